"""File scans for the raw inputs (SRC1–SRC4, SRC6, SRC12) and the feed
enrichment join (JN12).

All reads use explicit all-string schemas and ``try_cast`` afterwards —
nothing is inferred, so a bad value becomes null instead of failing the
job.  Choices between encodings or delimiters are made from the whole file by
distributed aggregates; the chosen read is then a normal distributed scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.cleaning import dedupe_names

# FIXED VALUES: encodings tried in order by the published reader
ENCODINGS = ["utf-8-sig", "utf-8", "latin-1", "cp1252"]
# FIXED VALUES: (encoding, delimiter) strategies for the survey table
STRATEGIES = [("utf-8-sig", ","), ("utf-16", ","), ("utf-16-le", ","), ("latin-1", ","),
              ("utf-8", "\t"), ("utf-8", ";"), ("latin-1", "\t")]

_SPARK_CHARSET = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "latin-1": "ISO-8859-1", "cp1252": "windows-1252",
                  "utf-16": "UTF-16", "utf-16-le": "UTF-16LE"}


def string_schema(names) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _raw(spark: SparkSession, path: str, encoding: str, sep: str = ",", header: bool = True,
         schema: StructType | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    r = (spark.read.option("encoding", _SPARK_CHARSET.get(encoding, encoding)).option("sep", sep)
         .option("header", str(header).lower()).option("mode", mode).option("multiLine", "false"))
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "false")
    return r.csv(path)


def _replacement_chars(df: DataFrame) -> int:
    """U+FFFD count over the whole file (one distributed aggregate) — the sign of a wrong decoding."""
    cols = [F.coalesce(F.size(F.split(F.col(f"`{c}`"), "�")) - 1, F.lit(0)) for c in df.columns]
    total = sum(cols[1:], cols[0]) if cols else F.lit(0)
    row = df.agg(F.sum(total).alias("n")).first()
    return int(row["n"] or 0)


def judge_encodings(spark: SparkSession, path: str) -> tuple[dict[str, bool], bytes]:
    """Which single-byte and UTF-8 encodings every byte of a file is valid in, and its
    first line: one scan of the bytes judges all candidates."""
    lines = spark.read.text(path).select(F.col("value").cast("binary").alias("raw"), F.is_valid_utf8("value").alias("utf8"),
                                         F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line"))
    # FIXED VALUES: the bytes that windows-1252 leaves undefined
    undefined = F.hex("raw").rlike("^(..)*(81|8D|8F|90|9D)")
    found = lines.agg(F.min("utf8").alias("utf8"), (F.max(undefined.cast("int")) == 0).alias("cp1252"),
                      F.hex(F.min_by("raw", F.when(F.col("at") == 0, F.col("line")))).alias("head")).first()
    utf8 = found["utf8"] is not False
    valid = {"utf-8-sig": utf8, "utf-8": utf8, "latin-1": True, "cp1252": found["cp1252"] is not False}
    return valid, bytes.fromhex(found["head"] or "")


def read_csv(spark: SparkSession, path: str, charsets=ENCODINGS, header: bool = True) -> DataFrame:
    """SRC1: the first candidate encoding that all bytes of the file are valid in wins
    (the last one if none is).  Header names are repaired (PRJ2: a repeated name
    gets ``_1``, ``_2``) and given as an all-string schema."""
    import csv
    valid, head = judge_encodings(spark, path)
    enc = next((c for c in charsets if valid.get(c, False)), list(charsets)[-1])
    schema = None
    if header:
        line = head.decode(enc, "replace").lstrip("\ufeff").rstrip("\r")
        schema = string_schema(dedupe_names(next(csv.reader([line])) if line else []))
    return _raw(spark, path, enc, header=header, schema=schema)


def read_csv_glob(spark: SparkSession, pattern: str, predicate=None) -> DataFrame:
    """SRC2: many files, each by its own header, in one scan; the per-file filter is a
    normal predicate, and the source file name is kept for auditing.  Files
    with no matching rows simply contribute nothing.  Fields are read by place
    and named by the header of their file; a column that a file lacks is null
    there.  The driver sees the distinct headers, and no list of files."""
    import csv
    lines = spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("at"),
                                            F.monotonically_increasing_id().alias("line")).where("at = 0")
    heads = lines.groupBy("_path").agg(F.min_by("value", "line").alias("_head"))
    layouts = {r["_head"]: dedupe_names(next(csv.reader([r["_head"].lstrip("\ufeff").rstrip("\r")])))
               for r in heads.select("_head").distinct().orderBy("_head").collect()}  # a row a distinct header
    names = list(dict.fromkeys(n for layout in layouts.values() for n in layout))
    places = [f"_c{i}" for i in range(max(map(len, layouts.values()), default=0))]
    rows = (spark.read.option("header", "true").schema(string_schema(places or ["_c0"])).csv(pattern)
                 .withColumns({"_path": F.col("_metadata.file_path"), "_file": F.col("_metadata.file_name")}).join(heads, "_path"))
    columns = []
    for name in names:
        value = F.lit(None).cast("string")
        for head, layout in layouts.items():
            if name in layout:
                value = F.when(F.col("_head") == head, F.col(places[layout.index(name)])).otherwise(value)
        columns.append(value.alias(name))
    out = rows.select(*columns, "_file")
    return out.filter(predicate) if predicate is not None else out


def read_stat_table(spark: SparkSession, path: str, names, key: str = "year", skip_rows: int = 4) -> DataFrame:
    """SRC3: a statistics table with metadata rows above and footnotes below.
    Positional names; metadata and footer rows are the ones whose key does
    not parse as an integer, so no row skipping is needed (``skip_rows`` is
    kept for documentation of the source layout)."""
    df = _raw(spark, path, "utf-8-sig", header=False, schema=string_schema(names))
    return df.filter(F.trim(F.regexp_replace(F.col(key), '"', "")).try_cast("int").isNotNull())


def read_first_parsable(spark: SparkSession, path: str, strategies=STRATEGIES, stub: DataFrame | None = None) -> DataFrame:
    """SRC4: try (encoding, delimiter) pairs; the first that decodes the whole
    file and gives at least two columns and one row wins, else the given
    literal stub.  No line is dropped: fields that a line lacks are null."""
    for enc, sep in strategies:
        try:
            df = _raw(spark, path, enc, sep=sep, mode="PERMISSIVE")
            if len(df.columns) >= 2 and not df.isEmpty() and _replacement_chars(df) == 0:
                return df
        except (AnalysisException, IllegalArgumentException):  # an unreadable strategy is skipped, as in the source
            continue
    if stub is None:
        raise ValueError(f"no strategy could parse {path}")
    return stub


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: a two-section file (location block, blank line, daily rows);
    only rows whose first field is a date are kept."""
    names = ["time", "precipitation_sum_mm", "temperature_2m_max_c", "c4", "c5", "c6"]
    df = _raw(spark, path, "utf-8", header=False, schema=string_schema(names))
    d = F.try_to_date(F.col("time"))
    return df.filter(d.isNotNull()).select(
        d.alias("date"), F.col("precipitation_sum_mm").try_cast("double").alias("precipitation_sum_mm"),
        F.col("temperature_2m_max_c").try_cast("double").alias("temperature_2m_max_c"))


FEED_SCHEMA = ("precipitation_sum array<double>, rates struct<EUR: double, JPY: double>, "
               "date string, ways int")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: landed external feed records (JSON lines), every part optional."""
    return spark.read.schema(FEED_SCHEMA).json(path)


def feed_values(feed: DataFrame) -> DataFrame:
    """By landing: its date, the 7-day rain total (nulls skipped, FN16), exchange
    rates and whether the corridors were verified; a missing part is null."""
    from ..functions.scalars import array_sum_skip_null
    return feed.select(
        F.col("date").alias("fx_date"), F.round(array_sum_skip_null("precipitation_sum"), 1).alias("rain_feed"),
        F.round(F.col("rates.EUR"), 4).alias("nzd_eur"), F.round(F.col("rates.JPY"), 2).alias("nzd_jpy"),
        F.when(F.col("ways").isNotNull(), F.col("ways") > 0).alias("corridors_verified"))


def enrich_feed(agg: DataFrame, feed: DataFrame, date_col: str | None = None) -> DataFrame:
    """JN12: override a season's rain with the feed's total and add FX and a
    corridor-verified flag; a missing part leaves the ETL value and a null field,
    as each published call is independently guarded.  With ``date_col`` a row
    takes the landing that is valid at its date, else the latest one."""
    from ..operators.joins import as_of
    landings = feed_values(feed)
    if date_col is None:
        # at most one row: no landing, no change
        latest = landings.agg(F.max(F.struct(F.coalesce("fx_date", F.lit("")).alias("_day"), *landings.columns)).alias("r"))
        j = agg.join(F.broadcast(latest.where("r is not null").select("r.*").drop("_day")), on=F.lit(True), how="left")
    else:
        j = as_of(agg, landings, date_col, "fx_date")
    return (j.withColumn("rain_source", F.when(F.col("rain_feed").isNotNull(), F.lit("feed")).otherwise(F.lit("etl")))
             .withColumn("rain_avg", F.coalesce(F.col("rain_feed"), F.col("rain_avg"))).drop("rain_feed"))
