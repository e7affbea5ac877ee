"""Projection, schema and cleaning operators (PRJ1–PRJ21) and filters (FLT1–FLT5).

Column-name operators run on the driver over ``df.columns`` (planner-side,
no data touched); value operators are Column expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col, to_numeric, unsuppress


# --------------------------------------------------------------------------
# Names (PRJ1–PRJ6)
# --------------------------------------------------------------------------

def normalise_name(name: str, case: str = "lower") -> str:
    n = str(name).strip().replace(" ", "_").replace("-", "_")
    return n.lower() if case == "lower" else n.upper() if case == "upper" else n


def normalise_columns(df: DataFrame, case: str = "lower") -> DataFrame:
    """Strip, case-fold, space and dash → underscore (PRJ1); duplicates
    that appear after folding are suffixed (PRJ2)."""
    return df.toDF(*dedupe_names([normalise_name(c, case) for c in df.columns]))


def dedupe_names(names) -> list:
    """``a, a, a`` → ``a, a_1, a_2`` (PRJ2).  The names are always distinct: a
    suffix that another column already has is passed over."""
    names = list(names)
    taken, out = set(names), []
    for i, name in enumerate(names):
        k, new = 0, name
        while new in out or (k and new in taken):
            k += 1
            new = f"{name}_{k}"
        out.append(new)
    return out


def dedupe_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*dedupe_names(df.columns))


def require_columns(df: DataFrame, required, prefix_len: int = 4) -> DataFrame:
    """Required-column check with a prefix remap for near-miss names (PRJ3):
    a missing ``TRAFFIC_COUNT`` is taken from a column starting ``TRAF``."""
    renames = {}
    for r in required:
        if r in df.columns:
            continue
        cands = [c for c in df.columns if c.upper().startswith(r.upper()[:prefix_len]) and c not in required]
        if cands:
            renames[cands[0]] = r
    out = df.withColumnsRenamed(renames) if renames else df
    missing = [r for r in required if r not in out.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return out


def find_column(df: DataFrame, any_of=(), all_of=()) -> str | None:
    """First column whose lower-case name contains any of ``any_of`` and all
    of ``all_of`` (PRJ4)."""
    for c in df.columns:
        lc = c.lower()
        if (not any_of or any(a in lc for a in any_of)) and all(a in lc for a in all_of):
            return c
    return None


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """PRJ5."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_existing(df: DataFrame, cols) -> DataFrame:
    """Keep the listed columns that exist, in the given order (PRJ6)."""
    return df.select(*[c for c in cols if c in df.columns])


# --------------------------------------------------------------------------
# Values (PRJ7–PRJ21)
# --------------------------------------------------------------------------

def coerce_numeric(df: DataFrame, cols, type_: str = "double") -> DataFrame:
    """Numeric coercion, unparsable → null (PRJ7)."""
    return df.withColumns({c: to_numeric(c, type_) for c in cols})


def unsuppress_columns(df: DataFrame, cols, symbols=("..", ""), fill=0) -> DataFrame:
    """Suppression symbols → null → ``fill``, then numeric (PRJ9)."""
    return df.withColumns({c: F.coalesce(to_numeric(unsuppress(c, symbols)), F.lit(fill)) for c in cols})


def drop_null(df: DataFrame, how: str = "any", subset=None) -> DataFrame:
    """PRJ10."""
    return df.dropna(how=how, subset=subset)


def drop_dupes(df: DataFrame) -> DataFrame:
    """Exact duplicate removal (PRJ11)."""
    return df.dropDuplicates()


def fill0(df: DataFrame, cols) -> DataFrame:
    """Nulls → 0 after a pivot (PRJ12)."""
    return df.fillna(0, subset=list(cols))


def ensure_columns(df: DataFrame, cols, value=0) -> DataFrame:
    """Add absent columns with a constant (PRJ13)."""
    return df.withColumns({c: F.lit(value) for c in cols if c not in df.columns})


def bool_to_int(df: DataFrame) -> DataFrame:
    """Every boolean column → 0/1 (PRJ14)."""
    return df.withColumns({f.name: F.col(f.name).cast("int") for f in df.schema.fields
                           if f.dataType.typeName() == "boolean"})


def coalesce_from(df: DataFrame, c: str, fallback: str) -> DataFrame:
    """Own value, else the joined fallback; the fallback is dropped (PRJ17)."""
    return df.withColumn(c, F.coalesce(F.col(c), F.col(fallback))).drop(fallback)


def scale(c, k: float) -> Column:
    """Unit scaling (PRJ19)."""
    return col(c) * F.lit(k)


def pad_site(c, width: int = 8) -> Column:
    """Restore leading zeros lost by a spreadsheet: all-digit ids shorter
    than ``width`` are left-padded (PRJ21)."""
    s = F.trim(col(c).cast("string"))
    return F.when(s.rlike("^[0-9]+$") & (F.length(s) < width), F.lpad(s, width, "0")).otherwise(s)


def clean_survey(df: DataFrame, region_col: str, value_cols) -> DataFrame:
    """Survey clean-up (PRJ20): trim the region, drop footnote and blank rows,
    thousands commas stripped, ``S`` (suppressed) → null, ``-`` (nil) → 0,
    and a subtotal flag for rows named 'Total…'."""
    region = F.trim(F.col(region_col))
    out = df.withColumn(region_col, region)
    out = out.filter(region.isNotNull() & (region != "") & ~region.rlike(r"^(\(|Note|Source|Symbol|Footnote|[0-9]+\.)"))
    vals = {}
    for c in value_cols:
        s = F.trim(F.col(c).cast("string"))
        vals[c] = (F.when(s == "S", F.lit(None).cast("double"))
                   .when(s == "-", F.lit(0.0))
                   .otherwise(to_numeric(s)))
    out = out.withColumns(vals)
    return out.withColumn("is_subtotal", F.lower(F.col(region_col)).startswith("total"))


# --------------------------------------------------------------------------
# Filters (FLT1–FLT5)
# --------------------------------------------------------------------------

def region_filter(df: DataFrame, c: str, name: str, code: str) -> DataFrame:
    """Case-insensitive name match OR code substring; null → false (FLT1)."""
    x = F.col(c)
    return df.filter(F.coalesce(F.lower(x).contains(name.lower()) | x.contains(code), F.lit(False)))


def region_filter_rx(df: DataFrame, c: str, rx: str) -> DataFrame:
    """Case-insensitive regex alternation; null → false (FLT2)."""
    return df.filter(F.coalesce(F.col(c).rlike("(?i)" + rx), F.lit(False)))


def prefix_filter(df: DataFrame, c: str, prefix: str) -> DataFrame:
    """Text prefix test (FLT3).  On a string column of a Parquet scan this
    pushes down as ``StringStartsWith``."""
    return df.filter(F.col(c).cast("string").startswith(prefix))


def threshold(df: DataFrame, c: str, op: str, value) -> DataFrame:
    """FLT4/FLT5: equality or threshold on one column."""
    ops = {"=": F.col(c) == value, ">": F.col(c) > value, "<": F.col(c) < value,
           ">=": F.col(c) >= value, "<=": F.col(c) <= value}
    return df.filter(ops[op])
