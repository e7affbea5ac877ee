"""Data-quality operators (DQ1–DQ8, SNK7–SNK8).

Checks are aggregates (one pass each, partial aggregation map-side) or
anti-joins; none collects rows to the driver.  A cleaning path that groups by
``removed_by`` counts the rows of its steps without an extra pass (DQ1/DQ4).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .aggregates import pct


#: Columns of ``fact_health`` that count violations of integrity: one refuses a batch.
HARD_CHECKS = ("nulls", "no_date", "bad_trays", "bad_return", "bad_otif", "bad_risk")


AUDIT = "run_id string, number int, step string, rows_in long, rows_out long, status string"


def removed_by(steps: dict) -> Column:
    """The first step of a cleaning path whose condition a row does not meet, or null
    (DQ1): a path that groups by it counts what every step removes in the same scan."""
    out = F.lit(None).cast("string")
    for name, kept in reversed(list(steps.items())):
        out = F.when(F.coalesce(kept, F.lit(False)), out).otherwise(F.lit(name))
    return out


def audit_rows(removed: DataFrame, steps, run_id: str) -> DataFrame:
    """One row a step from counts (step, n) of removed rows and, with a null step, of
    kept ones (DQ4): what came in, what was kept, and a warning where nothing was."""
    counts = {r["step"]: r["n"] for r in removed.groupBy("step").agg(F.sum("n").alias("n")).collect()}  # a row a step
    rows, left = [], sum(counts.values())
    for number, name in enumerate(["read", *steps]):
        before, left = left, left - counts.get(name, 0)
        rows.append((run_id, number, name, before, left, "OK" if left else "WARN"))
    return removed.sparkSession.createDataFrame(rows, AUDIT)


def steps_violating(audit: DataFrame, most_removed: dict[str, float]) -> DataFrame:
    """DQ4: audited steps that removed a larger share of their rows than expected."""
    limit = F.create_map(*[x for k, v in most_removed.items() for x in (F.lit(k), F.lit(float(v)))])
    share = F.when(F.col("rows_in") > 0, 1 - F.col("rows_out") / F.col("rows_in")).otherwise(0.0)
    return audit.where(share > limit[F.col("step")])


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their multiplicity (DQ2)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_pk(df: DataFrame, keys, name: str) -> DataFrame:
    """One row: duplicate-key groups plus rows with a null key part (DQ2)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    null_any = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dups = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("v"))
    nulls = df.agg(F.sum(null_any.cast("long")).alias("v"))
    return (dups.crossJoin(nulls.withColumnRenamed("v", "w"))
                .select(F.lit(name).alias("check_name"),
                        (F.col("v") + F.coalesce(F.col("w"), F.lit(0))).cast("long").alias("violations")))


def check_fk(df: DataFrame, dim: DataFrame, keys, name: str) -> DataFrame:
    """One row: child rows whose key has no parent (DQ3, left_anti)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    orphans = df.select(*keys).join(dim.select(*keys), keys, "left_anti")
    return orphans.agg(F.count(F.lit(1)).cast("long").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations")


def check_counts(source: DataFrame, loaded: DataFrame, name: str) -> DataFrame:
    """Source vs loaded row count difference (DQ4)."""
    a = source.agg(F.count(F.lit(1)).alias("a"))
    b = loaded.agg(F.count(F.lit(1)).alias("b"))
    return a.crossJoin(b).select(F.lit(name).alias("check_name"), F.abs(F.col("a") - F.col("b")).cast("long").alias("violations"))


def check_range(df: DataFrame, cond_pass, lo: float, hi: float, name: str) -> DataFrame:
    """Share of rows meeting ``cond_pass`` must lie in [lo, hi] % (DQ7)."""
    g = df.agg(F.avg(F.when(cond_pass, 100.0).otherwise(0.0)).alias("rate"))
    return g.select(F.lit(name).alias("check_name"),
                    F.when(F.col("rate").between(lo, hi), 0).otherwise(1).cast("long").alias("violations"))


def schema_diff(df: DataFrame, expected_schema) -> dict:
    """Missing and extra columns against a declared schema (DQ5) — a
    planner-side comparison of two column lists, no data touched."""
    have = set(df.columns)
    want = [f.name for f in expected_schema.fields] if hasattr(expected_schema, "fields") else list(expected_schema)
    return {"missing": [c for c in want if c not in have], "extra": sorted(have - set(want))}


def load_to_schema(df: DataFrame, schema, renames: dict | None = None) -> DataFrame:
    """SNK3: rename, keep the declared columns in order, null the missing
    ones, drop the extras, cast to the declared types (booleans → 0/1 ints
    where the target is integral)."""
    if renames:
        df = df.withColumnsRenamed(renames)
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            src = df.schema[f.name].dataType.typeName()
            if src == "boolean" and f.dataType.typeName() in ("integer", "long"):
                c = c.cast("int")
            cols.append(c.cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def star_checks(fact: DataFrame, readings: DataFrame, corridor: DataFrame, time_dim: DataFrame,
                growers: DataFrame | None = None) -> DataFrame:
    """All key checks over the star schema as one small table (DQ2, DQ3)."""
    parts = [
        check_pk(readings, ["kpin", "season", "pack_week", "variety"], "pk_dim_fruit_quality"),
        check_pk(corridor, ["corridor_key"], "pk_dim_corridor"),
        check_pk(time_dim, ["date_key"], "pk_dim_time"),
        check_fk(fact, readings, ["kpin", "season", "pack_week", "variety"], "fk_fact_fruit"),
        check_fk(fact.filter(F.col("date_key").isNotNull()), time_dim, ["date_key"], "fk_fact_time"),
        check_fk(fact, corridor, ["corridor_key"], "fk_fact_corridor"),
    ]
    if growers is not None:
        parts += [check_pk(growers, ["kpin"], "pk_dim_grower"),
                  check_fk(fact, growers, ["kpin"], "fk_fact_grower"),
                  check_fk(growers, corridor, ["corridor_key"], "fk_grower_corridor")]
    return reduce(DataFrame.unionByName, parts)


#: Cells of the fact that must not be null.
KEY_COLS = ["season", "subzone", "variety", "pack_week", "dm_pct_avg", "otif_pct", "risk_score", "total_return_nzd",
            "trays_submitted", "trays_exported", "trays_lost", "mts_pass"]


def health_counts() -> dict:
    """What a row of the fact adds to each count of DQ8; a check that cannot be told for nulls is violated."""
    def violated(holds):
        return F.when(F.coalesce(holds, F.lit(False)), 0).otherwise(1).cast("long")

    return {
        "nulls": reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in KEY_COLS]),
        "no_date": F.col("date_key").isNull().cast("long"),
        "bad_trays": violated(F.col("trays_exported") + F.col("trays_lost") == F.col("trays_submitted")),
        "bad_return": violated(F.col("mts_pass") | (F.col("total_return_nzd") == 0)),
        "bad_otif": violated(F.col("otif_pct").between(C.OTIF_FLOOR, C.OTIF_BASE)),
        "bad_risk": violated(F.col("risk_score").between(1, 100)),
        "passed": F.coalesce(F.col("mts_pass"), F.lit(False)).cast("long"),
        "rows": F.lit(1).cast("long"),
    }


def health_score(pass_lo: float = 85.0, pass_hi: float = 97.0):
    """The share of checks passed, 0 to 100, from summed ``health_counts``; no rows pass none."""
    checks = [F.col(c) == 0 for c in HARD_CHECKS] + [F.col("pass_rate").between(pass_lo, pass_hi)]
    passed = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(False)).cast("int") for c in checks])
    return ((passed * 100) / len(checks)).cast("double")


def fact_health(f: DataFrame, pass_lo: float = 85.0, pass_hi: float = 97.0) -> DataFrame:
    """DQ8: health score 0–100 from the fact in one aggregate pass.

    Checks: no null keys/measures, every row has a date key, exported + lost
    = submitted, failed fruit returns 0, OTIF and risk within their model
    bounds, and the pass rate inside the expected range (DQ7).  The score is
    the share of checks passed; ``nulls`` counts null cells in key columns.
    """
    g = f.agg(*[F.sum(v).alias(k) for k, v in health_counts().items()])
    g = g.withColumn("pass_rate", pct("passed", "rows", 3))
    return g.select("nulls", health_score(pass_lo, pass_hi).alias("health_score"), "pass_rate", *HARD_CHECKS[1:])


def table_summary(tables: dict, keys: dict) -> DataFrame:
    """SNK8: table, row count, key and grain, with the number of rows that repeat a
    key; ``keys`` gives the key columns of each table."""
    parts = []
    for name, df in tables.items():
        key = [keys[name]] if isinstance(keys[name], str) else list(keys[name])
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("repeated"))
                     .select(F.lit(name).alias("table"), "rows", F.lit(", ".join(key)).alias("key"), "repeated"))
    return reduce(DataFrame.unionByName, parts)


def audit_table(results: DataFrame, run_id: str) -> DataFrame:
    """SNK7: tag check results with the run id and status for an append-only audit table."""
    return results.select(F.lit(run_id).alias("run_id"), "check_name", "violations",
                          F.when(F.col("violations") == 0, "OK").otherwise("ALERT").alias("status"))
