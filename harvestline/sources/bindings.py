"""Domain tables derived from the driver's TPC-H-shaped tables.

Mapping (all integer arithmetic so every engine agrees exactly):

* grower ``kpin``      = 100000 + s_suppkey; subzone via supplier → nation → region
* ``variety``          = part type mapped to a kiwifruit variety
* submission date      = l_shipdate; pack week = ISO week; season = export season label
* ``dm_centi``         = 1300 + (7·orderkey + 13·partkey + 31·suppkey + 101·linenumber) mod 701
* ``trays_submitted``  = 10 · quantity; trays lost = trays · round(100·discount) div 100
* ``loss_draw``        = (7·orderkey + 13·linenumber) mod 100
* ``size_code``        = cumulative-probability choice over (3·orderkey + 7·linenumber + partkey) mod 100

Scale notes: region and nation are fixed-size (5 and 25 rows in every
scale factor) and are broadcast explicitly.  supplier and part grow with the
data, so their joins are left to Catalyst/AQE: a broadcast hash join only
when the measured side is under ``autoBroadcastJoinThreshold``, sort-merge
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import formulas as DF
from ..functions.scalars import date_key, half_up_div, int_div, lookup, season_year
from .tables import read_table

VARIETY_ORDER = ["Green", "SunGold", "OrganicSunGold", "RubyRed", "OrganicGreen", "SweetGreen"]


def subzone_of_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region → subzone (fixed five-row table, broadcast)."""
    region = read_table(spark, sf_dir, "region", ["r_regionkey"])
    return F.broadcast(region.select(
        "r_regionkey", lookup("r_regionkey", C.REGION_SUBZONE).alias("subzone")))


def supplier_subzone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s_suppkey → subzone through nation and region (both fixed-size)."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    nz = F.broadcast(nation.join(subzone_of_region(spark, sf_dir),
                                 nation.n_regionkey == F.col("r_regionkey"))
                     .select("n_nationkey", "subzone"))
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    return supplier.join(nz, supplier.s_nationkey == nz.n_nationkey, "left").select("s_suppkey", "subzone")


def grower_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grower register: one row per supplier (the published register's columns)."""
    sz = supplier_subzone(spark, sf_dir)
    k = F.col("s_suppkey")
    variety = F.element_at(F.array(*[F.lit(v) for v in VARIETY_ORDER]), (k % len(VARIETY_ORDER) + 1).cast("int"))
    return sz.select(
        kpin_of("s_suppkey").alias("kpin"),
        "subzone",
        variety.alias("primary_variety"),
        variety.contains("Organic").alias("organic"),
        ((k % 20) + 2).cast("double").alias("orchard_ha"),
        lookup("subzone", {s: float(v["distance_port_km"]) for s, v in C.SUBZONES.items()}).alias("distance_port_km"),
        ((k % 7) == 0).alias("psa_history"),
        lookup("subzone", {s: v["base_risk_weight"] for s, v in C.SUBZONES.items()}).alias("base_risk_weight"),
        lookup("subzone", {s: v["dm_std_modifier"] for s, v in C.SUBZONES.items()}).alias("dm_std_modifier"),
    )


def size_code(u100) -> F.Column:
    """Weighted choice of the pallet size by cumulative probability."""
    expr = None
    acc = 0
    for code, p in zip(C.SIZE_CODES[:-1], C.SIZE_PROBS[:-1]):
        acc += int(round(p * 100))
        expr = F.when(u100 < acc, code) if expr is None else expr.when(u100 < acc, code)
    return expr.otherwise(C.SIZE_CODES[-1])


KPIN_BASE = 100000
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate"]


def submissions(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None, numbered: bool = False) -> DataFrame:
    """Pallet submission batches (the generator's submission table), one per
    lineitem.  ``lineitem`` may be a streaming DataFrame: part and supplier
    are then joined stream–static (STR5).  ``numbered`` gives each its order and
    line number, and leaves the subzone to whoever joins the growers."""
    j = varieties(spark, sf_dir, lineitem)
    if numbered:
        return described(j, *numbers())
    sz = supplier_subzone(spark, sf_dir)
    return described(j.join(sz, F.col("l_suppkey") == sz.s_suppkey), "subzone")


def varieties(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """The lineitems with the variety of their part."""
    li = (lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")).select(*LINEITEM_COLS)
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    return li.join(part, li.l_partkey == part.p_partkey).select(*LINEITEM_COLS, lookup("p_type", C.PART_TYPE_VARIETY).alias("variety"))


def numbers() -> list:
    return [F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number")]


def kpin_of(suppkey) -> F.Column:
    return (F.lit(KPIN_BASE) + F.col(suppkey)).cast("long")


def described(j: DataFrame, *extra) -> DataFrame:
    """Submissions from lineitems with their variety: all that follows from the row
    itself.  ``kpin`` is taken over where the rows have it."""
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    d = F.to_date("l_shipdate")
    variety = F.col("variety")
    dm_centi = (F.lit(1300) + (ok * 7 + pk * 13 + sk * 31 + ln * 101) % 701).cast("int")
    trays = (F.col("l_quantity").cast("long") * 10)
    disc_pct = F.round(F.col("l_discount") * 100).cast("long")
    base = j.select(
        F.col("kpin") if "kpin" in j.columns else kpin_of("l_suppkey").alias("kpin"),
        *extra,
        variety.alias("variety"),
        d.alias("submission_date"),
        date_key(d).alias("date_key"),
        F.weekofyear(d).alias("pack_week"),
        season_year(d).alias("season"),
        size_code((ok * 3 + ln * 7 + pk) % 100).alias("size_code"),
        trays.alias("trays_submitted"),
        int_div(trays * disc_pct, 100).alias("trays_lost"),
        dm_centi.alias("dm_centi"),
        ((ok * 7 + ln * 13) % 100).cast("int").alias("loss_draw"),
        ((sk % 5) == 0).cast("int").alias("pest_indicator"),
        (F.lit(95) + F.year(d) % 10).cast("double").alias("vol_index"),
    )
    out = base.withColumns({
        "trays_exported": F.col("trays_submitted") - F.col("trays_lost"),
        "loss_pct": F.col("trays_lost") * 100.0 / F.col("trays_submitted"),
        "dm_pct_avg": F.col("dm_centi") / 100.0,
        "mts_threshold": DF.mts_threshold("variety"),
        "mts_pass": DF.mts_pass("dm_centi", "variety"),
        "tzg_milli": DF.taste_milli("dm_centi", "variety"),
        "submit_payment_nzd": DF.submit_payment("variety", "size_code", "trays_submitted"),
    })
    out = out.withColumns({
        "tzg_score": F.col("tzg_milli") / 1000.0,
        "taste_payment_nzd": DF.taste_payment("tzg_milli", "trays_exported", "mts_pass"),
        "otif_impact": F.when(F.col("mts_pass"), 0.0).otherwise(C.MTS_BREACH_OTIF_PENALTY),
    })
    return out.withColumn("total_return_nzd",
                          DF.total_return("submit_payment_nzd", "taste_payment_nzd", "mts_pass"))


def feed_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External feed records (SRC12), one a month, from the month's orders: n orders
    give rain of n mod 5, none and (n mod 7) / 2 mm, rates of (500 + n mod 100) / 1000
    euros and 80 + n mod 10 yen, and n mod 3 verified ways."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderdate"]).where("o_orderdate is not null")
    months = orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return months.select(
        F.array((n % 5).cast("double"), F.lit(None).cast("double"), (n % 7) / 2.0).alias("precipitation_sum"),
        F.struct(((n % 100 + 500) / 1000.0).alias("EUR"), (n % 10 + 80).cast("double").alias("JPY")).alias("rates"),
        F.col("month").cast("string").alias("date"), (n % 3).cast("int").alias("ways"))
