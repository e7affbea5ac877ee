"""Scalar helpers (FN1–FN16) as Column expressions.

Everything here stays inside Catalyst: no Python runs per row.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """Column from a name; Columns pass through; other values become literals."""
    if isinstance(c, str):
        return F.col(c)
    return c if isinstance(c, Column) else F.lit(c)


def lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def dec(v, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal literal (money and rates never go through binary floats)."""
    return F.lit(Decimal(str(v))).cast(f"decimal({precision},{scale})")


def clamp(x, lo, hi) -> Column:
    """least(greatest(x, lo), hi) — FN10.  A null input stays null
    (``greatest``/``least`` skip nulls, a clip must not)."""
    v = col(x)
    return F.when(v.isNotNull(), F.least(F.greatest(v, lit(lo)), lit(hi)))


def int_div(a, b) -> Column:
    """Exact integral division for non-negative longs (no binary floats); null over zero."""
    x, y = col(a).cast("long"), col(b).cast("long")
    return F.when(y != 0, F.call_function("div", x, y))


def half_up_div(num, den) -> Column:
    """num/den rounded half-up to an integer, exact for non-negative operands.

    Used where a published formula rounds a ratio: integer arithmetic gives
    the same answer on every engine and every partitioning.
    """
    n, d = col(num).cast("long"), col(den).cast("long")
    return int_div(n * 2 + d, d * 2)


def half_up_wide(a, factor, b) -> Column:
    """a · factor / b rounded half-up to a whole number, for whole numbers of which
    the product outgrows a long; null where b is null or 0."""
    num, den = (col(x).cast("decimal(30,0)") for x in (a, b))
    twice = (num * col(factor).cast("decimal(8,0)") * F.lit(2) + den).cast("decimal(38,0)")
    by = F.when(den != 0, den * F.lit(2)).cast("decimal(38,0)")
    return ((twice - F.pmod(twice, by)) / by).cast("long")


def lookup(c, mapping: Mapping, default=None) -> Column:
    """Small fixed lookup as a CASE chain (JN10 for config-sized tables)."""
    x = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == F.lit(k), lit(v)) if expr is None else expr.when(x == F.lit(k), lit(v))
    if expr is None:
        return lit(default)
    return expr.otherwise(lit(default)) if default is not None else expr


# --------------------------------------------------------------------------
# Coercion (PRJ7, PRJ8, PRJ9)
# --------------------------------------------------------------------------

def to_numeric(c, type_: str = "double") -> Column:
    """Strip quotes, spaces and thousands commas, then try_cast: bad → null."""
    cleaned = F.trim(F.regexp_replace(F.regexp_replace(col(c).cast("string"), '"', ""), ",", ""))
    return cleaned.try_cast(type_)


def to_ts(c, fmt: str | None = None) -> Column:
    """Timestamp parse, null on error (FN5)."""
    s = col(c).cast("string")
    return F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)


def unsuppress(c, symbols=("..", "", "S"), fill=None) -> Column:
    """Suppression symbols → null (→ fill when given)."""
    s = F.trim(col(c).cast("string"))
    v = F.when(s.isin(list(symbols)) | s.isNull(), F.lit(None)).otherwise(s)
    return F.coalesce(v, lit(fill)) if fill is not None else v


# --------------------------------------------------------------------------
# Dates (FN6, FN7, DF2–DF5)
# --------------------------------------------------------------------------

def date_key(d) -> Column:
    """YYYYMMDD as int (integer arithmetic, no formatting)."""
    x = col(d)
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")


def iso_week(d) -> Column:
    return F.weekofyear(col(d))


def iso_year(d) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), col(d))


def season_year(d) -> Column:
    """Export season label: April onwards → 'y/(y+1)%100', else '(y-1)/y%100' (DF3)."""
    x = col(d)
    y = F.year(x)
    start = F.when(F.month(x) >= 4, y).otherwise(y - 1)
    return F.concat(start.cast("string"), F.lit("/"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def season_phase(week) -> Column:
    """KiwiStart before week 14, MainPack to week 22, then Late (DF2)."""
    w = col(week)
    return (F.when(w < 14, "KiwiStart").when(w <= 22, "MainPack")
            .when(w.isNotNull(), "Late"))


def is_pack_season(d) -> Column:
    """Month in March..August (DF4)."""
    return F.month(col(d)).between(3, 8)


def pack_week_date(season_start, pack_week) -> Column:
    """Season start + 7·(pw − 11) days (DF5)."""
    return F.date_add(col(season_start), ((col(pack_week) - 11) * 7).cast("int"))


# --------------------------------------------------------------------------
# Arrays / JSON (FN15, FN16)
# --------------------------------------------------------------------------

def array_sum_skip_null(a) -> Column:
    """Sum of an array ignoring nulls; null for an empty or all-null array."""
    kept = F.filter(col(a), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x))


def json_field(c, path: str, default=None) -> Column:
    v = F.get_json_object(col(c), path)
    return F.coalesce(v, lit(default)) if default is not None else v
