"""Column builders shared by every load: safe casts, cleansing, calendar keys.

Every builder returns a built-in Spark expression, so it stays inside whole-stage
codegen and can be pushed through projections; none is a Python UDF.

The casts reproduce the warehouse's text-to-type rules, which are those of the
original embedded SQL dialect, not Spark's defaults (see the trap tests):

* text -> int: spaces ignored, decimals and exponents rounded half away from zero,
  junk and overflow give NULL ('225.5' -> 226, '1e3' -> 1000, '99999999999' -> NULL);
* text -> timestamp/date: a full ``YYYY-M-D`` date is required ('2017-10' -> NULL,
  although Spark alone would read it as 2017-10-01);
* a typed raw column takes no way through text (``declared``);
* minutes between two timestamps count minute boundaries crossed
  (00:00:59 -> 00:01:00 is one minute).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# A full calendar date at the start of the text, optionally followed by a time.
FULL_DATE_PATTERN = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"

# Minute numbers are counted from this instant, so flooring is exact for any
# timestamp the warehouse can hold and no session time zone is involved.
_MINUTE_ANCHOR = "TIMESTAMP_NTZ '0001-01-01 00:00:00'"


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _text(x) -> Column:
    return F.trim(col(x).cast("string"))


def try_int(x) -> Column:
    """Text to INT; NULL when the text is not a number or does not fit."""
    return _text(x).try_cast("decimal(38,10)").cast("decimal(38,0)").try_cast("int")


def try_dec(x, precision: int = 10, scale: int = 2) -> Column:
    """Text to DECIMAL(p,s), rounding half away from zero; NULL on junk or overflow."""
    return _text(x).try_cast(f"decimal({precision},{scale})")


def try_ts(x) -> Column:
    """Text to TIMESTAMP (no zone); NULL unless the text holds a full date."""
    s = _text(x)
    return F.when(s.rlike(FULL_DATE_PATTERN), s.try_cast("timestamp_ntz"))


def try_date(x) -> Column:
    """Text holding a date or a timestamp to DATE; NULL unless it parses as a timestamp."""
    return try_ts(x).cast("date")


_KINDS = {
    "int": {"tinyint", "smallint", "int", "bigint", "float", "double"},
    "decimal(10,2)": {"tinyint", "smallint", "int", "bigint", "float", "double"},
    "timestamp_ntz": {"timestamp", "timestamp_ntz", "date"},
}


def fits(physical: str, kind: str) -> bool:
    """Whether a file may store a column of this declared kind as ``physical``."""
    return physical == "string" or kind == "string" or physical in _KINDS[kind] or (kind != "timestamp_ntz" and physical.startswith("decimal"))


def declared(df, column: str, kind: str) -> Column:
    """A raw column in its declared kind, by how it is stored: text goes through the safe casts
    above, a typed column is only widened or narrowed (so filters on it reach the scan).  A
    value that doesn't fit is NULL."""
    physical = dict(df.dtypes)[column]
    if physical == kind:
        return col(column)
    if physical == "string":
        return {"int": try_int, "decimal(10,2)": try_dec, "timestamp_ntz": try_ts}[kind](column)
    if not fits(physical, kind):
        raise TypeError(f"column {column} is stored as {physical}, not as text or {kind}")
    if kind == "int" and physical in ("float", "double"):
        return F.rint(column).try_cast("int")  # the original dialect rounds these half to even
    if kind == "int" and physical.startswith("decimal"):
        return F.round(column, 0).try_cast("int")
    return col(column).try_cast(kind)


def clean_lower(x) -> Column:
    return F.lower(F.trim(col(x)))


def clean_upper(x) -> Column:
    return F.upper(F.trim(col(x)))


def or_unknown(x) -> Column:
    return F.coalesce(col(x), F.lit("unknown"))


def distinct_from(a, b) -> Column:
    """Null-safe inequality (``a IS DISTINCT FROM b``)."""
    return ~col(a).eqNullSafe(col(b))


def any_distinct(pairs) -> Column:
    out = F.lit(False)
    for a, b in pairs:
        out = out | distinct_from(a, b)
    return out


def date_key(x) -> Column:
    """Smart date key YYYYMMDD as INT, from a DATE or a TIMESTAMP; NULL stays NULL."""
    d = col(x).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week0(x) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(col(x)) - 1).cast("int")


def minute_number(x) -> Column:
    return F.timestamp_diff("MINUTE", F.expr(_MINUTE_ANCHOR), col(x).cast("timestamp_ntz"))


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (negative when end is earlier)."""
    return minute_number(end) - minute_number(start)


def cents(x) -> Column:
    """A DECIMAL of two places as a LONG number of cents."""
    return (col(x) * 100).cast("long")


def hundredths(x, scale: int = 2) -> Column:
    """A LONG as a DECIMAL with its last ``scale`` digits behind the point."""
    return col(x).cast("decimal(20,0)") * F.lit(Decimal((0, (1,), -scale)))


def _floor_div(a: Column, b: Column) -> Column:
    # Integer division of a >= 0 by b > 0, on longs.
    return F.call_function("div", a, b)


def round_ratio(num, den, scale: int = 2, precision: int = 10) -> Column:
    """``num / den`` rounded half away from zero to ``scale`` places, as DECIMAL.

    Integer arithmetic throughout, so the value is exact (no double rounding);
    NULL when ``den`` is NULL or zero or ``num`` is NULL.
    """
    n = col(num).cast("long")
    d = col(den).cast("long")
    m = 10 ** scale
    q = _floor_div(F.abs(n) * (2 * m) + d, d * 2)
    value = hundredths(F.when(n < 0, -q).otherwise(q), scale)
    return F.when(d > 0, value.cast(f"decimal({precision},{scale})"))
