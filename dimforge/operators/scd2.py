"""Slowly changing dimension, type 2 with type 1 columns, as one state transition.

Post-state for each history row ``h`` whose business key has a source row ``s``:

* type 1 columns take ``s``'s values on every version, open or closed;
* if ``h`` is current and a type 2 column IS DISTINCT FROM ``s``'s, ``h`` is closed
  (``is_current = FALSE``, ``scd_end_date = as_of - 1 day``) -- unless ``h`` opened on
  ``as_of`` itself, in which case its type 2 columns are updated in place (closing it
  would give an end before its start);
* history rows without a source row are untouched (no delete detection).

Then every source key left without a current row (new, just closed, or only closed
versions) gets one new current version starting ``as_of``.  Running twice with the
same source and ``as_of`` changes nothing the second time.  A source row without its key opens no
version.

Plan: one left join history x source on the key, written once to the checkpoint folder;
then one anti join of the source against the keys that still have a current row there, so
history is scanned and joined once.  A current version that opens after ``as_of`` means a
back-dated run; it is refused rather than overwritten.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_distinct
from .joins import by_rows
from .keys import assign_keys, has_key, max_key, require_unique, written


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def _as_date(as_of):
    if isinstance(as_of, (dt.date, str)):
        return F.lit(as_of).cast("date")
    return as_of


def scd2_apply(
    hist: DataFrame,
    source: DataFrame,
    key_cols,
    type1_cols,
    type2_cols,
    as_of,
    sk_col: str,
    start_col: str = "scd_start_date",
    end_col: str = "scd_end_date",
    current_col: str = "is_current",
    key_offset: int | None = None,
) -> DataFrame:
    """``key_offset`` is the largest surrogate key in use, where the caller knows it."""
    key_cols, t1, t2 = _list(key_cols), _list(type1_cols), _list(type2_cols)
    source = has_key(source, key_cols)
    require_unique(source, key_cols, "SCD source")
    as_of_c = _as_date(as_of)
    if hist.where(F.col(current_col) & (F.col(start_col) > as_of_c)).limit(1).count():
        raise ValueError(f"a current version starts after {as_of}: this run is back-dated")
    src = source.select(*key_cols, *t1, *t2)
    s = src.select(*key_cols, *[F.col(c).alias(f"_s_{c}") for c in t1 + t2], F.lit(True).alias("_hit"))
    h = hist.join(by_rows(s), key_cols, "left")

    hit = F.col("_hit").isNotNull()
    changed = F.col(current_col) & hit & any_distinct([(c, f"_s_{c}") for c in t2])
    same_day = F.col(start_col) == as_of_c
    close = F.coalesce(changed & ~same_day, F.lit(False))
    in_place = F.coalesce(changed & same_day, F.lit(False))

    cols = []
    for c in hist.columns:
        if c in t1:
            cols.append(F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c in t2:
            cols.append(F.when(in_place, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c == current_col:
            cols.append(F.when(close, F.lit(False)).otherwise(F.col(c)).alias(c))
        elif c == end_col:
            cols.append(F.when(close, F.date_sub(as_of_c, 1)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    updated = written(h.select(*cols))

    still_open = updated.where(F.col(current_col)).select(*key_cols)
    opened = src.join(by_rows(still_open), key_cols, "left_anti").select(
        *key_cols,
        *t1,
        *t2,
        as_of_c.alias(start_col),
        F.lit(None).cast("date").alias(end_col),
        F.lit(True).alias(current_col),
    )
    offset = max_key(hist, sk_col) if key_offset is None else key_offset
    keyed = assign_keys(opened, sk_col, key_cols, offset=offset)
    return updated.unionByName(keyed.select(*hist.columns))


def scd2_update_type1(hist, source, key_cols, type1_cols):
    """Step 1 of the textbook form: type 1 columns take the source's values on every version."""
    key_cols, t1 = _list(key_cols), _list(type1_cols)
    s1 = source.select(*key_cols, *[F.col(c).alias(f"_s_{c}") for c in t1], F.lit(True).alias("_hit"))
    h = hist.join(s1, key_cols, "left")
    return h.select(*[
        F.when(F.col("_hit").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
        if c in t1 else F.col(c)
        for c in hist.columns
    ])


def scd2_close_changed(hist, source, key_cols, type2_cols, as_of,
                       start_col="scd_start_date", end_col="scd_end_date", current_col="is_current"):
    """Step 2: close current versions whose type 2 columns changed (in place on the opening day)."""
    key_cols, t2 = _list(key_cols), _list(type2_cols)
    as_of_c = _as_date(as_of)
    s2 = source.select(*key_cols, *[F.col(c).alias(f"_s_{c}") for c in t2], F.lit(True).alias("_hit"))
    h = hist.join(s2, key_cols, "left")
    changed = F.coalesce(
        F.col(current_col) & F.col("_hit").isNotNull() & any_distinct([(c, f"_s_{c}") for c in t2]),
        F.lit(False),
    )
    same_day = F.col(start_col) == as_of_c
    return h.select(*[
        F.when(changed & ~same_day, F.lit(False)).otherwise(F.col(c)).alias(c) if c == current_col
        else F.when(changed & ~same_day, F.date_sub(as_of_c, 1)).otherwise(F.col(c)).alias(c)
        if c == end_col
        else F.when(changed & same_day, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in t2
        else F.col(c)
        for c in hist.columns
    ])


def scd2_open_missing(hist, source, key_cols, type1_cols, type2_cols, as_of, sk_col,
                      start_col="scd_start_date", end_col="scd_end_date", current_col="is_current",
                      key_offset=None):
    """Step 3: new current versions for source keys without a current row (new rows only)."""
    key_cols, t1, t2 = _list(key_cols), _list(type1_cols), _list(type2_cols)
    as_of_c = _as_date(as_of)
    src = has_key(source, key_cols).select(*key_cols, *t1, *t2)
    opened = src.join(hist.where(F.col(current_col)).select(*key_cols), key_cols, "left_anti").select(
        *key_cols, *t1, *t2, as_of_c.alias(start_col),
        F.lit(None).cast("date").alias(end_col), F.lit(True).alias(current_col),
    )
    offset = max_key(hist, sk_col) if key_offset is None else key_offset
    return assign_keys(opened, sk_col, key_cols, offset=offset).select(*hist.columns)


def scd2_three_step(
    hist, source, key_cols, type1_cols, type2_cols, as_of, sk_col,
    start_col="scd_start_date", end_col="scd_end_date", current_col="is_current",
):
    """The textbook three statements (update type 1, close, open), used as a test oracle.

    Same-day changes follow ``scd2_apply``'s ruling, so both must agree everywhere.
    """
    step1 = scd2_update_type1(hist, source, key_cols, type1_cols)
    step2 = scd2_close_changed(step1, source, key_cols, type2_cols, as_of, start_col, end_col, current_col)
    opened = scd2_open_missing(step2, source, key_cols, type1_cols, type2_cols, as_of, sk_col,
                               start_col, end_col, current_col, key_offset=max_key(hist, sk_col))
    return step2.unionByName(opened)
