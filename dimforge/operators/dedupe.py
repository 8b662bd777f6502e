"""One row per key: first by an ordering, or latest by a timestamp with NULLs last.

``row_number() = 1`` lets Spark plan a WindowGroupLimit on both sides of the
shuffle, so each map task keeps only its best row per key before anything is
exchanged; a hot key costs one row per map task, not all its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def first_per_key(df: DataFrame, key_cols, order_by) -> DataFrame:
    """Keep the first row of each key under ``order_by`` (Columns or names, ascending,
    NULLs last).  ``order_by`` should make the choice unique."""
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in _list(order_by)]
    w = Window.partitionBy(*_list(key_cols)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, key_cols, ts, tie_breakers=()) -> DataFrame:
    """Keep the row with the greatest ``ts`` per key; NULL ``ts`` ranks last;
    ``tie_breakers`` (ascending) make the pick deterministic."""
    ts_c = F.col(ts) if isinstance(ts, str) else ts
    order = [ts_c.desc_nulls_last()] + [
        F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tie_breakers
    ]
    return first_per_key(df, key_cols, order)
