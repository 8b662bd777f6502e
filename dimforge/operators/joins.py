"""Sides of joins that Spark may broadcast.

Spark judges a side that is read from files by the files' bytes.  Keys in order are compressed
some hundred times there: 9 million order ids with their numbers lie in 9 MB, below Spark's limit,
and take 1.3 GB of the driver's memory as a hash table.  Sides that grow with the data are judged by
their rows and the schema's row size instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows x the schema's row size of a side that may be broadcast; on the driver some five times that.
BROADCAST_BYTES = 42 << 20


def by_rows(side: DataFrame, rows: int | None = None) -> DataFrame:
    """``side``, to be shuffled if its rows are more than BROADCAST_BYTES; else Spark decides.
    ``rows`` is their number, where the caller knows it; the footers of files tell it too."""
    return side if _fits(side, rows) else side.hint("merge")


def batch(side: DataFrame) -> DataFrame:
    """``side``, a batch's keys read from files: broadcast up to BROADCAST_BYTES, so that the table it
    is looked up in isn't shuffled; a longer one is shuffled.  Spark itself would take a filtered
    relation for as large as the whole."""
    return F.broadcast(side) if _fits(side) else side.hint("merge")


def _fits(side: DataFrame, rows: int | None = None) -> bool:
    n = side.count() if rows is None else rows
    return n * side._jdf.schema().defaultSize() <= BROADCAST_BYTES
