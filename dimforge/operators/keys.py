"""Surrogate keys and key integrity.

``assign_keys`` numbers rows ``offset + 1, offset + 2, ...`` in natural-key order
without a single-partition window, whatever the number of rows:

1. write the rows once to the shared folder as Parquet, so that counting them, sampling them
   for the ranges and shuffling them don't derive them again and hold no executor's memory;
2. range-partition and sort them by the natural key, into partitions of about
   ``TARGET_BYTES`` each (and no fewer than the session's shuffle partitions), a Parquet file
   each: files and row positions are fixed even if an executor is lost;
3. count rows per file (one row per file, from the footers) and turn the counts into starting
   offsets;
4. key = offset + file start + position inside the file.

Step 3's result has one row per file, so broadcasting it is bounded by the partition count,
not by the data.  Tasks that read the files take them by size, many small ones together.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The number of the partition in the names of the files that Spark writes.
_FILE_NUMBER = r"^part-(\d+)"

# Rows of one key partition, by the schema's row size.
TARGET_BYTES = 128 << 20

#: Compression of the Parquet files of raw relations, rows between two steps and tables: a third
#: less is written than with Spark's default, in about the same time.
CODEC = "zstd"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder (``spark.checkpoint.dir``); a temp one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="dimforge-ckpt-")  # single-machine runs only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder as Parquet, a file for each partition, and read
    from there: compressed, and read column by column."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.options(maxRecordsPerFile=0, compression=CODEC).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def max_key(df: DataFrame, key_col: str) -> int:
    """Largest existing key, 0 for an empty table (one scalar to the driver)."""
    row = df.agg(F.max(key_col).alias("m")).first()
    return int(row["m"] or 0)


def partitions_for(df: DataFrame) -> int:
    """Partitions of about TARGET_BYTES for the rows of ``df``, at least the session's."""
    size = df.count() * df._jdf.schema().defaultSize()
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TARGET_BYTES))


def assign_keys(
    df: DataFrame, key_col: str, order_cols, offset: int = 0, num_partitions: int | None = None, stored: bool = False,
    unique: str | None = None,
) -> DataFrame:
    """Add ``key_col`` (LONG) numbering the rows of ``df`` after ``offset`` in ``order_cols`` order.

    The order columns must identify a row (ties would be numbered arbitrarily).  ``stored``:
    ``df`` is read from files (``written``, at most filtered since) and isn't written again.
    ``unique``: two rows with the same order columns, none of which is NULL, are an error that
    names the rows so; equal rows lie in one range, so the check shuffles nothing more.
    """
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    if not stored:
        df = written(df)  # read to be counted, to be sampled for the ranges and to be shuffled
    n = num_partitions or partitions_for(df)
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    ranged = df.repartitionByRange(n, *order)
    if unique:
        same = Window.partitionBy(*order_cols).orderBy(*order_cols)
        ranged = ranged.withColumn("_again", F.row_number().over(same) > 1)
        order = [F.col(c).asc() for c in order_cols]  # as the window has sorted them
    fixed = written(ranged.sortWithinPartitions(*order))
    if unique:
        fixed = refuse_again(fixed, order_cols, unique)
    file = F.regexp_extract("_metadata.file_name", _FILE_NUMBER, 1).cast("int")
    tagged = fixed.select("*", file.alias("_kpid"), F.col("_metadata.row_index").alias("_kpos"))
    counts = fixed.select(file.alias("_kpid")).groupBy("_kpid").agg(F.count(F.lit(1)).alias("_kn"))
    upto = Window.orderBy("_kpid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_kpid", F.coalesce(F.sum("_kn").over(upto), F.lit(0)).alias("_kbase"))
    out = tagged.join(F.broadcast(starts), "_kpid").withColumn(
        key_col, (F.lit(offset) + F.col("_kbase") + F.col("_kpos") + 1).cast("long")
    )
    return out.drop("_kpid", "_kpos", "_kbase")


def has_key(df: DataFrame, key_cols) -> DataFrame:
    """The rows whose key columns are all there.  A row without its key can't be matched
    again: no write operator lets it in (it would go in anew at each run); ``rejects`` counts
    such rows."""
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    for c in key_cols:
        df = df.where(F.col(c).isNotNull())
    return df


def rejects(df: DataFrame, key_cols) -> DataFrame:
    """(key_column, rejected): how many rows lack each column of the key."""
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in key_cols])
    items = [F.struct(F.lit(c).alias("key_column"), F.col(c).alias("rejected")) for c in key_cols]
    return counts.select(F.explode(F.array(*items)).alias("r")).select("r.*")


class DuplicateKeyError(ValueError):
    pass


def require_unique(df: DataFrame, key_cols, what: str = "source", samples: int = 5) -> None:
    """Raise if any key occurs twice; the error names a few offending keys."""
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    _refuse(df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), key_cols, what, samples)


def refuse_again(df: DataFrame, key_cols: list[str], what: str) -> DataFrame:
    """``df``, read from files, without its mark ``_again``; a marked row is an error.  The files'
    statistics tell that a file has none."""
    _refuse(df.where("_again").select(*key_cols).distinct(), key_cols, what)
    return df.drop("_again")


def _refuse(dups: DataFrame, key_cols: list[str], what: str, samples: int = 5) -> None:
    found = dups.limit(samples).collect()
    if found:
        shown = ", ".join(str(tuple(r[c] for c in key_cols)) for r in found)
        raise DuplicateKeyError(f"duplicate {what} keys on {key_cols}: {shown}")
