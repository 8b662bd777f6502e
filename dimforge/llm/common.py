"""Helpers shared by the text operators: table access, Arrow batches as byte arrays,
hashes of substrings, and a folder that every executor sees."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a task works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20
STEP_ROWS = 1 << 12

#: Rows of an Arrow batch at most: what a task holds of its input beside the step it works on.
BATCH_ROWS = 2000

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share.  Only a local
    session without one, as in tests, gets a folder of its own."""
    context = spark.sparkContext
    where = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not where:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        import tempfile

        where = tempfile.mkdtemp(prefix="dimforge-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(where)
    return where


def shared(df: DataFrame) -> DataFrame:
    """Cut the lineage through a file in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage through Parquet in the shared folder: compressed, where a checkpoint's
    rows are not, and read column by column."""
    folder = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def held_out(doc_id) -> F.Column:
    """The rows kept for testing: crc32 of the id as text, mod 5, is 0.  A null id is
    never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES, rows: int = STEP_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text and at most ``rows`` rows each, at
    least a row."""
    array = as_large(batch.column(batch.schema.get_field_index(column)))
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), first + rows, batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def as_large(array: pa.Array) -> pa.Array:
    return array if pa.types.is_large_string(array.type) else array.cast(pa.large_string())


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def utf8(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row begins (one more entry than rows).
    Null is the empty text."""
    array = as_large(batch.column(batch.schema.get_field_index(column)))
    if array.null_count:
        array = array.fill_null("")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers at least.  A worker keeps one pair of tables, for a step's units."""
    size = -(-n // (1 << 16)) << 16
    if size > len(_powers[0]):
        up = np.full(size, _BASE, U64)
        down = np.full(size, _INVERSE, U64)
        up[0] = down[0] = 1
        np.cumprod(up, out=up), np.cumprod(down, out=down)
        if size > 2 * STEP_BYTES:  # for a text longer than a step: not kept
            return up, down
        _powers[:] = up, down
    return _powers[0], _powers[1]


_UNIT = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))


def substring_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of units[start:end] for many substrings at once: differences of
    prefix sums of c(unit) * base^position, moved to position 0.  Equal substrings have
    equal hashes wherever they stand."""
    up, down = _power_tables(len(units) + 1)
    values = _UNIT[units] if units.dtype == np.uint8 else mix(units.astype(U64) + U64(1))
    sums = np.zeros(len(units) + 1, U64)
    np.cumsum(values * up[: len(units)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = ~_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words [^\\x20\\x09-\\x0D]+ of many texts with A-Z lower-cased: where each begins
    and ends (bytes), the hash of each, and how many words come before each text.
    ``in_word`` tells other bytes that words are made of."""
    data = _LOWER[data]
    solid = in_word[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, solid
    text_starts = offsets[:-1]
    before[offsets] = False
    starts = np.flatnonzero(solid & ~before[:-1])
    after = np.empty(len(data) + 1, bool)
    after[-1], after[:-1] = False, solid
    after[offsets] = False
    ends = np.flatnonzero(solid & ~after[1:]) + 1
    return starts, ends, substring_hashes(data, starts, ends), np.searchsorted(starts, np.append(text_starts, len(data)))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application: their Python
    workers import the functions that tasks name.  The session's Arrow batches are made no
    larger than BATCH_ROWS."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows, "10000")) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    import os
    import tempfile
    import zipfile

    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # The driver's own file; Spark copies it to every executor.
    path = os.path.join(tempfile.mkdtemp(prefix="dimforge-source-"), "dimforge_source.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def fresh(df: DataFrame, name: str) -> str:
    """A column name for an operator's own use that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
