"""Document fingerprints by winnowing.

The hashes of all ``GRAM``-grams of a text's code points are looked at through windows of
``WINDOW`` neighbours; the smallest of each window is kept, the rightmost of equal ones, with
its position.  Two texts that share ``WINDOW + GRAM - 1`` code points in a row share a kept hash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, steps, substring_hashes, texts

GRAM = 16
WINDOW = 32
#: A kept hash has 40 bits; the key that windows compare has the position's complement below.
_LOW = 24


def winnow(rows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, position) of every kept hash, in order.  A text shorter than a gram is a gram
    of its own; one with fewer grams than a window has one window; an empty text keeps none."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    units = np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.append(0, np.cumsum(sizes))
    grams = np.where(sizes > 0, np.maximum(sizes - GRAM + 1, 1), 0)
    first = np.append(0, np.cumsum(grams))
    row = np.repeat(np.arange(len(rows)), grams)
    place = np.arange(first[-1]) - first[row]
    starts = begins[row] + place
    hashes = substring_hashes(units, starts, np.minimum(starts + GRAM, begins[row + 1]))
    low = (1 << _LOW) - 1
    key = (hashes >> U64(_LOW) << U64(_LOW)) | ((~place) & low).astype(U64)
    # the least of WINDOW neighbours by doubling
    least, span = key, 1
    while span < WINDOW:
        step = min(span, WINDOW - span)
        if len(least) <= step:
            least = least[:0]
            break
        least = np.minimum(least[:-step], least[step:])
        span += step
    # Windows that lie within one text; texts with fewer grams have theirs apart.
    whole = np.flatnonzero(row[: len(least)] == row[WINDOW - 1 : WINDOW - 1 + len(least)]) if len(least) else np.zeros(0, int)
    kept_row, kept = row[whole], least[whole]
    short = np.flatnonzero((grams > 0) & (grams < WINDOW))
    if len(short):
        edges = np.stack([first[short], first[short + 1]], axis=1).ravel()
        edges = edges[:-1] if edges[-1] == len(key) else edges
        kept_row = np.append(kept_row, short)
        kept = np.append(kept, np.minimum.reduceat(key, edges)[::2])
        order = np.argsort(kept_row, kind="stable")
        kept_row, kept = kept_row[order], kept[order]
    if len(kept):
        new = np.append(True, (kept[1:] != kept[:-1]) | (kept_row[1:] != kept_row[:-1]))
        kept_row, kept = kept_row[new], kept[new]
    # A position's complement has _LOW bits; in a longer text the bits above are those of the
    # position before, one more where the low bits begin anew.
    position = (~kept & U64(low)).astype(np.int64)
    if len(position) and sizes.max() > low:
        wraps = np.append(0, np.cumsum((position[1:] < position[:-1]) & (kept_row[1:] == kept_row[:-1])))
        head = np.searchsorted(kept_row, kept_row)
        position += (wraps - wraps[head]) << _LOW
    return kept_row, (kept >> U64(_LOW)), position


def likeness(a: tuple, b: tuple, n: int) -> np.ndarray:
    """Jaccard similarity of the kept hashes of rows 0..n-1 of two results of winnow(); two
    empty sets are alike (1)."""
    codes = [np.unique((row.astype(U64) << U64(40)) | h) for row, h, _ in (a, b)]
    common = np.intersect1d(*codes, assume_unique=True)
    size = lambda c: np.bincount((c >> U64(40)).astype(np.int64), minlength=n)[:n]
    both = size(common)
    total = size(codes[0]) + size(codes[1]) - both
    return np.where(total > 0, both / np.maximum(total, 1), 1.0)


def packed(kept: tuple, n: int) -> list[str]:
    """A text for each row: base64 of 6 bytes for each kept hash, five of the hash and one of
    the distance from the position before (at most WINDOW)."""
    row, h, position = kept
    before = np.append(0, position[:-1])
    if len(row):
        before[np.append(True, row[1:] != row[:-1])] = 0
    raw = np.zeros((len(row), 6), np.uint8)
    raw[:, :5] = h.view(np.uint8).reshape(-1, 8)[:, :5]
    raw[:, 5] = position - before
    ends = np.searchsorted(row, np.arange(n + 1)) * 6
    data = raw.tobytes()
    return [base64.b64encode(data[a:b]).decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, hashes (array of long) and positions (array of long) in order.

    Defined cases: null and empty texts keep no hash.  Positions are code points from 0, of
    texts of any length.  Equal texts give equal results; null ids stay null; further columns
    are not looked at; an empty table gives no rows."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                row, h, position = winnow(texts(part, "text"))
                ends = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, pa.array(h.astype(np.int64))), pa.ListArray.from_arrays(ends, pa.array(position))],
                    ["doc_id", "hashes", "positions"],
                )

    return docs.mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


def with_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, text) dealt into ranges of ids, each sorted in one partition and ended by a
    ``tail`` row: the first row of the next range, for the last range that of the first.  So
    each row's successor stands behind it, and no sort or window spans all rows.

    What comes to the driver is a bound and a smallest id for each range."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = docs.filter("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.25 / n) if n > 1 else []
    bounds = np.unique(np.array(bounds, np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right").astype(np.int32))

    # null ids come before all others
    dealt = docs.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(range_of(F.coalesce("doc_id", F.lit(0)))))
    least = {r["part"]: r["first"] for r in dealt.groupBy("part").agg(F.min(F.struct("doc_id")).alias("first")).collect()}
    parts = sorted(least)
    tails = [(least[p]["doc_id"], parts[i - 1]) for i, p in enumerate(parts)]
    first = spark.createDataFrame(tails, "first long, before int")
    tail = docs.join(F.broadcast(first), docs["doc_id"].eqNullSafe(first["first"])).select("doc_id", "text", F.col("before").alias("part"), F.lit(True).alias("tail"))
    rows = dealt.select("doc_id", "text", "part", F.lit(False).alias("tail")).union(tail)
    return rows.repartitionById(n, F.col("part")).sortWithinPartitions("part", "tail", "doc_id", "text")


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last floor(n/2) code points
    replaced by the first as many (or all) of the next text by ascending id, after the last the
    first.  Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Defined cases: a null text is empty; two empty fingerprints are alike with 1, an empty and
    another with 0.  Equal ids are ordered by text; null ids come first; a table of one row
    has itself as next; an empty table gives no rows."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def result(ids: list, own: list[str], usable: list[bool]) -> pa.RecordBatch:
        n = len(own) - 1
        halves = [len(t) // 2 for t in own]
        edited = [own[i][: len(own[i]) - halves[i]] + own[i + 1][: halves[i]] for i in range(n)]
        kept, other = winnow(own), winnow(edited)
        following = (kept[0] - 1, kept[1], kept[2])
        later = following[0] >= 0
        following = tuple(x[later] for x in following)
        upto = kept[0] < n
        mine = tuple(x[upto] for x in kept)
        columns = [
            pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in own[:n]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(packed(mine, n), pa.string()), pa.array(packed(other, n), pa.string()), pa.array(likeness(mine, other, n)), pa.array(likeness(mine, following, n)),
        ]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(usable[:n], pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, own, part_of, is_tail = [], [], [], []
        for batch in batches:
            for step in steps(batch, "text"):
                ids += step.column(0).to_pylist()
                own += texts(step, "text")
                part_of += step.column(2).to_pylist()
                is_tail += step.column(3).to_pylist()
                usable = [not is_tail[i] and part_of[i] == part_of[i + 1] for i in range(len(own) - 1)]
                if usable:
                    yield result(ids, own, usable)
                # the last row waits for the one behind it
                ids, own, part_of, is_tail = ids[-1:], own[-1:], part_of[-1:], is_tail[-1:]

    return with_neighbours(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
