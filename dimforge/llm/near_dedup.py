"""Near-duplicate documents: HyperMinHash sketches, banded, estimated, verified.

A document's set is its distinct 5-word shingles.  Each set gets ``REGISTERS`` buckets, and
each bucket keeps the smallest hash that falls into it in compressed form: the count of
leading zeros and ``MANTISSA`` bits after the first one.  A bucket that no shingle reaches
is filled by further rounds of the same hashing (a later round counts as larger), so small
sets have full sketches too and a register of two sets agrees with probability J.

Documents with equal sets form one class and one of them stands for it.  Bands of ``ROWS``
registers give candidates; the estimate, corrected for registers that agree by chance,
drops the clearly unlike ones; the rest are verified on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, mix, shared, steps, utf8, words
from .components import components

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: 64 bands of 6 registers miss a pair of similarity 0.75 with probability 4e-6.
ROWS, BANDS = 6, 64
REGISTERS = ROWS * BANDS
MANTISSA = 10
#: How far below the threshold an estimate may lie: over five standard deviations.
SLACK = 0.15
#: So many ids (8 bytes each) may be broadcast; beyond, the same join is a shuffle.
BROADCAST_IDS = 2_000_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of many texts: (text number, hash), sorted by both."""
    _, _, hashes, first = words(data, offsets)
    counts = np.diff(first)
    n = len(hashes)
    text = np.repeat(np.arange(len(counts)), counts)
    #: of each word, how many words of its text follow
    left = first[1:][text] - np.arange(n) if n else np.zeros(0, np.int64)
    total = np.zeros(n, U64)
    for k in range(SHINGLE):
        shifted = np.zeros(n, U64)
        shifted[: max(n - k, 0)] = hashes[k:]
        total += np.where(left > k, mix(shifted + U64(k + 1)), U64(0)) * U64(2 * k + 1)
    # a text with fewer words has its whole sequence as one shingle
    keep = (left >= SHINGLE) | ((counts[text] < SHINGLE) & (left == counts[text]))
    text, total = text[keep], mix(total[keep])
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    if len(text):
        new = np.empty(len(text), bool)
        new[0] = True
        new[1:] = (text[1:] != text[:-1]) | (total[1:] != total[:-1])
        text, total = text[new], total[new]
    return text, total


def _compress(smallest: np.ndarray) -> np.ndarray:
    """(round << 32 | value) to 16 bits: leading zeros and mantissa; a value of a later
    round has the top bit set and its round mixed into the exponent."""
    turn, value = (smallest >> U64(32)).astype(np.int64), (smallest & U64(0xFFFFFFFF)).astype(np.int64)
    bits = np.frexp(value.astype(np.float64))[1]
    zeros = np.minimum(32 - bits, 31)
    mantissa = ((value << (zeros + 1)) >> (32 - MANTISSA)) & ((1 << MANTISSA) - 1)
    exponent = np.where(turn == 0, zeros, 32 + ((zeros + 7 * turn) & 31))
    return ((exponent << MANTISSA) | mantissa).astype(np.uint16)


def sketches(text: np.ndarray, hashes: np.ndarray, n_texts: int) -> np.ndarray:
    """(n_texts, REGISTERS) registers of the sets that shingle_sets() made; the row of an
    empty set means nothing."""
    empty = np.iinfo(np.uint64).max
    smallest = np.full(n_texts * REGISTERS, empty, U64)
    has = np.zeros(n_texts, bool)
    has[text] = True
    turn = 0
    # Random buckets for as many rounds as there are registers, then each register's own
    # round: after those no register of a set with a shingle is empty.
    while turn < 2 * REGISTERS and len(text):
        many = 1 if turn == 0 else int(min(max(1, 60_000 // len(text)), 64, 2 * REGISTERS - turn))
        if turn < REGISTERS:
            many = min(many, REGISTERS - turn)
        rounds = np.arange(turn, turn + many, dtype=U64)[:, None]
        value = mix(hashes[None, :] + (rounds + U64(1)) * U64(0x9E3779B97F4A7C15))
        if turn < REGISTERS:
            bucket = ((value >> U64(32)) * U64(REGISTERS)) >> U64(32)
        else:
            bucket = np.broadcast_to(rounds - U64(REGISTERS), value.shape)
        at = text[None, :] * REGISTERS + bucket.astype(np.int64)
        np.minimum.at(smallest, at.ravel(), ((rounds << U64(32)) | (value & U64(0xFFFFFFFF))).ravel())
        turn += many
        open_texts = (smallest.reshape(n_texts, REGISTERS) == empty).any(axis=1) & has
        more = open_texts[text]
        text, hashes = text[more], hashes[more]
    return _compress(smallest).reshape(n_texts, REGISTERS)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of sketches, row by row, without the agreements by chance:
    registers of unequal shingles agree if exponents and mantissas do."""
    same = (a == b).mean(axis=1)
    chance = np.zeros(len(a))
    ea, eb = a >> MANTISSA, b >> MANTISSA
    for e in range(0, 64):
        chance += (ea == e).mean(axis=1) * (eb == e).mean(axis=1)
    chance /= 1 << MANTISSA
    return (same - chance) / (1 - chance)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            text, hashes = shingle_sets(*utf8(part, "text"))
            n = np.bincount(text, minlength=part.num_rows)
            starts = np.append(0, np.cumsum(n))
            sums = [np.append(U64(0), np.cumsum(h)) for h in (mix(hashes), mix(hashes ^ U64(0x5851F42D4C957F2D)))]
            keys = [(s[starts[1:]] - s[starts[:-1]]).view(np.int64) for s in sums]
            registers = sketches(text, hashes, part.num_rows)
            raw = pa.py_buffer(registers.tobytes())
            ends = np.arange(part.num_rows + 1, dtype=np.int32) * (2 * REGISTERS)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), pa.array(keys[0]), pa.array(keys[1]), pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends), raw])],
                ["doc_id", "n_shingles", "key1", "key2", "sketch"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            text, hashes = shingle_sets(*utf8(part, "text"))
            ends = np.append(0, np.cumsum(np.bincount(text, minlength=part.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes.view(np.int64)))],
                ["doc_id", "shingles"],
            )


def _sketch_matrix(column: pa.Array) -> np.ndarray:
    size = 2 * REGISTERS
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[start : start + size * len(column)]
    return raw.view(np.uint16).reshape(len(column), REGISTERS)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            similar = estimate(_sketch_matrix(batch.column(2)), _sketch_matrix(batch.column(3)))
            yield batch.select([0, 1]).filter(pa.array(similar >= PERCENT / 100 - SLACK))


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is among ``ids``.  Up to BROADCAST_IDS of them are sent to the
    executors, so the rows stay where they are; more are joined by a shuffle."""
    ids = shared(ids.select("doc_id").distinct())
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def _links(pairs: DataFrame, sketched: DataFrame, docs: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b) of representatives, those that are links.  First the sizes
    and the estimate, then the full sets."""

    def side(df, name, *more):
        return df.select(F.col("doc_id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in more])

    def ends(df):
        return df.select(F.explode(F.array("a", "b")).alias("doc_id"))

    sizes = pairs.join(side(sketched, "a", "n_shingles"), "a").join(side(sketched, "b", "n_shingles"), "b")
    na, nb = F.col("n_shingles_a"), F.col("n_shingles_b")
    pairs = shared(sizes.filter(100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)).select("a", "b"))
    near = _only(sketched, ends(pairs))
    likely = pairs.join(side(near, "a", "sketch"), "a").join(side(near, "b", "sketch"), "b")
    likely = shared(likely.select("a", "b", "sketch_a", "sketch_b").mapInArrow(_estimated, "a long, b long"))
    sets = shared(_only(docs, ends(likely)).dropDuplicates(["doc_id"]).mapInArrow(_sets, "doc_id long, shingles array<long>"))
    both = likely.join(side(sets, "a", "shingles"), "a").join(side(sets, "b", "shingles"), "b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - common
    return both.filter(100 * common >= PERCENT * union).select("a", "b")


def _unfinished(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """(doc_id, part): the documents of buckets that hold more than one component, with their
    component."""
    labelled = buckets.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    labelled = labelled.select("key", "doc_id", F.coalesce("component", "doc_id").alias("part"))
    split = labelled.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high")
    return labelled.join(split.select("key"), "key", "left_semi").select("doc_id", "part").distinct()


def _star_pairs(buckets: DataFrame) -> DataFrame:
    """Each bucket's members with its centre: at most as many candidates as the buckets have
    rows, however large a bucket is.  The centre is the member that shares most buckets with
    others: of a group of near copies the original, or the least changed."""
    degree = buckets.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    ranked = buckets.join(degree, "doc_id").select("key", "doc_id", "degree")
    centre = ranked.groupBy("key").agg(F.min_by("doc_id", F.struct(-F.col("degree"), "doc_id")).alias("centre"))
    met = buckets.select("key", "doc_id").join(centre, "key").filter("doc_id <> centre")
    return met.select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")).distinct()


def _remaining_pairs(buckets: DataFrame, parts: DataFrame, docs: DataFrame) -> DataFrame:
    """Candidates among the documents of buckets that still hold several components, none
    lost: pairs in different components that share a shingle early enough in both texts' order
    for 100 * intersection >= PERCENT * union.  A text with many shingles of its own has no
    such pair, so loosely similar groups don't meet pair by pair."""
    rest = shared(_unfinished(buckets, parts))
    sets = _only(docs, rest).dropDuplicates(["doc_id"]).mapInArrow(_sets, "doc_id long, shingles array<long>")
    rows = shared(sets.select("doc_id", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle")))
    several = rows.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1")
    # One order of all shingles, the rarest first: a text's own ones come before those here.
    order = Window.partitionBy("doc_id").orderBy("n", "shingle")
    ranked = rows.join(several, "shingle").select("*", F.row_number().over(order).alias("rank"), F.count("*").over(Window.partitionBy("doc_id")).alias("met"))
    rare = ranked.withColumn("place", F.col("size") - F.col("met") + F.col("rank") - 1)
    # of two similar texts' common shingles the first stands within this reach in both
    rare = rare.filter(100 * (F.col("size") - F.col("place")) >= PERCENT * F.col("size"))
    rare = shared(rare.join(rest, "doc_id").select("shingle", "doc_id", "part", "place", "size"))
    # Of each shingle's rows, those outside its largest component meet the others.
    by_part = rare.groupBy("shingle", "part").agg(F.count("*").alias("m")).groupBy("shingle").agg(F.max_by("part", F.struct("m", "part")).alias("largest"), F.count("*").alias("parts"))
    by_part = by_part.filter("parts > 1").select("shingle", "largest")
    x = rare.join(by_part, "shingle").filter("part <> largest").select("shingle", F.col("doc_id").alias("x"), F.col("part").alias("part_x"), F.col("place").alias("place_x"), F.col("size").alias("size_x"))
    y = rare.select("shingle", F.col("doc_id").alias("y"), F.col("part").alias("part_y"), F.col("place").alias("place_y"), F.col("size").alias("size_y"))
    most = F.least(F.col("size_x") - F.col("place_x"), F.col("size_y") - F.col("place_y"))
    enough = (100 + PERCENT) * most >= PERCENT * (F.col("size_x") + F.col("size_y"))
    met = x.join(y, (x["shingle"] == y["shingle"]) & (F.col("part_x") != F.col("part_y")) & enough)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.  See the module's text for the method.

    Defined cases: a null, empty or blank text has no shingles, is linked with nothing and
    is its own component.  A null id links with nothing; its component is null and it is
    kept.  Rows that repeat an id are one document.  Further columns are not looked at.  An
    empty table gives no rows.  Equal sets are one class, whose smallest id stands for it;
    ties in size or similarity do not matter, as the smallest id of a component is kept."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    summary = shared(docs.mapInArrow(_summaries, "doc_id long, n_shingles long, key1 long, key2 long, sketch binary"))
    full = summary.filter("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "key1", "key2"]
    # A row for each class, with its representative's id; equal sets have equal sketches.
    sketched = shared(full.groupBy(*key).agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch")))
    member = full.select("doc_id", *key).join(sketched.select(*key, F.col("doc_id").alias("node")), key).select("doc_id", "node")

    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring(F.col("sketch"), b * (2 * ROWS) + 1, F.lit(2 * ROWS)))))
    banded = sketched.select("doc_id", band.alias("key"))
    # Keys that more than one representative has.
    several = banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = shared(banded.join(several, "key"))
    links = shared(_links(_star_pairs(buckets), sketched, docs))
    parts = components(links)
    links = links.union(_links(_remaining_pairs(buckets, parts, docs), sketched, docs))
    # rows that repeat an id under different texts belong together as well
    several = member.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    tied = member.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(links.union(tied))
    home = member.join(found, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    result = summary.select("doc_id", "n_shingles").join(home, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
