"""Benchmark passages in documents: SimHash of windows of the items' sizes, found by blocks
of bits, verified by weighted shingles.

Every window of a document and of an item gets a 64-bit SimHash of its words.  A window that
lies within ``RADIUS`` bits of an item's has one of ``RADIUS + 1`` blocks of bits equal to it
(pigeonhole), so looking the blocks up finds all of them.  Document windows begin at every
fourth word from the document's first and the item's at every word, so an item that stands in
a document always has a window at distance 0.  The window is as long as what a document's
border may leave of the item, less the step; an item long enough to stay similar with edits
inside also has shorter windows that fit between the edits (see ``window_sizes``).  The verification is exact:
5-word shingles of the item and of the place in the document, weighted by how few different
item texts of the whole benchmark have them; a shingle that the item lacks weighs as much as
the item's own do on average, so items that stand there often or share passages lose no more
by an edit than others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, shared, steps, substring_hashes, texts, words

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 3
STEP = 4
#: Bits of a block: 64 bits in RADIUS + 1 blocks.
BLOCK_BITS = 64 // (RADIUS + 1)
#: Pairs of windows that one step of the search holds at a time.
CHUNK = 1 << 20
#: Words of benchmark text that one pass takes to the executors; more make more passes.
PASS_WORDS = 2_000_000


#: Words are runs of ASCII letters, digits and all bytes of other characters, in lower
#: case: punctuation put between or behind words hides no passage.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


def _words(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of many texts, and how many come before each text."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in rows]
    offsets = np.append(0, np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))))
    _, _, hashes, first = words(np.frombuffer(b"".join(raw), np.uint8), offsets, _IN_WORD)
    return hashes, first


def _round(size: int) -> int:
    """A window size near below: steps of 4, from 64 on of a sixteenth."""
    step = max(STEP, 1 << max(0, size.bit_length() - 5))
    return size // step * step


def _segment(weights: np.ndarray, least: float) -> int:
    """How many shingles in a row can hold no less than ``least`` of the weight."""
    sums = np.append(0, np.cumsum(weights))
    ends = np.searchsorted(sums, sums[:-1] + least * (1 - 1e-9), "left")
    fits = ends < len(sums)
    return int((ends - np.arange(len(weights)))[fits].min()) if fits.any() else len(weights)


def words_left(n_words: int, weights: np.ndarray, cost: float = 0.0) -> int:
    """How few words of an item a document's border may leave if edits cost so much weight."""
    return min(n_words, _segment(weights, SIMILARITY * weights.sum() + cost) + SHINGLE - 1)


def window_sizes(n_words: int, weights: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(size, step) of an item's windows, from the weights of its shingles in a row (a
    repeated one's as often; equal ones if not given).

    What a passage loses at a document's border brings nothing foreign in, so there a quarter
    of the weight T may lack.  An edit further inside costs five shingles and brings at least
    three quarters of four foreign ones of the mean weight; e edits leave the rest of the
    quarter to the border, and some run of what is left, over e + 1, is untouched.  A run
    holds a window at a multiple of STEP if it is STEP - 1 longer; too short ones are looked
    up at every word."""
    n = max(1, n_words - SHINGLE + 1)
    weights = np.ones(n) if weights is None else weights
    total = weights.sum()
    lost = np.cumsum(np.sort(weights))
    foreign = (SHINGLE - 1) * SIMILARITY * weights.mean()

    def window(run: int) -> tuple[int, int]:
        size = _round(run - (STEP - 1))
        return (size, STEP) if size >= 2 * STEP else (max(1, min(n_words, max(run, SHINGLE))), 1)

    def cost(edits: int) -> float:
        return edits * foreign + lost[min(SHINGLE * edits, n) - 1]

    most = 0
    while SHINGLE * (most + 1) <= n and cost(most + 1) <= (1 - SIMILARITY) * total:
        most += 1
    sizes = [window(words_left(n_words, weights))]
    run, edits = n_words, 1
    while edits <= most:
        # many edits are taken together: the fewest of them for the loss, the most for the runs
        last = min(edits + edits // 8, most)
        run = min(run, (words_left(n_words, weights, cost(edits)) - last) // (last + 1))
        edits = last + 1
    if most and window(run) != sizes[0]:
        sizes.append(window(run))
    return sizes


class _Bits:
    """Prefix counts of the words' hash bits, for windows at any multiple of a step."""

    def __init__(self, hashes: np.ndarray):
        self.raw = np.unpackbits(mix(hashes).view(np.uint8).reshape(-1, 8), axis=1)
        self.sums: dict[int, np.ndarray] = {}

    def windows(self, size: int, step: int) -> np.ndarray:
        """SimHashes of the windows of ``size`` words that begin at multiples of ``step``; a
        bit is set if more than half of the words have it."""
        if step not in self.sums:
            n = len(self.raw) // step
            block = self.raw[: n * step : step].copy()
            for k in range(1, step):
                block += self.raw[k : n * step : step]
            # 16 bits may overflow; differences of prefix sums are right all the same
            sums = np.zeros((n + 1, 64), np.uint16)
            np.cumsum(block, axis=0, dtype=np.uint16, out=sums[1:])
            self.sums[step] = sums
        sums, span = self.sums[step], size // step
        if len(sums) <= span:
            return np.zeros(0, U64)
        return np.packbits(sums[span:] - sums[:-span] > size // 2, axis=1).view(U64)[:, 0]


def _shingle_row(hashes: np.ndarray) -> np.ndarray:
    """The shingles in the order of the words; fewer words than SHINGLE are one."""
    if len(hashes) < SHINGLE:
        return mix(np.array([np.sum(mix(hashes) * (np.arange(len(hashes)).astype(U64) * U64(2) + U64(1)), dtype=U64)], U64)) if len(hashes) else hashes
    n = len(hashes) - SHINGLE + 1
    total = np.zeros(n, U64)
    for k in range(SHINGLE):
        total += mix(hashes[k : k + n] + U64(k + 1)) * U64(2 * k + 1)
    return mix(total)


def _shingles(hashes: np.ndarray) -> np.ndarray:
    return np.unique(_shingle_row(hashes))


def _sequence(hashes: np.ndarray) -> int:
    """One hash of all words in their order: equal for texts of the same words."""
    return int(np.sum(mix(mix(hashes) + np.arange(1, len(hashes) + 1).astype(U64)), dtype=U64).view(np.int64))


def _spread(many: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number, 0 .. many[number] - 1) for all numbers in turn, some CHUNK at a time."""
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, CHUNK):
        k = np.arange(low, min(low + CHUNK, total))
        number = np.searchsorted(ends, k, "right")
        yield number, k - (ends[number] - many[number])


class Index:
    """The items' words, shingle weights, and window fingerprints by block."""

    def __init__(self, items: list[tuple[int, str]], shared_by: dict[int, int] | None = None):
        """``shared_by``: how many different item texts of the benchmark have a shingle, for
        those that several have; if not given, ``items`` are the whole benchmark."""
        self.ids, self.words = [], []
        # equal texts of several items are looked up once for each
        for item, text in items:
            hashes = _words([text])[0]
            if len(hashes):
                self.ids.append(item)
                self.words.append(hashes)
        self.shingles = [_shingles(h) for h in self.words]
        if shared_by is None:
            different = {_sequence(h): sh for h, sh in zip(self.words, self.shingles)}
            shared_by = Counter(int(x) for sh in different.values() for x in sh)
        #: of each item, the weights of its shingles
        self.weights = [np.array([1 / shared_by.get(int(x), 1) for x in sh]) for sh in self.shingles]
        #: of each item, how few words a document's border may leave
        self.least: list[int] = []
        found: dict[tuple[int, int], list] = {}
        for i, hashes in enumerate(self.words):
            bits = _Bits(hashes)
            in_row = self.weights[i][np.searchsorted(self.shingles[i], _shingle_row(hashes))]
            self.least.append(words_left(len(hashes), in_row))
            for size, step in window_sizes(len(hashes), in_row):
                prints = bits.windows(size, 1)
                found.setdefault((size, step), []).append((prints, np.full(len(prints), i), np.arange(len(prints))))
        #: of each window size: the distinct (fingerprint, item) entries, where each one's
        #: places begin in the list of places, and that list
        self.prints, self.tables = {}, {}
        for key, parts in found.items():
            prints, item, offset = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((offset, prints, item))
            prints, item, offset = prints[order], item[order], offset[order]
            begin = np.flatnonzero(np.append([True], (prints[1:] != prints[:-1]) | (item[1:] != item[:-1]))) if len(prints) else np.zeros(0, np.int64)
            self.prints[key] = (prints[begin], item[begin], np.append(begin, len(prints)), offset)
            for b in range(RADIUS + 1):
                block = self.block(prints[begin], b)
                order = np.argsort(block, kind="stable")
                has = np.zeros(1 << BLOCK_BITS, bool)
                has[block] = True
                self.tables[key, b] = (has, block[order], order)

    @staticmethod
    def block(prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> U64(b * BLOCK_BITS)) & U64((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, where in the row the item would begin) of all windows of the rows'
        words within RADIUS of one of the items' windows; rows begin at ``first``."""
        found = [np.zeros(0, np.int64)]
        # Every row begins at a multiple of STEP, so what stands before it changes nothing.
        sizes = np.diff(first)
        begin = np.append(0, np.cumsum(-(-sizes // STEP) * STEP))
        padded = np.zeros(begin[-1], U64)
        padded[np.arange(len(hashes)) + np.repeat(begin[:-1] - first[:-1], sizes)] = hashes
        bits = _Bits(padded)
        row = np.repeat(np.arange(len(sizes)), np.diff(begin))
        left = (begin[:-1] + sizes)[row] - np.arange(len(padded))
        # One number for (row, item, place): a place lies less than an item's length before
        # its row.
        most = max(map(len, self.words), default=0)
        span = int(sizes.max(initial=0)) + most + 1
        for (size, step), (prints, item, bounds, offsets) in self.prints.items():
            own = bits.windows(size, step)
            inside = left[: len(own) * step : step] >= size
            pairs = [np.zeros(0, np.int64)]
            for b in range(RADIUS + 1):
                has, block, order = self.tables[(size, step), b]
                value = self.block(own, b)
                hit = np.flatnonzero(has[value] & inside)
                low, high = np.searchsorted(block, value[hit], "left"), np.searchsorted(block, value[hit], "right")
                for part, k in _spread(high - low):
                    at, other = hit[part], order[low[part] + k]
                    near = np.bitwise_count(own[at] ^ prints[other]) <= RADIUS
                    pairs.append(np.unique(at[near] * len(prints) + other[near]))
            # A window and a fingerprint of an item are one pair, whatever blocks they share and
            # however often the item has it; the places it stands for are merged as they come.
            pairs = np.unique(np.concatenate(pairs))
            at, other = pairs // max(len(prints), 1), pairs % max(len(prints), 1)
            for part, k in _spread(np.diff(bounds)[other]):
                where = at[part] * step
                place = where - begin[row[where]] - offsets[bounds[other[part]] + k]
                found.append(np.unique((row[where] * len(self.words) + item[other[part]]) * span + place + most))
            if len(found) > 32:
                found = [np.unique(np.concatenate(found))]
        every = np.unique(np.concatenate(found))
        pair, place = every // span, every % span - most
        return pair // max(len(self.words), 1), pair % max(len(self.words), 1), place

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item's shingles and a window's; a shingle that n
        different items have weighs 1/n, one that this item lacks the mean of the item's."""
        own, weights = self.shingles[item], self.weights[item]
        other = _shingles(window)
        common, at, _ = np.intersect1d(own, other, assume_unique=True, return_indices=True)
        both = float(weights[at].sum())
        total = float(weights.sum() + weights.mean() * (len(other) - len(common)))
        # all of the item and nothing else is 1 in whatever order the weights are summed
        return 1.0 if len(common) == len(own) == len(other) else both / total


def _search(index: Index, rows: list[str]) -> list[tuple[int, int, int, float]]:
    """(row, item id, first word, similarity) of verified passages, the best of each row and
    item (ties: the first)."""
    hashes, first = _words(rows)
    if not len(hashes) or not index.words:
        return []
    row, item, place = index.candidates(hashes, first)
    sizes, least = np.array([len(w) for w in index.words]), np.array(index.least)
    # Near a border the place may reach past it, so that less of what is foreign is in it: all
    # such places of a row and item are tried.
    size, few, n = sizes[item], least[item], np.diff(first)[row]
    more = [np.stack([row, item, place])]
    for near, low, high in (
        (place <= size - few, few - size, np.minimum(place, 0)),
        (place + size >= n - (size - few), np.maximum(place, n - size) + 1, n - few + 1),
    ):
        low, high = low[near], np.maximum(high[near], low[near])
        pair = np.stack([row[near], item[near]])
        # places of one row and item make one range
        _, same = np.unique(pair, axis=1, return_inverse=True)
        same = same.reshape(-1)
        if len(same):
            first_of = np.unique(same, return_index=True)[1]
            bottom, top = np.full(len(first_of), 1 << 60), np.full(len(first_of), -(1 << 60))
            np.minimum.at(bottom, same, low)
            np.maximum.at(top, same, high)
            for part, k in _spread(np.maximum(top - bottom, 0)):
                more.append(np.stack([*pair[:, first_of[part]], bottom[part] + k]))
    row, item, place = np.unique(np.concatenate(more, axis=1), axis=1)
    # What reaches past the row is cut off.
    low, high = np.maximum(place, 0) + first[row], np.minimum(place + sizes[item] + first[row], first[row + 1])
    held = low < high
    row, item, low, high = row[held], item[held], low[held], high[held]
    # Equal windows are compared with an item once, however often they stand in a step.
    windows = np.stack([item.astype(U64), substring_hashes(hashes, low, high)])
    _, one, same = np.unique(windows, axis=1, return_index=True, return_inverse=True)
    similar = np.array([index.similarity(int(item[k]), hashes[low[k] : high[k]]) for k in one])[same.reshape(-1)] if len(one) else np.zeros(0)
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for k in np.flatnonzero(similar >= SIMILARITY).tolist():
        r, i, s = int(row[k]), index.ids[item[k]], float(similar[k])
        if s > best.get((r, i), (0, 0))[0]:
            best[r, i] = s, int(low[k] - first[r])
    return [(r, i, p, s) for (r, i), (s, p) in best.items()]


def _indexes(benchmark: DataFrame, item_col: str, text_col: str) -> list:
    """The benchmark as broadcast indexes of at most about PASS_WORDS words each."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    passes = max(1, -(-total // PASS_WORDS))
    items = items.withColumn("pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)).cast("int"))
    counts = shared(_shared_shingles(items))
    context, indexes = benchmark.sparkSession.sparkContext, []
    for k in range(passes):
        known = {r["shingle"] & (1 << 64) - 1: r["n"] for r in counts.filter(F.array_contains("passes", k)).select("shingle", "n").toLocalIterator()}
        rows = [(r["item_id"], r["text"]) for r in items.filter(F.col("pass") == k).toLocalIterator()]
        indexes.append(context.broadcast(Index(rows, known)))
    return indexes


def _shared_shingles(items: DataFrame) -> DataFrame:
    """From (text, pass): the shingles that several different item texts of the benchmark
    have, as (shingle, n, passes whose items have it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text"):
                hashes, first = _words(texts(step, "text"))
                each = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
                found = [_shingles(h) for h in each]
                sizes = [len(x) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(found).view(np.int64)),
                        pa.array(np.repeat(np.array([_sequence(h) for h in each], np.int64), sizes)),
                        pa.array(np.repeat(step.column(1).to_numpy(), sizes)),
                    ],
                    ["shingle", "sequence", "pass"],
                )

    found = items.select("text", "pass").mapInArrow(run, "shingle long, sequence long, pass int").distinct()
    return found.groupBy("shingle").agg(F.count_distinct("sequence").alias("n"), F.collect_set("pass").alias("passes")).filter("n > 1")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each document and benchmark item that it holds: doc_id, item_id, first_word
    (of the document, from 0), similarity.

    The benchmark is the stated query set: it goes to the executors in passes of at most
    about PASS_WORDS words, each against all documents.  Defined cases: null and empty texts
    and items match nothing; null ids stay null in the result; repeated documents each get
    their rows, repeated items each match; an item of fewer than five words is one shingle;
    further columns are not looked at; an empty table on either side gives no rows."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    result = None
    for index in _indexes(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for step in steps(batch, "text"):
                    found = _search(index.value, texts(step, "text"))
                    if found:
                        row, item, place, similar = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [step.column(0).take(pa.array(row)), pa.array(item, pa.int64()), pa.array(place, pa.int64()), pa.array(similar, pa.float64())],
                            ["doc_id", "item_id", "first_word", "similarity"],
                        )

        hits = docs.mapInArrow(run, "doc_id long, item_id long, first_word long, similarity double")
        result = hits if result is None else result.union(hits)
    return result


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text contaminated() finds no item, with all columns.  Each
    row is judged by its own text, so nothing is joined or shuffled."""
    kept = docs
    for index in _indexes(benchmark, "item_id", "text"):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for step in steps(batch, text_col):
                    clean = np.ones(step.num_rows, bool)
                    clean[[row for row, *_ in _search(index.value, texts(step, text_col))]] = False
                    yield step.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
