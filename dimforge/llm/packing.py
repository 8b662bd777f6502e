"""Best-fit packing of tokenised documents into sequences of fixed capacity, certified by
dual-feasible lower bounds.

Documents are dealt into partitions, each packed by best-fit decreasing.  A dual feasible
function f gives sizes weights such that no full sequence weighs more than 1, so the items'
total weight is a bound on the number of sequences that any packing needs.  A partition whose
count reaches its bound is certified.  While all sequences together are more than the bound of
all items, partitions offer their loosest sequences: the documents of eight partitions meet,
are packed anew, and the better packing stays.

Best fit of items of equal size fills the fullest fitting sequence as far as it goes, then the
next, so a partition is packed by the counts of its sizes, whole runs of equal sequences at
once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared, steps, utf8

#: Documents of a partition, and how many partitions exchange documents with each other.
DEAL = 1 << 13
MEET = 8
#: Sequences, the loosest, that a partition offers in an exchange.
OFFER = 16

#: Bytes of text that are tokenised together.
STEP = 2 << 20
#: Bytes that a worker's remembered parts and their ids may take, and the longest part kept.
REMEMBERED = 128 << 20
LONGEST_KEPT = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _marked(values) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[*values]] = True
    return table


# Bytes that may begin a part, and what has to stand before them.
_WHITE = _marked([*range(0x09, 0x0E), *range(0x1C, 0x21)])
_POINT = _marked(b".,;:!?")
_LETTER = _marked([*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)])
#: Lead bytes of the characters above ASCII that may be white space, two and three bytes long.
_TWO, _THREE = _marked([0xC2]), _marked([0xE1, 0xE2, 0xE3])


class Ids:
    """Ids of whole texts by the tokenizers library.

    A byte-level vocabulary's words end before white space that follows something else, and
    before a point that follows a letter, whatever stands around.  Texts are cut there, equal
    parts of a step are found at once, and the library gets each part that wasn't met before."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self.between_id, self.between = min(special, default=(None, None))
        self.known: dict[bytes, bytes] = {}
        self.room = REMEMBERED

    @staticmethod
    def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where parts begin, ascending; every text begins one."""
        white = _WHITE[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = (white[1:] & ~white[:-1]) | (_POINT[data[1:]] & _LETTER[data[:-1]])
        at = np.flatnonzero(begins)
        # A character above ASCII before the cut might be white space: then there is none.
        unsure = (at >= 2) & _TWO[data[at - 2]] | (at >= 3) & _THREE[data[at - 3]]
        begins[at[unsure]] = False
        begins[offsets[:-1]] = True
        return np.flatnonzero(begins[:-1])

    def _of(self, parts: list[bytes]) -> list[bytes]:
        """The ids of parts, as little-endian 32-bit numbers."""
        found = list(map(self.known.get, parts))
        missing = [k for k, ids in enumerate(found) if ids is None]
        for begin in range(0, len(missing), 1 << 16):
            some = missing[begin : begin + (1 << 16)]
            for k, ids in zip(some, self._asked([parts[k].decode() for k in some])):
                found[k] = ids
                # About what Python needs for the two strings and the entry.
                cost = len(parts[k]) + len(ids) + 180
                if len(parts[k]) <= LONGEST_KEPT and cost <= self.room:
                    self.known[parts[k]] = ids
                    self.room -= cost
        return found

    def _asked(self, parts: list[str]) -> list[bytes]:
        """The library's ids.  It cuts texts at its special tokens first, so one of them between
        parts keeps them apart, and many parts are asked for at once."""
        alone = [k for k, part in enumerate(parts) if self.between is None or self.between in part or not part]
        kept = set(alone)
        rest = [k for k in range(len(parts)) if k not in kept]
        out: list[bytes] = [b""] * len(parts)
        for k, e in zip(alone, self.tokenizer.encode_batch_fast([parts[k] for k in alone], add_special_tokens=False)):
            out[k] = np.array(e.ids, "<u4").tobytes()
        groups = [rest[k : k + 256] for k in range(0, len(rest), 256)]
        joined = [self.between.join([parts[k] for k in group]) for group in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            stops = np.append(np.flatnonzero(ids == self.between_id), len(ids)).tolist()
            if len(stops) != len(group):
                raise ValueError("the tokenizer doesn't keep its special tokens")
            low = 0
            for k, high in zip(group, stops):
                out[k] = ids[low:high].tobytes()
                low = high + 1
        return out

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts data[offsets[k]:offsets[k + 1]], and where each text's begin."""
        starts = self.cuts(data, offsets)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        places = np.append(starts, len(data)).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))])
        distinct = parts.dictionary_encode()
        ids = self._of(distinct.dictionary.to_pylist())
        code = distinct.indices.to_numpy()
        size = np.array([len(i) // 4 for i in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4")
        many = size[code]
        ends = np.cumsum(many)
        shift = (np.cumsum(size) - size)[code] - (ends - many)
        out = flat[np.repeat(shift, many) + np.arange(ends[-1])]
        return out, np.append(0, ends)[np.searchsorted(starts, offsets)]


_readers: dict[str, Ids] = {}


def reader(path: str) -> Ids:
    if path not in _readers:
        _readers[path] = Ids(path)
    return _readers[path]


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids_crc32) of each document's ids and
    ``end_id``.  Only documents longer than the capacity are cut: all pieces but the first are
    full.  A null text is empty, a document of one id.  Other columns aren't looked at."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = reader(path)
        for batch in batches:
            for step in steps(batch, "text", STEP):
                ids, bounds = ids_of(*utf8(step, "text"))
                out: list[tuple] = []
                for doc_id, low, high in zip(step.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    whole = ids[low:high].tobytes() + end
                    total, start, piece = high - low + 1, 0, 0
                    while start < total:
                        length = (total - 1) % capacity + 1 if piece == 0 else capacity
                        out.append((doc_id, piece, start, length, zlib.crc32(whole[4 * start : 4 * (start + length)])))
                        start, piece = start + length, piece + 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


# ------------------------------------------------------------------------------------------
# Bounds and packing by the counts of sizes


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The largest of the bounds that dual feasible functions give; ``counts[s]`` items have
    size s.  Whole numbers throughout, so nothing is lost by rounding."""
    sizes = np.arange(capacity + 1, dtype=np.int64)
    upto = np.cumsum(counts, dtype=np.int64)
    room = np.cumsum(counts * sizes, dtype=np.int64)
    # Items above capacity - t count whole, those from t on by size, smaller ones not at all.
    t = np.arange(capacity // 2 + 1)
    whole = upto[capacity] - upto[capacity - t]
    middle = room[capacity - t] - np.where(t > 0, room[np.maximum(t - 1, 0)], 0)
    best = int((whole - (-middle // capacity)).max())
    # Rounded down to k-ths, but for sizes that are (k + 1)-ths.
    for k in range(1, 101):
        share = (k + 1) * sizes
        weight = np.where(share % capacity == 0, sizes * k, share // capacity * capacity)
        best = max(best, -(-int((counts * weight).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups (number of equal sequences, their contents as (size, how many)) of the best-fit
    decreasing packing of ``counts[s]`` items of size s."""
    rooms: dict[int, list[tuple[int, tuple]]] = {}
    mask = 0  # bit r: there are sequences with room r

    def put(room: int, number: int, content: tuple) -> None:
        nonlocal mask
        if number:
            rooms.setdefault(room, []).append((number, content))
            mask |= 1 << room

    for size in map(int, np.flatnonzero(counts)[::-1]):
        left = int(counts[size])
        while left:
            fits = mask >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                number, content = rooms[room].pop()
                if not rooms[room]:
                    mask &= ~(1 << room)
            else:
                room, content = capacity, ()
                number = -(-left // (capacity // size))
            each = room // size
            filled = min(number, left // each)
            rest = min(left - filled * each, each - 1) if filled < number else 0
            put(room - each * size, filled, (content, size, each))
            if rest:
                put(room - rest * size, 1, (content, size, rest))
            put(room, number - filled - bool(rest), content)
            left -= filled * each + rest
    groups = []
    for found in rooms.values():
        for number, content in found:
            items = []
            while content:
                content, size, many = content
                items.append((size, many))
            if items:
                groups.append((number, items[::-1]))
    return groups


def pack_sizes(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each item, and the number of sequences."""
    counts = np.bincount(sizes, minlength=capacity + 1)
    slots: dict[int, list[tuple[np.ndarray, int]]] = {}
    total = 0
    for number, content in best_fit_decreasing(counts, capacity):
        at, members = 0, np.arange(total, total + number)
        for size, many in content:
            for _ in range(many):
                slots.setdefault(size, []).append((members, at))
                at += size
        total += number
    order = np.argsort(sizes, kind="stable")
    by_size = [(np.concatenate([m for m, _ in slots[s]]), np.concatenate([np.full(len(m), at) for m, at in slots[s]])) for s in sorted(slots)]
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    if by_size:
        sequence[order] = np.concatenate([s for s, _ in by_size])
        offset[order] = np.concatenate([o for _, o in by_size])
    return sequence, offset, total


def _packer(capacity: int, stage: int, last: bool):
    """Packs the documents of one deal.  Documents that were packed before stay as they were
    unless there are fewer sequences now.  Unless it is the last stage, the loosest sequences
    are offered for the next."""

    def run(rows: pa.Table) -> pa.Table:
        sizes = rows.column("length").to_numpy()
        deal = rows.column("deal")[0].as_py()
        sequence, offset, total = pack_sizes(sizes, capacity)
        before = rows.column("sequence_id").to_numpy()
        names = ((np.int64(stage) << 24 | deal) << 32 | sequence) * 2
        if stage:
            _, old = np.unique(before, return_inverse=True)
            if old.max() + 1 <= total:
                sequence, total, names, offset = old, int(old.max()) + 1, before, rows.column("offset").to_numpy()
        counts = np.bincount(sizes, minlength=capacity + 1)
        used = np.bincount(sequence, weights=sizes, minlength=total)
        loosest = np.argsort(used, kind="stable")[: 0 if last else OFFER]
        offered = np.isin(sequence, loosest[used[loosest] < capacity])
        certified = np.full(len(sizes), total == lower_bound(counts, capacity))
        for name, values in (("sequence_id", names), ("offset", offset), ("offered", offered), ("certified", certified)):
            rows = rows.set_column(rows.schema.get_field_index(name), rows.schema.field(name), pa.array(values))
        return rows

    return run


def pack(found: DataFrame, capacity: int = 2048) -> DataFrame:
    """Deals the pieces into sequences of at most ``capacity`` ids: adds sequence_id, offset
    (gapless from 0) and certified: whether the partition that the piece was last packed in has
    no more sequences than its lower bound.

    Defined cases: full pieces are sequences by themselves.  Repeated rows are pieces of their
    own.  Ties are settled by the rows' order in the written table of pieces.  An empty table
    gives no rows."""
    rows = shared(found)
    spark = rows.sparkSession
    # The written table gives each row the same number whenever it is read.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    full = rows.filter(F.col("length") == capacity).select(*found.columns, (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    small = rows.filter(F.col("length") < capacity)
    sizes = small.groupBy("length").count().collect()  # less than capacity rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in sizes:
        counts[r["length"]] = r["count"]
    if not counts.sum():
        return full
    bound, deals = lower_bound(counts, capacity), -(-int(counts.sum()) // DEAL)
    state = small.select(
        *found.columns, F.pmod(F.xxhash64("row"), F.lit(deals)).alias("deal"), F.lit(0).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(False).alias("offered"), F.lit(False).alias("certified"),
    )
    done, sequences, stage = [full], 0, 0
    while True:
        last = deals == 1
        state = shared(state.groupBy("deal").applyInArrow(_packer(capacity, stage, last), state.schema))
        begun = {r["offered"]: r["count"] for r in state.filter("offset = 0").groupBy("offered").count().collect()}
        sequences += sum(begun.values())
        if last or sequences == bound:
            break
        # What was offered is counted again after the next stage.
        sequences -= begun.get(True, 0)
        done.append(state.filter("not offered"))
        deals, stage = -(-deals // MEET), stage + 1
        state = state.filter("offered").withColumn("deal", F.floor(F.col("deal") / MEET).cast("long"))
        if not begun.get(True, 0):
            state = spark.createDataFrame([], state.schema)
            break
    parts = [p.select(full.columns) for p in [*done, state]]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
