"""SentencePiece encoding and decoding.

Texts are cut into words (a run of spaces belongs to the word behind it), and the distinct
words of a batch are segmented together: those of equal length advance position by position
as one numpy array.  At each position the hashes of all substrings that end there probe the
sorted hashes of the pieces, and the best way to get there is kept with a backpointer.

A unigram model takes the largest sum of scores.  A BPE model's merges follow no such sum, but
they have an order, and two pieces can stand side by side only if that order never merges
across their border.  With this condition on transitions exactly one path reaches each
position, and it is the one that merging gives (see ``Model.joins``); the maximum then picks it
among impossible ones.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import U64, mix, steps, texts

SPACE = "\u2581"
#: Characters that words are cut at besides spaces, if the model has no piece with them.
_CUTS = "\n\t\r"
#: Words longer than this are too few of a length for arrays; they advance one by one.
LONG_WORD = 128
#: Segmented words that a Python worker remembers: so many new ones, and as many of before;
#: words longer than LONGEST_KEPT code points are not, so the memory is bounded in bytes.
REMEMBERED = 50_000
LONGEST_KEPT = 64
#: Bytes of text whose new words are segmented together.
STEP = 1 << 21
_PAIR_SLOTS = 1 << 20
_NEVER = 1 << 40

DEFAULT_MODEL = "piece_bpe_32k.model"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_MODEL)


def _slot(key: np.ndarray) -> np.ndarray:
    """A place among 2 ** 20 for a substring's hash."""
    return ((key * U64(0xD1342543DE82EF95)) >> U64(44)).astype(np.int64)


def _is_bpe(raw: bytes) -> bool:
    """Whether the model file says BPE: field 3 (model_type) of field 2 (trainer_spec) is 2;
    1 is unigram, which is also what a file without the field means."""

    def fields(data: bytes):
        at = 0

        def number():
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            key = number()
            if key & 7 == 0:
                yield key >> 3, number()
            elif key & 7 == 2:
                size = number()
                yield key >> 3, data[at : at + size]
                at += size
            else:
                at += 8 if key & 7 == 1 else 4

    return any(kind == 2 for field, spec in fields(raw) if field == 2 for name, kind in fields(spec) if name == 3)


class Model:
    """A model's pieces as arrays.  Built on the driver from the file and broadcast: its size
    is that of the vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            raw = f.read()
        reader = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.n = n = reader.get_piece_size()
        pieces = [reader.id_to_piece(i) for i in range(n)]
        special = np.array([reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i) or reader.is_byte(i) for i in range(n)])
        score = np.array([reader.get_score(i) for i in range(n)])
        self.unknown = reader.unk_id()
        self.byte = np.zeros(256, np.int32)
        self.raw: list[bytes] = [p.replace(SPACE, " ").encode() for p in pieces]
        for i in range(n):
            if reader.is_byte(i):
                self.byte[int(pieces[i][1:-1], 16)] = i
                self.raw[i] = bytes([int(pieces[i][1:-1], 16)])
            elif reader.is_control(i):
                self.raw[i] = b""
            elif reader.is_unknown(i):
                self.raw[i] = " \u2047 ".encode()
        self.has_bytes = any(reader.is_byte(i) for i in range(n))
        self.bpe = _is_bpe(raw)
        self.ids = {pieces[i]: i for i in range(n) if not special[i]}
        #: lengths of runs of spaces that are pieces; they merge after all else, left to right
        self.runs = {len(p): i for p, i in self.ids.items() if not p.strip(SPACE)}
        # Merge order: by falling score.  A character that is a piece was not merged.
        self.born = np.full(n + 1, -1)
        self.left, self.right = np.full(n + 1, -1), np.full(n + 1, -1)
        usable = {p: i for p, i in self.ids.items() if len(p) == 1 or p.strip(SPACE)}
        if self.bpe:
            order = sorted((i for p, i in usable.items() if len(p) > 1), key=lambda i: -score[i])
            for rank, i in enumerate(order):
                self.born[i] = rank
            for i in order:
                parts = self._merge(pieces[i])
                if parts:
                    self.left[i], self.right[i] = parts
                else:
                    usable.pop(pieces[i])  # merging never makes it
        self.longest = max(map(len, usable))
        self.score = np.append(score, score.min() - 10) if not self.bpe else np.zeros(n + 1)
        keys = np.array([self._key(p) for p in usable], U64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(usable.values()))[order]
        self.may = np.zeros(1 << 20, bool)
        self.may[_slot(keys)] = True
        self.usable = usable
        pair = self.left * (n + 1) + self.right
        made = np.flatnonzero(self.left >= 0)
        made = made[np.argsort(pair[made])]
        self.pairs, self.pair_born = pair[made], self.born[made]
        cuts = "".join(c for c in _CUTS if not any(c in p for p in usable))
        self.cut = re.compile(f"{SPACE}*[^{SPACE}{cuts}]+|{SPACE}+" + (f"|[{cuts}]" if cuts else ""))

    def _key(self, piece: str) -> int:
        total, power = 0, 1
        for c in piece:
            total = (total + int(mix(np.array([ord(c) + 1], U64))[0]) * power) & (1 << 64) - 1
            power = power * _BASE & (1 << 64) - 1
        return total

    def _merge(self, piece: str) -> tuple[int, int] | None:
        """The two pieces that merging ``piece``'s characters puts together last, or None if
        merging doesn't end with the one piece."""
        parts, last = list(piece), None
        while len(parts) > 1:
            best = min((self.born[i], k) for k in range(len(parts) - 1) if (i := self.ids.get(parts[k] + parts[k + 1])) is not None) if any(parts[k] + parts[k + 1] in self.ids for k in range(len(parts) - 1)) else None
            if best is None:
                return None
            k = best[1]
            last = parts[k], parts[k + 1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return tuple(self.ids.get(p, self.n) for p in last) if last else None

    def joins(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the border of pieces a, b alone.  Seen backwards in time:
        while the symbols at the border are a and b, they would merge if a piece is made of
        them that was born before the later of both went on; then that later one falls apart
        into its halves, of which one lies at the border.  At equal births the left merges
        first."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), _NEVER)
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            pair = a[live] * (self.n + 1) + b[live]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            merges = (self.pairs[at] == pair) & (self.pair_born[at] < limit[live])
            good[live[merges]] = False
            live = live[~merges]
            ba, bb = self.born[a[live]], self.born[b[live]]
            some = (ba >= 0) | (bb >= 0)
            live, ba, bb = live[some], ba[some], bb[some]
            first = ba > bb
            limit[live] = np.where(first, ba, bb + 1)
            a[live] = np.where(first, self.right[a[live]], a[live])
            b[live] = np.where(first, b[live], self.left[b[live]])
        return good


_BASE = 0x9E3779B97F4A7C15 | 1
_POWER = np.array([pow(_BASE, k, 1 << 64) for k in range(LONG_WORD + 1)], U64)
_BACK = np.array([pow(pow(_BASE, -1, 1 << 64), k, 1 << 64) for k in range(LONG_WORD + 1)], U64)


class Encoder:
    """Segments words, and remembers a bounded number of them."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.pair_keys = np.full(_PAIR_SLOTS, -1)
        self.pair_good = np.zeros(_PAIR_SLOTS, bool)

    def _joins(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a * (self.model.n + 1) + b
        slot = (mix(pair.astype(U64)) >> U64(44)).astype(np.int64)
        miss = np.flatnonzero(self.pair_keys[slot] != pair)
        if not len(miss):
            return self.pair_good[slot]
        good = self.pair_good[slot]
        good[miss] = self.model.joins(a[miss], b[miss])
        self.pair_keys[slot[miss]], self.pair_good[slot[miss]] = pair[miss], good[miss]
        return good

    def _viterbi(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of one length as columns of code points: for every end position (row) the
        last piece on the best way to it, and that piece's length."""
        m = self.model
        n, count = units.shape
        sums = np.zeros((n + 1, count), U64)
        np.cumsum(mix(units.astype(U64) + U64(1)) * _POWER[:n, None], axis=0, out=sums[1:])
        best = np.full((n + 1, count), -np.inf)
        best[0] = 0
        last, back = np.full((n + 1, count), m.n), np.zeros((n + 1, count), np.int32)
        for end in range(1, n + 1):
            for size in range(1, min(end, m.longest) + 1):
                start = end - size
                key = (sums[end] - sums[start]) * _BACK[start]
                word = np.flatnonzero(m.may[_slot(key)])
                key = key[word]
                at = np.minimum(np.searchsorted(m.keys, key), len(m.keys) - 1)
                found = m.keys[at] == key
                if size == 1:  # a character that is no piece is a piece of its own
                    piece = np.full(count, m.n)
                    piece[word[found]] = m.key_ids[at[found]]
                    word = np.arange(count)
                else:
                    word, piece = word[found], m.key_ids[at[found]]
                if not len(word):
                    continue
                if m.bpe and start:
                    free = self._joins(last[start][word], piece)
                    word, piece = word[free], piece[free]
                value = best[start][word] + m.score[piece]
                better = value > best[end][word]
                word, piece = word[better], piece[better]
                best[end][word], last[end][word], back[end][word] = value[better], piece, size
        return last, back

    def _one(self, word: str) -> list[tuple[int, int]]:
        """(piece, length) of a long word: the same recurrence, position by position."""
        m = self.model
        best, last, back = [0.0], [m.n], [0]
        for end in range(1, len(word) + 1):
            value, piece, length = -np.inf, m.n, 1
            for size in range(1, min(end, m.longest) + 1):
                p = m.usable.get(word[end - size : end])
                if p is None:
                    if size > 1:
                        continue
                    p = m.n
                start = end - size
                v = best[start] + m.score[p]
                if v > value and (not m.bpe or not start or self._joins(np.array([last[start]]), np.array([p]))[0]):
                    value, piece, length = v, p, size
            best.append(value)
            last.append(piece)
            back.append(length)
        out, end = [], len(word)
        while end:
            out.append((last[end], back[end]))
            end -= back[end]
        return out[::-1]

    def _finish(self, word: str, path: list[tuple[int, int]]) -> bytes:
        ids, at = [], 0
        for piece, size in path:
            if piece < self.model.n:
                ids.append(piece)
            elif self.model.has_bytes:
                ids += self.model.byte[list(word[at : at + size].encode("utf-8", "replace"))].tolist()
            elif not ids or ids[-1] != self.model.unknown:
                ids.append(self.model.unknown)
            at += size
        return np.array(ids, np.int32).tobytes()

    def _learn(self, words: set[str]) -> None:
        lengths = defaultdict(list)
        for w in words:
            lengths[len(w)].append(w)
        for n, group in lengths.items():
            if n > LONG_WORD:
                for w in group:
                    self.known[w] = self._finish(w, self._one(w))
                continue
            for k in range(0, len(group), 8192):
                part = group[k : k + 8192]
                units = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
                last, back = self._viterbi(np.ascontiguousarray(units.T))
                # All words step back together; one that is at its beginning waits.
                ids = np.full((len(part), n), -1, np.int32)
                end, rows = np.full(len(part), n), np.arange(len(part))
                while len(rows):
                    size = back[end[rows], rows]
                    ids[rows, end[rows] - size] = last[end[rows], rows]
                    end[rows] -= size
                    rows = rows[end[rows] > 0]
                odd = set(np.flatnonzero((ids == self.model.n).any(axis=1)).tolist())
                used = ids >= 0
                ends = np.cumsum(used.sum(axis=1)) * 4
                flat = ids[used].tobytes()
                begin = 0
                for i, (w, stop) in enumerate(zip(part, ends.tolist())):
                    self.known[w] = flat[begin:stop]
                    begin = stop
                    if i in odd:
                        row = ids[i]
                        starts = np.flatnonzero(row >= 0)
                        self.known[w] = self._finish(w, list(zip(row[starts].tolist(), np.diff(np.append(starts, n)).tolist())))

    def _spaces(self, count: int) -> bytes:
        runs, most, ids = self.model.runs, max(self.model.runs, default=1), []
        while count:
            size = max((k for k in runs if k <= min(count, most)), default=1)
            ids.append(runs.get(size, self.model.unknown))
            count -= size
        return np.array(ids, np.int32).tobytes()

    def encode(self, rows: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of 32-bit numbers."""
        cut, known = self.model.cut, self.known
        parts = [cut.findall((SPACE + t).replace(" ", SPACE)) if t else [] for t in rows]
        new = set().union(*parts).difference(known) if parts else set()
        if len(known) + len(new) > REMEMBERED:
            self.before, self.known = known, {}
            known, new = self.known, set().union(*parts)
        if new:
            for w in new.intersection(self.before):
                known[w] = self.before[w]
            new.difference_update(known)
            # Of several spaces only the last can join the word; the others merge last of all.
            spaced = {w for w in new if w.startswith(SPACE * 2) or w == SPACE} if self.model.bpe else set()
            bare = {w: SPACE + w.lstrip(SPACE) for w in spaced}
            self._learn(new.difference(spaced).union(w for w in bare.values() if w != SPACE and w not in known))
            alone = self._spaces(1)
            for w, tail in bare.items():
                count = len(w) - len(tail)
                if tail == SPACE:
                    known[w] = self._spaces(count + 1)
                elif known[tail].startswith(alone):
                    known[w] = self._spaces(count + 1) + known[tail][len(alone) :]
                else:
                    known[w] = self._spaces(count) + known[tail]
        out = [b"".join(map(known.__getitem__, p)) for p in parts]
        for w in [*new, *(w.lstrip(SPACE) for w in new)]:
            if len(w) > LONGEST_KEPT - 1:
                known.pop(w, None)
                known.pop(SPACE + w, None)
        return out


def decode(model: Model, ids: np.ndarray) -> str:
    """The text of ids: pieces put together, byte pieces as bytes (what is no UTF-8 becomes
    U+FFFD), without the space that encoding put in front."""
    raw = b"".join(map(model.raw.__getitem__, ids.tolist()))
    return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def _encoder(model) -> Encoder:
    """A worker's encoder for a broadcast model; it lives on over the worker's tasks."""
    if model.id not in _encoders:
        _encoders.clear()
        _encoders[model.id] = Encoder(model.value)
    return _encoders[model.id]


class _Shared:
    def __init__(self, spark: SparkSession, path: str | None):
        self.handle = spark.sparkContext.broadcast(Model(path or default_path()))
        self.id = uuid.uuid4().hex

    @property
    def value(self) -> Model:
        return self.handle.value


def _plus(docs: DataFrame, *fields: T.StructField) -> tuple[DataFrame, T.StructType]:
    """``docs`` without columns of the new fields' names, and the schema with the fields."""
    names = {f.name.lower() for f in fields}
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() not in names])
    return docs, T.StructType([*docs.schema.fields, *fields])


def _lists(encoded: list[bytes]) -> pa.Array:
    ends = np.append(0, np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def encode(docs: DataFrame, text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_tokens``, as the model's own library gives
    them without begin or end.

    Defined cases: null and empty texts have no ids.  Control pieces inside a text are plain
    text.  A character without a piece becomes its UTF-8 bytes' pieces (or the unknown id if
    the model has none).  The library reads U+2581 in a text as a space, and so does this.
    Texts of any length are whole; equal texts have equal ids.  Columns called ids or n_tokens
    are replaced, all others kept; an empty table gives no rows."""
    docs, schema = _plus(docs, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()))
    model = _Shared(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            for part in steps(batch, text_col, STEP):
                encoded = encoder.encode(texts(part, text_col))
                sizes = pa.array([len(e) // 4 for e in encoded], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(encoded), sizes], schema.names)

    return docs.mapInArrow(run, schema)


def encode_checked(docs: DataFrame, text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """encode(), with ``round_trip``: whether the ids decode to the text (null: the empty
    text) again.  A column of this name is replaced."""
    docs, schema = _plus(docs, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType()))
    model = _Shared(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            for part in steps(batch, text_col, STEP):
                rows = texts(part, text_col)
                encoded = encoder.encode(rows)
                same = [decode(encoder.model, np.frombuffer(e, np.int32)) == t for e, t in zip(encoded, rows)]
                sizes = pa.array([len(e) // 4 for e in encoded], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(encoded), sizes, pa.array(same, pa.bool_())], schema.names)

    return docs.mapInArrow(run, schema)


def decoded(docs: DataFrame, ids_col: str = "ids", model_path: str | None = None) -> DataFrame:
    """``docs`` with ``decoded``, the text of the ids.  Null or empty ids give an empty text;
    an id that the model doesn't have is an error."""
    docs, schema = _plus(docs, T.StructField("decoded", T.StringType()))
    model = _Shared(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            rows = [decode(model.value, np.array(x or [], np.int64)) for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.string())], schema.names)

    return docs.mapInArrow(run, schema)


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """Encode every text and decode its ids: doc_id, n_tokens, ids, decoded_sha256 and
    round_trip, whether the decoded text is the text (null: the empty text)."""
    docs = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    model = _Shared(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            for part in steps(batch, "text", STEP):
                rows = texts(part, "text")
                encoded = encoder.encode(rows)
                back = [decode(encoder.model, np.frombuffer(e, np.int32)) for e in encoded]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(e) // 4 for e in encoded], pa.int64()), _lists(encoded),
                        pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back]), pa.array([a == b for a, b in zip(rows, back)]),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded_sha256", "round_trip"],
                )

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string, round_trip boolean")
