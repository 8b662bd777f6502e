"""Token counts by byte-pair merging, without ever making token ids.

A word's bytes are a linked list of symbols.  A heap holds the ranks of adjacent pairs; the
lowest is popped, merged if its symbols still stand side by side, and the pairs that arise go
into the heap.  The count is the number of first symbols less the merges.
"""

from __future__ import annotations

import json
import unicodedata
import uuid
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps, texts

DEFAULT_VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Words whose counts a Python worker remembers: so many new ones, and as many of before;
#: words longer than LONGEST_KEPT are not, so the memory is bounded in bytes.
REMEMBERED = 500_000
LONGEST_KEPT = 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_VOCABULARY)


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1
    characters stand for themselves, the others take the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Vocabulary:
    """What counting needs of a tokenizer file: the merges by symbol numbers, the pattern that
    cuts words, and the special tokens.  Read on the driver and broadcast; as large as the
    vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only plain byte-pair vocabularies")
        end = model.get("end_of_word_suffix") or ""
        vocabulary = model["vocab"]
        letters = _byte_letters()
        self.inner = [vocabulary[c] for c in letters]
        self.last = [vocabulary[c + end] for c in letters]
        self.size = max(vocabulary.values()) + 1
        #: left * size + right: (rank, symbol made)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges[vocabulary[a] * self.size + vocabulary[b]] = rank, vocabulary[a + b]
        self.special = [t["content"] for t in spec["added_tokens"]]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        cut = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if kinds != ["NFC", "Replace", "Lowercase"] or not cut["invert"] or cut["behavior"] != "Removed":
            raise ValueError("another normalizer or word pattern than this operator knows")
        self.pattern = cut["pattern"]["Regex"]


def count_word(vocabulary: Vocabulary, word: bytes) -> int:
    """Tokens of one word of at least a byte."""
    n = len(word)
    symbols = [vocabulary.inner[b] for b in word]
    symbols[-1] = vocabulary.last[word[-1]]
    if n == 1:
        return 1
    size, merges = vocabulary.size, vocabulary.merges
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        pair = symbols[i] * size + symbols[i + 1]
        if pair in merges:
            heap.append((merges[pair][0], i, pair))
    heapify(heap)
    count = n
    while heap:
        _, i, pair = heappop(heap)
        j = after[i]
        if symbols[i] < 0 or j >= n or symbols[i] * size + symbols[j] != pair:
            continue  # one of the two has merged since
        symbols[i], symbols[j] = merges[pair][1], -1
        count -= 1
        k = after[j]
        after[i] = k
        if k < n:
            before[k] = i
            right = symbols[i] * size + symbols[k]
            if right in merges:
                heappush(heap, (merges[right][0], i, right))
        h = before[i]
        if h >= 0:
            left = symbols[h] * size + symbols[i]
            if left in merges:
                heappush(heap, (merges[left][0], h, left))
    return count


class _Counts(dict):
    """Counts by word; a word that isn't known is counted when it is asked for."""

    def __init__(self, vocabulary: Vocabulary, before: dict | None = None):
        self.vocabulary, self.before = vocabulary, before or {}

    def __missing__(self, word: str) -> int:
        count = self.before.get(word)
        if count is None:
            count = count_word(self.vocabulary, word.encode("utf-8", "replace"))
        if len(word) <= LONGEST_KEPT:
            self[word] = count
        return count


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.counts = _Counts(vocabulary)
        self.find = regex.compile(vocabulary.pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None

    def _plain(self, text: str) -> int:
        # The library lower-cases character by character, so a capital sigma at a word's end
        # becomes the usual small one.
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return sum(map(self.counts.__getitem__, self.find(low)))

    def count(self, text: str) -> int:
        if len(self.counts) > REMEMBERED:
            before = dict(self.counts)
            self.counts = _Counts(self.vocabulary, before)
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), as the
    tokenizer's library counts without begin, end or added special tokens; special strings
    inside a text are a token each, as by its default.

    Defined cases: null and empty texts, and those of white space alone, have 0 tokens.  Whole
    texts of any length are counted.  Equal texts count equally; null ids stay null; further
    columns are not looked at; an empty table gives no rows."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path or default_path()))
    key = uuid.uuid4().hex  # a worker may live on over several of these

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(vocabulary.value)
        count = _counters[key].count
        for batch in batches:
            for part in steps(batch, "text"):
                rows = texts(part, "text")
                tokens = list(map(count, rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in rows], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
