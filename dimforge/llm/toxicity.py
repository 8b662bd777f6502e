"""Toxicity from two Kneser-Ney language models, one of toxic texts and one of ordinary ones.

The models are over the letters of words (``ORDER``-grams of code points, word borders
included).  Only the highest order is counted by class; the orders below are Kneser-Ney
continuation counts of both classes together, so an expression that neither class shows often
gets about the same likelihood from both.  A text's evidence is the difference of its two
log-likelihoods, divided by its length; a logistic curve turns it into a score.

Counts and models are tables that grow with the labelled text; they are joined, never
collected.  The words of all texts are scored once each by a join with the models.  Then texts
meet their words.  The ``HEAD_WORDS`` words that most blocks of texts hold are sent to all tasks
with their evidence; for each other word of a block, however many there are, the block asks once,
by a join, and says which of its texts hold it how often.  Evidence is a whole number of 2 ** -24,
so sums don't depend on their order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, steps, stored

ORDER = 5
#: What stands before and behind a word.
BORDER = "\0"
#: Absolute discount of Kneser-Ney smoothing.
DISCOUNT = 0.75
#: Bins that the development rows' evidence is counted in to fit the logistic curve.
BINS = 8000
REACH = 4.0
#: So many label rows (16 bytes each) may be broadcast; beyond, the same join is a shuffle.
BROADCAST_LABELS = 2_000_000
#: Characters and texts of a block of texts; a longer text is a block of its own.
BLOCK_CHARS = 16 << 20
BLOCK_TEXTS = 1 << 16
#: Blocks of a task at most, by which their names are told apart.
TASK_BLOCKS = 1 << 24
#: Longer texts are cut into words by pieces of so many characters.
PIECE = 1 << 17
#: So many words, or few more, are turned to numbers at once; their texts are not kept.
STEP_WORDS = 1 << 16
#: Evidence is counted in this unit.
UNIT = 1 << 24
ROWS_OUT = 1 << 15
#: Texts that one row names at most: a word of more texts of a block has several rows.
TEXTS_A_ROW = 1 << 10
#: Pairs of a text and a word that are added up at once.
PAIRS = 1 << 17
#: Letters of a word; a longer one is several words.
LONGEST = 64
#: Words that ask for their grams together.
WORDS_A_BUCKET = 100_000
#: Words whose evidence every task gets: a bounded list of those that most blocks hold.  The
#: other words' evidence reaches the texts by a join.
HEAD_WORDS = 400_000
#: Steps to a doubling that numbers of blocks are told apart by.
LEVELS = 16
#: Stands before a block's number, in place of a word, in the rows of the block's texts.
ANY = "\0"

# Letters of scripts without spaces between words stand alone.
_ALONE = "฀-໿က-႟ក-៿⺀-꓏豈-﫿\U00020000-\U0003ffff"
_find = re.compile(f"[{_ALONE}]|[^\\W{_ALONE}]+").findall
_letter = re.compile(r"[^\W\d_]").search
_gap = re.compile(f"[\\W{_ALONE}]").search


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _words(piece: str) -> list[str]:
    """The words that have a letter; longer ones than LONGEST in parts."""
    words = [w for w in _find(piece) if w.isalpha() or _letter(w)]
    if words and len(max(words, key=len)) > LONGEST:
        words = [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return words


def _pieces(text: str) -> Iterator[str]:
    """The text in lower case, cut where no word goes on."""
    first = 0
    while len(text) - first > PIECE:
        gap = _gap(text, first + PIECE)
        if gap is None:
            break
        yield text[first : gap.start()].lower()
        first = gap.start()
    yield text[first:].lower()


class Block:
    """The words of some texts as numbers: those of ``head`` have its numbers, the others come
    behind.  Texts are taken one by one and not kept; those without a word have no place."""

    def __init__(self, head: dict[str, int] | None = None):
        self.head, self.numbers = head or {}, _Numbers()
        self.n_texts = 0
        self._words, self._sizes, self._places = [], [], []

    def take(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers, lengths and places of the words, once STEP_WORDS have come; ``rest`` gives
        the last ones."""
        place = self.n_texts
        for piece in _pieces(text):
            words = _words(piece)
            if words:
                self.n_texts = place + 1
                self._words += words
                self._sizes.append(len(words))
                self._places.append(place)
                if len(self._words) >= STEP_WORDS:
                    yield from self.rest()

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        words, n = self._words, len(self._words)
        if n:
            if self.head:
                seq = np.fromiter(map(self.head.get, words, repeat(-1)), np.int64, n)
                others = np.flatnonzero(seq < 0)
                found = map(self.numbers.__getitem__, map(words.__getitem__, others.tolist()))
                seq[others] = np.fromiter(found, np.int64, len(others)) + len(self.head)
            else:
                seq = np.fromiter(map(self.numbers.__getitem__, words), np.int64, n)
            yield seq, np.fromiter(map(len, words), np.int64, n), np.repeat(self._places, self._sizes)
            self._words, self._sizes, self._places = [], [], []


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple]]:
    """Rows, text first, dealt to blocks of about BLOCK_CHARS characters.  A block is to be read
    to its end before the next."""
    rows = (row for batch in batches for part in steps(batch, batch.schema.names[0]) for row in zip(*(c.to_pylist() for c in part.columns)) if row[0])
    ahead = next(rows, None)

    def block() -> Iterator[tuple]:
        nonlocal ahead
        n = size = 0
        # a long text is alone
        while ahead is not None and not (n and (size >= BLOCK_CHARS or n == BLOCK_TEXTS or len(ahead[0]) >= BLOCK_CHARS)):
            row, ahead = ahead, None
            n, size = n + 1, size + len(row[0])
            yield row
            ahead = next(rows, None)

    while ahead is not None:
        yield block()


#: What is counted of a word: toxic and ordinary rows, and those without dev rows.
COUNTS = ["toxic", "ordinary", "toxic_part", "ordinary_part"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (text, toxic, dev): word and COUNTS of each word of a block.  Texts whose toxic is
    null have words and no counts."""
    for rows in _blocks(batches):
        block, kinds, n = Block(), [], np.zeros((0, 5), np.int32)

        def add(seq: np.ndarray, of: np.ndarray) -> None:
            if len(n) < len(block.numbers):
                n.resize((len(block.numbers) * 5 // 4, 5), refcheck=False)  # new rows are zeros
            found, times = np.unique(seq * 5 + np.array(kinds, np.int64)[of], return_counts=True)
            n.reshape(-1)[found] += times.astype(np.int32)

        for text, toxic, dev in rows:
            del kinds[block.n_texts :]  # of texts without a word
            kinds.append(0 if toxic is None else 1 + toxic + 2 * dev)
            for seq, _, of in block.take(text):
                add(seq, of)
        for seq, _, of in block.rest():
            add(seq, of)
        words = list(block.numbers)
        for i in range(0, len(words), ROWS_OUT):
            c = n[i : min(i + ROWS_OUT, len(words))].astype(np.int64)
            out = c[:, 2] + c[:, 4], c[:, 1] + c[:, 3], c[:, 2].copy(), c[:, 1].copy()
            yield pa.RecordBatch.from_arrays([pa.array(words[i : i + ROWS_OUT], pa.string()), *map(pa.array, out)], ["word", *COUNTS])


def _vocabulary(texts: DataFrame) -> DataFrame:
    """Of (text, toxic, dev) all words with their COUNTS, and level, which grows with the
    logarithm of the number of blocks that hold the word."""
    counted = texts.mapInArrow(_counted, f"word string, {', '.join(f'{c} long' for c in COUNTS)}").groupBy("word")
    return stored(counted.agg(*[F.sum(c).alias(c) for c in COUNTS], F.floor(F.log2(F.count("*")) * LEVELS).cast("int").alias("level")))


def grams(word: str) -> F.Column:
    """All grams of a word: each letter, and the border behind it, with what stands before."""
    whole = F.concat(F.lit(BORDER * (ORDER - 1)), F.col(word), F.lit(BORDER))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substring(whole, i, F.lit(ORDER)))


def _context(gram: str) -> F.Column:
    return F.expr(f"substring({gram}, 1, length({gram}) - 1)")


def _shorter(gram: str) -> F.Column:
    return F.expr(f"substring({gram}, 2)")


def _model(counts: DataFrame, toxic: str, ordinary: str) -> tuple[DataFrame, DataFrame]:
    """From the grams' counts: (gram, seen) of seen grams and (context, new) of a gram that is
    new in its context.  Both are ln P(toxic model) - ln P(ordinary model)."""
    seen = counts.select("gram", F.col(toxic).alias("t"), F.col(ordinary).alias("o")).filter("t + o > 0")

    # Shared lower orders: how many different symbols a shorter gram has been seen behind.
    below, tables = seen.select("gram"), {}
    for order in range(ORDER - 1, 0, -1):
        tables[order] = below.groupBy(_shorter("gram").alias("gram")).agg(F.count("*").alias("k"))
        below = tables[order].select("gram")
    tables[1] = stored(tables[1])
    p, lower = None, F.lit(1.0 / (tables[1].count() + 1))
    for order in range(1, ORDER):
        table = tables[order].withColumn("context", _context("gram"))
        sums = table.groupBy("context").agg(F.sum("k").alias("total"), F.count("*").alias("kinds"))
        table = table.join(sums, "context")
        if p is not None:
            table = table.withColumn("shorter", _shorter("gram")).join(p.withColumnsRenamed({"gram": "shorter", "p": "lower"}), "shorter")
            lower = F.col("lower")
        p = table.select("gram", ((F.col("k") - DISCOUNT + DISCOUNT * F.col("kinds") * lower) / F.col("total")).alias("p"))

    def has(c):
        return F.sum((F.col(c) > 0).cast("long"))

    seen = seen.withColumns({"context": _context("gram"), "shorter": _shorter("gram")})
    by_context = stored(seen.groupBy("context").agg(F.sum("t").alias("t_sum"), F.sum("o").alias("o_sum"), has("t").alias("t_kinds"), has("o").alias("o_kinds")))

    def left(c):
        return F.when(F.col(f"{c}_sum") > 0, DISCOUNT * F.col(f"{c}_kinds") / F.col(f"{c}_sum")).otherwise(1.0)

    def probability(c):
        own = F.when(F.col(f"{c}_sum") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"{c}_sum")).otherwise(0.0)
        return own + left(c) * F.col("p")

    full = seen.join(by_context, "context").join(p.withColumnRenamed("gram", "shorter"), "shorter")
    return stored(full.select("gram", F.log(probability("t") / probability("o")).alias("seen"))), by_context.select("context", F.log(left("t") / left("o")).alias("new"))


def _columns(models) -> list[str]:
    """The evidence under each model."""
    return ["evidence", *[f"evidence_{i}" for i in range(1, len(models))]]


def _of_words(words: DataFrame, models: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(word, level, evidence of each model in UNITs) from (word, level).  Words are dealt to
    buckets of about WORDS_A_BUCKET by hash; a bucket asks for each of its grams once."""
    columns = _columns(models)

    def word_sums(words: pa.Table, pieces: pa.Table) -> pa.Table:
        """A bucket's words with the sums over their grams."""
        number = {g: i for i, g in enumerate(pieces["gram"].to_pylist())}
        names = words["word"].to_pylist()
        wholes = [BORDER * (ORDER - 1) + w + BORDER for w in names]
        sizes = np.fromiter(map(len, names), np.int64, len(names)) + 1
        at = np.fromiter((number[w[i : i + ORDER]] for w in wholes for i in range(len(w) - ORDER + 1)), np.int64, int(sizes.sum()))
        sums = [np.add.reduceat(pieces[c].to_numpy()[at], np.cumsum(sizes) - sizes) if len(at) else at for c in columns]
        return pa.table([words["word"], words["level"], *map(pa.array, sums)], names=["word", "level", *columns])

    buckets = F.pmod(F.xxhash64("word"), F.lit(words.count() // WORDS_A_BUCKET + 1)).alias("bucket")
    words = words.select("word", "level", buckets).repartition("bucket")
    pieces = words.select("bucket", F.explode(grams("word")).alias("gram")).distinct()
    for c, (seen, _) in zip(columns, models):
        pieces = pieces.join(seen.withColumnRenamed("seen", f"seen_{c}"), "gram", "left")
    pieces = pieces.withColumn("context", _context("gram"))
    for c, (_, new) in zip(columns, models):
        pieces = pieces.join(new.withColumnRenamed("new", f"new_{c}"), "context", "left")
    values = [F.round(F.coalesce(f"seen_{c}", f"new_{c}", F.lit(0.0)) * UNIT).cast("long").alias(c) for c in columns]
    pieces = pieces.select(F.col("bucket").alias("asker"), "gram", *values)
    schema = f"word string, level int, {', '.join(f'{c} long' for c in columns)}"
    return stored(words.groupBy("bucket").cogroup(pieces.groupBy("asker")).applyInArrow(word_sums, schema))


def _in_head(words: DataFrame) -> F.Column:
    """Whether a word is among the HEAD_WORDS of the highest levels, or few less.  Of the level
    that goes in by part some words are taken by hash."""
    left = HEAD_WORDS
    for level, n in sorted(((r["level"], r["n"]) for r in words.groupBy("level").agg(F.count("*").alias("n")).collect()), reverse=True):
        if n > left:
            part = F.pmod(F.xxhash64(F.lit("head"), F.col("word")), F.lit(1 << 20)) < int(left / n * (1 << 20))
            return (F.col("level") > level) | ((F.col("level") == level) & part)
        left -= n
    return F.lit(True)


def _asked(batches: Iterator[pa.RecordBatch], head: dict[str, int], values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """From (text, key1, key2): (word, block, found) of each word of a block that is not in
    ``head``.  ``found`` holds pairs of 16-bit numbers, a text and how often it holds the word.
    Rows of ANY and the block's number hold text, number of symbols, keys, and the sums of
    ``values`` (a row for each model) over the head's words, of the block's texts, 64 bits each."""
    names = ["word", "block", "found"]
    task = TaskContext.get().partitionId()
    values = np.concatenate([values, np.zeros((len(values), 1), np.int64)], axis=1).astype(np.float64)
    for number, rows in enumerate(_blocks(batches)):
        block, name = Block(head), task * TASK_BLOCKS + number
        keys, known_keys = [], set()
        # symbols, and the sums over the head's words, by text; whole numbers below 2 ** 53: sums of doubles are exact
        totals, held, n = np.zeros((len(values) + 1, 0)), [], []

        def add(seq: np.ndarray, lengths: np.ndarray, of: np.ndarray) -> np.ndarray:
            known = np.minimum(seq, len(head))
            first = int(of[0])
            new = np.stack([np.bincount(of - first, w, block.n_texts - first) for w in (lengths + 1, *(v[known] for v in values))])
            new[:, : totals.shape[1] - first] += totals[:, first:]
            other = known == len(head)
            words, times = np.unique((seq[other] - len(head)) * BLOCK_TEXTS + of[other], return_counts=True)
            held.append(words), n.append(times)
            return np.concatenate([totals[:, :first], new], axis=1)

        for text, *key in rows:
            if tuple(key) in known_keys:
                continue
            known_keys.add(tuple(key))
            del keys[block.n_texts :]  # of texts without a word
            keys.append(key)
            for step in block.take(text):
                totals = add(*step)
        for step in block.rest():
            totals = add(*step)
        n_texts = block.n_texts
        if not n_texts:
            continue
        symbols, *sums = totals
        texts = np.stack([np.arange(n_texts), symbols, *np.array(keys[:n_texts], np.int64).T, *sums], axis=1, dtype=np.int64, casting="unsafe")
        texts = [texts[i : i + TEXTS_A_ROW // 8].tobytes() for i in range(0, n_texts, TEXTS_A_ROW // 8)]
        yield pa.RecordBatch.from_arrays([pa.array([f"{ANY}{name}"] * len(texts)), pa.array([name] * len(texts), pa.int64()), pa.array(texts, pa.binary())], names)
        held, n = np.concatenate(held), np.concatenate(n)
        if not len(held):
            continue
        # a long text's steps are put together
        held, at = np.unique(held, return_inverse=True)
        n = np.bincount(at, n, len(held)).astype(np.int64)
        word, text = np.divmod(held, BLOCK_TEXTS)
        if n.max() >= 1 << 16:  # no count of 16 bits: several
            times = (n - 1) // 0xFFFF + 1
            last = np.cumsum(times) - 1
            word, text, over = np.repeat(word, times), np.repeat(text, times), n - (times - 1) * 0xFFFF
            n = np.full(len(word), 0xFFFF)
            n[last] = over
        first_of = np.diff(word, prepend=-1) != 0
        since = np.arange(len(word)) - np.flatnonzero(first_of)[np.cumsum(first_of) - 1]
        new = np.flatnonzero(since % TEXTS_A_ROW == 0)
        words = pa.array(list(block.numbers), pa.string()).take(pa.array(word[new]))
        found = np.stack([text, n], axis=1).astype(np.uint16)
        bounds = np.append(new, len(word))
        for i in range(0, len(new), ROWS_OUT):
            to = bounds[i : i + ROWS_OUT + 1]
            data = pa.Array.from_buffers(pa.binary(), len(to) - 1, [None, pa.py_buffer(((to - to[0]) * 4).astype(np.int32)), pa.py_buffer(found[to[0] : to[-1]].tobytes())])
            yield pa.RecordBatch.from_arrays([words.slice(i, ROWS_OUT), pa.array(np.full(len(to) - 1, name)), data], names)


def _summed(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """From (whether ANY, block, found, evidence of each model): evidence by block and text, a
    task's sums put together; the rows of ANY have the texts' lengths and keys, and the sums
    over the head's words.  ``names``: block, place, n, key1, key2, evidence of each model."""
    keys, values, pending = [], [[] for _ in names[5:]], 0

    def together():
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        keys[:] = [found]
        for v in values:
            # whole numbers below 2 ** 53: sums of doubles are exact
            v[:] = [np.bincount(at, np.concatenate(v), len(found))]

    def out():
        for i in range(0, len(keys[0]), ROWS_OUT):
            key = keys[0][i : i + ROWS_OUT]
            none = [pa.nulls(len(key), pa.int64())] * 3
            sums = [pa.array(v[0][i : i + ROWS_OUT].astype(np.int64)) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(key // BLOCK_TEXTS), pa.array(key % BLOCK_TEXTS), *none, *sums], names)
        for kept in (keys, *values):
            kept.clear()

    for batch in batches:
        any_, name = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        evidence = [c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns[3:]]
        found = batch.column(2).to_pylist()
        for i in np.flatnonzero(any_):
            text, *more = np.frombuffer(found[i], np.int64).reshape(-1, len(names) - 1).T
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (np.full(len(text), name[i]), text, *more)], names)
            found[i] = b""
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        before, first = np.concatenate([[0], np.cumsum(sizes)]), 0
        while first < len(found):
            # rows of about PAIRS pairs; one row has TEXTS_A_ROW at most
            last = max(first + 1, int(np.searchsorted(before, before[first] + PAIRS, "right")) - 1)
            pairs = np.frombuffer(b"".join(found[first:last]), np.uint16).reshape(-1, 2)
            row = np.repeat(np.arange(first, last), sizes[first:last])
            keys.append(name[row] * BLOCK_TEXTS + pairs[:, 0])
            for v, e in zip(values, evidence):
                v.append(pairs[:, 1] * e[row].astype(np.float64))
            pending, first = pending + len(pairs), last
            if pending > PAIRS:
                together()
                # what a task keeps is bounded; what it has added since, in proportion to that
                pending = -len(keys[0])
                if len(keys[0]) > 2 * PAIRS:
                    yield from out()
                    pending = 0
    if keys:
        together()
        yield from out()


def _evidence(docs: DataFrame, *models: tuple[DataFrame, DataFrame], words: DataFrame | None = None) -> DataFrame:
    """The rows with ``evidence`` per symbol in place of text, under further models as
    ``evidence_1`` and so on.  ``words``: the texts' vocabulary, if it stands ready.  Equal texts are told by two hashes of 64 bits and have equal
    evidence."""
    columns = _columns(models)
    if words is None:
        words = _vocabulary(docs.select("text", F.lit(None).cast("boolean").alias("toxic"), F.lit(None).cast("boolean").alias("dev")))
    words = _of_words(words, list(models))
    in_head = _in_head(words)
    top = words.filter(in_head).select("word", *columns).toArrow()
    head = docs.sparkSession.sparkContext.broadcast(("\n".join(top["word"].to_pylist()), np.stack([top[c].to_numpy() for c in columns])))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, values = head.value
        return _asked(batches, {w: i for i, w in enumerate(names.split("\n"))} if names else {}, values)

    docs = docs.withColumns({"key1": F.xxhash64("text"), "key2": F.xxhash64(F.lit("second"), F.col("text"))})
    rows = docs.select("text", "key1", "key2").mapInArrow(asked, "word string, block long, found binary")
    rows = rows.join(words.filter(~in_head).select("word", *columns).hint("merge"), "word", "left")
    rows = rows.select(F.col("word").startswith(ANY).alias("any"), "block", "found", *columns)
    names = ["block", "place", "n", "key1", "key2", *columns]
    sums = rows.mapInArrow(lambda batches: _summed(batches, names), ", ".join(f"{c} long" for c in names))
    texts = sums.groupBy("block", "place").agg(*[F.sum(c).alias(c) for c in columns], *[F.max(c).alias(c) for c in ("n", "key1", "key2")])
    texts = texts.groupBy("key1", "key2").agg(*[(F.min(c) / F.min("n") / UNIT).alias(c) for c in columns])
    texts = docs.drop("text").join(texts.hint("merge"), ["key1", "key2"], "left").drop("key1", "key2")
    return texts.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in columns})


def _curve(rows: pd.DataFrame) -> tuple[float, float]:
    """Slope and intercept of the logistic curve through counts by bin: Newton's method, with
    a weak pull to 0 that keeps separable or one-sided counts finite."""
    if rows.empty:
        return 0.0, 0.0
    x = rows["bin"].to_numpy(float) / BINS * REACH * 10
    y, n = rows["toxic"].to_numpy(float), rows["n"].to_numpy(float)
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)])
    pull = np.array([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        slope = design @ (y - n * p) - pull * w
        step = np.linalg.solve((design * (n * p * (1 - p))) @ design.T + np.diag(pull), slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] * 10), float(w[1])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Labels of rows whose crc32(doc_id) mod 5 is 0 are never learned from.  The curve is fitted
    to the rows of remainder 1 under a model of the others; the final model then counts all
    rows that may be learned from.

    Defined cases: a text that is null or has no letter has no evidence and gets the curve's
    value at 0.  Null labels and labels without a document teach nothing; if a document has
    several labels, one toxic is enough.  Without labels every score is 0.5, predicted 1.
    Null ids are not held out and not labelled.  Repeated rows get equal results; further
    columns are not looked at; an empty table gives no rows."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    labels = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    labels = stored(labels.filter(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    labels = F.broadcast(labels) if labels.count() <= BROADCAST_LABELS else labels
    dev = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    words = _vocabulary(docs.join(labels, "doc_id", "left").select("text", (F.col("toxic") != 0).alias("toxic"), dev.alias("dev")))
    counts = words.filter("toxic + ordinary > 0").select(F.explode(grams("word")).alias("gram"), *COUNTS)
    counts = stored(counts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in COUNTS]))

    # One pass over the texts for both models; the development rows' evidence is of the second.
    models = _model(counts, "toxic", "ordinary"), _model(counts, "toxic_part", "ordinary_part")
    scored = stored(_evidence(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), *models, words=words))
    place = F.round(F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.col("evidence_1"))) * (BINS / REACH)).cast("int")
    found = scored.join(labels, "doc_id").filter(dev)
    slope, intercept = _curve(found.groupBy(place.alias("bin")).agg(F.sum((F.col("toxic") != 0).cast("int")).alias("toxic"), F.count("*").alias("n")).toPandas())

    value = 1 / (1 + F.exp(-(F.col("evidence") * slope + intercept)))
    return scored.select("doc_id", "held_out", value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))
