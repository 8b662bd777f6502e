"""Phrase collocation mining by top-order marginalisation.

Each word leads one window of the longest order, itself and the words after it in its piece,
padded with nulls.  Only these windows are counted: a phrase occurs as often as windows begin
with it, so Spark's ROLLUP over the lead columns gives the counts of all shorter phrases, and
of all words, without exploding other n-grams.

Windows are counted within a task first.  The counts travel as blocks, one for each bucket of
(lang, first two words) and step: a list of words and columns of their numbers.  The pairs of
one first word are spread over about the square root of the number of buckets, so that a very
frequent word is split and a rare one is not in every bucket.  In its bucket
a window's count is whole, and so is its pair's: windows that occur less than ``min_count``
times are given back as their longest prefix that doesn't, which leaves the counts of all
phrases that matter as they are and keeps the table that is rolled up small.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import _LOWER, U64, mix, shared, steps, substring_hashes, utf8

#: Bytes of text that are counted together, and bytes of text for each bucket.
STEP = 4 << 20
BUCKET = 8 << 20
#: The most buckets: more than 2^17 * 8 MB of text makes larger ones.
MOST_BUCKETS = 1 << 17
#: Rows of a result batch.
OUT_ROWS = 1 << 16

# What ends a piece, and what stands between words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[0x20, 0x09]] = True

_BLOCKS = pa.schema([("bucket", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.binary()), ("windows", pa.binary())])
BLOCKS = "bucket long, langs array<string>, words binary, windows binary"
_WINDOWS = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("n", pa.int64())])
WINDOWS = "lang string, w1 string, w2 string, w3 string, n long"
_ZSTD = pa.Codec("zstd", 1)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of n of each."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append([True], keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n[order], first)


def _distinct(lang: np.ndarray, word: list[np.ndarray], n: np.ndarray, size: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Sums n over equal windows: numbers of lang and of up to three words (-1: none) below
    ``size``, in the order of (lang, words)."""
    pairs, at = np.unique((lang * size + word[0]) * (size + 1) + word[1] + 1, return_inverse=True)
    keys, n = _summed(at * (size + 1) + word[2] + 1, n)
    pair = pairs[keys // (size + 1)]
    first = pair // (size + 1)
    return first // size, [first % size, pair % (size + 1) - 1, keys % (size + 1) - 1], n


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Number of each word, the distinct words, the number of each word's piece and text."""
    data = _LOWER[data]
    ends = _ENDS[data]
    solid = ~(ends | _BETWEEN[data])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (edge[:-1] | ~np.append([False], solid[:-1])))
    stops = np.flatnonzero(solid & (edge[1:] | ~np.append(solid[1:], [False]))) + 1
    cuts = ends.astype(np.int32)
    np.add.at(cuts, offsets[:-1][offsets[:-1] < len(data)], 1)
    piece = np.cumsum(cuts, dtype=np.int32)[starts]
    letters = np.ascontiguousarray(data[solid])
    places = np.concatenate([[0], np.cumsum(stops - starts)])
    all_words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(letters)])
    found = all_words.dictionary_encode()
    text = np.searchsorted(offsets, starts, "right") - 1
    return found.indices.to_numpy().astype(np.int64), found.dictionary, piece, text


def _hashes(words: pa.Array) -> np.ndarray:
    places = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
    return substring_hashes(data[places[0] : places[-1]], places[:-1] - places[0], places[1:] - places[0])


def _counter(buckets: int):
    spread = max(1, int(buckets**0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "text", STEP, 1 << 20):
                langs = step.column(0).dictionary_encode()
                word, known, piece, text = _words(*utf8(step, "text"))
                if not len(word):
                    continue
                size = len(known)
                lead = [word]
                for k in (1, 2):
                    ahead = np.full(len(word), -1, np.int64)
                    if len(word) > k:
                        ahead[:-k] = np.where(piece[k:] == piece[:-k], word[k:], -1)
                    lead.append(ahead)
                of, lead, n = _distinct(langs.indices.to_numpy().astype(np.int64)[text], lead, np.ones(len(word), np.int64), size)
                names = langs.dictionary.to_pylist()
                hashed = _hashes(known)
                salt = np.array([zlib.crc32(name.encode("utf-8", "surrogatepass")) for name in names], U64)
                home = mix(salt[of] * U64(0x9E3779B97F4A7C15) + hashed[lead[0]])
                away = mix(home + np.where(lead[1] >= 0, hashed[lead[1]], U64(1))) % U64(spread)
                bucket = ((home % U64(buckets) + away * U64(buckets // spread)) % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.append([True], np.diff(bucket[order]) != 0))
                out = []
                for rows in np.split(order, edges[1:]):
                    used, local = np.unique(np.concatenate([w[rows] for w in lead]), return_inverse=True)
                    local = local.reshape(3, -1) - (1 if used[0] < 0 else 0)
                    vocabulary = known.take(pa.array(used[used >= 0])).to_pylist()
                    columns = np.stack([of[rows], *local, n[rows]]).astype("<i4")
                    packed = b"\n".join(vocabulary)  # a newline ends a piece: no word has one
                    out.append((int(bucket[rows[0]]), names, _sealed(packed), _sealed(columns.tobytes())))
                    if len(out) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _BLOCKS)], schema=_BLOCKS)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _BLOCKS)], schema=_BLOCKS)

    return run


def _sealed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def _opened(data: bytes) -> bytes:
    return _ZSTD.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True)


def _bucket_counts(blocks: list[tuple], least: int) -> Iterator[pa.RecordBatch]:
    """The windows of one bucket, those under ``least`` as their longest prefix that isn't."""
    words, names, of, lead, n = [], {}, [], [[], [], []], []
    base = 0
    for langs, packed, columns in blocks:
        vocabulary = _opened(packed).split(b"\n")
        columns = np.frombuffer(_opened(columns), "<i4").astype(np.int64).reshape(5, -1)
        words.append(pa.array(vocabulary, pa.large_binary()))
        of.append(np.array([names.setdefault(x, len(names)) for x in langs], np.int64)[columns[0]])
        for k in range(3):
            lead[k].append(np.where(columns[k + 1] >= 0, columns[k + 1] + base, -1))
        n.append(columns[4])
        base += len(vocabulary)
    found = pa.concat_arrays(words).dictionary_encode()
    number = np.append(found.indices.to_numpy().astype(np.int64), -1)  # -1 stays -1
    size = len(found.dictionary)
    of, lead, n = _distinct(np.concatenate(of), [number[np.concatenate(w)] for w in lead], np.concatenate(n), size)
    rare = n < least
    lead[2][rare] = -1
    pair = (of * size + lead[0]) * (size + 1) + lead[1]
    first = np.flatnonzero(np.append([True], pair[1:] != pair[:-1]))
    of_pair = np.cumsum(np.append([True], pair[1:] != pair[:-1])) - 1
    lead[1][np.add.reduceat(n, first)[of_pair] < least] = -1
    of, lead, n = _distinct(of, lead, n, size)
    texts = found.dictionary.cast(pa.large_string()).cast(pa.string())
    langs = pa.array(list(names), pa.string())
    for k in range(0, len(n), OUT_ROWS):
        part = slice(k, k + OUT_ROWS)
        columns = [texts.take(pa.array(w[part], mask=w[part] < 0)) for w in lead]
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(of[part])), *columns, pa.array(n[part])], schema=_WINDOWS)


def _merger(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for bucket, *block in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != last and held:
                    yield from _bucket_counts(held, least)
                    held = []
                last = bucket
                held.append(block)
        if held:
            yield from _bucket_counts(held, least)

    return run


def windows(docs: DataFrame, min_count: int = 10, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Counts (lang, w1, w2, w3, n) of windows of three words, each padded with nulls behind
    the end of its piece.  Every word leads one window; windows that occur less than
    ``min_count`` times are counted as their longest prefix that doesn't (one word at least)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(size // BUCKET + 1, least), MOST_BUCKETS)
    blocks = rows.mapInArrow(_counter(buckets), BLOCKS)
    return blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_merger(min_count), WINDOWS)


def phrase_counts(counted: DataFrame, min_count: int = 10) -> DataFrame:
    """Occurrences n of the phrases of one to three words (and of all words: w1 null) that
    occur at least ``min_count`` times in a language, by ROLLUP over the lead columns."""
    rolled = counted.rollup("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    # A window shorter than its level's prefix is counted there once more: its last word is null.
    words = {0: "w3", 1: "w2", 3: "w1"}
    whole = F.col("level") == 7
    for level, last in words.items():
        whole = whole | ((F.col("level") == level) & F.col(last).isNotNull() & (F.col("n") >= min_count))
    order = F.when(F.col("level") == 0, 3).when(F.col("level") == 1, 2).when(F.col("level") == 3, 1).otherwise(0)
    return rolled.filter(whole).select("lang", "w1", "w2", "w3", "n", order.alias("words"))


def mine(docs: DataFrame, min_count: int = 10, inside_percent: int = 50, most: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``most`` best collocations of each language: lang, rank, phrase, a, l, r, n, score.

    a is the phrase's count, l and r the counts of the two parts of its lowest-scoring cut (the
    first such), n the language's words, score floor(10^6 a^2 / (l r)).  A phrase that lies in
    a longer candidate with at least ``inside_percent`` of its count is dropped.  Products are
    exact decimals of 38 digits: counts up to 10^15.

    Defined cases: a null language is ``und``; null and empty texts have no words; repeated
    rows count each; ties are ranked by count, then by the phrase's bytes.  An empty table
    gives no rows.  Columns other than the two named aren't looked at."""
    counts = shared(phrase_counts(windows(docs, min_count, lang_col, text_col), min_count))

    def part(words: int, names: dict[str, str], n: str) -> DataFrame:
        return counts.filter(F.col("words") == words).select("lang", *[F.col(c).alias(a) for c, a in names.items()], F.col("n").alias(n))

    def score(l_count: str, r_count: str) -> F.Column:
        return F.expr(f"cast(cast(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) as decimal(32,0)) * cast(1000000 as decimal(7,0)) as decimal(38,0)) div (cast({l_count} as decimal(18,0)) * cast({r_count} as decimal(18,0)))")

    one = {"w1": "w1"}
    both = part(2, {"w1": "w1", "w2": "w2"}, "a").join(part(1, one, "l"), ["lang", "w1"]).join(part(1, {"w1": "w2"}, "r"), ["lang", "w2"])
    pairs = both.select("lang", "w1", "w2", F.lit(None).cast("string").alias("w3"), "a", "l", "r", score("l", "r").alias("score"))
    three = (
        part(3, {"w1": "w1", "w2": "w2", "w3": "w3"}, "a")
        .join(part(1, one, "l1"), ["lang", "w1"]).join(part(2, {"w1": "w2", "w2": "w3"}, "r1"), ["lang", "w2", "w3"])
        .join(part(2, {"w1": "w1", "w2": "w2"}, "l2"), ["lang", "w1", "w2"]).join(part(1, {"w1": "w3"}, "r2"), ["lang", "w3"])
        .withColumn("s1", score("l1", "r1")).withColumn("s2", score("l2", "r2"))
    )
    early = F.col("s1") <= F.col("s2")
    triples = three.select("lang", "w1", "w2", "w3", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    around = part(3, {"w1": "w1", "w2": "w2"}, "longer").unionByName(part(3, {"w2": "w1", "w3": "w2"}, "longer")).groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer"))
    free = pairs.join(around, ["lang", "w1", "w2"], "left").filter(F.coalesce(F.col("longer"), F.lit(0)) * 100 < F.col("a") * inside_percent)
    ranked = free.drop("longer").unionByName(triples).withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = ranked.withColumn("rank", place).filter(F.col("rank") <= most)
    totals = counts.filter(F.col("words") == 0).select("lang", "n")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(min_count: int = 10, inside_percent: int = 50, most: int = 2000) -> str:
    """The same for DuckDB, by exploding every order."""
    return rf"""
with pieces as (
  select coalesce(lang, 'und') lang, regexp_extract_all(piece, '[^\x20\x09]+') w
  from (select lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents)
), leads as (select lang, unnest(w) w1, unnest(list_concat(w[2:], [null])) w2, unnest(list_concat(w[3:], [null, null])) w3 from pieces where len(w) > 0),
f1 as (select lang, w1, count(*) n from leads where w1 is not null group by all),
f2 as (select lang, w1, w2, count(*) n from leads where w1 is not null and w2 is not null group by all),
f3 as (select lang, w1, w2, w3, count(*) n from leads where w3 is not null group by all having count(*) >= {min_count}),
c2 as (
  select f2.lang, f2.w1 || ' ' || f2.w2 phrase, f2.n a, x.n l, y.n r, (1000000::hugeint * f2.n * f2.n) // (x.n::hugeint * y.n) score
  from f2 join f1 x on (x.lang, x.w1) = (f2.lang, f2.w1) join f1 y on (y.lang, y.w1) = (f2.lang, f2.w2)
  where f2.n >= {min_count} and not exists (
    select 1 from f3 where f3.lang = f2.lang and ((f3.w1, f3.w2) = (f2.w1, f2.w2) or (f3.w2, f3.w3) = (f2.w1, f2.w2)) and 100 * f3.n >= {inside_percent} * f2.n)
), cuts as (
  select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 phrase, f3.n a, 1 k, x.n l, y.n r, (1000000::hugeint * f3.n * f3.n) // (x.n::hugeint * y.n) score
  from f3 join f1 x on (x.lang, x.w1) = (f3.lang, f3.w1) join f2 y on (y.lang, y.w1, y.w2) = (f3.lang, f3.w2, f3.w3)
  union all
  select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.n, 2, x.n, y.n, (1000000::hugeint * f3.n * f3.n) // (x.n::hugeint * y.n)
  from f3 join f2 x on (x.lang, x.w1, x.w2) = (f3.lang, f3.w1, f3.w2) join f1 y on (y.lang, y.w1) = (f3.lang, f3.w3)
), c3 as (select lang, phrase, a, l, r, score from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from (select * from c2 union all select * from c3))
select lang, rank::bigint rank, phrase, a::bigint a, l::bigint l, r::bigint r, (select sum(n) from f1 where f1.lang = ranked.lang)::bigint n, score::bigint score
from ranked where rank <= {most}
"""
