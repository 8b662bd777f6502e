"""Language identification in two levels: first the family, then the language within it.

Every text becomes frequencies of hashed character n-grams.  Linear support vector machines,
one against one, choose the family; others, one against one within it, choose the language.
The machines are fitted on a bounded sample of labelled rows, each in a task of its own; every
row is then scored with whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, held_out, mix, steps, texts

#: Buckets of hashed n-grams.
DIM = 4096
ORDERS = (1, 2, 3)
#: The bound of the sample: so many labelled rows of each language are learned from.
SAMPLE = 300
#: Languages that a run can learn; more is an error, as the models would be no small side.
MAX_LANGUAGES = 200
#: Rows whose features are held at once: 8 MB of them.
BLOCK = 256
#: Characters whose n-grams are counted at once.
UNITS = 1 << 16
EPOCHS, PENALTY = 30, 10.0

#: The usual families; a language not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic", "is": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance", "gl": "romance",
    "ru": "slavic", "uk": "slavic", "be": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic", "sr": "slavic", "hr": "slavic",
    "hi": "indic", "mr": "indic", "ne": "indic", "ar": "arabic", "fa": "iranian", "ur": "indic", "fi": "uralic", "et": "uralic", "hu": "uralic",
}

UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def features(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, DIM) square roots of n-gram frequencies, so each row has length 1; and whether
    a row has a letter (rows without are 0).  Case doesn't count, and all that isn't a letter
    counts as a space.  Some rows' n-grams are counted at a time, of UNITS characters or one
    row's: what is held besides the result is bounded by that."""
    low = [t.lower() for t in rows]
    before = np.append(0, np.cumsum(np.fromiter(map(len, low), np.int64, len(low))))
    counts = np.zeros((len(rows), DIM))
    first = 0
    while first < len(low):
        last = max(int(np.searchsorted(before, before[first] + UNITS, "right")) - 1, first + 1)
        _count(low[first:last], counts[first:last].reshape(-1))
        first = last
    totals = counts.sum(axis=1, keepdims=True)
    has = totals[:, 0] > 0
    counts /= np.maximum(totals, 1)
    return np.sqrt(counts, out=counts), has


def _count(low: list[str], counts: np.ndarray) -> None:
    """Add the rows' n-grams to ``counts``, DIM for each row."""
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    units = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[units]
    units = np.where(letter, units, 0).astype(U64)
    row = np.repeat(np.arange(len(low)), sizes)
    gram = np.zeros(len(units), U64)
    any_letter = np.zeros(len(units), bool)
    for order in range(1, max(ORDERS) + 1):
        n = len(units) - order + 1
        if n <= 0:
            break
        gram = gram[:n] * U64(0x110000) + units[order - 1 :]
        any_letter = any_letter[:n] | letter[order - 1 :]
        if order in ORDERS:
            use = any_letter & (row[:n] == row[order - 1 :])
            bucket = mix(gram[use] + U64(order << 60)) >> U64(64 - DIM.bit_length() + 1)
            counts += np.bincount(row[:n][use] * DIM + bucket.astype(np.int64), minlength=len(counts))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text", rows=BLOCK):
            x, has = features(texts(part, "text"))
            rows = pa.array([v.tobytes() for v in x.astype(np.float32)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), rows], ["label", "x"]).filter(pa.array(has))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A linear support vector machine (squared hinge loss, bias as a constant feature) by
    dual coordinate descent; y is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    norm = (x * x).sum(axis=1) + 0.5 / PENALTY
    draw = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in draw.permutation(len(x)):
            step = max(alpha[i] - (y[i] * (w @ x[i]) - 1 + alpha[i] * 0.5 / PENALTY) / norm[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
    return w


def _fit_group(rows: pd.DataFrame) -> pd.DataFrame:
    # The bounded sample of two sides: 2 * SAMPLE rows of a language pair, or of a family
    # pair, whose sample is dealt over the family's languages.
    rows = rows.sort_values(["side", "x"])
    x = np.vstack([np.frombuffer(b, np.float32) for b in rows["x"]]).astype(float)
    w = fit(x, rows["side"].to_numpy(float))
    return pd.DataFrame({"model": [rows["model"].iloc[0]], "w": [w.astype(np.float32).tobytes()]})


def train(labelled: DataFrame) -> dict:
    """Models from (doc_id, text, lang).  What comes to the driver is a count for each
    language and the weights; MAX_LANGUAGES bounds both."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    family = {x: FAMILIES.get(x, x) for x in counts}
    members: dict[str, list[str]] = {}
    for x in sorted(family):
        members.setdefault(family[x], []).append(x)
    models = [("family", a, b) for a, b in combinations(sorted(members), 2)]
    models += [("language", a, b) for group in members.values() for a, b in combinations(group, 2)]
    known = {"languages": sorted(counts), "members": members, "models": models, "w": np.zeros((len(models), DIM + 1), np.float32)}
    if not models:
        return known
    # A row's place by a hash of its id: about twice the sample is read in full, and the
    # smallest of each language are taken.
    spark = labelled.sparkSession
    share = spark.createDataFrame([(x, min(1.0, 2 * SAMPLE / n + 20 / n)) for x, n in counts.items()], "lang string, share double")
    place = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 31)) / float(1 << 31)
    near = labelled.withColumn("place", place).join(F.broadcast(share), "lang").filter("place < share")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))).filter(F.col("rank") <= SAMPLE)
    uses = []  # (language, rank limit, model number, side)
    for i, (level, a, b) in enumerate(models):
        for name, side in ((a, 1.0), (b, -1.0)):
            group = members[name] if level == "family" else [name]
            uses += [(x, -(-SAMPLE // len(group)), i, side) for x in group]
    uses = spark.createDataFrame(uses, "label string, most int, model int, side double")
    # The label goes through the features step with its rank.
    label = F.concat_ws("\t", F.col("rank").cast("string"), "lang")
    vectors = ranked.select(label.alias("label"), "text").mapInArrow(_features_of, "label string, x binary")
    vectors = vectors.select(F.expr("substring(label, instr(label, '\t') + 1)").alias("label"), F.substring_index("label", "\t", 1).cast("int").alias("rank"), "x")
    dealt = vectors.join(F.broadcast(uses), "label").filter("rank <= most").select("model", "side", "x")
    for r in dealt.groupBy("model").applyInPandas(_fit_group, "model int, w binary").collect():
        known["w"][r["model"]] = np.frombuffer(r["w"], np.float32)
    return known


def predict(known: dict, rows: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.  At either level the candidate with most won
    comparisons is taken, ties by the sum of margins; the score is the product of both
    levels' logistic smallest margins of the winner."""
    x, has = features(rows)
    margins = x.astype(np.float32) @ known["w"][:, :-1].T + known["w"][:, -1]
    langs, score = [UNKNOWN] * len(rows), np.zeros(len(rows))
    if not known["languages"]:
        return langs, score

    def decide(level: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        won, total, least = (np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names))), np.full((len(rows), len(names)), np.inf))
        for i, (kind, a, b) in enumerate(known["models"]):
            if kind == level and a in names:
                for name, m in ((a, margins[:, i]), (b, -margins[:, i])):
                    k = names.index(name)
                    won[:, k] += m > 0
                    total[:, k] += m
                    least[:, k] = np.minimum(least[:, k], m)
        best = np.lexsort((total.T, won.T), axis=0)[-1] if len(names) > 1 else np.zeros(len(rows), int)
        return best, 1 / (1 + np.exp(-3 * np.clip(least[np.arange(len(rows)), best], -20, 20)))

    families = sorted(known["members"])
    which, sure = decide("family", families)
    for k, name in enumerate(families):
        best, more = decide("language", known["members"][name])
        for i in np.flatnonzero((which == k) & has):
            langs[i], score[i] = known["members"][name][best[i]], sure[i] * more[i]
    return langs, score


def _known(docs: DataFrame, id_col: str, text_col: str, lang_col: str):
    """The broadcast models that the rows to learn from give."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return docs.sparkSession.sparkContext.broadcast(train(rows))


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced), as identify()
    says."""
    known = _known(docs, id_col, text_col, lang_col)
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text_col, rows=BLOCK):
                langs, score = predict(known.value, texts(part, text_col))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(score)], schema.names)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score.  Rows whose crc32(doc_id) mod 5 is 0 are
    never learned from.

    Defined cases: a text that is null or has no letter gets ``und`` and score 0, and so does
    every row if no row has a language to learn.  With one learned language every text with a
    letter gets it.  Rows with null lang or null text teach nothing.  A null id is not held
    out.  Repeated rows get equal results; further columns are not looked at; an empty table
    gives no rows."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return label(known).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
