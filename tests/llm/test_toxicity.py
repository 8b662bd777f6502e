import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa

from dimforge.llm import toxicity as tx

GOOD = "the river runs past old houses and green fields where children play every day with stones".split()
BAD = ["idiot", "moron", "scum"]


def corpus(n=600):
    draw = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [draw.choice(GOOD) for _ in range(draw.randint(30, 60))]
        for _ in range(draw.randint(3, 6) if toxic else 0):
            words[draw.randrange(len(words))] = draw.choice(BAD)
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic), "x"))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels = corpus()
    out = {r["doc_id"]: r for r in tx.score(*frames(spark, docs, labels)).collect()}
    held = [i for i, _, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i]["held_out"] == (i in set(held)) for i, _, _ in docs)
    assert sum(out[i]["predicted"] == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    # other labels of held-out rows change nothing
    turned = [(i, 1 - t if i in set(held) else t, x) for i, t, x in labels]
    again = {r["doc_id"]: r["score"] for r in tx.score(*frames(spark, docs, turned)).collect()}
    assert all(abs(again[i] - out[i]["score"]) < 1e-9 for i in again)


def test_odd_rows(spark):
    docs, labels = corpus(200)
    docs += [(900, None, "x"), (901, "", "x"), (902, "123 !!", "x"), (None, "idiot moron scum", "x"), (903, "idiot " * 50_000, "x"), (0, docs[0][1], "x")]
    labels += [(900, 1, "x"), (None, 1, "x"), (5, None, "x"), (99999, 1, "x"), (1, 0, "x"), (1, 0, "x")]
    out = tx.score(*frames(spark, docs, labels)).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[900]["score"] == by[901]["score"] == by[902]["score"] and not by[None]["held_out"]
    assert by[903]["predicted"] == 1
    empty = tx.score(*frames(spark, docs[:3], [])).collect()
    assert [r["score"] for r in empty] == [0.5] * 3
    assert tx.score(*frames(spark, [], labels)).collect() == []


def brute_evidence(seen):
    """Kneser-Ney by its definition; seen: {gram: (toxic, ordinary)}."""
    from math import log

    d = tx.DISCOUNT

    def shared(h, x):
        # of grams one symbol longer: how many different ones end in h + x
        def k(g):
            longer = {s[-len(g) - 1 :] for s in seen if len(s) > len(g)}
            return sum(1 for s in longer if s[1:] == g)

        letters = {s[-1] for s in seen}
        counts = {y: k(h + y) for y in letters if k(h + y)}
        total = sum(counts.values())
        lower = shared(h[1:], x) if h else 1 / (len({s[-1] for s in seen}) + 1)
        return (max(counts.get(x, 0) - d, 0) + d * len(counts) * lower) / total if total else lower

    def p(c, h, x):
        counts = {s[-1]: v[c] for s, v in seen.items() if s[:-1] == h and v[c]}
        lower = shared(h[1:], x)
        if not counts:
            return lower
        total = sum(counts.values())
        return (max(counts.get(x, 0) - d, 0) + d * len(counts) * lower) / total

    return lambda s: log(p(0, s[:-1], s[-1]) / p(1, s[:-1], s[-1]))


def test_evidence_is_kneser_ney_by_definition(spark):
    toxic = ["you are an idiot", "what an idiot you are", "go home you fool", "fool"]
    good = ["you are an angel", "what a day 漢字", "go home and rest you two", "rest at home", "an idiom paints"]

    def cut(word):
        whole = "\0" * (tx.ORDER - 1) + word + "\0"
        return [whole[i : i + tx.ORDER] for i in range(len(word) + 1)]

    seen = {}
    for c, texts in enumerate([toxic, good]):
        for g in (g for t in texts for w in tx._find(t) for g in cut(w)):
            seen.setdefault(g, [0, 0])[c] += 1
    counts = spark.createDataFrame([(g, *v) for g, v in seen.items()], "gram string, toxic long, ordinary long")
    texts = toxic + good + ["an unseen idiocy foolish", "zzz", "home " * 70_000, "you You YOU, fool!", "字", "x1y " + "f" * 150]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", "!", None, *texts])], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["evidence"] for r in tx._evidence(docs, tx._model(counts, "toxic", "ordinary")).collect()}
    value = brute_evidence(seen)
    of_word = {}
    for i, t in enumerate(texts):
        words = [w[k : k + 64] for w in tx._find(t.lower()) for k in range(0, len(w), 64)]
        for w in set(words) - of_word.keys():
            # a symbol no class has seen has the contexts' evidence alone
            of_word[w] = sum(map(value, cut(w)))
        assert abs(got[i] - sum(of_word[w] for w in words) / sum(len(w) + 1 for w in words)) < 1e-6, t[:80]
        assert got[i] == got[len(texts) + 3 + i]
    assert got[len(texts)] == got[len(texts) + 1] == got[len(texts) + 2] == 0.0


def test_pieces_cut_no_word(monkeypatch):
    text = "Alpha beta, GAMMA 漢字 delta9 x" * 5
    whole = tx._find(text.lower())
    for size in (1, 2, 7, 20):
        monkeypatch.setattr(tx, "PIECE", size)
        assert [w for p in tx._pieces(text) for w in tx._find(p)] == whole


def test_small_blocks_give_the_same_scores(spark, monkeypatch):
    docs, labels = corpus(150)
    docs += [(1000 + i, t, x) for i, t, x in docs[:20]]
    before = {r["doc_id"]: r["score"] for r in tx.score(*frames(spark, docs, labels)).collect()}
    monkeypatch.setattr(tx, "BLOCK_CHARS", 500)
    monkeypatch.setattr(tx, "TEXTS_A_ROW", 8)
    monkeypatch.setattr(tx, "WORDS_A_BUCKET", 7)
    assert before == {r["doc_id"]: r["score"] for r in tx.score(*frames(spark, docs, labels)).collect()}
    assert all(before[i] == before[1000 + i] for i in range(20))


def test_words_outside_latin_and_long_ones():
    assert tx._words("漢字 abc1 ไทย 123") == ["漢", "字", "abc1", "ไ", "ท", "ย"]
    assert tx._words("a" * 130) == ["a" * 64, "a" * 64, "aa"]


def test_head_words_are_asked_by_no_block(spark):
    rows = spark.createDataFrame([(f"the river {i} the w{'abcdefgh'[i]}x", i, i) for i in range(8)], "text string, key1 long, key2 long").coalesce(1)
    head, values = {"the": 0, "river": 1}, np.array([[5, 7], [-2, 3]])
    out = rows.mapInArrow(lambda batches: tx._asked(batches, head, values), "word string, block long, found binary").collect()
    assert sorted(r["word"] for r in out if not r["word"].startswith(tx.ANY)) == [f"w{c}x" for c in "abcdefgh"]
    texts = np.concatenate([np.frombuffer(r["found"], np.int64).reshape(-1, 6) for r in out if r["word"].startswith(tx.ANY)])
    # text, symbols, keys, and the head's sums under both models
    assert [(n, *sums) for _, n, _, _, *sums in texts.tolist()] == [(18, 17, -1)] * 8


def test_any_head_gives_the_same_scores(spark, monkeypatch):
    docs, labels = corpus(150)
    docs += [(1000 + i, f"{t} rare{'abcdefghij'[i]} idiocy", x) for i, t, x in docs[:10]]
    scores = []
    for n in (400_000, 0, 9):
        monkeypatch.setattr(tx, "HEAD_WORDS", n)
        scores.append({r["doc_id"]: r["score"] for r in tx.score(*frames(spark, docs, labels)).collect()})
    assert scores[0] == scores[1] == scores[2]


def test_a_block_keeps_no_texts(monkeypatch):
    class Context:
        get = classmethod(lambda cls: cls)
        partitionId = classmethod(lambda cls: 3)

    monkeypatch.setattr(tx, "TaskContext", Context)

    def batches(*columns):
        for i in range(40):
            texts = [f"row {i} {j} " + " ".join(GOOD[(i + j + k) % len(GOOD)] for k in range(180)) for j in range(100)]
            yield pa.RecordBatch.from_arrays([pa.array(texts), *[pa.array(c(np.arange(100) + 100 * i)) for c in columns]], ["text", "a", "b"])

    counted = tx._counted, (lambda k: k % 2 == 0, lambda k: k % 3 == 0), ()
    asked = tx._asked, (lambda k: k, lambda k: k), ({"the": 0, "river": 1}, np.array([[5, 7]]))
    for work, columns, more in (counted, asked):
        tracemalloc.start()
        n = sum(b.num_rows for b in work(batches(*columns), *more))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # 4,000 texts of 1,000 characters are one block: 4 MB of text, 720,000 words
        assert n and peak < 16 << 20, (work.__name__, peak)
