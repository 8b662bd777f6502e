import random
import re
from collections import defaultdict

import numpy as np

from dimforge.llm import near_dedup as nd
from dimforge.llm.components import components


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    home = {i: i for i in sets}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    home[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def run(spark, rows):
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    return nd.near_duplicates(frame).collect()


def changed(draw, words, n, vocabulary):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = draw.choice(vocabulary)
    return words


def test_against_all_pairs(spark):
    draw = random.Random(11)
    vocabulary = ["".join(draw.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(400)]
    rows = []
    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([3, 5, 7, 9, 30, 120, 300]))]
        for _ in range(draw.randint(1, 14)):
            rows.append(" ".join(changed(draw, base, draw.randint(0, max(1, len(base) // 25)), vocabulary)))
    passage = " ".join(draw.choice(vocabulary) for _ in range(60))
    rows += [passage + " " + " ".join(draw.choice(vocabulary) for _ in range(draw.randint(5, 80))) for _ in range(25)]
    rows += [rows[0].upper(), rows[0].replace(" ", "\n\t"), "É é", "é É", "  ", "one two three four"]
    draw.shuffle(rows)
    rows = [(3 * i + 1, t) for i, t in enumerate(rows)]
    expected = brute(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, rows)}
    assert got == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in run(spark, rows))


def test_loosely_similar_group_loses_no_link(spark):
    """A large group around one text, many of it just below the threshold: what the stars leave
    open is settled exactly."""
    draw = random.Random(12)
    vocabulary = ["".join(draw.choice("qrstuvwxyz") for _ in range(6)) for _ in range(5000)]
    base = [draw.choice(vocabulary) for _ in range(150)]
    rows = [(i, " ".join(changed(draw, base, draw.randint(0, 9), vocabulary))) for i in range(150)]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, rows)} == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f"), (1, None), (2, ""), (3, " \n "), (None, "a b c d e f"), (None, None), (7, long), (8, long + " more"), (4, "only four words here")]
    out = run(spark, rows)
    assert len(out) == len(rows)
    by = defaultdict(set)
    for r in out:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[5] == {(2, 5, True)} and by[9] == {(2, 5, False)}
    assert by[1] == {(0, 1, True)} and by[2] == {(0, 2, True)} and by[3] == {(0, 3, True)} and by[4] == {(1, 4, True)}
    assert by[None] == {(2, None, True), (0, None, True)} and by[7] == {(39996, 7, True)} and by[8] == {(39997, 7, False)}
    assert run(spark, []) == []


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(3)
    for size, similar in [(2000, 0.9), (2000, 0.5), (40, 0.8), (300, 0.75)]:
        common = round(size * similar)
        pool = draw.integers(0, 1 << 63, 2 * size - common).astype(np.uint64)
        a, b = np.sort(pool[:size]), np.sort(pool[size - common :])
        sketch = nd.sketches(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 2)
        true = common / (2 * size - common)
        assert abs(nd.estimate(sketch[:1], sketch[1:])[0] - true) < 0.1


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 150, 150: 150}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_short_text_alone_in_a_step(spark):
    """1 to 5 words that share their step with no other text."""
    for n in range(1, 6):
        text = " ".join("abcde"[:n])
        data = np.frombuffer(text.encode(), np.uint8)
        assert len(nd.shingle_sets(data, np.array([0, len(data)]))[0]) == 1
    got = run(spark, [(1, "two words")])
    assert [r["doc_id"] for r in got] == [1]
    rows = [(1, "now three words"), (2, "long text of words " * 70_000), (3, "now three words")]
    assert sorted(r["doc_id"] for r in run(spark, rows)) == [1, 2, 3]
