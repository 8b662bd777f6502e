import random

import numpy as np

from dimforge.llm import decontaminate as dc

DRAW = random.Random(6)
VOCABULARY = ["".join(DRAW.choice("abcdefghijklmnopqrst") for _ in range(6)) for _ in range(3000)]


def words(n):
    return [DRAW.choice(VOCABULARY) for _ in range(n)]


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, similarity string")
    return d, spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, extra string")


def brute(docs, items):
    """Every place of every document against every item, by the operator's similarity."""
    index = dc.Index([(i, t) for i, t in items if t])
    found = set()
    for d, text in docs:
        hashes = dc._words([text or ""])[0]
        for k, item in enumerate(index.ids):
            n = len(index.words[k])
            if any(index.similarity(k, hashes[max(p, 0) : p + n]) >= dc.SIMILARITY for p in range(-n // 4, len(hashes)) if len(hashes[max(p, 0) : p + n])):
                found.add((d, item))
    return found


def test_all_passages_are_found(spark):
    items = [(k, " ".join(words(n))) for k, n in enumerate([2, 3, 5, 7, 8, 9, 12, 14, 16, 20, 24, 33, 40, 47, 60, 75, 90, 130])]
    docs = []
    for item, text in items:
        own = text.split()
        for edit in range(4):
            put = list(own)
            if edit == 1 and len(own) >= 24:
                put[DRAW.choice([0, 1, len(put) - 1])] = "changed"
            if edit == 2 and len(own) >= 40:
                put[len(put) // 2] = "changed"
            if edit == 3:
                put = [w.upper() + "&&&" for w in put]
            docs.append((len(docs), " ".join(words(DRAW.randint(0, 60)) + put + words(DRAW.randint(0, 60)))))
    docs += [(len(docs) + i, " ".join(words(200))) for i in range(10)]
    docs.append((5000, " ".join(items[12][1].split()[:20])))  # half an item
    got = {(r["doc_id"], r["item_id"]): r for r in dc.contaminated(*frames(spark, docs, items)).collect()}
    expected = brute(docs, items)
    assert set(got) == expected and all((d, d // 4) in expected for d in range(4 * len(items)))
    for (d, item), r in got.items():
        if d == 4 * item:
            at = docs[d][1].split()
            n = len(items[item][1].split())
            assert at[r["first_word"] : r["first_word"] + n] == items[item][1].split() and r["similarity"] == 1.0


def test_window_sizes_fit_an_untouched_run():
    for n in range(8, 500):
        lacking = int(max(1, n - 4) / 7)
        for size, step in dc.window_sizes(n):
            assert size + step - 1 <= n and size % step == 0
        assert dc.window_sizes(n)[0][0] + dc.window_sizes(n)[0][1] - 1 <= n - min(lacking, 5) or dc.window_sizes(n)[0][1] == 1


def test_simhash_of_windows():
    hashes = np.arange(50, dtype=np.uint64) * np.uint64(977)
    bits = dc._Bits(hashes)
    got = bits.windows(8, 4)
    raw = np.unpackbits(dc.mix(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    for k in range(len(got)):
        expected = np.packbits(raw[4 * k : 4 * k + 8].sum(axis=0) > 4).view(np.uint64)[0]
        assert got[k] == expected
    assert len(got) == 11


def test_odd_rows(spark):
    passage = " ".join(words(30))
    docs = [(1, passage), (1, passage), (None, passage), (2, None), (3, ""), (4, "w " * 60_000 + passage)]
    items = [(10, passage), (11, passage), (12, None), (13, ""), (None, "...")]
    got = sorted((str(r["doc_id"]), r["item_id"]) for r in dc.contaminated(*frames(spark, docs, items)).collect())
    assert got == sorted((d, i) for d in ["1", "1", "None", "4"] for i in [10, 11])
    left = dc.without_contaminated(*frames(spark, docs, items)).collect()
    assert sorted(r["doc_id"] for r in left) == [2, 3] and left[0]["similarity"] == "x"
    assert dc.contaminated(*frames(spark, [], items)).collect() == []
    assert dc.contaminated(*frames(spark, docs, [])).collect() == []


def test_several_passes_find_the_same(spark, monkeypatch):
    items = [(k, " ".join(words(20))) for k in range(9)]
    docs = [(k, " ".join(words(10)) + " " + items[k][1]) for k in range(9)]
    monkeypatch.setattr(dc, "PASS_WORDS", 40)
    assert sorted((r["doc_id"], r["item_id"]) for r in dc.contaminated(*frames(spark, docs, items)).collect()) == [(k, k) for k in range(9)]
    assert dc.without_contaminated(*frames(spark, docs, items)).collect() == []


def test_repeated_and_overlapping_items_bear_an_edit(spark, monkeypatch):
    """An item that stands often, and items that share a passage, are found with one changed
    word; the passes that the benchmark is cut into change nothing."""
    often, text = " ".join(words(60)), " ".join(words(60))
    items = [(k, often) for k in range(50)] + [(100 + k, text + " " + " ".join(words(12))) for k in range(10)]
    changed = [*often.split()[:30], "changed", *often.split()[31:]]
    docs = [(0, " ".join(words(7) + changed + words(9)))]
    for k, (_, item) in enumerate(items[50:]):
        own = item.split()
        docs.append((1 + k, " ".join(words(5) + own[:20] + ["changed"] + own[21:] + words(5))))
    expected = [(0, k) for k in range(50)] + [(1 + k, 100 + k) for k in range(10)]
    found = {}
    for limit in (dc.PASS_WORDS, 300):
        monkeypatch.setattr(dc, "PASS_WORDS", limit)
        found[limit] = sorted(tuple(r) for r in dc.contaminated(*frames(spark, docs, items)).collect())
    assert [f[:2] for f in found[300]] == expected and found[300] == found[dc.PASS_WORDS] == found[2_000_000]


def test_items_cut_at_a_border_are_found_in_every_alignment(spark):
    """Three quarters of an item that make up, begin or end a document, after words of other
    documents that shift them: found as brute force finds them, in any batch."""
    items = [(k, " ".join(words(n))) for k, n in enumerate([30, 31, 33, 35, 36, 37, 38, 50, 80])]
    docs = []
    for _, text in items:
        own = text.split()
        most = (len(own) - 4) // 4
        for head in (0, most, most // 2):
            kept = own[head : len(own) - (most - head)]
            for shift in range(4):
                rest = words(20 + shift)
                whole = [kept] + [kept + rest] * (head > 0) + [rest + kept] * (head < most)
                docs += [(len(docs) + i, " ".join(x)) for i, x in enumerate(whole)]
                docs.append((len(docs), " ".join(words(1 + shift))))
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    index = dc.Index(items)
    got = {(r, i) for r, i, *_ in dc._search(index, [t for _, t in docs])}
    alone = {(r, i) for r, (_, t) in enumerate(docs) for _, i, *_ in dc._search(index, [t])}
    assert got == alone == brute(docs, items) and len(got) >= 9 * 3 * 4


def plain_similarity(item, window, items):
    """Weighted shingle similarity from its definition, on words."""
    def shingles(w):
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    by = [shingles(t) for t in {tuple(t) for t in items}]
    own, other = shingles(item), shingles(window)
    weight = {x: 1 / sum(x in o for o in by) for x in own}
    mean = sum(weight.values()) / len(own)
    both = sum(weight[x] for x in own & other)
    return both / (sum(weight.values()) + mean * len(other - own))


def test_equals_plain_python_on_words(spark):
    """Every place of every document, by words and sets alone: nothing of the operator's."""
    draw = random.Random(11)
    base = [words(n) for n in (6, 11, 19, 30, 45)]
    items = [*base, base[3][:20] + words(10), ["again"] * 12, ["to", "and"] * 9]
    docs = []
    for item in items:
        for edits in range(4):
            put = list(item)
            for _ in range(edits):
                put[draw.randrange(len(put))] = draw.choice(VOCABULARY)
            docs.append(words(draw.randint(0, 9)) + put + words(draw.randint(0, 9)))
    docs += [["again"] * 40, ["to", "and"] * 30, words(80), base[4][:36], base[4][12:]]
    expected = set()
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            n = len(item)
            if any(plain_similarity(item, doc[max(p, 0) : p + n], items) >= 0.75 - 1e-12 for p in range(-n // 4, len(doc)) if doc[max(p, 0) : p + n]):
                expected.add((d, i))
    got = dc.contaminated(*frames(spark, [(d, " ".join(t)) for d, t in enumerate(docs)], [(i, " ".join(t)) for i, t in enumerate(items)])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected


def test_repetitive_text_takes_little_memory():
    """An item of 300 equal words against a megabyte of them, and one of two words in turn."""
    import resource
    import time

    index = dc.Index([(1, "same " * 300), (2, "one two " * 200), (3, " ".join(words(40)))])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    start = time.process_time()
    found = dc._search(index, ["same " * 200_000 + "one two " * 30_000])
    assert {i for _, i, _, _ in found} == {1, 2} and all(s == 1.0 for *_, s in found)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 500
    assert time.process_time() - start < 120
