import hashlib
import random

import numpy as np

from dimforge.llm import fingerprints as fp
from dimforge.llm.common import substring_hashes


def brute(text):
    if not text:
        return []
    units = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = max(1, len(text) - fp.GRAM + 1)
    h = [int(substring_hashes(units, np.array([i]), np.array([min(i + fp.GRAM, len(text))]))[0]) >> 24 for i in range(n)]
    out = []
    for a in range(max(1, n - fp.WINDOW + 1)):
        m = min(range(a, min(a + fp.WINDOW, n)), key=lambda i: (h[i], -i))
        if not out or out[-1] != (h[m], m):
            out.append((h[m], m))
    return out


def test_winnowing_and_its_guarantee():
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab é") for _ in range(draw.choice([0, 1, 15, 16, 17, 46, 47, 48, 200]))) for _ in range(80)] + ["a" * 300, "", "ab" * 100]
    row, h, at = fp.winnow(texts)
    for i, t in enumerate(texts):
        assert list(zip(h[row == i].tolist(), at[row == i].tolist())) == brute(t)
    shared = "".join(draw.choice("abcdefgh ") for _ in range(fp.GRAM + fp.WINDOW - 1))
    row, h, _ = fp.winnow(["x" * 70 + shared + "yz" * 40, "q" * 33 + shared])
    assert set(h[row == 0]) & set(h[row == 1])
    assert fp.winnow([])[0].size == 0


def test_edited_texts(spark):
    draw = random.Random(2)
    rows = [(i * 7 % 101, "".join(draw.choice("abcdefghij ") for _ in range(draw.randint(0, 400))), "x") for i in range(101)]
    rows += [(None, None, "x"), (5000, "é🙂" * 100, "x"), (5000, "a tie", "x"), (6000, "z" * 150_000, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(7)
    out = fp.edited_texts(frame).collect()
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out), key=key) == sorted(expected, key=key)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    assert fp.edited_texts(frame.limit(0)).collect() == []
    one = fp.edited_texts(frame.filter("doc_id = 6000")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_equal_texts_have_equal_fingerprints(docs):
    text = "some text that is long enough to have a few windows of its own, and more of it " * 3
    out = fp.fingerprints(docs([(1, text, None, None), (2, "other " * 30, None, None), (3, text, None, None), (4, None, None, None), (5, "", None, None)])).collect()
    by = {r["doc_id"]: (r["hashes"], r["positions"]) for r in out}
    assert by[1] == by[3] != by[2] and by[4] == by[5] == ([], []) and len(by[1][0]) == len(by[1][1]) > 1
