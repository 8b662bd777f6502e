import re
from collections import Counter

import pytest

from dimforge.llm import collocations
from dimforge.oracle_check import compare, duckdb_views

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mined(rows, least, percent, most):
    """(lang, text) rows by plain counting of every order."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, *words[i : i + k]] += 1
    out = {}
    for (lang, *p), a in f.items():
        if len(p) == 1 or a < least:
            continue
        if len(p) == 2:
            if any(len(q) == 4 and q[0] == lang and (q[1:3] == tuple(p) or q[2:4] == tuple(p)) and b >= least and 100 * b >= percent * a for q, b in f.items()):
                continue
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, *p[:k]], f[lang, *p[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    result = set()
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            result.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return result


def run(df, *args):
    got = [tuple(r) for r in collocations.mine(df, *args).collect()]
    assert len(got) == len(set(got))
    return set(got)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def test_odd_texts_equal_brute_force(spark):
    rows = [("en", "New York is New York, new york! A b c\nd e f"), (None, "a b c d a b c"), ("und", "a b c"), ("en", None), ("en", ""), ("en", " \t. ,"),
            ("de", "é É é É é É"), ("de", "x y x y z"), ("en", "new york is big. is big is big"), ("", "q q q q q")] * 2
    for least, percent, most in ((1, 50, 5000), (2, 50, 5), (3, 90, 10), (2, 1, 100)):
        assert run(frame(spark, rows), least, percent, most) == mined(rows, least, percent, most)


def test_random_texts_over_many_steps(spark, monkeypatch):
    import random

    draw = random.Random(2)
    monkeypatch.setattr(collocations, "STEP", 300)
    rows = [(draw.choice(["en", "de", None]), " ".join(draw.choice(["a", "b", "c", "d.", "E,", "zz", "ü"]) for _ in range(draw.randint(0, 60)))) for _ in range(120)]
    df = frame(spark, rows).repartition(5).withColumn("w1", collocations.F.lit(1)).withColumn("n", collocations.F.lit(2))
    assert run(df, 4, 50, 30) == mined(rows, 4, 50, 30)


def test_very_long_text_and_hot_phrase(spark):
    rows = [("en", "of the " * 150_000)] + [("en", "of the x.")] * 50
    assert run(frame(spark, rows), 10, 50, 2000) == mined(rows, 10, 50, 2000)


def test_empty_table(spark):
    assert run(frame(spark, [])) == set()


@pytest.mark.parametrize("sf", [SF])
def test_query_equals_sql(spark, sf):
    from dimforge.llm.queries import op13_collocations

    r = compare(spark, sf, "op13_collocations", op13_collocations, collocations.oracle_sql(), duckdb_views(sf))
    assert r["status"] == "MATCH", r
