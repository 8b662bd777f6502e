import random

import corpus_pipeline
from dimforge.llm import decontaminate, near_dedup

DRAW = random.Random(9)
WORDS = "the and that with which from would there water house green light stone river field child day night over under".split()


def text(n):
    return " ".join(DRAW.choice(WORDS) + str(DRAW.randint(0, 99)).translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(n))


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "sentence_pieces"]


def test_run(spark, tmp_path):
    item = text(30)
    clean = [(i, f"{text(80)}\nabout this site", "en", f"s{i % 2}", 1) for i in range(40)]
    base = text(90)
    rows = clean + [(100 + i, base, "en", "s0", 1) for i in range(5)] + [(200, base + " more", "en", "s0", 1)]
    rows += [(300, f"{text(20)} {item} {text(20)}", "en", "s1", 1), (301, None, "en", "s1", 1), (302, "123 !!", "en", "s1", 1), (303, "", None, None, None), (0, clean[0][1], "en", "s0", 1), (None, "no id has the water", "en", "s0", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by = {r["doc_id"]: r for r in out}
    assert set(by) == {*range(40), 100, None} and len(out) == 42
    assert all("about this site" not in r["text"] for r in out) and by[1]["text"] == clean[1][1].split("\n")[0]
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in out) and by[1]["n_chars"] == len(by[1]["text"])
    assert list(out[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens", "round_trip"]


def test_each_stage_takes_an_empty_table_and_further_columns(spark, tmp_path):
    spark.createDataFrame([(1, text(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.createDataFrame([(i, text(30), "en", "s", 1, "k") for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long, part string")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame.limit(0), str(tmp_path)).collect() == []
        out = stage(spark, frame, str(tmp_path)).collect()
        assert len(out) == 6 and all(r["part"] == "k" for r in out), name


def test_columns_of_any_name_go_through_all_stages(spark, tmp_path):
    """A user's columns named like results of the operators come out as they went in."""
    own = {"score": 0.25, "lang_pred": "mine", "n_lines": 777, "n_dropped": 5, "kept": False, "component_id": 9, "similarity": 0.5, "IDS": "a", "n_tokens": 3, "round_trip": "no", "own_score": 1, "page_key": "p", "host_key": "h"}
    rows = [(i, f"{text(40)}\nabout this site", "en", f"s{i % 2}", 1, *own.values()) for i in range(12)] + [(50, "word " * 60_000 + "end", "en", "s1", 1, *own.values())]
    frame = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *own])
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, text(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert all({c: r[c] for c in own} == own for r in out.collect()), name
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) == 13
    for r in out:
        assert {c: r[c] for c in own} == own and r["_round_trip"] and r["_n_tokens"] == len(r["_ids"])
