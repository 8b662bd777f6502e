from dimforge.llm import line_dedup as ld


def test_against_sql(spark, docs):
    import duckdb

    rows = [(i, f"page {i}\nshared by the host\n\nmenu {i % 3}\nshared by the host", "en", "a" if i % 2 else "b") for i in range(40)]
    rows += [(100 + i, "copied page\nwith its own line", "en", "a") for i in range(30)]  # copies are no boilerplate
    rows += [(200, None, "en", "a"), (201, "", "en", "a"), (202, "shared by the host", "en", None), (203, "shared by the host", "en", "c")]
    rows += [(300 + i, f"lonely {i}\nnull host line", "en", None) for i in range(6)]
    rows += [(0, rows[0][1], "en", "b"), (None, rows[1][1], "en", "a"), (400, "long line " * 30_000 + "\nshared by the host", "en", "a")]
    frame = docs(rows)
    got = ld.drop_boilerplate(frame, ratio=0.2).select("doc_id", "text", "n_lines", "n_dropped").collect()
    documents = frame.select("doc_id", "text", "source").toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    expected = duckdb.sql(ld.oracle_sql(ratio=0.2)).fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["text"] == "page 1\n" and by[1]["n_dropped"] == 3 and by[1]["n_lines"] == 5
    assert by[100]["text"] == "copied page\nwith its own line" and by[203]["text"] == "shared by the host"
    assert by[200]["text"] is None and by[201]["text"] == "" and by[300]["text"] == "lonely 0"


def test_hot_lines_meet_as_counts_only(spark, docs):
    plan = ld.drop_boilerplate(docs([(i, f"x{i}\ny", "en", "a") for i in range(50)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan


def test_columns_and_empty_table(spark):
    frame = spark.createDataFrame([(i, f"own {i}\nall pages", "h", 7, "k") for i in range(20)], "doc_id long, text string, source string, n_lines int, page_key string")
    out = ld.drop_boilerplate(frame)
    assert out.columns == ["doc_id", "text", "source", "page_key", "n_lines", "n_dropped"]
    row = out.first()
    assert row["page_key"] == "k" and row["n_lines"] == 2 and row["text"].startswith("own")
    assert ld.drop_boilerplate(frame.limit(0)).collect() == []


def test_planted_lines_on_a_small_share_of_a_large_host(spark, docs):
    """A sentence on 8 and a paragraph on 5 of 6,000 pages go; lines of the pages' own, and a
    word on 30 of them, stay."""
    sentence = "This work may be copied under the terms of its license, version 3."
    paragraph = " ".join(f"word{i}" for i in range(60))
    rows = []
    for i in range(6000):
        text = f"page {i} of the host\nnumber {i} has its own words here"
        text += f"\n{sentence}" if i % 750 == 0 else f"\n{paragraph}" if i % 1200 == 1 else "\nNext" if i % 200 == 2 else ""
        rows.append((i, text, "en", "large"))
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in ld.drop_boilerplate(docs(rows)).select("doc_id", "text", "n_dropped").collect()}
    for i, text, _, _ in rows:
        planted = i % 750 == 0 or i % 1200 == 1
        assert got[i] == ((text.rsplit("\n", 1)[0], 1) if planted else (text, 0)), i
