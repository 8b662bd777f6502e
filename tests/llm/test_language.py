import random
import zlib

from dimforge.llm import language as lg

WORDS = {
    "en": "the and that with which from would there their water house green light stone".split(),
    "de": "und der die das nicht eine werden schließlich über müssen zwischen straße".split(),
    "fr": "les des une dans pour être même où elle sont aussi très forêt".split(),
    "es": "los las una para está niño también donde cuando señor mañana año".split(),
}


def corpus(n=400):
    draw = random.Random(8)
    rows = []
    for i in range(n):
        lang = list(WORDS)[i % 4]
        rows.append((i, " ".join(draw.choice(WORDS[lang]) for _ in range(20)), lang, "s"))
    return rows


def test_held_out_accuracy_and_no_leak(spark, docs):
    rows = corpus()
    out = {r["doc_id"]: r for r in lg.identify(docs(rows)).collect()}
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(out[i]["held_out"] == (i in held) for i, *_ in rows)
    assert all(out[i]["lang_pred"] == lang for i, _, lang, _ in rows if i in held)
    assert all(0 <= r["score"] <= 1 for r in out.values())
    wrong = [(i, t, "en" if i in held else lang, s) for i, t, lang, s in rows]
    again = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lg.identify(docs(wrong)).collect()}
    assert all(again[i] == (out[i]["lang_pred"], out[i]["score"]) for i in again)


def test_odd_rows(docs):
    rows = corpus(80) + [(900, None, "en", "s"), (901, "", "fr", "s"), (902, "123 ... !", None, "s"), (None, "und der die das nicht", None, None), (903, "the water " * 30_000, None, "s"), (904, "THE WATER HOUSE with that", None, "s"), (904, "THE WATER HOUSE with that", None, "s")]
    out = lg.identify(docs(rows)).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (900, 901, 902))
    assert by[None]["lang_pred"] == "de" and not by[None]["held_out"] and by[903]["lang_pred"] == by[904]["lang_pred"] == "en"
    assert lg.identify(docs([])).collect() == []
    assert {r["lang_pred"] for r in lg.identify(docs([(1, "abc", None, "s")])).collect()} == {"und"}
    assert {r["lang_pred"] for r in lg.identify(docs([(i, "abc", "xx", "s") for i in range(20)])).collect()} == {"xx"}


def test_label_keeps_other_columns(docs):
    out = lg.label(docs(corpus(40))).first().asDict()
    assert out["n_tokens"] == "kept" and out["source"] == "s" and out["lang_pred"] == out["lang"]


def test_a_block_holds_little_besides_its_features():
    import tracemalloc

    rows = ["some ordinary words that go on and on, "[: 7 + i % 32] * 100 for i in range(lg.BLOCK)]
    lg.features(rows[:1])
    tracemalloc.start()
    x, _ = lg.features(rows)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < x.nbytes + 20_000_000
    assert all((lg.features([t])[0][0] == v).all() for t, v in zip(rows[::51], x[::51]))
