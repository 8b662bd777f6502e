import random

import pytest

from dimforge.llm import token_counts as tc

library = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    return library.Tokenizer.from_file(tc.default_path())


def test_equals_the_library(reference):
    draw = random.Random(3)
    parts = ["a", "é", "é", "É", "İ", "Σ", "ΑΣ", " ", "\n", "1", "²", "½", "'s", "'S", "'re", "🙂", "中", "<|startoftext|>", "<|endoftext|>", "<|", "ing", "tion", "--", "_", "ﬁ"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(4000)] + ["", " \n", "a" * 5000, "ab" * 2000]
    counter = tc.Counter(tc.Vocabulary(tc.default_path()))
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in reference.encode_batch(texts, add_special_tokens=False)]


def test_forgetting_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(tc, "REMEMBERED", 2)
    counter = tc.Counter(tc.Vocabulary(tc.default_path()))
    for text in ["one two three", "four five one", "two six", "one two three"]:
        assert counter.count(text) == len(reference.encode(text, add_special_tokens=False).ids)


def test_frames(docs, reference):
    many = "word " * 3000
    rows = [(1, "Grüße <|endoftext|>", "de", "a"), (1, "Grüße <|endoftext|>", "de", "a"), (None, None, None, None), (2, "", "en", "a"), (3, many, "en", "a"), (4, " \n", "en", "a")]
    out = tc.count_tokens(docs(rows)).collect()
    assert len(out) == 6 and set(out[0].asDict()) == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    by = {r["doc_id"]: r for r in out}
    assert by[1]["n_bytes"] == len("Grüße <|endoftext|>".encode()) and by[1]["n_tokens"] == len(reference.encode("Grüße <|endoftext|>", add_special_tokens=False).ids)
    assert (by[None]["n_bytes"], by[None]["n_tokens"], by[2]["n_tokens"], by[4]["n_tokens"]) == (0, 0, 0, 0)
    assert by[3]["n_tokens"] == 3000 and by[3]["over_limit"] and not by[1]["over_limit"]
    assert tc.count_tokens(docs([])).collect() == []
