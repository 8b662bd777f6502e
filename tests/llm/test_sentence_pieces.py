import random

import numpy as np
import pytest

from dimforge.llm import sentence_pieces as sp

reader = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    return reader.SentencePieceProcessor(model_file=sp.default_path())


@pytest.fixture(scope="module")
def model():
    return sp.Model(sp.default_path())


def test_equals_the_library_on_odd_texts(library, model):
    draw = random.Random(7)
    parts = ["a", "b", "e", "the", "ing", " ", "  ", "\n", "\t", "é", "ß", "🙂", "中", "1", "-", "=", "<s>", "</s>", "aaaa", "    ", " ", "."]
    pieces = list(model.usable)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 50))) for _ in range(3000)]
    texts += ["".join(draw.choice(pieces) for _ in range(5)).replace(sp.SPACE, " ") for _ in range(3000)]
    texts += ["a" * 300, "ab" * 400, " " * 40, " " * 40 + "x", "\n" * 5, "", "x" * 129 + "中" * 20]
    got = sp.Encoder(model).encode(texts)
    expected = library.encode(texts)
    assert [np.frombuffer(g, np.int32).tolist() for g in got] == expected
    assert [sp.decode(model, np.frombuffer(g, np.int32)) for g in got] == texts


def test_the_words_forgotten_are_segmented_again(monkeypatch, library, model):
    monkeypatch.setattr(sp, "REMEMBERED", 3)
    encoder = sp.Encoder(model)
    for text in ["one two three four", "five six one", "two two seven", "one two three four"]:
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == library.encode(text)


def test_unigram_takes_the_largest_sum(model):
    """With free transitions and other scores, against all segmentations."""
    import copy
    from itertools import product

    m = copy.copy(model)
    m.bpe, m.score = False, -np.abs(np.sin(np.arange(m.n + 1))) - 0.1
    encoder = sp.Encoder(m)
    for word in ["straße", "walking", "tions"]:
        best = max(
            (sum(m.score[m.usable[p]] for p in parts), parts)
            for cuts in product([0, 1], repeat=len(word) - 1)
            for parts in [_cut(word, cuts)]
            if all(p in m.usable for p in parts)
        )[1]
        encoder._learn({word})
        assert np.frombuffer(encoder.known[word], np.int32).tolist() == [m.usable[p] for p in best]
        assert [word[sum(s for _, s in encoder._one(word)[:i]) :][:size] for i, (_, size) in enumerate(encoder._one(word))] == best


def _cut(word, cuts):
    parts, start = [], 0
    for i, c in enumerate(cuts, 1):
        if c:
            parts.append(word[start:i])
            start = i
    return [*parts, word[start:]]


def test_frames(docs, library):
    long = "word " * 30_000
    rows = [(1, "Hello  world", "en", "a"), (1, "Hello  world", "en", "a"), (None, None, None, None), (2, "", "en", "a"), (3, long, "en", "a")]
    out = {(r["doc_id"], r["text"]): r for r in sp.encode(docs(rows)).collect()}
    assert out[1, "Hello  world"]["ids"] == library.encode("Hello  world")
    assert out[None, None]["ids"] == [] and out[2, ""]["n_tokens"] == 0
    assert out[3, long]["n_tokens"] == len(library.encode(long))
    assert out[1, "Hello  world"].asDict().keys() == {"doc_id", "text", "lang", "source", "ids", "n_tokens"}
    back = sp.decoded(sp.encode(docs(rows))).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back) and len(back) == 5
    assert all(r["round_trip"] for r in sp.round_trips(docs(rows)).collect())
    assert sp.encode_checked(docs([])).collect() == []
