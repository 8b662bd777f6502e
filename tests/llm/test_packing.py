import itertools
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from dimforge.llm import packing

MODEL = path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


def counts(sizes, capacity):
    return np.bincount(np.array(sizes, np.int64), minlength=capacity + 1)


def fewest(sizes, capacity):
    """The least number of sequences, by trying."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= sizes[k] and rooms[i] not in rooms[:i]:
                go(k + 1, rooms[:i] + [rooms[i] - sizes[k]] + rooms[i + 1 :])
        go(k + 1, [*rooms, capacity - sizes[k]])

    go(0, [])
    return best


def plain_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = min((r for r in rooms if r >= s), default=None)
        if fit is None:
            rooms.append(capacity - s)
        else:
            rooms.remove(fit)
            rooms.append(fit - s)
    return len(rooms)


def test_bounds_hold_and_packing_is_best_fit():
    draw = np.random.default_rng(1)
    tight = 0
    for _ in range(300):
        capacity = int(draw.integers(5, 30))
        sizes = draw.integers(1, capacity + 1, draw.integers(1, 9))
        bound, best = packing.lower_bound(counts(sizes, capacity), capacity), fewest(sizes.tolist(), capacity)
        assert bound <= best
        tight += bound == best
        sequence, offset, total = packing.pack_sizes(sizes, capacity)
        assert total == plain_best_fit(sizes.tolist(), capacity) >= best
        assert total == len(set(sequence.tolist()))
    assert tight > 250


@pytest.mark.parametrize("low, high, n", [(1, 2048, 20000), (1, 60, 5000), (700, 2048, 4000), (1024, 1025, 999), (1, 2, 5000)])
def test_many_sizes(low, high, n):
    sizes = np.random.default_rng(2).integers(low, high, n)
    sequence, offset, total = packing.pack_sizes(sizes, 2048)
    order = np.lexsort((offset, sequence))
    s, o, z = sequence[order], offset[order], sizes[order]
    first = np.append([True], s[1:] != s[:-1])
    assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + z)[:-1][~first[1:]]).all() and (o + z).max() <= 2048
    assert total == first.sum() == plain_best_fit(sizes.tolist(), 2048)
    assert packing.lower_bound(counts(sizes, 2048), 2048) <= total


def check(rows, texts, capacity=2048):
    """Pieces give the library's ids and sequences hold them without gaps."""
    library = Tokenizer.from_file(MODEL)
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        found = sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(len(found)))
        assert sum(r["length"] for r in found) == len(ids)
        assert all(r["length"] == capacity for r in found[1:])
        assert len(found) == -(-len(ids) // capacity)
        at = 0
        for r in found:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_table_packs_near_its_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "DEAL", 64)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(packing.pieces(docs, MODEL)).collect()
    used = check(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    bound = packing.lower_bound(counts([r["length"] for r in rows], 2048), 2048)
    assert bound <= used <= bound + 1


def test_exchange_only_helps(spark, monkeypatch):
    """Sizes just above a half and a third: a deal alone leaves room."""
    draw = np.random.default_rng(4)
    sizes = draw.choice([1100, 1030, 690, 700, 500, 330, 40, 3], 3000)
    df = spark.createDataFrame([(int(i), 0, 0, int(s), 0) for i, s in enumerate(sizes)], packing.PIECES)
    used = {}
    for meet, deal in ((8, 50), (8, 100000)):
        monkeypatch.setattr(packing, "MEET", meet)
        monkeypatch.setattr(packing, "DEAL", deal)
        got = packing.pack(df).collect()
        assert sorted(r["doc_id"] for r in got) == list(range(3000))
        used[deal] = len({r["sequence_id"] for r in got})
        assert max(r["offset"] + r["length"] for r in got) <= 2048
    bound = packing.lower_bound(counts(sizes, 2048), 2048)
    alone = sum(packing.pack_sizes(sizes[k::60], 2048)[2] for k in range(60))
    assert bound <= used[50] < alone and used[50] <= used[100000] * 1.02 + 1


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a b c", "x\x1c y", "x \x85y", "it's  we'll 'll", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "　 z", "1 2  3\t 4", "é" * 300, "中文 字" * 50, "a" * 5000, "!? ?!  -", "​ a ﻿ b", "x  y z", "👍🏽 ok  👍"]


def test_ids_equal_the_library():
    library = Tokenizer.from_file(MODEL)
    reader = packing.Ids(MODEL)
    odd = [*ODD, *("".join(p) for p in itertools.product([" ", "a", "\n", ".", "\u00a0", "\x1c", "é", "'s"], repeat=4))]
    for _ in range(2):
        for text, ids in zip(odd, encode(reader, odd)):
            assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
    reader.room = 0
    assert encode(reader, ["quite new words"]) == [library.encode("quite new words").ids]
    assert encode(reader, []) == [] and encode(reader, ["", ""]) == [[], []]


def encode(reader, many):
    raw = [t.encode() for t in many]
    ids, bounds = reader(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_odd_documents(spark, docs):
    rows = [(i, t, "en", "s") for i, t in enumerate([*ODD, None, "word " * 300_000])]
    got = packing.pack(packing.pieces(docs(rows).withColumnRenamed("n_tokens", "length"), MODEL)).collect()
    check(got, {i: t for i, t, _, _ in rows})


def test_repeated_and_null_ids_and_empty_table(spark, docs):
    rows = [(None, "one two", "en", "s")] * 3 + [(1, "x", "en", "s")] * 2
    got = packing.pack(packing.pieces(docs(rows), MODEL)).collect()
    assert len(got) == 5 and len({r["sequence_id"] for r in got}) == 1
    assert len({r["offset"] for r in got}) == 5
    assert packing.pack(packing.pieces(docs([]), MODEL)).collect() == []
