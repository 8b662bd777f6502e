import tracemalloc

import numpy as np

from dimforge.llm import common


def test_hashes_of_many_lengths_keep_one_pair_of_tables():
    """A worker that has hashed steps of all sizes holds tables for one step, not for each size."""
    tracemalloc.start()
    for n in [1 << k for k in range(10, 21)] + [common.STEP_BYTES + 1]:
        common.substring_hashes(np.zeros(n, np.uint8), np.array([0]), np.array([n]))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 20_000_000


def test_equal_substrings_hash_alike_whatever_the_tables():
    text = np.frombuffer(b"some words " * 30_000, np.uint8)
    starts = np.arange(0, len(text) - 11, 11)
    assert len(np.unique(common.substring_hashes(text, starts, starts + 10))) == 1
    longer = np.resize(text, 2 * common.STEP_BYTES + (1 << 17))  # longer than a step: tables of its own
    a, b = (common.substring_hashes(t, np.array([11, 22]), np.array([21, 32])) for t in (text, longer))
    assert (a == b).all() and a[0] == a[1]


def test_stored_rows_come_back(spark):
    rows = [(1, "a", None), (2, None, True), (None, "漢", False)]
    df = spark.createDataFrame(rows, "a long, b string, c boolean")
    assert sorted(map(tuple, common.stored(df).collect()), key=repr) == sorted(rows, key=repr)
    assert common.stored(df.filter("a = 7")).collect() == []
