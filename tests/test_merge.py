"""Write operators as next-state functions: insert-or-ignore, SCD-1 upsert, reload by key."""

import pytest

from dimforge.operators.keys import DuplicateKeyError
from dimforge.operators.merge import delete_where, insert_if_absent, replace_by_key, upsert
from tests.conftest import rows

T_SCHEMA = "sk long, id string, city string, state string"


def test_upsert_all_cases(spark):
    target = spark.createDataFrame(
        [(1, "same", "x", "A"), (2, "changed", "old", "A"), (5, "tgt_only", "y", "B"),
         (7, "to_null", "z", "C")], T_SCHEMA)
    source = spark.createDataFrame(
        [("same", "x", "A"), ("changed", "new", "A"), ("new2", "n", "D"), ("new1", "m", "E"),
         ("to_null", None, "C")], "id string, city string, state string")
    out = upsert(target, source, "id", ["city", "state"], sk_col="sk")
    assert rows(out, "sk", "id", "city", "state") == sorted([
        (1, "same", "x", "A"), (2, "changed", "new", "A"), (5, "tgt_only", "y", "B"),
        (7, "to_null", None, "C"), (8, "new1", "m", "E"), (9, "new2", "n", "D")], key=repr)
    # idempotent
    again = upsert(out, source, "id", ["city", "state"], sk_col="sk")
    assert rows(again) == rows(out)


def test_upsert_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([], T_SCHEMA)
    source = spark.createDataFrame([("a", "x", "A"), ("a", "y", "A")], "id string, city string, state string")
    with pytest.raises(DuplicateKeyError):
        upsert(target, source, "id", ["city", "state"], sk_col="sk")


def test_insert_if_absent_keeps_existing_values(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "changed"), (3, "c")], "k int, v string")
    once = insert_if_absent(target, source, "k")
    assert rows(once) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(insert_if_absent(once, source, "k")) == rows(once)


def test_insert_if_absent_takes_one_row_of_a_repeated_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "y"), (2, "x"), (2, None), (1, "z")], "k int, v string")
    assert rows(insert_if_absent(target, source, "k")) == [(1, "a"), (2, "x")]
    keys_only = insert_if_absent(target.select("k"), source.select("k"), "k")
    assert rows(keys_only) == [(1,), (2,)]


def test_replace_by_key_with_repeated_keys(spark):
    target = spark.createDataFrame([(3, "o1", 1), (2, "o1", 1), (9, "o2", 1)], "sk long, order_id string, v int")
    fresh = spark.createDataFrame([("o1", 7)], "order_id string, v int")
    scope = spark.createDataFrame([("o1",)], "order_id string")
    assert rows(replace_by_key(target, fresh, scope, "order_id", "order_id", "sk"), "sk", "order_id", "v") == [(2, "o1", 7), (9, "o2", 1)]
    with pytest.raises(DuplicateKeyError):
        replace_by_key(target, fresh.union(fresh), scope, "order_id", "order_id", "sk")


def test_replace_by_key_edges(spark):
    schema = "sk long, order_id string, item int, price int"
    target = spark.createDataFrame(
        [(1, "o1", 1, 10), (2, "o1", 2, 20), (3, "o2", 1, 30), (4, "o3", 1, 40), (5, None, 1, 50)], schema)
    # o1 reloaded with one item changed and one gone, o2 in scope but all its rows failed cleansing,
    # o3 and the NULL key are out of scope, o4 is new
    fresh = spark.createDataFrame([("o1", 1, 11), ("o4", 1, 90)], "order_id string, item int, price int")
    scope = spark.createDataFrame([("o1",), ("o2",), ("o4",)], "order_id string")
    out = replace_by_key(target, fresh, scope, "order_id", ["order_id", "item"], "sk")
    assert rows(out, "sk", "order_id", "item", "price") == sorted(
        [(1, "o1", 1, 11), (4, "o3", 1, 40), (5, None, 1, 50), (6, "o4", 1, 90)], key=repr)


def test_delete_where_keeps_null_condition_rows(spark):
    df = spark.createDataFrame([("dim",), ("fct",), (None,)], "layer string")
    assert rows(delete_where(df, "layer = 'dim'")) == sorted([("fct",), (None,)], key=repr)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_ids = st.sampled_from(list("abcdefgh"))
_vals = st.sampled_from(["x", "y", None])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_ids, _vals), max_size=6, unique_by=lambda r: r[0]),
       st.lists(st.tuples(_ids, _vals), max_size=6, unique_by=lambda r: r[0]))
def test_upsert_properties(spark, t, s):
    target = spark.createDataFrame([(i * 3 + 1, k, v, "S") for i, (k, v) in enumerate(t)], T_SCHEMA)
    source = spark.createDataFrame([(k, v, "S") for k, v in s], "id string, city string, state string")
    once = upsert(target, source, "id", ["city", "state"], sk_col="sk")
    assert rows(upsert(once, source, "id", ["city", "state"], sk_col="sk")) == rows(once)
    got = {r.id: (r.sk, r.city) for r in once.collect()}
    old = {k: (i * 3 + 1, v) for i, (k, v) in enumerate(t)}
    src = dict(s)
    assert set(got) == set(old) | set(src)
    for k, (sk, city) in got.items():
        if k in old:
            assert sk == old[k][0]                      # existing keys never change
        assert city == (src[k] if k in src else old[k][1])
    top = max((v[0] for v in old.values()), default=0)
    new = sorted(k for k in src if k not in old)
    assert [got[k][0] for k in new] == list(range(top + 1, top + 1 + len(new)))


_orders = st.sampled_from(["o1", "o2", "o3", "o4"])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_orders, st.integers(1, 3), st.integers(0, 9)), max_size=8,
                unique_by=lambda r: (r[0], r[1])),
       st.lists(st.tuples(_orders, st.integers(1, 3), st.integers(0, 9)), max_size=8,
                unique_by=lambda r: (r[0], r[1])))
def test_replace_by_key_properties(spark, t, f):
    schema = "sk long, order_id string, item int, price int"
    target = spark.createDataFrame([(i + 1, *r) for i, r in enumerate(t)], schema)
    fresh = spark.createDataFrame(f, "order_id string, item int, price int")
    scope = spark.createDataFrame([(o,) for o in {r[0] for r in f}], "order_id string")
    once = replace_by_key(target, fresh, scope, "order_id", ["order_id", "item"], "sk")
    twice = replace_by_key(once, fresh, scope, "order_id", ["order_id", "item"], "sk")
    assert rows(twice) == rows(once)
    got = {(r.order_id, r.item): (r.sk, r.price) for r in once.collect()}
    in_scope = {r[0] for r in f}
    expected_keys = {(o, i) for o, i, _ in t if o not in in_scope} | {(o, i) for o, i, _ in f}
    assert set(got) == expected_keys
    old_sk = {(o, i): k + 1 for k, (o, i, _) in enumerate(t)}
    for nk, (sk, price) in got.items():
        if nk in old_sk:
            assert sk == old_sk[nk]              # a natural key keeps its surrogate key
    assert len({v[0] for v in got.values()}) == len(got)   # keys stay unique


def test_reload_writes_its_rows_once(spark, monkeypatch):
    """Fresh rows are checked, matched and numbered from one written copy."""
    import pytest
    from dimforge.operators import merge
    from dimforge.operators.keys import DuplicateKeyError
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "sk long, o string, i int")
    scope = spark.createDataFrame([("a",)], "o string")
    calls, write = [], merge.written
    monkeypatch.setattr(merge, "written", lambda df: calls.append(1) or write(df))
    out = merge.replace_by_key(target, spark.createDataFrame([("a", 1), ("a", 2)], "o string, i int"), scope, "o", ["o", "i"], "sk")
    assert sorted(tuple(r) for r in out.select("sk", "o", "i").collect()) == [(1, "a", 1), (2, "b", 1), (3, "a", 2)] and len(calls) == 1
    with pytest.raises(DuplicateKeyError, match="duplicate reload keys"):
        merge.replace_by_key(target, spark.createDataFrame([("a", 1), ("a", 1)], "o string, i int"), scope, "o", ["o", "i"], "sk")
