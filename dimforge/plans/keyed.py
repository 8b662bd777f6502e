"""Dimensions dealt into buckets by business key: type 1 and type 2 loads that read only the
buckets a source has keys of and write only those where something changes.

A bucket is a hash of the business key, so all versions of a key lie in one.  The source is
compared with the buckets it falls into; rows that are new or differ name the buckets to be
written.  A source that says nothing new writes nothing.  The next surrogate key stands in the
manifest, so no table is read for its largest key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import any_distinct
from ..operators.joins import by_rows
from ..operators.keys import assign_keys, has_key, require_unique, written
from ..operators.scd2 import scd2_apply
from .publish import BUCKET, TableStore
from .reload import values

#: Buckets of a dimension, kept in its manifest from the first load on.
BUCKETS = 16


def _dealt(store: TableStore, name: str, source: DataFrame, what: str) -> DataFrame:
    """The source's rows with a key, each with its bucket, written once."""
    key, _ = schemas.KEYS[name]
    dealt = written(has_key(source, key).withColumn(BUCKET, store.bucket(name, store.entry(name)["buckets"])))
    require_unique(dealt, key, what)
    return dealt


def _labels(buckets) -> list[str]:
    return [f"{BUCKET}={b}" for b in buckets]


def _first_load(store: TableStore, name: str, rows: DataFrame, version: str, buckets: int, **more) -> DataFrame:
    published = store.publish(name, rows, version, buckets=buckets)
    store.pending[name].update(next_key=published.count() + 1, **more)
    return published


def upsert_buckets(store: TableStore, name: str, source: DataFrame, set_cols, version: str, buckets: int = BUCKETS) -> DataFrame:
    """SCD type 1 MERGE into a published dimension; ``merge.upsert`` by buckets.  Returns the
    next state."""
    key, sk = schemas.KEYS[name]
    entry = store.entry(name)
    if not entry["parts"]:
        rows = has_key(source, key).select(*key, *set_cols)
        require_unique(rows, key, "merge source")
        return _first_load(store, name, assign_keys(rows, sk, key), version, buckets)
    src = _dealt(store, name, source.select(*key, *set_cols), "merge source")
    target = store.read(name, with_partitions=True, labels=_labels(values(src, BUCKET)))
    old = target.select(*key, BUCKET, sk, *[F.col(c).alias(f"_t_{c}") for c in set_cols])
    differs = F.col(sk).isNull() | any_distinct([(c, f"_t_{c}") for c in set_cols])
    # a row for each number given out, at most
    changed = written(src.join(by_rows(old, entry["next_key"] - 1), [*key, BUCKET], "left").where(differs).select(*key, BUCKET, sk, *set_cols))
    touched = values(changed, BUCKET)
    next_key = entry["next_key"]
    keyed = assign_keys(changed.where(F.col(sk).isNull()).drop(sk), sk, key, offset=next_key - 1, stored=True)
    news = changed.where(F.col(sk).isNotNull()).select(*key, *[F.col(c).alias(f"_s_{c}") for c in set_cols], F.lit(True).alias("_hit"))
    kept = store.read(name, labels=_labels(touched)).join(by_rows(news), key, "left").select(*[
        F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
        for c in schemas.schema_of(name).names
    ])
    rows = kept.unionByName(keyed.select(kept.columns))
    next_key += changed.where(F.col(sk).isNull()).count()
    return store.replace_parts(name, rows, version, _labels(touched), next_key=next_key)


def apply_history(
    store: TableStore, name: str, source: DataFrame, type1_cols, type2_cols, as_of: dt.date, version: str, buckets: int = BUCKETS
) -> DataFrame:
    """``scd2.scd2_apply`` on the buckets of a published history where something changes.
    Returns the next state.  A run dated before the last one that changed the table is
    refused."""
    key, sk = schemas.KEYS[name]
    entry = store.entry(name)
    t1, t2 = list(type1_cols), list(type2_cols)
    if not entry["parts"]:
        rows = scd2_apply(schemas.empty(store.spark, name), source, key, t1, t2, as_of, sk)
        return _first_load(store, name, rows, version, buckets, as_of=as_of.isoformat())
    if as_of.isoformat() < entry["as_of"]:
        raise ValueError(f"{name} was last run as of {entry['as_of']}: a run as of {as_of} is back-dated")
    src = _dealt(store, name, source.select(*key, *t1, *t2), "SCD source")
    hist = store.read(name, with_partitions=True, labels=_labels(values(src, BUCKET)))
    theirs = src.select(*key, BUCKET, *[F.col(c).alias(f"_s_{c}") for c in t1 + t2])
    versions = hist.join(by_rows(theirs), [*key, BUCKET])
    differs = any_distinct([(c, f"_s_{c}") for c in t1]) | (F.col("is_current") & any_distinct([(c, f"_s_{c}") for c in t2]))
    stale = versions.where(differs).select(BUCKET)
    open_now = by_rows(hist.where("is_current").select(*key, BUCKET), entry["next_key"] - 1)
    without = src.join(open_now, [*key, BUCKET], "left_anti").select(BUCKET)
    touched = values(stale.union(without), BUCKET)
    next_key = entry["next_key"]
    rows = None
    if touched:
        here = src.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        rows = written(scd2_apply(store.read(name, labels=_labels(touched)), here, key, t1, t2, as_of, sk, key_offset=next_key - 1))
        next_key += rows.where(F.col(sk) >= next_key).count()
    return store.replace_parts(name, rows, version, _labels(touched), next_key=next_key, as_of=as_of.isoformat())
