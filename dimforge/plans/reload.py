"""Fact reloads that read and write only the parts a batch touches.

A batch replaces the rows of its scope (orders, or months).  Touched parts are the months of
the fresh rows and the months where rows of the scope are now; those are found from two narrow
columns.  Only these months are read whole, freed of the scope, joined by the fresh rows and
written; all others stay as files.

Surrogate keys come from a side table ``keys_<fact>``, an append-only map of every natural key
that ever had one.  A batch is matched with it; only rows that aren't in it are numbered, from
the next free key in the manifest, and appended to it.  So neither the fact's largest key nor
its old rows are looked up, keys outlive the rows they name, and the numbers of a run that is
never committed are given out again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.joins import batch, by_rows
from ..operators.keys import assign_keys, has_key, require_unique, written
from .publish import TableStore, keys_of


def values(df: DataFrame, column) -> list:
    """Distinct values of a column that has few by construction: months or key buckets."""
    return [r[0] for r in df.select(column).distinct().collect()]


def with_keys(store: TableStore, name: str, fresh: DataFrame, version: str) -> tuple[DataFrame, int]:
    """``fresh``, rows read from files, with the fact's surrogate key, and the next free key.
    New natural keys are numbered in their order and appended to the side table.  A natural key
    that occurs twice is an error; if all rows are numbered, the numbering finds it."""
    natural, sk = schemas.KEYS[name]
    known = store.read(keys_of(name))
    next_key = store.entry(name).get("next_key", 1)
    if known is None:
        have, need = None, fresh
    else:
        require_unique(fresh, natural, "reload")
        # every natural key so far, so the side table is as long as the fact; each took a number
        matched = written(fresh.join(by_rows(known, next_key - 1), natural, "left"))
        have, need = matched.where(F.col(sk).isNotNull()), matched.where(F.col(sk).isNull()).drop(sk)
    keyed = assign_keys(need, sk, natural, offset=next_key - 1, stored=True, unique="reload" if known is None else None)
    store.append(keys_of(name), keyed.select(*natural, sk), version)
    # Parquet footers tell how many rows were appended.
    next_key += store.frame(keys_of(name), store.pending[keys_of(name)], labels=[f"v={version}"]).count()
    return (keyed if have is None else have.unionByName(keyed.select(have.columns))), next_key


def reload_fact(store: TableStore, name: str, fresh: DataFrame, scope: DataFrame, scope_col: str, version: str) -> DataFrame:
    """Replace the rows whose ``scope_col`` is in ``scope`` by ``fresh`` and return the next
    state.  Fresh rows without their natural key don't go in; a natural key that occurs twice
    is an error.  A scope value without fresh rows is emptied."""
    natural, _ = schemas.KEYS[name]
    parts, derived, _ = schemas.LAYOUT[name]
    part = parts[0]
    month = F.col(part) if derived is None else F.date_format(F.col(derived), "yyyy-MM")
    fresh = written(has_key(fresh, natural))  # read to check, to match and to write
    keyed, next_key = with_keys(store, name, fresh, version)
    there = store.entry(name)["parts"]
    scope = scope.select(scope_col).where(F.col(scope_col).isNotNull()).distinct()
    touched = {f"{part}={m}" for m in values(fresh, month.alias(part))}
    kept = None
    if scope_col == part:
        touched |= {f"{part}={m}" for m in values(scope, scope_col)}
    elif there:
        scope = batch(written(scope))
        places = store.read(name, with_partitions=True).select(scope_col, part).join(scope, scope_col, "left_semi")
        touched |= {f"{part}={m}" for m in values(places, part)}
        if old := touched & there.keys():
            kept = store.read(name, labels=old).join(scope, scope_col, "left_anti")
    rows = schemas.conform(keyed, name)
    return store.replace_parts(name, rows if kept is None else kept.unionByName(rows.select(kept.columns)), version, touched, next_key=next_key)
