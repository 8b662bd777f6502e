"""Write operators as pure state transitions: ``(target, source, ...) -> next target``.

Parquet tables do not support MERGE / UPDATE / DELETE, so every write is a
function returning the complete next state; ``plans.publish`` then swaps it in.
Each function is one join (or anti join) on the business key plus an append,
so it scales like a shuffle of the target and the source on that key.

A source row without its whole key never goes in (``keys.has_key``): it could not be matched
at the next run.  ``plans.reload`` and ``plans.keyed`` write only the parts of a published
table that a batch changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import first_per_key
from .keys import assign_keys, has_key, max_key, refuse_again, require_unique, written


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def insert_if_absent(target: DataFrame, source: DataFrame, key_cols) -> DataFrame:
    """``INSERT OR IGNORE``: append source rows whose key is not in the target.  Of source rows
    that repeat a key one goes in, the first by its other columns (NULLs last)."""
    key_cols = _list(key_cols)
    new = has_key(source, key_cols).join(target.select(*key_cols), key_cols, "left_anti")
    others = [c for c in target.columns if c not in key_cols]
    new = first_per_key(new, key_cols, others) if others else new.dropDuplicates(key_cols)
    return target.unionByName(new.select(*target.columns))


def upsert(
    target: DataFrame,
    source: DataFrame,
    key_cols,
    set_cols,
    sk_col: str | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """SCD type 1 MERGE on ``key_cols``.

    matched       -> target surrogate key, source values of ``set_cols``
    target only   -> unchanged
    source only   -> inserted; ``sk_col`` = max(existing) + rank in key order
    A source key occurring twice is an error (the MERGE would be ambiguous).
    """
    key_cols, set_cols = _list(key_cols), _list(set_cols)
    source = has_key(source, key_cols)
    if check_unique:
        require_unique(source, key_cols, "merge source")
    s = source.select(*key_cols, *set_cols).withColumn("_in_src", F.lit(True))
    t = target.withColumn("_in_tgt", F.lit(True))
    j = t.join(s.select(*key_cols, *[F.col(c).alias(f"_s_{c}") for c in set_cols], "_in_src"),
               key_cols, "full_outer")
    matched_or_new = F.col("_in_src").isNotNull()
    cols = []
    for c in target.columns:
        if c in set_cols:
            cols.append(F.when(matched_or_new, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    merged = j.select(*cols, F.col("_in_tgt").isNull().alias("_is_new"))
    if sk_col is None:
        return merged.drop("_is_new")
    merged = written(merged)  # read twice below: for kept and for new rows
    kept = merged.where(~F.col("_is_new")).drop("_is_new")
    new = merged.where(F.col("_is_new")).drop("_is_new", sk_col)
    keyed = assign_keys(new, sk_col, key_cols, offset=max_key(target, sk_col), stored=True)
    return kept.unionByName(keyed.select(*target.columns))


def replace_by_key(
    target: DataFrame,
    fresh: DataFrame,
    scope_keys: DataFrame,
    scope_col: str,
    natural_key,
    sk_col: str | None = None,
) -> DataFrame:
    """Idempotent reload: drop target rows whose ``scope_col`` value is in ``scope_keys``,
    then append ``fresh``.

    Surrogate keys are reproducible: a fresh row whose natural key existed keeps
    its old key; other rows get max(existing) + rank in natural-key order.  A
    scope value with no fresh rows simply empties that scope (rows are not kept
    just because nothing replaces them).  A fresh batch that repeats a natural key is an
    error; of several old rows with one natural key the smallest key is kept.
    """
    natural_key = _list(natural_key)
    fresh = has_key(fresh, natural_key)
    if sk_col is None:
        require_unique(fresh, natural_key, "reload")
    scope = scope_keys.select(F.col(scope_col)).distinct()
    kept = target.join(scope, scope_col, "left_anti")
    if sk_col is None:
        return kept.unionByName(fresh.select(*target.columns))
    old_keys = target.join(scope, scope_col, "left_semi").groupBy(*natural_key).agg(F.min(sk_col).alias(sk_col))
    fresh = fresh.drop(sk_col) if sk_col in fresh.columns else fresh
    # the join brings equal keys together, so what repeats is marked there: rows are shuffled and
    # written once to be checked, matched and numbered
    same = Window.partitionBy(*natural_key).orderBy(*natural_key)
    matched = fresh.join(old_keys, natural_key, "left").withColumn("_again", F.row_number().over(same) > 1)
    reused = refuse_again(written(matched), natural_key, "reload")
    have = reused.where(F.col(sk_col).isNotNull())
    need = reused.where(F.col(sk_col).isNull()).drop(sk_col)
    keyed = assign_keys(need, sk_col, natural_key, offset=max_key(target, sk_col), stored=True)
    return kept.unionByName(have.select(*target.columns)).unionByName(keyed.select(*target.columns))


def delete_where(target: DataFrame, condition) -> DataFrame:
    """``DELETE FROM target WHERE condition`` (NULL condition keeps the row)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return target.where(~F.coalesce(cond, F.lit(False)))
