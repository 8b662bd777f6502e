"""Declarative data-quality checks, run in a few fused scans.

Families (each check yields ``failed_count``; PASS iff it is 0):

* ``K`` row count: ``|count(*) - expected|``
* ``P`` row predicate: rows for which a failing-row predicate holds
* ``U`` uniqueness: number of key values occurring more than once (groups, not rows),
  optionally among rows passing a filter
* ``R`` referential: rows whose foreign key has no match in the referenced table
  (a NULL key counts as unmatched), optionally among rows passing a filter

Execution plan:

* all ``K`` and ``P`` checks of one table: **one** aggregate pass over that table;
* each ``U`` check: one grouped count over the typed key columns; partial aggregation
  collapses hot keys map-side before the exchange;
* all ``R`` checks of one table: **one** scan -- each row contributes ``(check_id, key)``
  per check, pre-aggregated (distinct key + row count, partial aggregation first) before
  one anti join, so a hot key costs one row, not a third of the table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_COLUMNS = ["run_timestamp", "layer", "table_name", "check_name", "status", "failed_count", "note"]


@dataclass(frozen=True)
class Check:
    layer: str
    table: str
    name: str
    family: str  # K, U, P, R
    note: str
    expected: int | None = None  # K
    key: tuple = ()  # U
    where: str | None = None  # P: failing-row predicate; U: rows considered
    ref_table: str | None = None  # R
    fk: str | None = None  # R
    ref_key: str | None = None  # R
    report: str | None = None  # table named in the results, if not the scanned one

    @property
    def reported(self) -> str:
        return self.report or self.table

    @property
    def id(self) -> str:
        return f"{self.layer}.{self.reported}.{self.name}"


def row_count(layer, table, name, expected, note):
    return Check(layer, table, name, "K", note, expected=expected)


def unique(layer, table, name, key, note, where=None):
    return Check(layer, table, name, "U", note, key=tuple([key] if isinstance(key, str) else key),
                 where=where)


def predicate(layer, table, name, failing, note):
    return Check(layer, table, name, "P", note, where=failing)


def referential(layer, table, name, fk, ref_table, ref_key, note, where=None, report=None):
    return Check(layer, table, name, "R", note, fk=fk, ref_table=ref_table, ref_key=ref_key,
                 where=where, report=report)


def _union(frames):
    frames = [f for f in frames if f is not None]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _kp_counts(tables, checks):
    """One aggregate per table for its K and P checks -> (check_id, failed_count)."""
    frames = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.family in ("K", "P"):
            by_table.setdefault(c.table, []).append(c)
    for table, cs in by_table.items():
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(cs):
            if c.family == "P":
                aggs.append(F.count_if(F.coalesce(F.expr(c.where), F.lit(False))).alias(f"_p{i}"))
        row = tables[table].agg(*aggs)
        items = []
        for i, c in enumerate(cs):
            failed = F.abs(F.col("_n") - F.lit(c.expected)) if c.family == "K" else F.col(f"_p{i}")
            items.append(F.struct(F.lit(c.id).alias("check_id"), failed.cast("long").alias("failed_count")))
        frames.append(row.select(F.explode(F.array(*items)).alias("r")).select("r.*"))
    return frames


def _u_counts(tables, checks):
    """One row per uniqueness check: how many key values occur more than once."""
    frames = []
    for c in checks:
        if c.family != "U":
            continue
        rows = tables[c.table].where(F.expr(c.where)) if c.where else tables[c.table]
        groups = rows.groupBy(*c.key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        frames.append(groups.agg(F.count(F.lit(1)).cast("long").alias("failed_count"))
                      .select(F.lit(c.id).alias("check_id"), "failed_count"))
    return frames


def _r_counts(tables, checks):
    """One row per referential check.  The checks of a table whose keys have one type share
    its scan, their grouping and their anti join."""
    groups: dict[tuple[str, str], list[Check]] = {}
    for c in checks:
        if c.family == "R":
            kind = "string" if dict(tables[c.table].dtypes)[c.fk] == "string" else "bigint"
            groups.setdefault((c.table, kind), []).append(c)
    frames = []
    for (table, kind), cs in groups.items():
        keys = []
        # a check is a number until the end: its id would go with every key through the shuffles
        for i, c in enumerate(cs):
            key = F.struct(F.lit(i).alias("check"), F.col(c.fk).cast(kind).alias("_fk"))
            keys.append(F.when(F.coalesce(F.expr(c.where), F.lit(False)), key) if c.where else key)
        rows = tables[table].select(F.explode(F.array(*keys)).alias("r")).where("r IS NOT NULL")
        counts = rows.select("r.*").groupBy("check", "_fk").agg(F.count(F.lit(1)).alias("_n"))
        refs = _union([tables[c.ref_table].select(F.lit(i).alias("check"), F.col(c.ref_key).cast(kind).alias("_fk"))
                       for i, c in enumerate(cs)])
        # counts lie by key already; refs grow with the tables, and the bytes of their files, by which
        # Spark would broadcast them, say little of their rows
        orphans = counts.join(refs.hint("merge"), ["check", "_fk"], "left_anti")
        per_check = orphans.groupBy("check").agg(F.sum("_n").alias("n"))
        # one row per check of the list, 0 where nothing is orphaned
        ids = tables[table].sparkSession.createDataFrame([(i, c.id) for i, c in enumerate(cs)], "check int, check_id string")
        frames.append(ids.join(per_check, "check", "left").select(
            "check_id", F.coalesce("n", F.lit(0)).cast("long").alias("failed_count")))
    return frames


def checks_frame(spark: SparkSession, checks) -> DataFrame:
    return spark.createDataFrame(
        [(c.id, c.layer, c.reported, c.name, c.note, i) for i, c in enumerate(checks)],
        "check_id string, layer string, table_name string, check_name string, note string, ord int",
    )


def run_checks(spark: SparkSession, tables: dict[str, DataFrame], checks, run_ts=None) -> DataFrame:
    """Evaluate ``checks`` over ``tables``; one result row per check."""
    checks = list(checks)
    run_ts = run_ts or dt.datetime.now().replace(microsecond=0)
    counts = _union(_kp_counts(tables, checks) + _u_counts(tables, checks) + _r_counts(tables, checks))
    meta = F.broadcast(checks_frame(spark, checks))  # one row per declared check
    out = meta.join(counts, "check_id", "left")
    return out.select(
        F.lit(run_ts).cast("timestamp_ntz").alias("run_timestamp"),
        "layer", "table_name", "check_name",
        F.when(F.col("failed_count") == 0, "PASS").otherwise("FAIL").alias("status"),
        "failed_count", "note",
    )


def clear_layer_and_append(results: DataFrame, new: DataFrame, layer: str) -> DataFrame:
    """Replace one layer's rows of the results log with ``new`` (other layers kept)."""
    kept = results.where(~F.col("layer").eqNullSafe(F.lit(layer)))
    return kept.unionByName(new.select(*RESULT_COLUMNS))


def summary(results: DataFrame) -> DataFrame:
    """passed / failed / total over a results table (one row)."""
    return results.agg(
        F.count_if(F.col("status") == "PASS").cast("long").alias("passed"),
        F.count_if(F.col("status") != "PASS").cast("long").alias("failed"),
        F.count(F.lit(1)).cast("long").alias("total"),
    )


def failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == "FAIL").orderBy("layer", "table_name", "check_name")
