"""Quality checks whose states are kept by part: a run scans the parts it wrote.

For each part of a table the manifest keeps its row count and, of every check that can be told
part by part, how many rows (or keys) fail.  A table's result is the sum over its parts:

* row counts and predicates always;
* uniqueness where equal keys lie in one part (the key holds the part column, or the bucket's
  business key); of other keys the table's key columns are read again if any part was written;
* references, because dimensions never lose a key: a row that had its match keeps it.  Parts
  with rows that had none are scanned again if the run wrote to the referenced table, as the
  match may have come.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import quality
from .publish import BUCKET, TableStore


def _part_column(name: str, entry: dict) -> str | None:
    if entry.get("buckets"):
        return BUCKET
    parts = schemas.LAYOUT.get(name, ([], None, []))[0]
    return parts[0] if parts else None


def is_local(name: str, entry: dict, check: quality.Check) -> bool:
    """Whether a check's failures are the sum of its parts' failures."""
    if check.family != "U":
        return True
    part = _part_column(name, entry)
    home = schemas.KEYS[name][0] if part == BUCKET else [part]
    return part is None or set(home) <= set(check.key)


def _scan(store: TableStore, name: str, entry: dict, checks, labels) -> dict[str, dict]:
    """States of the parts ``labels``; at most a row for each part and check comes back."""
    part = _part_column(name, entry)
    rows = store.frame(name, entry, with_partitions=True, labels=labels)
    label = F.lit("") if part is None else F.concat(F.lit(f"{part}="), F.col(part).cast("string"))
    rows = rows.withColumn("_label", label)
    states = {x: {"n": 0, "failed": {c.id: 0 for c in checks if c.family != "K"}} for x in labels}
    predicates = [c for c in checks if c.family == "P"]
    counted = rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(F.coalesce(F.expr(c.where), F.lit(False))).alias(f"p{i}") for i, c in enumerate(predicates)])
    for r in counted.collect():
        state = states[r["_label"]]
        state["n"] = r["n"]
        state["failed"].update({c.id: r[f"p{i}"] for i, c in enumerate(predicates)})
    frames = []
    for c in checks:
        if c.family == "U":
            some = rows.where(F.expr(c.where)) if c.where else rows
            again = some.groupBy("_label", *c.key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            frames.append(again.groupBy("_label").agg(F.count(F.lit(1)).alias("failed")).select(F.lit(c.id).alias("id"), "_label", "failed"))
    frames += _unmatched(store, rows, [c for c in checks if c.family == "R"])
    for frame in frames:
        for r in frame.collect():
            states[r["_label"]]["failed"][r["id"]] = r["failed"]
    return states


def _unmatched(store: TableStore, rows: DataFrame, checks) -> list[DataFrame]:
    """(id, _label, failed) of references without a match, keys pre-aggregated by part."""
    frames = []
    for kind in ("string", "bigint"):
        cs = [c for c in checks if (dict(rows.dtypes)[c.fk] == "string") == (kind == "string")]
        if not cs:
            continue
        keys = []
        for c in cs:
            key = F.struct(F.lit(c.id).alias("id"), F.col(c.fk).cast(kind).alias("_fk"))
            keys.append(F.when(F.coalesce(F.expr(c.where), F.lit(False)), key) if c.where else key)
        counts = rows.select("_label", F.explode(F.array(*keys)).alias("r")).where("r IS NOT NULL").groupBy("_label", "r.id", "r._fk").agg(F.count(F.lit(1)).alias("_n"))
        known = None
        for c in cs:
            ref = current(store, c.ref_table).select(F.lit(c.id).alias("id"), F.col(c.ref_key).cast(kind).alias("_fk"))
            known = ref if known is None else known.unionByName(ref)
        orphans = counts.join(known.hint("merge"), ["id", "_fk"], "left_anti")  # as in quality._r_counts
        frames.append(orphans.groupBy("id", "_label").agg(F.sum("_n").alias("failed")))
    return frames


def current(store: TableStore, name: str) -> DataFrame:
    """A table as this run leaves it: what it wrote, or the committed state."""
    return store.frame(name, store.pending[name]) if name in store.pending else store.read(name)


def update(store: TableStore, checks) -> dict[str, list[str]]:
    """Bring the states of this run's tables up to date; returns the parts scanned, by table."""
    scanned = {}
    for name in dict.fromkeys(c.table for c in checks):
        entry = store.pending[name]
        mine = [c for c in checks if c.table == name]
        local = [c for c in mine if is_local(name, entry, c)]
        states = entry.setdefault("states", {})
        references = [c.id for c in mine if c.family == "R" and store.pending[c.ref_table]["written"]]
        due = [x for x in entry["parts"] if x not in states or any(states[x]["failed"].get(i) for i in references)]
        if due:
            states.update(_scan(store, name, entry, local, due))
        scanned[name] = due
        across = [c for c in mine if not is_local(name, entry, c)]
        known = entry.setdefault("across", {})
        if across and (entry["written"] or any(c.id not in known for c in across)):
            for frame in quality._u_counts({name: store.frame(name, entry)}, across):
                r = frame.first()
                known[r["check_id"]] = r["failed_count"]
    return scanned


def row_count(entry: dict) -> int:
    """Rows of a table, from the states of its parts."""
    return sum(s["n"] for x, s in entry["states"].items() if x in entry["parts"])


def results(store: TableStore, checks, run_ts: dt.datetime) -> DataFrame:
    """One row for each check, from the states alone."""
    rows = []
    for c in checks:
        entry = store.pending[c.table]
        if c.family == "K":
            failed = abs(row_count(entry) - c.expected)
        elif is_local(c.table, entry, c):
            failed = sum(s["failed"][c.id] for x, s in entry["states"].items() if x in entry["parts"])
        else:
            failed = entry["across"][c.id]
        rows.append((run_ts, c.layer, c.reported, c.name, "PASS" if failed == 0 else "FAIL", int(failed), c.note))
    return store.spark.createDataFrame(rows, schemas.SCHEMAS["dqc_results"])
