"""Versioned Parquet tables whose manifests name every part of every table.

A part is a folder: a month of a fact, a key bucket of a dimension, a run of an
append-only log, or a whole small table.  A run writes the parts it changes under its own
version (``<root>/<table>/v=<version>/...``) and never touches files that others read.
``commit`` then writes one small manifest, ``<root>/_runs/<number>``, that maps each table's
parts to folders: parts that the run didn't write are carried over as they are.  Until the
manifest is there, readers stay on the run before, for all tables at once.

Runs are numbered by the manifest they start from.  Of two runs that start from the same
manifest one commits and the other fails (``ConcurrentRun``): the manifest's file is put in
place by a rename that refuses an existing name.

Not-null rules of the declared schemas are part of the write itself: a row that breaks one
fails the job, so nothing that breaks a rule can be committed.

Facts are sorted within files on their date and cluster columns, so date filters prune parts
and Parquet row groups.  Older manifests and the folders only they name stay for rollback
until ``vacuum`` removes both.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.keys import CODEC

BUCKET = "key_bucket"


class ConcurrentRun(RuntimeError):
    """Another run has committed since this one started."""


def keys_of(name: str) -> str:
    """The side table that remembers a fact's surrogate keys."""
    return f"keys_{name}"


def ruled(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the table's types; evaluating a row with a NULL where the table has NOT NULL
    fails."""
    out = schemas.conform(df, name)
    return out.select(*[
        F.col(f.name) if f.nullable
        else F.coalesce(F.col(f.name), F.raise_error(F.lit(f"NULL in {name}.{f.name}")).cast(f.dataType)).alias(f.name)
        for f in schemas.schema_of(name).fields
    ])


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        #: Number of the manifest that this store's run starts from.
        self.base: int | None = None
        #: What the run has written: table to its next entry of the manifest.
        self.pending: dict[str, dict] = {}

    # ------------------------------------------------------------------ file system

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    def _names(self, folder: str) -> list[str]:
        base = self._Path(folder)
        fs = self._fs(base)
        return sorted(st.getPath().getName() for st in fs.listStatus(base)) if fs.exists(base) else []

    def files(self, name: str, label: str | None = None) -> dict[str, int]:
        """Data files (relative to the table's folder) and their sizes, of all committed parts
        or of one."""
        out = {}
        for part, folder in self.entry(name)["parts"].items():
            if label in (None, part):
                path = self._Path(f"{self.root}/{name}/{folder}")
                found = self._fs(path).listFiles(path, True)
                while found.hasNext():
                    status = found.next()
                    at = status.getPath().toString()
                    if at.endswith(".parquet"):
                        out[f"{folder}/{at.rsplit(folder + '/', 1)[1]}"] = status.getLen()
        return out

    # ------------------------------------------------------------------ manifests

    def _runs(self) -> list[int]:
        return [int(n) for n in self._names(f"{self.root}/_runs") if n.isdigit()]

    def head(self) -> int:
        """Number of the newest manifest, 0 before the first run."""
        return max(self._runs(), default=0)

    def manifest(self, number: int | None = None) -> dict:
        """{"version": of the run, "tables": {table: entry}} of a run, the newest by default."""
        number = self.head() if number is None else number
        if not number:
            return {"version": None, "tables": {}}
        path = self._Path(f"{self.root}/_runs/{number:08d}")
        stream = self._fs(path).open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def entry(self, name: str) -> dict:
        """The committed entry of a table: its parts, buckets and next surrogate key."""
        return self.manifest()["tables"].get(name) or {"parts": {}}

    def next_version(self, run_id: str) -> str:
        """A version above all that any run, finished or not, has written.  The run starts from
        the newest manifest."""
        self.base = self.head()
        self.pending = {}
        tables = [n for n in self._names(self.root) if not n.startswith(("_", "."))]
        used = [n.removeprefix("v=") for t in tables for n in self._names(f"{self.root}/{t}") if n.startswith("v=")]
        used += [self.manifest(n)["version"] for n in self._runs()[-1:]]
        numbers = [int(n.split("-")[0]) for n in used]
        return f"{max(numbers, default=0) + 1:08d}-{run_id}"

    def commit(self, version: str, tables) -> None:
        """Make what this run wrote of ``tables`` what readers see; other tables stay."""
        base = self.head() if self.base is None else self.base
        manifest = {"version": version, "tables": {**self.manifest(base)["tables"], **{t: self.pending[t] for t in tables}}}
        folder = self._Path(f"{self.root}/_runs")
        fs = self._fs(folder)
        fs.mkdirs(folder)
        # Written whole under a name of the run's own, then renamed; the rename fails if the
        # number is taken.
        draft, final = self._Path(folder, f".{version}"), self._Path(folder, f"{base + 1:08d}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)
        except Exception as error:
            fs.delete(draft, False)
            if fs.exists(final):
                raise ConcurrentRun(f"run {version} started from manifest {base}, which another run has followed") from error
            raise
        self.base, self.pending = base + 1, {}

    def versions(self, name: str) -> list[str]:
        """Versions of the committed runs that wrote a part of the table, oldest first."""
        found = {p.split("/")[0].removeprefix("v=") for r in self._runs() for p in (self.manifest(r)["tables"].get(name) or {"parts": {}})["parts"].values()}
        return sorted(found)

    # ------------------------------------------------------------------ reading

    def _layout(self, name: str, buckets: int | None):
        parts, derived, sort_cols = schemas.LAYOUT.get(name, ([], None, []))
        return ([BUCKET], None, sort_cols) if buckets else (parts, derived, sort_cols)

    def _schema_on_disk(self, name: str, buckets: int | None) -> T.StructType:
        fields = list(schemas.schema_of(name).fields)
        names = {f.name for f in fields}
        kind = T.IntegerType() if buckets else T.StringType()
        return T.StructType([*fields, *[T.StructField(p, kind, True) for p in self._layout(name, buckets)[0] if p not in names]])

    def frame(self, name: str, entry: dict, with_partitions: bool = False, labels=None) -> DataFrame:
        """The rows of an entry's parts (or of those in ``labels``), in declared types."""
        schema = self._schema_on_disk(name, entry.get("buckets"))
        folders = [f for label, f in entry["parts"].items() if labels is None or label in labels]
        if folders:
            df = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
            df = df.parquet(*[f"{self.root}/{name}/{f}" for f in folders]).drop("v")
        else:
            df = self.spark.createDataFrame([], schema)
        return df if with_partitions else schemas.conform(df, name)

    def read(self, name: str, version: str | None = None, with_partitions: bool = False, labels=None) -> DataFrame | None:
        """A table as the newest run (or the run ``version``, also before it is committed) left
        it.  ``with_partitions`` keeps derived partition columns (e.g. ``purchase_month``) so a
        query can add bounds that prune whole parts; ``labels`` reads some parts only."""
        if version is None:
            entry = self.manifest()["tables"].get(name)
        elif name in self.pending and self.pending[name]["version"] == version:
            entry = self.pending[name]
        else:
            found = [m for r in self._runs() if (m := self.manifest(r))["version"] == version]
            entry = found[0]["tables"].get(name) if found else None
        return None if entry is None else self.frame(name, entry, with_partitions, labels)

    def latest_part(self, name: str) -> DataFrame | None:
        """The rows that the newest run appended to a log: its folder is read, not the log."""
        parts = self.entry(name)["parts"]
        return self.read(name, labels=[max(parts)]) if parts else None

    # ------------------------------------------------------------------ writing

    def bucket(self, name: str, buckets: int) -> F.Column:
        return F.pmod(F.xxhash64(*schemas.KEYS[name][0]), F.lit(buckets)).cast("int")

    def _write(self, name: str, df: DataFrame, version: str, buckets: int | None) -> dict[str, str]:
        """Write rows under a version; returns the parts that came of it."""
        parts, derived_from, sort_cols = self._layout(name, buckets)
        out = ruled(df, name)
        for p in parts:
            if p == BUCKET:
                out = out.withColumn(p, self.bucket(name, buckets))
            elif p not in out.columns:
                out = out.withColumn(p, F.date_format(F.col(derived_from), "yyyy-MM"))
        if parts:
            # group rows of a part into few files; REBALANCE lets AQE split one that holds a
            # large share of the rows across several writers instead of one task
            out = out.hint("rebalance", *parts)
        if sort_cols:
            out = out.sortWithinPartitions(*sort_cols)
        writer = out.write.mode("errorifexists").option("compression", CODEC)
        if parts:
            writer = writer.partitionBy(*parts)
        folder = f"v={version}"
        writer.parquet(f"{self.root}/{name}/{folder}")
        if not parts:
            return {"": folder}
        return {n: f"{folder}/{n}" for n in self._names(f"{self.root}/{name}/{folder}") if n.startswith(f"{parts[0]}=")}

    def _note(self, name: str, parts: dict[str, str], version: str, written, old: dict, **more) -> dict:
        entry = {k: v for k, v in old.items() if k not in ("parts", "written", "states")}
        states = {label: s for label, s in old.get("states", {}).items() if label in parts and label not in written}
        self.pending[name] = {**entry, "parts": parts, "version": version, "written": sorted(written), "states": states, **more}
        return self.pending[name]

    def publish(self, name: str, df: DataFrame, version: str, with_partitions: bool = False, buckets: int | None = None, **more) -> DataFrame:
        """Write ``df`` as the whole next state and return what was written; readers see it
        once the version is committed.  ``buckets`` deals the rows by their business key;
        ``more`` is kept in the manifest."""
        parts = self._write(name, df, version, buckets)
        if buckets:
            more["buckets"] = buckets
        self._note(name, parts, version, parts, {}, **more)
        return self.read(name, version, with_partitions)

    def replace_parts(self, name: str, df: DataFrame, version: str, touched, **more) -> DataFrame:
        """Write the whole next state of the parts ``touched`` (labels); all other parts are
        carried over as files.  ``df`` has no rows of other parts."""
        old = self.entry(name)
        kept = {label: f for label, f in old["parts"].items() if label not in touched}
        new = self._write(name, df, version, old.get("buckets")) if touched else {}
        if strange := sorted(new.keys() - set(touched)):
            raise ValueError(f"rows of parts of {name} that aren't replaced: {strange[:5]}")
        self._note(name, {**kept, **new}, version, new, old, **more)
        return self.read(name, version)

    def append(self, name: str, df: DataFrame, version: str, **more) -> DataFrame:
        """Write ``df`` as a further part, without reading or writing any other."""
        old = self.entry(name)
        ruled(df, name).write.mode("errorifexists").option("compression", CODEC).parquet(f"{self.root}/{name}/v={version}")
        self._note(name, {**old["parts"], f"v={version}": f"v={version}"}, version, [f"v={version}"], old, **more)
        return self.read(name, version)

    def register_views(self, names=None) -> dict[str, DataFrame]:
        """Expose the newest committed version of each table as a temp view (for SQL)."""
        out = {}
        for name in names or schemas.WAREHOUSE_TABLES + ["dqc_results"]:
            df = self.read(name)
            if df is not None:
                df.createOrReplaceTempView(name)
                out[name] = df
        return out

    def register_tables(self, names=None, database: str = "default") -> list[str]:
        """Make the newest committed state of tables catalog tables of the session, with their
        rows counted, so that the optimizer knows sizes: each part is a catalog partition at its
        own folder.  The tables are external: dropping them leaves the files.  Logs, whose parts
        have no column, stay views."""
        out = []
        for name in names or schemas.WAREHOUSE_TABLES:
            entry = self.manifest()["tables"].get(name)
            if entry is None:
                continue
            parts, _, _ = self._layout(name, entry.get("buckets"))
            table = f"`{database}`.`{name}`"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema_on_disk(name, entry.get("buckets")).fields)
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            where = f"{self.root}/{name}" if parts else f"{self.root}/{name}/{entry['parts']['']}"
            by = f"PARTITIONED BY (`{parts[0]}`)" if parts else ""
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION '{where}'")
            labels = [(label.split("=", 1)[1], folder) for label, folder in entry["parts"].items()] if parts else []
            if labels:
                specs = " ".join(f"PARTITION (`{parts[0]}` = '{value}') LOCATION '{self.root}/{name}/{folder}'" for value, folder in labels)
                self.spark.sql(f"ALTER TABLE {table} ADD {specs}")
            self.spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
            out.append(name)
        return out

    def vacuum(self, keep: int = 2) -> dict[str, list[str]]:
        """Delete all manifests but the newest ``keep`` and every folder that none of those
        names.  Returns the folders removed, by table.  A run under way whose start has been
        overtaken can't commit any more, so its folders go too."""
        runs = self._runs()
        kept = runs[-keep:] if keep > 0 else []
        for r in runs:
            if r not in kept:
                path = self._Path(f"{self.root}/_runs/{r:08d}")
                self._fs(path).delete(path, False)
        newest = self.manifest(kept[-1])["version"] if kept else ""
        named: dict[str, set[str]] = {}
        for r in kept:
            for name, entry in self.manifest(r)["tables"].items():
                named.setdefault(name, set()).update(entry["parts"].values())
        gone: dict[str, list[str]] = {}
        for name in named:
            for v in self._names(f"{self.root}/{name}"):
                if not v.startswith("v=") or v[2:] > newest:
                    continue
                inner = [n for n in self._names(f"{self.root}/{name}/{v}") if "=" in n]
                folders = [v] if v in named[name] or not inner else [f"{v}/{n}" for n in inner]
                old = [f for f in folders if f not in named[name]]
                for f in [v] if len(old) == len(folders) else old:
                    path = self._Path(f"{self.root}/{name}/{f}")
                    self._fs(path).delete(path, True)
                    gone.setdefault(name, []).append(f)
        return gone
