"""Compare registered Spark queries with their SQL oracle on DuckDB.

    python -m dimforge.oracle_check /root/testdata/sf0.01 [key ...]

Prints one line per key: row counts, column names and an order-insensitive
comparison of the values (decimals and floats compared as rounded floats).
"""

from __future__ import annotations

import decimal
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def compare(spark, sf_dir: str, key: str, fn, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    d_rows = [dict(zip(cols, r)) for r in res.fetchall()]
    out["oracle_rows"] = len(d_rows)
    s_cols, o_cols = sorted(sdf.columns), sorted(cols)
    if s_cols != o_cols:
        out["status"] = f"COLUMNS spark={s_cols} oracle={o_cols}"
        return out
    a, b = _rows(s_rows, s_cols), _rows(d_rows, s_cols)
    if a == b:
        out["status"] = "MATCH"
    else:
        sa, sb = set(a), set(b)
        out["status"] = "VALUES"
        out["only_spark"] = [x for x in a if x not in sb][:3]
        out["only_oracle"] = [x for x in b if x not in sa][:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import importlib.util
    import os

    from pyspark.sql import SparkSession

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(root, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    keys = argv[2:] or list(qs)
    con = duckdb_views(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls.get(k), con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("MATCH", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
