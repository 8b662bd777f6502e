"""Surrogate keys."""

import pytest
from pyspark.sql import functions as F

from dimforge.operators import keys


@pytest.mark.parametrize("partitions", [1, 6])
def test_assign_keys_follow_natural_key_order(spark, partitions):
    df = spark.range(0, 5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("nk"))
    out = keys.assign_keys(df, "sk", "nk", offset=100, num_partitions=partitions).collect()
    by_nk = sorted(out, key=lambda r: r.nk)
    assert [r.sk for r in by_nk] == list(range(101, 5101))


def test_require_unique_names_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    with pytest.raises(keys.DuplicateKeyError, match="'a'"):
        keys.require_unique(df, "k")
    keys.require_unique(df, ["k", "v"])


def test_max_key_of_empty_table_is_zero(spark):
    assert keys.max_key(spark.createDataFrame([], "k long"), "k") == 0


def test_no_task_numbers_all_rows(spark):
    """The rows stay in the session's partitions; only the counts per partition meet in one."""
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("nk"))
    out = keys.assign_keys(df, "sk", "nk")
    assert out.rdd.getNumPartitions() > 1
    assert "Exchange SinglePartition" not in out.select("nk")._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_size(spark, monkeypatch):
    df = spark.range(0, 5000)
    assert keys.partitions_for(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(keys, "TARGET_BYTES", 400)
    assert keys.partitions_for(df) == 100


def test_numbered_rows_are_files_and_not_held_by_executors(spark):
    """Rows are numbered by their place in sorted files, over splits of any size."""
    cached = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    df = spark.range(0, 3000, numPartitions=5).select(F.format_string("k%05d", (F.col("id") * 7919) % 3000).alias("nk"))
    out = keys.assign_keys(df, "sk", "nk", num_partitions=12)
    assert out.inputFiles()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == cached
    assert [r.sk for r in sorted(out.collect(), key=lambda r: r.nk)] == list(range(1, 3001))
    none = keys.assign_keys(df.where("nk IS NULL"), "sk", "nk")
    assert none.count() == 0


def test_stored_rows_are_not_written_again_and_files_are_small(spark):
    """Rows that stand in files already are numbered from there; files are compressed well."""
    import glob

    df = keys.written(spark.range(0, 100).select(F.format_string("k%05d", "id").alias("nk")))
    folder = keys.ensure_checkpoint_dir(spark).removeprefix("file:")
    assert all(f.endswith(".zstd.parquet") for f in df.inputFiles())
    before = set(glob.glob(f"{folder}/rows-*"))
    out = keys.assign_keys(df.where("nk <> 'k00000'"), "sk", "nk", num_partitions=2, stored=True)
    assert len(set(glob.glob(f"{folder}/rows-*")) - before) == 1  # the sorted rows
    assert [r.sk for r in sorted(out.collect(), key=lambda r: r.nk)] == list(range(1, 100))


def test_reloads_leave_no_uncompressed_checkpoint(spark):
    import glob

    from dimforge.operators.merge import replace_by_key

    folder = keys.ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/rdd-*"))
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "sk long, k string, v int")
    fresh = spark.createDataFrame([("b", 5), ("c", 6)], "k string, v int")
    out = replace_by_key(target, fresh, fresh.select("k"), "k", ["k"], "sk")
    assert sorted(map(tuple, out.select("sk", "k", "v").collect())) == [(1, "a", 1), (2, "b", 5), (3, "c", 6)]
    assert set(glob.glob(f"{folder}/rdd-*")) == before


def test_numbering_finds_repeated_keys_and_shuffles_once(spark, monkeypatch):
    plans = []
    store = keys.written

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df)

    monkeypatch.setattr(keys, "written", noted)
    df = spark.createDataFrame([(f"o{i % 40:02d}", i // 40, i) for i in range(200)], "nk string, item int, v int").repartition(5)
    out = keys.assign_keys(df, "sk", ["nk", "item"], num_partitions=4, unique="reload")
    assert out.columns == ["nk", "item", "v", "sk"]
    assert [r.sk for r in out.orderBy("nk", "item").collect()] == list(range(1, 201))
    assert "rangepartitioning" in plans[-1] and "hashpartitioning" not in plans[-1]
    twice = df.unionByName(df.where("v in (7, 8)"))
    with pytest.raises(keys.DuplicateKeyError, match="duplicate reload keys.*'o0[78]'"):
        keys.assign_keys(twice, "sk", ["nk", "item"], num_partitions=4, unique="reload")
