"""Batches, previews and lookups on skewed data with tiny blocks."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarweave.operators.joins import last_per_key, lookup, read_by_shard, store_by_shard
from tarweave.operators.mappers import AddFieldsConfig, add_fields, add_fields_from_files
from tarweave.operators.ordering import assign_batches, first_rows, number_rows, preview_grid
from tarweave.operators.shards import limit_shards, pending_shards
from tarweave.sources.captions import write_rows


def skewed(spark):
    """One shard with most rows, gaps in the positions, a shard of one row."""
    rng = random.Random(3)
    rows = [("hot", p) for p in sorted(rng.sample(range(1 << 20), 900))]
    rows += [(f"s{i % 7}", i * 3) for i in range(200)] + [("one", 1 << 45)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "shard string, pos long")


@pytest.mark.parametrize("block", [64, 1000, 1 << 16])
def test_row_numbers(spark, block):
    rows, df = skewed(spark)
    expected, counts = {}, {}
    for shard, pos in sorted(rows):
        expected[shard, pos] = counts.get(shard, 0)
        counts[shard] = counts.get(shard, 0) + 1
    got = number_rows(df, block=block).collect()
    assert {(r.shard, r.pos): r.row_num for r in got} == expected
    assert all(r.shard_rows == counts[r.shard] for r in got) and len(got) == len(rows)


def test_tail_is_kept_or_dropped(spark):
    df = spark.range(70).select(F.lit("s").alias("shard"), F.col("id").alias("pos"))
    assert assign_batches(df, 32, block=16).groupBy("batch_id").count().orderBy("batch_id").collect() == [
        (0, 32), (1, 32), (2, 6)]
    assert assign_batches(df, 32, keep_partial=False, block=16).count() == 64
    with pytest.raises(ValueError):
        assign_batches(df, 0)


def test_first_rows(spark):
    rows, df = skewed(spark)
    small = {(r.shard, r.pos, r.row_num) for r in first_rows(df, 5).collect()}
    large = first_rows(df, 1001)
    hot = sorted(p for s, p in rows if s == "hot")
    assert {x[1:] for x in small if x[0] == "hot"} == {(p, i) for i, p in enumerate(hot[:5])}
    assert large.count() == len(rows)
    assert "WindowGroupLimit" in first_rows(df, 5)._jdf.queryExecution().executedPlan().toString()


def test_preview_takes_any_row_count(spark):
    df = spark.range(10).select(F.lit("s").alias("shard"), F.col("id").alias("pos"), F.lit("c").alias("caption"))
    cells = preview_grid(df, "caption", batch_size=6).orderBy("pos").collect()
    assert [(c.grid_row, c.grid_col) for c in cells] == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1)]


def test_last_row_of_a_key_wins(spark):
    meta = spark.createDataFrame([("s", "a", 1, 0), ("s", "b", 2, 1), ("s", "a", 3, 2), ("s", "c", None, 3)],
                                 "shard string, key string, v int, pos long")
    samples = spark.createDataFrame([("s", k) for k in "abcd"] + [("other", "a")], "shard string, key string")
    config = AddFieldsConfig("add_fields", "v", "out", "")
    got = {(r.shard, r.key): r.out for r in add_fields(samples, meta, config).collect()}
    assert got == {("s", "a"): 3, ("s", "b"): 2, ("s", "c"): None}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_lookup(spark, how):
    left = spark.range(600).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
                                   .alias("key"), "id")
    keys = [("hot", 1)] + [(f"k{i}", i) for i in range(40)]
    right = spark.createDataFrame(keys, "key string, v int")
    got = sorted(map(tuple, lookup(left, right, ["key"], how).select("id", "key", "v").collect()),
                 key=str)
    known = dict(keys)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(600)]
    assert got == sorted(((i, k, known.get(k)) for i, k in rows if how == "left" or k in known), key=str)


def test_a_hot_key_is_split(spark):
    """Adaptive execution splits the partition of a key with a third of all rows, each part with the key's single right row."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
        left = spark.range(0, 60_000, 1, 8).select(key.alias("key"), "id", F.sha2(F.col("id").cast("string"), 256).alias("more"))
        right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(5000)], "key string, v int")
        found = lookup(left, right, ["key"])
        # Executed, so that the plan is the one that was adapted.
        assert found.toPandas().groupby("key").size()["hot"] == 20_000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_tables_by_shard_are_joined_where_they_lie(spark):
    rows = [(f"s{i % 7}", f"k{i}", i) for i in range(300)]
    samples = spark.createDataFrame(rows, "shard string, key string, n int")
    metadata = spark.createDataFrame([(s, k, j, f"{k}-{j}" if j or n % 5 else None) for s, k, n in rows if n % 3 for j in range(2)], "shard string, key string, pos long, txt string")
    samples, metadata = (read_by_shard(spark, store_by_shard(df, 4)) for df in (samples, metadata))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = add_fields(samples, metadata, AddFieldsConfig("add_fields", "txt", "t", ""))
        got = sorted(map(tuple, found.select("shard", "key", "n", "t").collect()))
        assert got == sorted((s, k, n, f"{k}-1") for s, k, n in rows if n % 3)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_last_per_key_keeps_nulls(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", None, 5)], "k string, v int, o int")
    assert last_per_key(rows, ["k"], ["v"], "o").collect() == [("a", None)]


def test_metadata_layouts_and_errors(spark, tmp_path):
    flat, ours = tmp_path / "flat", tmp_path / "ours"
    flat.mkdir()
    pd.DataFrame({"id": ["a", "a"], "txt": ["first", "last"]}).to_parquet(flat / "00000.parquet")
    rows = spark.createDataFrame([("00000", 0, "a", "first"), ("00000", 7, "a", "last")],
                                 "shard string, pos long, id string, txt string")
    write_rows(rows, str(ours), rows.drop("shard").schema)
    samples = spark.createDataFrame([("00000", "a"), ("0", "a")], "shard string, key string")
    for path in (flat, ours):
        config = AddFieldsConfig("add_fields", "txt", "t", str(path), metadata_key="id")
        assert add_fields_from_files(samples, config).collect() == [("00000", "a", "last")]
    with pytest.raises(FileNotFoundError):
        add_fields_from_files(samples, AddFieldsConfig("add_fields", "txt", "t", str(tmp_path / "none")))
    with pytest.raises(ValueError):
        add_fields_from_files(samples, AddFieldsConfig("add_fields", "nope", "t", str(flat), metadata_key="id"))


def test_limit_comes_before_skipping(spark):
    shards = spark.createDataFrame([(f"s{i}", f"/s{i}.tar") for i in range(6)], "shard string, path string")
    done = spark.createDataFrame([("s0",), ("s5",)], "shard string")
    assert sorted(r.shard for r in pending_shards(shards, done, 3).collect()) == ["s1", "s2"]
    assert pending_shards(shards, done).count() == 4 and limit_shards(shards, 0).count() == 0
