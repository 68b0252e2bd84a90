import random

import pytest
from pyspark.sql import functions as F

from quadrille.sources import buckets, lookup, sinks

SCHEMA = "a string, b int, value int, note string"


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in (path / "data").rglob("*.parquet")}


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, rows, tmp_path):
    rng = random.Random(5)
    path = str(tmp_path / "t")
    stored = spark.createDataFrame([(f"k{i}", i % 7, i, "old") for i in range(400)], SCHEMA)
    buckets.create_buckets(stored, path, ["a", "b"], 32)
    plain = stored
    for step in range(3):
        picked = rng.sample(range(500), 4)
        batch = [(f"k{i}", i % 7, 1000 * step + i, f"s{step}", at) for i in picked for at in (1, 2)]
        new = spark.createDataFrame(batch, SCHEMA + ", at int").withColumn("value", F.col("value") + F.col("at"))
        before = _files(tmp_path / "t")
        version, touched = buckets.upsert_buckets(spark, path, new, ["value"], [F.col("at")])
        assert version == step + 2 and 1 <= len(touched) <= 4
        after = _files(tmp_path / "t")
        assert {f: t for f, t in after.items() if f in before} == before
        added = {f.split("key_bucket=")[1].split("/")[0] for f in set(after) - set(before)}
        assert added == {str(b) for b in touched}
        plain = sinks.upsert(plain, new, ["a", "b"], ["value"], [F.col("at")])
        assert rows(buckets.read_buckets(spark, path)) == rows(plain)
    # 20 of 32 buckets at least were left as they were at first.
    held = buckets.manifest(spark, path)[1]
    assert sum(v == 1 for v in held.values()) >= 20
    assert rows(buckets.read_buckets(spark, path, 1)) == rows(stored)


def test_a_failed_upsert_leaves_the_table_and_is_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    stored = spark.createDataFrame([(f"k{i}", 0, i, None) for i in range(20)], SCHEMA)
    buckets.create_buckets(stored, path, ["a", "b"], 4)
    # What a job leaves that dies before its manifest.
    left = stored.withColumn("value", F.lit(-1)).withColumn(buckets.BUCKET, F.lit(0))
    buckets._write(left, path, 2)
    assert rows(buckets.read_buckets(spark, path)) == rows(stored)
    batch = spark.createDataFrame([("k1", 0, 99, "x", 1)], SCHEMA + ", at int")
    assert buckets.upsert_buckets(spark, path, batch, ["value"], [F.col("at")])[0] == 2
    want = [tuple(r) if r.a != "k1" else ("k1", 0, 99, None) for r in stored.collect()]
    assert rows(buckets.read_buckets(spark, path)) == rows(spark.createDataFrame(want, SCHEMA))


def test_empty_tables_empty_batches_null_keys_and_other_types(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], SCHEMA)
    buckets.create_buckets(empty, path, ["a", "b"], 4)
    assert buckets.read_buckets(spark, path).count() == 0
    with pytest.raises(FileExistsError):
        buckets.create_buckets(empty, path, ["a", "b"], 4)
    timed = SCHEMA + ", at int"
    assert buckets.upsert_buckets(spark, path, spark.createDataFrame([], timed), ["value"], [F.col("at")]) == (1, [])
    batch = spark.createDataFrame([("k", 1, 5, "x", 1), (None, 1, 6, "y", 1)], timed)
    buckets.upsert_buckets(spark, path, batch, ["value"], [F.col("at")])
    # A wider type of a key is the same key.
    wide = spark.createDataFrame([("k", 1, 7, "z", 2)], timed).withColumn("b", F.col("b").cast("bigint"))
    buckets.upsert_buckets(spark, path, wide, ["value"], [F.col("at")])
    assert rows(buckets.read_buckets(spark, path)) == [("k", 1, 7, "x"), (None, 1, 6, "y")]
    asked = spark.createDataFrame([("k", 1), ("gone", 2)], "a string, b int")
    assert rows(buckets.read_keys(spark, path, asked)) == [("k", 1, 7, "x")]
    with pytest.raises(ValueError):
        buckets.create_buckets(empty, str(tmp_path / "u"), ["a"], 0)


def test_a_lookup_in_a_sorted_table_reads_few_rows(spark, rows, tmp_path):
    many = spark.range(0, 200_000, 2, 4).select(
        F.format_string("m%07d", "id").alias("model_id"), (F.col("id") * 3).alias("downloads")
    ).orderBy(F.rand(3))
    mart = lookup.sorted_mart(many, str(tmp_path / "mart"), "model_id", 64 << 10)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert lookup.rows_scanned(mart.filter("downloads >= 0")) == 100_000
        assert lookup.rows_scanned(mart.filter("model_id = 'm0000500'")) <= 25_000
        # Within the range of the keys, but not among them.
        assert lookup.rows_scanned(mart.filter("model_id = 'm0000501'")) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rows(mart.filter("model_id = 'm0000500'")) == [("m0000500", 1500)]
    assert mart.count() == 100_000
