import zlib

import numpy as np
import pytest
from conftest import pairs

from quadrille.llm import sharding


def slow_jump(key, shards):
    """The published loop, one key at a time."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 1000])
def test_jump(shards):
    keys = np.random.default_rng(1).integers(0, 2**64, 2000, dtype=np.uint64)
    keys[:3] = [0, 1, 2**64 - 1]
    assert sharding.jump(keys, shards).tolist() == [slow_jump(int(k), shards) for k in keys]


def test_a_new_shard_takes_its_share_only():
    keys = np.random.default_rng(2).integers(0, 2**64, 100_000, dtype=np.uint64)
    now, grown = sharding.jump(keys, 16), sharding.jump(keys, 17)
    moved = now != grown
    assert (grown[moved] == 16).all()
    assert abs(moved.mean() - 1 / 17) < 0.005
    assert abs(np.bincount(now, minlength=16) - 6250).max() < 400


def check(rows, texts):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == sorted(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts if d is not None)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_key = {}
    for r in rows:
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)


@pytest.mark.parametrize("bucket_rows", [1, 5, 50_000])
def test_awkward_documents(docs, bucket_rows):
    placed = sharding.assign(sharding.sized(docs.select("doc_id", "text")))
    rows = sharding.numbered(placed, order=("doc_id", "text_crc32"), bucket_rows=bucket_rows).collect()
    assert len(rows) == docs.count()
    check(rows, pairs(docs))


def test_query(run, corpus):
    rows = run("op4_jump_shards")
    assert {r.law for r in rows} == {"key"}
    check(rows, pairs(corpus))


def test_copies_of_one_row(spark):
    df = spark.createDataFrame([(7, "x")] * 100 + [(i, "y") for i in range(50)], "doc_id long, text string")
    rows = sharding.numbered(sharding.assign(sharding.sized(df)), bucket_rows=3).collect()
    assert len(rows) == 150
    check(rows, pairs(df))


def test_other_keys_and_clashing_names(spark):
    df = spark.createDataFrame([("a", 1, 2), (None, 3, 4), ("a", 5, 6)], "doc_id string, shard int, slot int")
    rows = sharding.numbered(sharding.assign(df)).collect()
    assert len(rows) == 3
    assert len({r.shard for r in rows if r.doc_id == "a"}) == 1


def test_empty(no_docs):
    assert sharding.numbered(sharding.assign(sharding.sized(no_docs))).collect() == []


def test_files(spark, docs, tmp_path):
    sharding.write_shards(docs.select("doc_id", "text"), str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert pairs(back) == pairs(docs)
    ids = sorted({(r.doc_id, r.shard) for r in back.collect()}, key=repr)
    assert len(ids) == len({d for d, _ in ids})
