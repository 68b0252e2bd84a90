"""Sharding by jump consistent hashing, and gapless slots within shards.

A stable key and the number of shards decide the shard (law ``key``); no table of ring positions
is kept. When shards are appended, a row stays or moves into one of the new shards, and no more
rows move than the new shards' share (Lamping and Veach 2014).

Slots number the rows of a shard from 0 without gaps. No shard is sorted as a whole: rows fall into
buckets by a hash, buckets are small, and a bucket's first slot is the count of the rows in the
buckets before it.

Defined results: a NULL key counts as one key of its own. Rows with equal keys share a shard,
whatever their other columns; rows equal in all columns get adjacent slots. A NULL text has size 1 and
checksum 0. Empty tables give empty results. Other columns are passed through; columns named like
the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm.common import staged

SHARDS = 16
# The generator of the published algorithm (a fixed value).
STEP = np.uint64(2862933555777941757)
# Rows that a bucket of slots should hold.
BUCKET_ROWS = 50_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, from 0 on, of each 64-bit key."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        state[live] = state[live] * STEP + np.uint64(1)
        spread = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1)
        to = ((at[live] + 1) * spread).astype(np.int64)
        stays = to >= shards
        live, to = live[~stays], to[~stays]
        at[live] = to
    return at


def shard_of(key: Column, shards: int = SHARDS) -> Column:
    """The shard of a key of any type: its hash jumps."""

    @F.pandas_udf("int")
    def jumped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for hashes in batches:
            yield pd.Series(jump(hashes.to_numpy(dtype=np.int64).view(np.uint64), shards), dtype="int32")

    return jumped(F.xxhash64(key))


def assign(
    df: DataFrame, key: str = "doc_id", shards: int = SHARDS, into: str = "shard", grown: str = "grown_shard"
) -> DataFrame:
    """``df`` with the shard of each row, now and with one more shard. Nothing is shuffled."""
    return df.withColumns({into: shard_of(F.col(key), shards), grown: shard_of(F.col(key), shards + 1)})


def numbered(
    df: DataFrame, shard: str = "shard", slot: str = "slot", order: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``df`` with each row's place in its shard, from 0 on.

    Rows equal in every column are counted first and unfolded last, so no bucket grows with them.
    Give it narrow rows, such as keys and sizes, and join what is wide by key.
    """
    columns = [c for c in df.columns if c != slot]
    order = list(order) or columns
    folded = staged(df.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies")))
    buckets = max(1, folded.count() // bucket_rows)
    hashed = folded.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = hashed.groupBy(shard, "__bucket").agg(F.sum("__copies").alias("__rows"))
    # One row per shard and bucket: a millionth of the table at most.
    upto = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.withColumn("__first", F.coalesce(F.sum("__rows").over(upto), F.lit(0))).drop("__rows")
    before = (
        Window.partitionBy(shard, "__bucket").orderBy(*order, *[c for c in columns if c not in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = hashed.withColumn("__before", F.coalesce(F.sum("__copies").over(before), F.lit(0)))
    placed = inside.join(firsts, [shard, "__bucket"])
    start = F.col("__first") + F.col("__before")
    return placed.select(*columns, F.explode(F.sequence(start, start + F.col("__copies") - 1)).alias(slot))


def sized(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with size (UTF-8 bytes and 1) and text_crc32 in place of ``text``."""
    value = F.coalesce(F.col(text), F.lit(""))
    rest = [F.col(c) for c in df.columns if c not in (text, "size", "text_crc32")]
    return df.select(
        *rest, (F.octet_length(value) + 1).cast("bigint").alias("size"), F.crc32(value).alias("text_crc32")
    )


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS, files: int = 1) -> None:
    """Write ``df`` with one folder per shard; a shard's rows are dealt over ``files`` files."""
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    placed = df.withColumn("shard", shard_of(F.col(key), shards))
    placed.repartition(shards * files, "shard", spread).write.partitionBy("shard").parquet(path)
