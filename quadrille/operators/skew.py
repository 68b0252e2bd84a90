"""Joins and per-key picks that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task should take; a key with more is hot and split by its own count.
TASK_ROWS = 2_000_000
# A table of hot keys never has more rows than this, the hottest ones, so it is always safe to broadcast.
HOT_KEYS = 100_000
# Lookups settle groups with more than 1/HOT_SHARE of the rows by broadcast.
HOT_SHARE = 64
# Tasks that rows without a key are spread over.
SALTS = 1024
# Tables of a few short columns are broadcast up to this many rows (about 30 MB).
BROADCAST_ROWS = 100_000


def salt_of(*columns: str, salts: int | Column = SALTS) -> Column:
    """A salt that depends on the row and the partition it is in: a rerun task repeats it, and equal
    rows of different partitions differ."""
    salts = salts if isinstance(salts, Column) else F.lit(salts)
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), salts).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """(keys, _salts): the keys with more than ``task_rows`` rows, at most ``HOT_KEYS`` of them, and
    into how many parts of that size each one falls."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.filter(F.col("_rows") > task_rows).orderBy(F.col("_rows").desc()).limit(HOT_KEYS)
    return hot.select(*keys, F.ceil(F.col("_rows") / task_rows).cast("int").alias("_salts"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    salt_by: Sequence[str] | None = None,
    task_rows: int = TASK_ROWS,
    unique_right: bool = False,
    counted: DataFrame | None = None,
    merged: bool = False,
) -> DataFrame:
    """Equi join that spreads the hot keys of either side over several tasks.

    A row of a hot key gets one of as many salts as the key has parts of ``task_rows``, and the
    other side's rows of that key are copied once per salt; all other rows keep salt 0. Say
    ``unique_right`` where the right side has one row per key: it is not counted then.
    An inner join salts the hot keys of both sides (a key hot on both forms a grid); left,
    left_semi and left_anti joins may only copy the right side, so they salt the left one.
    Rows with a NULL key match nothing and are spread too. ``condition`` is an extra
    predicate evaluated inside the join, over names that differ between the sides.
    ``salt_by`` names left columns to salt by where hashing all of them is dear; ``counted`` is a table
    to count the left keys in that is cheaper to read and has all of their rows. Say ``merged`` where
    files are no measure of the right side's rows, so that a guess from their size never broadcasts it.
    """
    keys = list(keys)
    every = F.sequence(F.lit(0), F.col("_salts") - 1)
    once = F.array(F.lit(0))
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()

    def flagged(df: DataFrame, hot: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), keys, "left")

    def salted(df: DataFrame, hot: DataFrame, name: str, columns: list[str]) -> DataFrame:
        spread = F.when(no_key, salt_of(*columns)).when(
            F.col("_salts").isNotNull(), salt_of(*columns, salts=F.col("_salts"))
        )
        return flagged(df, hot).withColumn(name, spread.otherwise(F.lit(0))).drop("_salts")

    def copied(df: DataFrame, hot: DataFrame, name: str) -> DataFrame:
        copies = F.when(F.col("_salts").isNotNull(), every).otherwise(once)
        return flagged(df, hot).withColumn(name, F.explode(copies)).drop("_salts")

    left_columns, right_columns = list(salt_by or left.columns), right.columns
    left_hot = hot_keys(left if counted is None else counted, keys, task_rows)
    on = [*keys, "_salt_l"]
    lhs = salted(left, left_hot, "_salt_l", left_columns)
    rhs = copied(right, left_hot, "_salt_l")
    if how == "inner" and not unique_right:
        right_hot = hot_keys(right, keys, task_rows)
        lhs = copied(lhs, right_hot, "_salt_r")
        rhs = salted(rhs, right_hot, "_salt_r", right_columns)
        on.append("_salt_r")
    rhs = rhs.hint("merge") if merged else rhs
    if condition is None:
        return lhs.join(rhs, on, how).drop("_salt_l", "_salt_r")
    rhs = rhs.withColumnsRenamed({k: f"_r_{k}" for k in on})
    matched = condition
    for key in on:
        matched = matched & (F.col(key) == F.col(f"_r_{key}"))
    return lhs.join(rhs, matched, how).drop("_salt_l", "_salt_r", *[f"_r_{k}" for k in on])


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; reads at most that many."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(left: DataFrame, groups: DataFrame, key: str, rows: str = "rows") -> DataFrame:
    """Left join to a table with one row per value of ``key`` and its group's size.

    ``groups`` should be cheap to read (a written table or a lineage cut); its ``rows``
    column says how many rows a group has and is not carried over. The table is
    broadcast only when counted and found small, which leaves ``left`` where it is.
    Otherwise only the hot groups (at most HOT_SHARE of them) are broadcast: their rows
    find the answer on the spot and are spread by a salt, and no row is ever copied.
    """
    added = [c for c in groups.columns if c not in (key, rows)]
    if at_most(groups, BROADCAST_ROWS):
        return left.join(F.broadcast(groups.drop(rows)), key, "left")
    total = groups.agg(F.sum(rows)).scalar()
    is_hot = F.coalesce(F.col(rows) * HOT_SHARE > total, F.lit(False))
    hot = groups.filter(is_hot).select(
        key, F.struct(*added).alias("_answer"), F.lit(True).alias("_hot")
    )
    cold = groups.filter(~is_hot & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.lit(0).alias("_salt"), F.struct(*added).alias("_other")
    )
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    marked = left.join(F.broadcast(hot), key, "left").withColumns({
        "_salt": F.when(settled, salt_of(*left.columns)).otherwise(F.lit(0)),
        "_key": F.when(~settled, F.col(key)),
    })
    answer = F.coalesce("_answer", "_other")
    return marked.join(cold, ["_key", "_salt"], "left").select(
        *left.columns, *[answer[c].alias(c) for c in added]
    )


def pick_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    last: bool = False,
) -> DataFrame:
    """One row per key: the first (or last) in ``order``.

    An aggregate, not a window, so each map task keeps one candidate per key and a
    key with a third of the rows costs no more than any other. ``order`` entries
    must be NULL-free and comparable.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = F.max_by(row, rank) if last else F.min_by(row, rank)
    picked = df.groupBy(*keys).agg(best.alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
