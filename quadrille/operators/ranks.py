"""Exact ranks and medians without pulling a whole ordering into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.operators.skew import BROADCAST_ROWS, at_most, lookup_join
from quadrille.session import cut_lineage


def running_counts(
    df: DataFrame, group: Sequence[str], value: str, one_task_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Per group and distinct value: ``rows``, rows ``before`` it, group ``total``.

    Rows are first counted per (group, value), so ties of any size become one row.
    When few distinct values are left, a window per group sums them up. Otherwise they
    are range-partitioned: the partition number is kept as a column and written out, so
    a lost executor cannot move a value to another partition, each partition sums its
    own run, and the totals per partition and group supply the offsets.
    """
    group = list(group)
    counted = cut_lineage(df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("rows")))
    run = (Window.unboundedPreceding, Window.currentRow)
    if at_most(counted, one_task_rows):
        whole = Window.partitionBy(*group)
        upto = F.sum("rows").over(whole.orderBy(value).rowsBetween(*run))
        return counted.select(
            *group,
            value,
            "rows",
            (upto - F.col("rows")).alias("before"),
            F.sum("rows").over(whole).alias("total"),
        )
    laid_out = cut_lineage(
        counted.repartitionByRange(*group, value).withColumn("_part", F.spark_partition_id())
    )
    runs = laid_out.groupBy(*group, "_part").agg(F.sum("rows").alias("_run"))
    parts = Window.partitionBy(*group)
    offsets = runs.select(
        *group,
        "_part",
        (F.sum("_run").over(parts.orderBy("_part").rowsBetween(*run)) - F.col("_run")).alias(
            "_offset"
        ),
        F.sum("_run").over(parts).alias("total"),
    )
    inside = Window.partitionBy(*group, "_part").orderBy(value).rowsBetween(*run)
    renamed = offsets.withColumnsRenamed({g: f"_o_{g}" for g in [*group, "_part"]})
    same = F.lit(True)
    for name in (*group, "_part"):
        # NULL is a group like any other.
        same = same & F.col(name).eqNullSafe(F.col(f"_o_{name}"))
    return (
        laid_out.withColumn("_upto", F.sum("rows").over(inside))
        .join(renamed, same)
        .select(
            *group,
            value,
            "rows",
            (F.col("_offset") + F.col("_upto") - F.col("rows")).alias("before"),
            "total",
        )
    )


def percent_ranks(
    df: DataFrame, signals: Mapping[str, Column], one_task_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``<name>`` = (rank - 1) / (n - 1) of each signal over the whole frame.

    ``signals`` maps the new column's name to the (never NULL) value to rank. All
    signals are ranked in one pass over (signal, value) counts. A population of one
    gets 0.0.
    """
    names = list(signals)
    prepared = df.select("*", *[v.cast("double").alias(f"_v_{n}") for n, v in signals.items()])
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(i).alias("signal"), F.col(f"_v_{n}").alias("value"))
            for i, n in enumerate(names)
        ])
    )
    long = prepared.select(pairs.alias("p")).select("p.signal", "p.value")
    ranked = cut_lineage(
        running_counts(long, ["signal"], "value", one_task_rows).select(
            "signal",
            "value",
            "rows",
            F.when(F.col("total") <= 1, F.lit(0.0))
            .otherwise(F.col("before") / (F.col("total") - 1))
            .alias("_pct"),
        )
    )
    for i, name in enumerate(names):
        one = ranked.filter(F.col("signal") == i).select(
            F.col("value").alias(f"_v_{name}"), "rows", F.col("_pct").alias(name)
        )
        prepared = lookup_join(prepared, one, f"_v_{name}")
    return prepared.select(*df.columns, *names)


def percent_ranks_small(df: DataFrame, signals: Mapping[str, Column]) -> DataFrame:
    """The plain window form of :func:`percent_ranks`, for frames that fit one task."""
    ranked = {
        n: F.percent_rank().over(Window.orderBy(v.cast("double"))) for n, v in signals.items()
    }
    return df.select("*", *[c.alias(n) for n, c in ranked.items()])


def group_medians(
    df: DataFrame, group: Sequence[str], value: str, name: str, one_task_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Interpolated median of ``value`` per group (NULL is one), exact for groups of any size."""
    group = list(group)
    runs = running_counts(df.filter(F.col(value).isNotNull()), group, value, one_task_rows)
    low = F.floor((F.col("total") - 1) / 2)
    high = F.floor(F.col("total") / 2)
    covers = lambda at: (F.col("before") <= at) & (at < F.col("before") + F.col("rows"))
    return (
        runs.groupBy(*group)
        .agg(
            F.max(F.when(covers(low), F.col(value).cast("double"))).alias("_low"),
            F.max(F.when(covers(high), F.col(value).cast("double"))).alias("_high"),
        )
        .select(*group, ((F.col("_low") + F.col("_high")) / 2).alias(name))
    )
