"""Tables laid out for point lookups: sorted by key, with bloom filters over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Bytes of a row group: a lookup reads the pages of one or two of them.
GROUP_BYTES = 16 << 20


def write_sorted(df: DataFrame, path: str, key: str, group_bytes: int = GROUP_BYTES) -> None:
    """``df`` in ranges of ``key``, sorted, with a bloom filter over the key per row group.

    Ranges of the key are files, so its smallest and largest values tell files and row groups apart,
    and inside a group the column index tells pages apart. The bloom filter spares the groups
    whose range a key lies in without being there. A hot key fills several files.
    """
    ranged = df.repartitionByRange(df[key]).sortWithinPartitions(key)
    ranged.write.mode("overwrite").option("parquet.block.size", group_bytes).option(
        f"parquet.bloom.filter.enabled#{key}", "true"
    ).option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path)


def sorted_mart(df: DataFrame, path: str, key: str, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``df`` written by :func:`write_sorted` and read back; an equality on ``key`` reaches its scan."""
    write_sorted(df, path, key, group_bytes)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_scanned(df: DataFrame) -> int:
    """Runs ``df``; how many rows its file scans gave out. Adaptive execution must be off."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    total, left = 0, [plan]
    while left:
        node = left.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return total
