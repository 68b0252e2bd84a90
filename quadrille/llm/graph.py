"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import staged


def _least(pairs: DataFrame) -> DataFrame:
    """Each node with its smallest neighbour, itself included."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("m")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the component's smallest node.

    Large-star and small-star turns (Kiveris et al. 2014): each moves edges to smaller
    neighbours by joins on a node, so no component is ever gathered in one place. A turn's
    edges are written to the shared folder; the turns end when nothing changes, after about
    the logarithm of the longest path.
    """
    now = staged(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both)
        large = both.filter("v > u").join(least, F.col("u") == F.col("node")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).distinct()
        # large holds (node, smaller node); the small star hangs those below the smallest of them.
        lower = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "node")
        small = (
            large.join(lower, F.col("u") == F.col("node"))
            .select(F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct()
        )
        now = staged(small)
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
