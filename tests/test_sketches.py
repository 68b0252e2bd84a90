from pyspark.sql import functions as F

from quadrille.operators import sketches


def test_merged_deltas_equal_one_summary_within_the_stated_error(spark):
    rows = spark.range(0, 120_000, 1, 6).select(
        (F.col("id") % 40_000).alias("who"), (F.col("id") % 1000).cast("double").alias("value"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 3000 == 0, F.lit("cold")).alias("g"),
        (F.col("id") % 4).alias("day"),
    )
    deltas = sketches.summarize(rows, ["g", "day"], "who", "value")
    merged = sketches.merge(deltas, ["g"]).select(
        "g", "rows", sketches.distinct_count().alias("who"), sketches.quantile(0.5).alias("mid")
    )
    exact = {r.g: r for r in rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("who").alias("who")).collect()}
    values = {g: sorted(r.value for r in rows.filter(F.col("g").eqNullSafe(F.lit(g))).select("value").collect()) for g in exact}
    for r in merged.collect():
        assert r.rows == exact[r.g].rows
        assert abs(r.who - exact[r.g].who) <= 0.03 * exact[r.g].who
        ranked = values[r.g]
        slack = max(1, int(0.015 * len(ranked)))
        assert ranked[max(0, len(ranked) // 2 - slack)] <= r.mid <= ranked[min(len(ranked) - 1, len(ranked) // 2 + slack)]


def test_groups_without_values_and_empty_tables(spark):
    schema = "g string, who string, value double"
    none = spark.createDataFrame([("a", None, None), ("b", "x", 2.0)], schema)
    got = sketches.merge(sketches.summarize(none, ["g"], "who", "value"), ["g"]).select(
        "g", sketches.distinct_count().alias("n"), sketches.quantile(0.5).alias("mid"))
    assert sorted(map(tuple, got.collect())) == [("a", 0, None), ("b", 1, 2.0)]
    empty = sketches.summarize(none.limit(0), ["g"], "who", "value")
    assert sketches.merge(empty, ["g"]).count() == 0
