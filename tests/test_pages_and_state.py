import pytest

from quadrille.operators import explore, quality
from quadrille.streaming import arrivals


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_after_a_row_are_the_pages_by_offset(spark, order):
    rows = [(f"p{i % 4}", str(i), None if i % 5 == 0 else float(i % 3)) for i in range(47)]
    df = spark.createDataFrame(rows, "a string, b string, score double").repartition(3)
    for limit in (1, 7, 47, 60):
        if limit == 1 and order == "asc":
            continue
        got = [tuple(r) for _, page in explore.pages(df, "score", order, ["a", "b"], limit) for r in page]
        by = df["score"].asc_nulls_last() if order == "asc" else df["score"].desc_nulls_last()
        assert got == [tuple(r) for r in df.orderBy(by, "a", "b").collect()]
    assert list(explore.pages(df.limit(0), "score", order, ["a", "b"], 5)) == []
    with pytest.raises(ValueError):
        explore.page_after(df, "score", "up", ["a", "b"], None, 5)


def test_a_suite_without_its_table_fails(spark):
    suites = {"here": (quality.not_null("x"),), "gone": (quality.not_null("y"),)}
    here = spark.createDataFrame([(1,)], "x int")
    found = {r.table_name: (r.expectation, r.success) for r in quality.run_suites({"here": here}, suites).collect()}
    assert found["gone"] == ("table_present", False) and found["here"][1]
    with pytest.raises(quality.QualityError, match="gone"):
        quality.gate(quality.run_suites({"here": here}, suites))
    with pytest.raises(quality.QualityError):
        quality.gate(quality.run_suites({}, suites, spark))
    quality.gate(quality.run_suites({"here": here}, {"here": suites["here"]}))


def test_unchanged_contents_are_not_passed_on_across_batches_and_restarts(spark, tmp_path):
    schema = "repo string, path string, at int, sha string"
    batches = [
        [("r", "f", 1, "a"), ("r", "f", 2, "a"), ("r", "g", 1, ""), ("r", "h", 1, None)],
        [("r", "f", 3, "a"), ("r", "g", 2, ""), ("r", "g", 3, "x"), ("r", "h", 2, "y"), ("s", "f", 1, "a")],
        [("r", "f", 5, "a"), ("r", "f", 4, "b"), ("r", "g", 4, "x"), ("r", "h", 3, "y")],
    ]
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = arrivals.arriving(spark, str(tmp_path / "in"), schema)
        changed = arrivals.changed_contents(stream, ["repo", "path"], "sha", ["at"])
        arrivals.append_stream(changed, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
        now = sorted((r.repo, r.path, r.at) for r in arrivals.stored_batches(spark, str(tmp_path / "out")).collect())
        seen.append([r for r in now if all(r not in old for old in seen)])
    assert seen == [
        [("r", "f", 1), ("r", "g", 1), ("r", "h", 1)],
        [("r", "g", 2), ("r", "g", 3), ("r", "h", 2), ("s", "f", 1)],
        [("r", "f", 4), ("r", "f", 5)],
    ]
