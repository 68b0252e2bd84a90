import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from quadrille.operators import practice, ranks, score


def test_percent_ranks_match_the_window_in_both_forms(spark):
    random.seed(5)
    data = [(i, random.choice([0, 0, 0, 1, 2]), random.randint(0, 400)) for i in range(1500)]
    df = spark.createDataFrame(data, "model_id INT, a INT, b INT")
    signals = {"pa": F.col("a"), "pb": F.col("b")}
    want = sorted(map(tuple, ranks.percent_ranks_small(df, signals).collect()))
    for bound in (0, 10_000):
        got = sorted(map(tuple, ranks.percent_ranks(df, signals, bound).collect()))
        assert got == want


def test_percent_rank_of_one_row_is_zero(spark):
    df = spark.createDataFrame([(1, 7)], "model_id INT, a INT")
    assert ranks.percent_ranks(df, {"p": F.col("a")}).first()["p"] == 0.0


def test_group_medians_match_brute_force(spark):
    random.seed(6)
    data = [(random.choice("xxxxy"), random.randint(0, 50) / 4) for _ in range(999)]
    df = spark.createDataFrame(data, "g STRING, v DOUBLE")
    want = {g: median([v for k, v in data if k == g]) for g in "xy"}
    for bound in (0, 10_000):
        runs = ranks.running_counts(df, ["g"], "v", bound)
        assert {r["g"]: r["total"] for r in runs.collect()} == {
            g: sum(k == g for k, _ in data) for g in "xy"
        }
    assert {r["g"]: r["m"] for r in ranks.group_medians(df, ["g"], "v", "m").collect()} == want


def _signals(spark, rows, names=("downloads", "likes", "fine_tune_fan_out")):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "model_id INT, " + ", ".join(f"{n} INT" for n in names)
    )


def test_rescore_range_and_weights(spark):
    df = _signals(spark, [(0, 0, 0), (100, 5, 0), (1000, 2, 1), (50000, 300, 9)])
    got = {r["model_id"]: r["composite_success_score"] for r in score.rescore(df).collect()}
    assert got[3] == 1.0 and got[0] == 0.0 and all(0 <= v <= 1 for v in got.values())
    tied = score.rescore(_signals(spark, [(5, 5, 1), (5, 5, 9)])).collect()
    assert max(r["composite_success_score"] for r in tied) == 0.1


def test_rescore_reads_names_in_any_case_and_reports_missing(spark):
    upper = _signals(spark, [(1, 1, 1), (2, 2, 2)], ("DOWNLOADS", "LIKES", "FINE_TUNE_FAN_OUT"))
    assert max(r["composite_success_score"] for r in score.rescore(upper).collect()) == 1.0
    with pytest.raises(KeyError):
        score.rescore(spark.createDataFrame([(1, 1)], "downloads INT, likes INT"))


def _scored(spark, rows):
    return spark.createDataFrame(
        rows, "model_id STRING, base_model STRING, composite_success_score DOUBLE"
    )


def test_score_vs_base(spark):
    models = _scored(spark, [("a1", "A", 0.6), ("a2", "A", 0.8), ("b1", "B", 0.2), ("n", None, 0.4)])
    got = {r["model_id"]: round(r["score_vs_base"], 6) for r in score.score_vs_base(models).collect()}
    assert got == {"a1": -0.1, "a2": 0.1, "b1": 0.0, "n": -0.1}
    one = _scored(spark, [("x", "UNSEEN", 0.9), ("y", "A", 0.6)])
    got = {
        r["model_id"]: round(r["score_vs_base"], 6)
        for r in score.score_vs_base(one, models.filter("base_model = 'A'")).collect()
    }
    assert got == {"x": 0.2, "y": -0.1}


def _options(spark):
    rows = [(f"g{i}", "B", 0.9, "good") for i in range(3)]
    rows += [(f"b{i}", "B", 0.1, "bad") for i in range(3)] + [("r0", "B", 0.95, "rare")]
    df = spark.createDataFrame(
        rows, "model_id STRING, base_model STRING, composite_success_score DOUBLE, optimizer STRING"
    )
    return df.select("model_id", "optimizer"), df.drop("optimizer")


def test_quadrants(spark):
    params, outcomes = _options(spark)
    got = {r["param_value"]: r for r in practice.practice_stats(params, outcomes).collect()}
    assert {k: r["quadrant"] for k, r in got.items()} == {
        "good": "common+works", "bad": "common+fails", "rare": "rare+works",
    }
    assert got["good"]["sample_ok"] and not got["rare"]["sample_ok"]
    assert got["good"]["score_lift"] > 0 > got["bad"]["score_lift"]


def test_quadrants_against_a_reference_population(spark):
    params, outcomes = _options(spark)
    peers = _scored(spark, [("p1", "B", 0.95), ("p2", "B", 0.95)])
    stats = practice.practice_stats(params, outcomes, reference=peers).collect()
    got = {r["param_value"]: r["avg_score_vs_base"] for r in stats}
    assert got["good"] == -0.05 and got["rare"] == 0.0


def test_long_form_renders_promoted_values_once_per_value(spark, rows):
    df = spark.createDataFrame(
        [("a", 48.0, 1.0, None), ("b", 16.0, 0.0, 0.05)],
        "model_id STRING, lora_alpha DOUBLE, fp16 DOUBLE, lora_dropout DOUBLE",
    )
    assert rows(practice.long_form(df)) == [
        ("a", "fp16", "true"), ("a", "lora_alpha", "48"), ("b", "fp16", "false"),
        ("b", "lora_alpha", "16"), ("b", "lora_dropout", "0.05"),
    ]
