"""Practice statistics: which parameter values are common or rare, and which work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.functions.text import render_param, sql_round
from quadrille.operators.ranks import group_medians
from quadrille.operators.score import score_vs_base
from quadrille.session import cut_lineage

# Averages are summed in no fixed order; twelve digits are far below any real
# difference and make comparisons with a median repeatable.
STABLE_DIGITS = 12


def long_form(
    params: DataFrame, names: Sequence[str] = vocab.PRACTICE_PARAMS, keep: Sequence[str] = ("model_id",)
) -> DataFrame:
    """One row per (entity, parameter, rendered value), in a single scan."""
    present = [n for n in names if n in params.columns]
    rendered = params.select(*keep, *[render_param(n, F.col(n)).alias(n) for n in present])
    return rendered.unpivot(list(keep), present, "param_name", "param_value").filter(
        F.col("param_value").isNotNull()
    )


def bucket_stats(joined: DataFrame) -> DataFrame:
    """Per (parameter, value): models, mean score and mean score against the base."""
    return joined.groupBy("param_name", "param_value").agg(
        F.countDistinct("model_id").alias("prevalence"),
        F.round(F.avg("composite_success_score"), STABLE_DIGITS).alias("avg_score"),
        F.round(F.avg("score_vs_base"), STABLE_DIGITS).alias("avg_score_vs_base"),
        F.sum("composite_success_score").alias("_score_sum"),
        F.count("composite_success_score").alias("_score_rows"),
    )


def quadrants(buckets: DataFrame, min_sample: int = vocab.MIN_SAMPLE) -> DataFrame:
    """Place each bucket against its parameter's medians; rounding comes last."""
    buckets = cut_lineage(buckets)
    pooled = buckets.groupBy("param_name").agg(
        (F.sum("_score_sum") / F.sum("_score_rows")).alias("_pooled")
    )
    sides = pooled.join(
        group_medians(buckets, ["param_name"], "prevalence", "_common_from"), "param_name"
    ).join(
        group_medians(buckets, ["param_name"], "avg_score_vs_base", "_works_from"), "param_name"
    )
    common = F.when(F.col("prevalence") >= F.col("_common_from"), "common").otherwise("rare")
    works = F.when(
        F.col("avg_score_vs_base") >= F.round("_works_from", STABLE_DIGITS), "works"
    ).otherwise("fails")
    return buckets.join(sides, "param_name").select(
        "param_name",
        "param_value",
        "prevalence",
        sql_round(F.col("avg_score"), 3).alias("avg_success_score"),
        sql_round(F.col("avg_score_vs_base"), 3).alias("avg_score_vs_base"),
        sql_round(
            F.round(F.col("avg_score") - F.col("_pooled"), STABLE_DIGITS), 3
        ).alias("score_lift"),
        (F.col("prevalence") >= min_sample).alias("sample_ok"),
        F.concat_ws("+", common, works).alias("quadrant"),
    )


def practice_stats(
    params: DataFrame,
    outcomes: DataFrame,
    names: Sequence[str] = vocab.PRACTICE_PARAMS,
    min_sample: int = vocab.MIN_SAMPLE,
    reference: DataFrame | None = None,
) -> DataFrame:
    """The quadrant table of ``params`` (one row per model) against scored models.

    Models without a score are left out. ``reference`` supplies the peer means when
    the outcomes are only part of the population.
    """
    scores = score_vs_base(
        outcomes.select("model_id", "base_model", "composite_success_score"), reference
    )
    # Joined while there is one row per model, and unfolded after it: buckets then combine map-side.
    scored = params.join(scores.drop("base_model"), "model_id")
    joined = long_form(scored, names, ("model_id", "composite_success_score", "score_vs_base"))
    return quadrants(bucket_stats(joined), min_sample)
