"""Outcome score: blended percentile ranks, and the score against same-base peers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.functions.text import sql_round
from quadrille.operators.ranks import percent_ranks
from quadrille.operators.skew import lookup_join, skew_join
from quadrille.session import cut_lineage

# Signal column -> name of its percentile column.
PERCENTILES = {
    "downloads": "downloads_pct",
    "likes": "likes_pct",
    "fine_tune_fan_out": "fan_out_pct",
}


def rescore(
    df: DataFrame,
    weights: Mapping[str, float] = vocab.WEIGHTS,
    round_first: bool = True,
) -> DataFrame:
    """Add the three percentiles and their weighted blend to any frame.

    Missing signal values rank as 0. ``round_first`` blends the rounded percentiles;
    the warehouse score blends the exact ones.
    """
    present = {c.lower() for c in df.columns}
    missing = [s for s in PERCENTILES if s not in present]
    if missing:
        raise KeyError(f"missing required columns: {missing}")
    signals = {
        pct: F.coalesce(F.col(signal), F.lit(0)) for signal, pct in PERCENTILES.items()
    }
    ranked = percent_ranks(df, signals)
    blend = sum(
        (
            F.lit(weights[signal])
            * (sql_round(F.col(pct), 4) if round_first else F.col(pct))
            for signal, pct in PERCENTILES.items()
        ),
        start=F.lit(0.0),
    )
    return ranked.select(
        *df.columns,
        *[sql_round(F.col(pct), 4).alias(pct) for pct in signals],
        sql_round(blend, 4).alias("composite_success_score"),
    )


def outcome_scores(models: DataFrame, tree: DataFrame) -> DataFrame:
    """Score of every relevant model among all relevant models."""
    fan_out = tree.select(
        F.col("base_model").alias("model_id"),
        F.col("fine_tune_count").alias("fine_tune_fan_out"),
    )
    population = (
        models.filter("is_lora_relevant")
        .select(
            "model_id", "author", "base_model", "pipeline_tag", "library_name",
            "downloads", "likes", "is_fine_tune",
        )
        .join(fan_out, "model_id", "left")
        .withColumn("fine_tune_fan_out", F.coalesce("fine_tune_fan_out", F.lit(0)))
    )
    return rescore(population, round_first=False).select(
        "model_id", "author", "base_model", "pipeline_tag", "library_name", "downloads",
        "likes", "fine_tune_fan_out", "is_fine_tune", *PERCENTILES.values(),
        "composite_success_score",
    )


def score_vs_base(models: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Add ``score_vs_base``: a model's score minus the mean of its base model's models.

    The means come from ``reference`` (default: the models themselves); a NULL or
    unseen base is measured against the overall mean.
    """
    score = F.col("composite_success_score")
    peers = models if reference is None else reference
    sums = cut_lineage(
        peers.groupBy("base_model").agg(
            F.avg(score).alias("_peer_mean"),
            F.sum(score).alias("_sum"),
            F.count(score).alias("rows"),
        )
    )
    overall = sums.agg(F.sum("_sum") / F.sum("rows")).scalar()
    means = sums.filter(F.col("base_model").isNotNull()).select("base_model", "rows", "_peer_mean")
    if reference is None:
        joined = lookup_join(models, means, "base_model")
    else:
        # The counts are of other rows: the hot bases are those of the models themselves.
        joined = skew_join(models, means.drop("rows"), ["base_model"], "left")
    return joined.select(
        *models.columns,
        (score - F.coalesce(F.col("_peer_mean"), overall)).alias("score_vs_base"),
    )
