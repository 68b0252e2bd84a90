"""Staging, silver and gold tables as plain DataFrame functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.functions.text import json_length
from quadrille.operators.practice import practice_stats
from quadrille.operators.score import outcome_scores
from quadrille.session import cut_lineage


def _timestamps(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names if n in df.columns})


# --- staging -----------------------------------------------------------------------


def staged_repos(enriched: DataFrame, legacy: DataFrame) -> DataFrame:
    """Every enriched repository with the activity counts an older collection left."""
    counts = _timestamps(legacy, "first_seen_at", "last_seen_at").drop("repo_name", "id")
    kept = enriched.drop("id", "readme_content", "dependencies")
    return _timestamps(kept, "repo_created_at", "pushed_at", "enriched_at").join(
        counts, "repo_id", "left"
    )


def staged_models(bronze: DataFrame) -> DataFrame:
    return _timestamps(bronze.drop("id", "card_content"), "created_at", "last_modified", "ingested_at")


# --- silver ------------------------------------------------------------------------


def silver_repos(staged: DataFrame) -> DataFrame:
    """``is_enriched`` stays NULL where the status is NULL."""
    return staged.withColumn("is_enriched", F.col("enrichment_status") == "ok")


def silver_models(staged: DataFrame) -> DataFrame:
    return staged.drop("ingested_at").withColumns({
        "tag_count": json_length(F.col("tags")),
        "is_fine_tune": F.col("base_model").isNotNull(),
        "is_lora_relevant": F.coalesce(F.col("is_lora_relevant").cast("int"), F.lit(0)) == 1,
    })


def collapsed_links(links: DataFrame) -> DataFrame:
    """One row per (repository, model): best confidence and all strategies, in order.

    Links are first reduced to one row per pair and strategy, whatever strategies there are.
    """
    per_type = links.groupBy("repo_full_name", "model_id", "link_type").agg(
        F.max("confidence").cast("double").alias("best"), F.max("created_at").alias("last")
    )
    return per_type.groupBy("repo_full_name", "model_id").agg(
        F.max("best").alias("best_confidence"),
        F.array_join(F.sort_array(F.collect_list("link_type")), ",").alias("link_types"),
        F.max("last").alias("last_linked_at"),
    )


def silver_links(links: DataFrame, repos: DataFrame, models: DataFrame) -> DataFrame:
    """Collapsed links with flags and the context of both ends.

    Repositories and models are unique, so a plain join copies nothing; a key with a large
    share of all links is split at run time (adaptive skew join).
    """
    context = repos.select(F.col("repo_name").alias("repo_full_name"), "primary_language")
    facts = models.select("model_id", "base_model", "downloads", "likes")
    flagged = collapsed_links(links).withColumns({
        "is_high_confidence": F.col("best_confidence") >= 0.7,
        "is_signal_confidence": F.col("best_confidence") >= 0.5,
    })
    with_repo = flagged.join(context, "repo_full_name", "left")
    return with_repo.join(facts, "model_id", "left").select(
        "repo_full_name", "model_id", "best_confidence", "link_types", "last_linked_at",
        "is_high_confidence", "is_signal_confidence", "primary_language", "base_model",
        "downloads", "likes",
    )


def silver_raw_configs(raw: DataFrame) -> DataFrame:
    return raw.select(
        "config_id", "repo_full_name", "file_id", "source", "param_name", "param_value",
        "confidence", "extracted_at",
    )


def silver_model_params(params: DataFrame, models: DataFrame) -> DataFrame:
    context = models.select(
        "model_id", "base_model", "pipeline_tag", "library_name", "downloads", "likes"
    )
    return params.join(context, "model_id", "left")


def files_per_repo(files: DataFrame) -> DataFrame:
    of = lambda category: F.count_if(F.col("file_category") == category)
    return files.groupBy("repo_full_name").agg(
        F.count(F.lit(1)).alias("file_count"),
        of("training_script").alias("training_scripts"),
        of("config").alias("config_files"),
        of("adapter_config").alias("adapter_configs"),
        F.sum("file_size").alias("total_bytes"),
        F.max("fetched_at").alias("files_last_fetched"),
    )


def repos_needing_fallback(files: DataFrame, params: DataFrame, repos: DataFrame) -> DataFrame:
    """Repositories with files but no extracted parameters (their key is never NULL)."""
    context = repos.select(
        F.col("repo_name").alias("repo_full_name"), "primary_language", "star_count",
        "contributors_count",
    )
    return (
        files_per_repo(files)
        .join(params.select("repo_full_name"), "repo_full_name", "left_anti")
        .join(context, "repo_full_name", "left")
    )


# --- gold --------------------------------------------------------------------------


def children_of(models: DataFrame) -> DataFrame:
    """(parent, child) edges; a model that names itself is not its own child."""
    return models.filter(
        F.col("base_model").isNotNull() & (F.col("model_id") != F.col("base_model"))
    )


def tree_counts(models: DataFrame) -> DataFrame:
    return children_of(models).groupBy("base_model").agg(
        F.count(F.lit(1)).alias("fine_tune_count"),
        F.sum("downloads").alias("total_downloads"),
        F.sum("likes").alias("total_likes"),
    )


def tree_edges(models: DataFrame) -> DataFrame:
    """A row per (parent, child): a list of children of any length, without collecting it."""
    return children_of(models).select("base_model", "model_id")


def ordered_fallback(targets: DataFrame) -> DataFrame:
    """The repositories that need the fallback, most training scripts and files first."""
    return targets.orderBy(F.desc("training_scripts"), F.desc("file_count"), "repo_full_name")


def gold_repo_params(params: DataFrame, repos: DataFrame) -> DataFrame:
    context = repos.select(
        F.col("repo_name").alias("repo_full_name"), "primary_language", "star_count",
        "contributors_count", "has_tests", "has_ci",
    )
    return params.join(context, "repo_full_name", "left")


# --- the whole warehouse -----------------------------------------------------------

# Friendly mart name -> key in the dict that build_all returns.
MARTS = {
    "outcomes": "repo_lora_outcomes",
    "practice_stats": "lora_practice_stats",
    "repo_lora_params": "gold_repo_lora_params",
    "hf_model_tree": "hf_model_tree",
    "hf_model_tree_edges": "hf_model_tree_edges",
    "hf_models_lora_params": "silver_hf_models_lora_params",
    "repos": "repos",
    "hf_models": "hf_models",
    "github_hf_links": "silver_github_hf_links",
    "repos_needing_llm": "repos_needing_llm_extraction",
    "github_files": "github_files",
}


def build_all(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every table from bronze, staging first; one function call per table."""
    built: dict[str, DataFrame] = {}
    built["stg_github_repos"] = staged_repos(
        bronze["github_repos_enriched"], bronze["github_repos_bronze"]
    )
    built["stg_hf_models"] = staged_models(bronze["huggingface_models_bronze"])
    repos = built["repos"] = silver_repos(built["stg_github_repos"])
    models = built["hf_models"] = silver_models(built["stg_hf_models"])
    built["silver_github_hf_links"] = silver_links(bronze["github_hf_links"], repos, models)
    built["silver_lora_configs_raw"] = silver_raw_configs(bronze["lora_configs_raw"])
    params = built["silver_hf_models_lora_params"] = silver_model_params(
        bronze["hf_models_lora_params"], models
    )
    built["repos_needing_llm_extraction"] = repos_needing_fallback(
        bronze["github_files"], bronze["repo_lora_params"], repos
    )
    built["gold_repo_lora_params"] = gold_repo_params(bronze["repo_lora_params"], repos)
    built["hf_model_tree"] = tree_counts(models)
    built["hf_model_tree_edges"] = tree_edges(models)
    # The statistics read the scores several times: go on from the written table.
    outcomes = built["repo_lora_outcomes"] = cut_lineage(
        outcome_scores(models, tree_counts(models))
    )
    built["lora_practice_stats"] = practice_stats(params, outcomes, vocab.PRACTICE_PARAMS)
    built["github_files"] = bronze["github_files"]
    return built


class Marts:
    """Finished marts by friendly name."""

    def __init__(self, built: Mapping[str, DataFrame]):
        self._built = built

    def load(self, name: str, limit: int | None = None) -> DataFrame:
        if name not in MARTS:
            raise KeyError(f"unknown table {name!r}; options: {sorted(MARTS)}")
        df = self._built[MARTS[name]]
        return df.limit(int(limit)) if limit else df

    def all(self) -> dict[str, DataFrame]:
        return {name: self._built[key] for name, key in MARTS.items()}
