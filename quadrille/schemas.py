"""Explicit schemas of the bronze tables, one DDL string each."""

from __future__ import annotations

from pyspark.sql import types as T

_PARAM_COLUMNS = """
    rank_value INT, lora_alpha INT, target_modules STRING, learning_rate DOUBLE,
    optimizer STRING, lora_dropout DOUBLE, lora_bias STRING, scheduler STRING,
    batch_size INT, gradient_accumulation_steps INT, num_train_epochs INT,
    warmup_steps INT, bf16 BOOLEAN, fp16 BOOLEAN, gradient_checkpointing BOOLEAN,
    merge_and_unload BOOLEAN, param_sources STRING, total_params_extracted INT,
    extraction_confidence DECIMAL(3,2), extracted_at TIMESTAMP_NTZ
"""

BRONZE_DDL = {
    # One row per repository: activity counts of an older collection.
    "github_repos_bronze": """
        repo_id BIGINT, repo_name STRING, first_seen_at TIMESTAMP_NTZ,
        last_seen_at TIMESTAMP_NTZ, star_count INT, fork_count INT, event_count INT
    """,
    # One row per repository: the corpus root.
    "github_repos_enriched": """
        repo_id BIGINT, repo_name STRING, description STRING, primary_language STRING,
        topics STRING, license STRING, open_issues_count INT, readme_content STRING,
        readme_length INT, dependencies STRING, repo_created_at TIMESTAMP_NTZ,
        repo_size_kb INT, has_tests BOOLEAN, has_ci BOOLEAN, contributors_count INT,
        commit_count_30d INT, is_fork BOOLEAN, is_archived BOOLEAN,
        pushed_at TIMESTAMP_NTZ, forks_count INT, subscribers_count INT, homepage STRING,
        enriched_at TIMESTAMP_NTZ, enrichment_status STRING
    """,
    # One row per published model.
    "huggingface_models_bronze": """
        model_id STRING, author STRING, base_model STRING, pipeline_tag STRING,
        library_name STRING, downloads INT, likes INT, tags STRING, card_content STRING,
        created_at TIMESTAMP_NTZ, last_modified TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ,
        collection_source STRING, is_lora_relevant BOOLEAN
    """,
    # What was embedded and when.
    "github_repos_embedded": """
        repo_id BIGINT, repo_name STRING, model STRING, embedded_at TIMESTAMP_NTZ
    """,
    "hf_models_embedded": "model_id STRING, model STRING, embedded_at TIMESTAMP_NTZ",
    # One row per (repository, model, strategy).
    "github_hf_links": """
        link_id BIGINT, repo_full_name STRING, model_id STRING, link_type STRING,
        confidence DECIMAL(3,2), matched_text STRING, created_at TIMESTAMP_NTZ
    """,
    # One row per (repository, path).
    "github_files": """
        file_id BIGINT, repo_full_name STRING, file_path STRING, file_category STRING,
        file_sha STRING, file_size INT, content STRING, truncated BOOLEAN,
        fetched_at TIMESTAMP_NTZ
    """,
    # One row per (repository, file, source, parameter).
    "lora_configs_raw": """
        config_id BIGINT, repo_full_name STRING, file_id BIGINT, source STRING,
        param_name STRING, param_value STRING, confidence DECIMAL(3,2),
        extracted_at TIMESTAMP_NTZ
    """,
    # One row per repository / model with any parameter.
    "repo_lora_params": f"repo_full_name STRING, {_PARAM_COLUMNS}",
    "hf_models_lora_params": f"model_id STRING, {_PARAM_COLUMNS}",
    # Discovery logs.
    "lora_search_discovery": """
        repo_id BIGINT, repo_name STRING, search_source STRING, search_query STRING,
        discovered_at TIMESTAMP_NTZ, enriched BOOLEAN
    """,
    "hf_lora_search_discovery": """
        model_id STRING, search_query STRING, discovered_at TIMESTAMP_NTZ, ingested BOOLEAN
    """,
}


def bronze_schema(name: str) -> T.StructType:
    """Schema of a bronze table (parsing DDL needs a running session)."""
    return T.StructType.fromDDL(BRONZE_DDL[name])


# The tables a full warehouse load replaces.
WAREHOUSE_TABLES = (
    "github_repos_bronze", "github_repos_enriched", "huggingface_models_bronze",
    "github_repos_embedded", "github_hf_links", "github_files", "lora_configs_raw",
    "repo_lora_params", "hf_models_lora_params",
)

PATH_TREE = "repo STRING, ord INT, path STRING, type STRING, sha STRING"

ACTIVITY_EVENT = (
    "type STRING, repo STRUCT<name: STRING, topics: ARRAY<STRING>>, "
    "payload STRUCT<commits: ARRAY<STRUCT<message: STRING>>>"
)
