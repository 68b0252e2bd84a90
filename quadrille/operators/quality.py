"""Expectations on tables, checked in one aggregate per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions import vocab


@dataclass(frozen=True)
class Expectation:
    """One check. ``kind`` is min_rows, not_null, unique, in_set or between."""

    kind: str
    column: str | None = None
    values: tuple = field(default=())
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})" if self.column else self.kind


def min_rows(n: int) -> Expectation:
    return Expectation("min_rows", low=n)


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def unique(column: str) -> Expectation:
    return Expectation("unique", column)


def in_set(column: str, values: Sequence) -> Expectation:
    return Expectation("in_set", column, tuple(values))


def between(column: str, low: float, high: float) -> Expectation:
    return Expectation("between", column, (), low, high)


class QualityError(RuntimeError):
    """Raised by :func:`gate`; carries the failed checks."""


def _observed(check: Expectation) -> Column:
    """Rows that break the check (for min_rows: the row count)."""
    c = F.col(check.column) if check.column else None
    if check.kind == "min_rows":
        return F.count(F.lit(1))
    if check.kind == "not_null":
        return F.count_if(c.isNull())
    if check.kind == "in_set":
        return F.count_if(c.isNotNull() & ~c.isin(*check.values))
    return F.count_if((c < check.low) | (c > check.high))


def check_table(df: DataFrame, table: str, checks: Sequence[Expectation]) -> DataFrame:
    """(table, expectation, observed, success) of every check.

    All checks but ``unique`` share a single aggregate over the columns they name. A
    unique check counts the surplus rows per value, NULLs aside: first per value in the
    map tasks, then over the counts, so no value is ever expanded or collected.
    """
    plain = [c for c in checks if c.kind != "unique"]
    results = []
    if plain:
        row = df.agg(*[
            F.struct(
                F.lit(c.name).alias("expectation"),
                _observed(c).cast("bigint").alias("observed"),
                F.lit(c.kind == "min_rows").alias("_floor"),
                F.lit(int(c.low or 0) if c.kind == "min_rows" else 0).alias("_low"),
            ).alias(f"c{i}")
            for i, c in enumerate(plain)
        ])
        results.append(
            row.select(F.explode(F.array(*[f"c{i}" for i in range(len(plain))])).alias("c"))
            .select(
                "c.expectation",
                "c.observed",
                F.when(F.col("c._floor"), F.col("c.observed") >= F.col("c._low"))
                .otherwise(F.col("c.observed") == 0)
                .alias("success"),
            )
        )
    for check in checks:
        if check.kind == "unique":
            # Long texts meet as digests: the values themselves are not shuffled.
            value = F.col(check.column)
            if df.schema[check.column].dataType.simpleString() == "string":
                value = F.struct(F.sha2(value, 256), F.octet_length(value))
            counts = df.filter(F.col(check.column).isNotNull()).groupBy(value.alias("_value")).count()
            surplus = F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint")
            results.append(
                counts.agg(surplus.alias("observed")).select(
                    F.lit(check.name).alias("expectation"),
                    "observed",
                    (F.col("observed") == 0).alias("success"),
                )
            )
    merged = results[0]
    for more in results[1:]:
        merged = merged.unionByName(more)
    return merged.select(F.lit(table).alias("table_name"), "expectation", "observed", "success")


_CONFIDENCE = between("confidence", 0.0, 1.0)
_PARAM_RANGES = (
    between("rank_value", -1, 512),
    between("lora_alpha", 1, 1024),
    between("extraction_confidence", 0.0, 1.0),
)

# The gate in front of the warehouse load.
BRONZE_SUITES: dict[str, tuple[Expectation, ...]] = {
    "github_repos_bronze": (not_null("repo_id"),),
    "github_repos_enriched": (
        min_rows(1000),
        not_null("repo_id"),
        unique("repo_id"),
        in_set("enrichment_status", ("ok", "not_found", "error", "radio_lora")),
    ),
    "huggingface_models_bronze": (
        min_rows(1000),
        not_null("model_id"),
        unique("model_id"),
        in_set("collection_source", ("organic", "targeted_lora")),
    ),
    "github_hf_links": (
        not_null("repo_full_name"),
        not_null("model_id"),
        in_set("link_type", vocab.LINK_TYPES),
        _CONFIDENCE,
    ),
    "github_files": (
        not_null("repo_full_name"),
        not_null("file_path"),
        not_null("file_sha"),
        in_set("file_category", vocab.CATEGORY_ORDER),
    ),
    "lora_configs_raw": (
        not_null("repo_full_name"),
        not_null("file_id"),
        not_null("param_name"),
        in_set("source", tuple(vocab.SOURCE_PRIORITY)),
        _CONFIDENCE,
    ),
    "repo_lora_params": (not_null("repo_full_name"), *_PARAM_RANGES),
    "hf_models_lora_params": (not_null("model_id"), *_PARAM_RANGES),
}

# Checks of the built tables.
MODEL_SUITES: dict[str, tuple[Expectation, ...]] = {
    "stg_github_repos": (unique("repo_id"), not_null("repo_id"), not_null("repo_name")),
    "stg_hf_models": (unique("model_id"), not_null("model_id")),
    "repos": (unique("repo_id"), not_null("repo_id")),
    "hf_models": (unique("model_id"), not_null("model_id")),
    "silver_github_hf_links": (not_null("repo_full_name"), not_null("model_id")),
    "silver_lora_configs_raw": (
        unique("config_id"), not_null("config_id"), not_null("repo_full_name"),
        not_null("source"),
    ),
    "silver_hf_models_lora_params": (unique("model_id"), not_null("model_id")),
    "repos_needing_llm_extraction": (unique("repo_full_name"), not_null("repo_full_name")),
    "hf_model_tree": (unique("base_model"), not_null("base_model")),
    "gold_repo_lora_params": (unique("repo_full_name"), not_null("repo_full_name")),
    "repo_lora_outcomes": (
        unique("model_id"), not_null("model_id"), not_null("composite_success_score"),
    ),
    "lora_practice_stats": (
        not_null("param_name"),
        not_null("avg_score_vs_base"),
        not_null("quadrant"),
        in_set("quadrant", vocab.QUADRANTS),
    ),
}


def run_suites(
    tables: Mapping[str, DataFrame], suites: Mapping[str, Sequence[Expectation]], spark: SparkSession | None = None
) -> DataFrame:
    """Results of all suites. A suite whose table is absent fails with one row, ``table_present``;
    ``spark`` is needed only where no table at all is there."""
    spark = spark or next((t.sparkSession for t in tables.values()), None) or SparkSession.getActiveSession()
    absent = [(name, "table_present", 0, False) for name in suites if name not in tables]
    merged = spark.createDataFrame(absent, "table_name string, expectation string, observed bigint, success boolean")
    for name, checks in suites.items():
        if name in tables:
            found = check_table(tables[name], name, checks)
            merged = found.unionByName(merged)
    return merged


def gate(results: DataFrame) -> None:
    """Raise when any check failed. There is one row per check, whatever the data."""
    failed = results.filter(~F.col("success")).collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r.table_name}: {r.expectation} observed {r.observed}" for r in failed)
        )
