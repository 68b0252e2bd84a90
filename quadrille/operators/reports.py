"""Counts and top lists over the collected tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    merged = frames[0]
    for more in frames[1:]:
        merged = merged.unionByName(more)
    return merged


def top_groups(df: DataFrame, column: str, k: int, missing: str | None = None) -> DataFrame:
    """The k most frequent values, ties by value."""
    value = F.coalesce(F.col(column), F.lit(missing)) if missing else F.col(column)
    counted = df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), column).limit(k)


def top_of_each(
    df: DataFrame, columns: Sequence[str], k: int = 10, missing: str = "(none)"
) -> DataFrame:
    """The k most frequent values of several columns, counted in one scan.

    Grouping sets count all columns together; the top lists are cut from the counts.
    """
    filled = df.select(*[F.coalesce(F.col(c), F.lit(missing)).alias(c) for c in columns])
    counted = filled.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        F.count(F.lit(1)).alias("n")
    )
    facet = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns])
    long = counted.select(facet.alias("facet"), F.coalesce(*columns).alias("value"), "n")
    return union_all([
        long.filter(F.col("facet") == c).orderBy(F.col("n").desc(), "value").limit(k)
        for c in columns
    ])


# --- links -------------------------------------------------------------------------


def links_by_type(links: DataFrame) -> DataFrame:
    return links.groupBy("link_type").agg(
        F.count(F.lit(1)).alias("links"), F.avg("confidence").alias("avg_confidence")
    )


def distinct_pairs(links: DataFrame) -> DataFrame:
    return links.select("repo_full_name", "model_id").distinct()


def confidence_bucket(confidence: Column) -> Column:
    return (
        F.when(confidence >= 0.95, "0.95-1.0")
        .when(confidence >= 0.85, "0.85-0.95")
        .when(confidence >= 0.70, "0.70-0.85")
        .otherwise("<0.70")
    )


def links_by_confidence(links: DataFrame) -> DataFrame:
    bucket = confidence_bucket(F.col("confidence")).alias("bucket")
    return links.groupBy(bucket).agg(F.count(F.lit(1)).alias("links"))


def most_linked_repos(links: DataFrame, k: int = 20) -> DataFrame:
    return (
        links.groupBy("repo_full_name")
        .agg(F.countDistinct("model_id").alias("models"))
        .orderBy(F.col("models").desc(), "repo_full_name")
        .limit(k)
    )


def ordered_stats(stats: DataFrame) -> DataFrame:
    """The practice statistics by parameter, most frequent value first."""
    return stats.orderBy("param_name", F.desc("prevalence"), "param_value")


def sample_rows(df: DataFrame, n: int = 30, seed: int = 7) -> DataFrame:
    """n random rows."""
    return df.orderBy(F.rand(seed)).limit(n)


# --- collection --------------------------------------------------------------------


def discovered_by_source(discovered: DataFrame) -> DataFrame:
    return discovered.groupBy("search_source").agg(F.count(F.lit(1)).alias("n"))


def enriched_ok(discovered: DataFrame, enriched: DataFrame) -> DataFrame:
    """How many discovered repositories are enriched with status ok."""
    ok = enriched.filter("enrichment_status = 'ok'").select("repo_id")
    return discovered.join(ok, "repo_id").agg(F.count(F.lit(1)).alias("enriched_ok"))


def model_collection(models: DataFrame) -> dict[str, DataFrame]:
    """By source, how many are relevant, and the top facets of the relevant ones."""
    relevant = models.filter("is_lora_relevant")
    return {
        "by_source": models.groupBy("collection_source").agg(F.count(F.lit(1)).alias("n")),
        "relevant": relevant.agg(F.count(F.lit(1)).alias("n")),
        "facets": top_of_each(relevant, ["library_name", "pipeline_tag", "base_model"]),
    }


def file_summary(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.countDistinct("repo_full_name").alias("repos"),
        F.sum(F.coalesce(F.col("truncated").cast("int"), F.lit(0))).alias("truncated"),
        F.avg("file_size").alias("avg_size"),
    )


def files_by_category(files: DataFrame) -> DataFrame:
    return files.groupBy("file_category").agg(F.count(F.lit(1)).alias("files"))


# --- pipeline ----------------------------------------------------------------------


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of every table."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ])


def freshness(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("latest"))


def extraction_counts(rows: DataFrame) -> DataFrame:
    """Rows per extraction source."""
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


def extraction_yield(found: DataFrame) -> DataFrame:
    """Per source of (source, rows), one row per text read: texts seen, those with parameters, rows."""
    size = F.coalesce(F.greatest(F.size("rows"), F.lit(0)), F.lit(0))
    return found.groupBy("source").agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if(size > 0).alias("hits"),
        F.sum(size).alias("rows"),
    )


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values, sorted."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


