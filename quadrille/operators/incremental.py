"""What still has to be done: backlogs, changed rows and corpus windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.functions import vocab
from quadrille.operators.skew import skew_join


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows, for a job that takes a batch at a time; without a limit all."""
    return ordered if limit is None else ordered.limit(limit)


def not_yet(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the done ones (keys are never NULL)."""
    return todo.join(done.select(key), key, "left_anti")


def enrichment_backlog(discovered: DataFrame, enriched: DataFrame, limit: int | None = None) -> DataFrame:
    """Discovered repositories not enriched yet, newest first."""
    newest = not_yet(discovered, enriched, "repo_id").orderBy(F.col("discovered_at").desc(), "repo_id")
    return _first(newest, limit).select("repo_id", "repo_name")


def discovery_backlog(discovered: DataFrame, enriched: DataFrame, limit: int | None = None) -> DataFrame:
    """Neither marked nor enriched: search hits first, then the oldest."""
    from_search = F.coalesce(F.col("search_source") == "repo_search", F.lit(False))
    todo = not_yet(discovered.filter(~F.col("enriched")), enriched, "repo_id")
    ordered = todo.orderBy(from_search.desc(), "discovered_at", "repo_id")
    return _first(ordered, limit).select("repo_id", "repo_name")


def ingest_backlog(discovered: DataFrame, limit: int | None = None) -> DataFrame:
    """Models not ingested yet, oldest first."""
    pending = discovered.filter(~F.col("ingested"))
    return _first(pending.orderBy("discovered_at", "model_id"), limit).select("model_id")


def stale(
    rows: DataFrame, done: DataFrame, key: str, changed: str, done_at: str
) -> DataFrame:
    """Rows never processed, or changed since they were. A key may have many rows."""
    seen = done.select(key, F.col(done_at).alias("_done_at"))
    return (
        skew_join(rows, seen, [key], "left", salt_by=[key, changed])
        .filter(F.col("_done_at").isNull() | (F.col(changed) > F.col("_done_at")))
        .drop("_done_at")
    )


def repos_to_embed(enriched: DataFrame, embedded: DataFrame, limit: int | None = None) -> DataFrame:
    usable = enriched.filter("readme_content IS NOT NULL AND enrichment_status = 'ok'")
    changed = stale(usable, embedded, "repo_id", "enriched_at", "embedded_at")
    return _first(changed.orderBy(F.col("enriched_at").desc_nulls_last(), "repo_id"), limit)


def models_to_embed(models: DataFrame, embedded: DataFrame, limit: int | None = None) -> DataFrame:
    usable = models.filter("card_content IS NOT NULL AND is_lora_relevant")
    changed = stale(usable, embedded, "model_id", "last_modified", "embedded_at")
    return _first(changed.orderBy(F.col("created_at").desc_nulls_last(), "model_id"), limit)


def changed_files(tree: DataFrame, stored: DataFrame) -> DataFrame:
    """Tree files whose content hash differs from the stored one; no hash, no match."""
    known = stored.select(
        F.col("repo_full_name").alias("repo"),
        F.col("file_path").alias("path"),
        F.col("file_sha").alias("_stored"),
    )
    same = F.coalesce((F.col("sha") == F.col("_stored")) & (F.col("sha") != ""), F.lit(False))
    return tree.join(known, ["repo", "path"], "left").filter(~same).drop("_stored")


def cards_to_extract(models: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Models with a real card, or relevant ones, that have no parameters yet."""
    relevant = F.coalesce(F.col("is_lora_relevant"), F.lit(False))
    todo = models.filter((F.length("card_content") > 200) | relevant)
    return _first(not_yet(todo, done, "model_id").orderBy("model_id"), limit)


def fallback_targets(
    files: DataFrame, repos: DataFrame, raw: DataFrame, limit: int | None = None
) -> DataFrame:
    """Usable repositories that have file contents but no raw rows."""
    usable = repos.filter("enrichment_status = 'ok'").select(
        F.col("repo_name").alias("repo_full_name")
    )
    with_files = files.filter("content IS NOT NULL").select("repo_full_name").distinct()
    unread = with_files.join(usable, "repo_full_name", "left_semi").join(
        raw.select("repo_full_name").distinct(), "repo_full_name", "left_anti"
    )
    return _first(unread.orderBy("repo_full_name"), limit)


def above_floor(rows: DataFrame, column: str, floor: int, null_as_zero: bool = True) -> DataFrame:
    """Rows at or above a count; a missing count is 0, or passes when it is unknown."""
    c = F.col(column)
    missing = F.lit(0) if null_as_zero else F.lit(floor)
    return rows.filter(F.coalesce(c, missing) >= floor)


def date_window(
    day: Column, windows: Sequence[tuple[str, str | None, str | None]] = vocab.DATE_WINDOWS
) -> Column:
    """Label of the window a day falls into; bounds are half open."""
    label = F.lit(None).cast("string")
    for name, first, end in reversed(windows):
        inside = F.lit(True)
        if first:
            inside = inside & (day >= F.lit(first).cast("date"))
        if end:
            inside = inside & (day < F.lit(end).cast("date"))
        label = F.when(inside & day.isNotNull(), name).otherwise(label)
    return label
