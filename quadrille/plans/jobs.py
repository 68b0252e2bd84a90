"""Whole jobs: an extraction and the keyed write that it ends in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.operators import extract
from quadrille.sources.sinks import upsert

RAW_KEYS = ("repo_full_name", "file_id", "source", "param_name")


def refresh_raw_configs(stored: DataFrame, files: DataFrame, repos: DataFrame) -> DataFrame:
    """``stored`` raw rows with those of ``files`` merged in.

    A row known by repository, file, source and parameter gets the new value, confidence and time.
    """
    found = extract.raw_config_rows(files, repos).withColumn("extracted_at", F.current_timestamp())
    renewed = ["param_value", "confidence", "extracted_at"]
    return upsert(stored, found, RAW_KEYS, renewed, [F.col("extracted_at"), F.col("param_value")])


def refresh_params(stored: DataFrame, table: DataFrame, entity: str) -> DataFrame:
    """``stored`` parameter table with the rows of ``table`` in place of those with their ``entity``."""
    found = table.withColumn("extracted_at", F.current_timestamp())
    renewed = [c for c in stored.columns if c != entity]
    return upsert(stored, found, [entity], renewed, [F.col("extracted_at")])
