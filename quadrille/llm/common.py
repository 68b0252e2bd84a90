"""What the operators share: row identity, written steps, bounded slices of texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.session import use_checkpoint_dir

# Characters of text that a Python task works on at a time.
SLICE_CHARS = 2_000_000
# Bytes of text that one task of a shuffle should get.
TASK_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` into the folder that all executors share and read it back.

    A lost executor then costs its running tasks only, and a table that is read
    twice is computed once.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: str = "text") -> Column:
    """Tells rows of one doc_id apart; rows equal in both are copies of a row."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join on ``keys`` in which NULL equals NULL; the keys of ``right`` are dropped."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    matched = F.lit(True)
    for key in keys:
        matched = matched & left[key].eqNullSafe(renamed[f"__r_{key}"])
    return left.join(renamed, matched, how).drop(*[f"__r_{k}" for k in keys])


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = SLICE_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into pieces of about ``chars`` bytes, with the texts (NULL as empty).

    A single longer text is a piece of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate([*sizes, chars + 1]):
            if i > start and (size + n > chars or i == len(sizes)):
                part = batch.slice(start, i - start)
                yield part, [t or "" for t in part.column(text).to_pylist()]
                start, size = i, 0
            size += n


def with_columns(batch: pa.RecordBatch, drop: Sequence[str], **columns) -> pa.RecordBatch:
    """``batch`` without ``drop`` and with further columns after its own."""
    kept = [n for n in batch.schema.names if n not in drop]
    arrays = [batch.column(n) for n in kept]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], [*kept, *columns])


def schema_of(df: DataFrame, drop: Sequence[str], added: str) -> str:
    """DDL of ``df`` without ``drop`` and with the columns ``added``."""
    kept = [f for f in df.schema.fields if f.name not in drop]
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return ", ".join(filter(None, (own, added)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
