"""Incremental form of the keyed writes: new bronze rows arrive as files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quadrille.functions import vocab
from quadrille.functions.text import event_text, is_relevant
from quadrille.sources.sinks import complete_folders, insert_ignore


def arriving(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
    files_per_batch: int | None = None, names: str | None = None,
) -> DataFrame:
    """A stream of the files that appear under ``path``.

    Only those matching ``names``, and those in folders matching it: a table may be either.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Without the braces a single file would be taken for the folder that partitions are found in.
    return reader.load(f"{path}/{{{names}}}" if names else path)


def deduplicated(
    stream: DataFrame, keys: Sequence[str], time: str, watermark: str = "1 day"
) -> DataFrame:
    """Drop rows whose key was seen within the watermark; state stays bounded by it."""
    return (
        stream.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, watermark)
        .dropDuplicatesWithinWatermark(list(keys))
    )


def relevant_events(
    stream: DataFrame,
    wanted: Sequence[str] = vocab.TOPIC_WORDS,
    rejected: Sequence[str] = vocab.REJECT_WORDS,
) -> DataFrame:
    """Activity events about the topic; stateless, so the batch filter applies as is."""
    messages = F.transform("payload.commits", lambda c: c["message"])
    text = event_text(F.col("type"), F.col("repo.name"), messages, F.col("repo.topics"))
    return stream.filter(is_relevant(text, wanted, rejected))


def changed_contents(
    stream: DataFrame, keys: Sequence[str], content_hash: str, order: Sequence[str],
    idle: str | None = None,
) -> DataFrame:
    """Rows whose content hash differs from the one that their key had before them.

    The last hash of every key is the stream's own state, so a batch reads no earlier batch, a
    restart goes on where the last run ended, and a replayed batch finds the state it had and passes on
    the same rows. Rows of a batch are taken in the order of ``order``. An empty or NULL hash never
    counts as unchanged, and what follows one is a change. With ``idle`` (such as "30 days") a key
    that was not seen for so long is forgotten, which bounds the state. A batch's rows of one key are
    ordered in memory: bound the batch by ``files_per_batch``.
    """
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    forget = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else 0
    by = list(order)

    def changed(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(chunks)).sort_values(by, kind="stable")
        last, kept = state.get[0] if state.exists else None, []
        for now in rows[content_hash].fillna("").tolist():
            kept.append(not now or now != last)
            last = now
        state.update((last,))
        if idle:
            state.setTimeoutDuration(forget)
        yield rows[kept]

    return stream.groupBy(*keys).applyInPandasWithState(changed, stream.schema, "last string", "append", timeout)


def _start(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merged_rows(
    df: DataFrame, keys: Sequence[str], update: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """One row per key, as upserting the rows in ``order`` one by one would leave it.

    Updated columns come from the last row, all others from the first. Both are
    aggregates, so map tasks already reduce a hot key to one candidate.
    """
    keys = list(keys)
    kept = [c for c in df.columns if c not in keys and c not in update]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    folded = df.groupBy(*keys).agg(
        F.max_by(F.struct(*update), rank).alias("_last"),
        F.min_by(F.struct(F.lit(1).alias("_"), *kept), rank).alias("_first"),
    )
    return folded.select(
        *[
            F.col(c) if c in keys else F.col(f"{'_last' if c in update else '_first'}.{c}").alias(c)
            for c in df.columns
        ]
    )


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[Column],
) -> StreamingQuery:
    """Keep a keyed table of the stream under ``path``; read it with :func:`current`.

    A micro-batch writes only its own keys, into a folder named by its number: the cost
    follows the batch, not the table, and a replayed batch replaces its folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        merged_rows(batch, keys, update, order).write.mode("overwrite").parquet(
            f"{path}/batch={number}"
        )

    return _start(stream, write, checkpoint)


def stored_batches(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """All complete batches under ``path`` (those older than ``before``), or None.

    Batches that :func:`fold_batches` has put into a version are read from the newest one.
    """
    older = lambda n: before is None or n < before
    versions = [v for v in complete_folders(spark, path, "version") if older(v)]
    folded = versions[-1] if versions else -1
    numbers = [n for n in complete_folders(spark, path, "batch") if older(n) and n > folded]
    found = None
    if versions:
        found = spark.read.parquet(f"{path}/version={folded}").withColumn("batch", F.lit(folded))
    if numbers:
        newer = spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in numbers])
        found = newer if found is None else found.unionByName(newer)
    return found


def fold_batches(
    spark: SparkSession, path: str, keys: Sequence[str], update: Sequence[str] = ()
) -> int | None:
    """Put the table of all complete batches into one version and return the last batch in it.

    Later reads and inserts open the version and the newer batches only. Batches stay where
    they are: a replay of one finds what it found before.
    """
    numbers = complete_folders(spark, path, "batch")
    if not numbers:
        return None
    if numbers[-1] not in complete_folders(spark, path, "version"):
        table = current(spark, path, keys, update)
        table.write.mode("overwrite").parquet(f"{path}/version={numbers[-1]}")
    return numbers[-1]


def current(
    spark: SparkSession, path: str, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """The table that :func:`upsert_stream` keeps, one row per key."""
    stored = stored_batches(spark, path)
    if stored is None:
        raise FileNotFoundError(path)
    return merged_rows(stored, keys, [*update, "batch"], [F.col("batch")]).drop("batch")


def insert_stream(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column]
) -> StreamingQuery:
    """Append the first row of every key that no earlier batch stored."""

    def write(batch: DataFrame, number: int) -> None:
        stored = stored_batches(batch.sparkSession, path, before=number)
        known = batch.limit(0) if stored is None else stored.drop("batch")
        insert_ignore(known, batch, keys, order).write.mode("overwrite").parquet(
            f"{path}/batch={number}"
        )

    return _start(stream, write, checkpoint)


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add the rows of every micro-batch; read them with :func:`stored_batches`."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(stream, write, checkpoint)
