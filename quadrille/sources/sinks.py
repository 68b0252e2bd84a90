"""Keyed writes: upsert, insert-ignore and mark-done as joins, plus versioned folders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quadrille.operators.skew import pick_per_key
from quadrille.session import cut_lineage

OLD, NEW = "old", "new"


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[Column],
    rules: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``target`` with the batch merged in: update the listed columns, insert the rest.

    The last batch row per key in ``order`` wins. ``rules`` replaces the plain
    overwrite of a column by an expression over the structs ``old`` and ``new``.
    The target is only probed: when the batch is small it is broadcast at run time
    and the target is never shuffled.
    """
    keys = list(keys)
    # Written, as it is read for the updates, the known keys and the inserts.
    latest = cut_lineage(pick_per_key(batch, keys, order, last=True).select(
        *[F.col(c) for c in target.columns if c in batch.columns]
    ))
    incoming = latest.select(
        *[F.col(k) for k in keys], F.struct(*[F.col(c) for c in latest.columns]).alias(NEW)
    )
    stored = target.select(
        *[F.col(k) for k in keys], F.struct(*[F.col(c) for c in target.columns]).alias(OLD)
    )
    changed = F.col(NEW).isNotNull()
    rules = dict(rules or {})

    def merged(name: str) -> Column:
        if name in keys or name not in [*update, *rules]:
            return F.col(f"{OLD}.{name}")
        value = rules.get(name, F.col(f"{NEW}.{name}") if name in latest.columns else F.lit(None))
        return F.when(changed, value).otherwise(F.col(f"{OLD}.{name}"))

    types = {f.name: f.dataType for f in target.schema.fields}
    updated = stored.join(incoming, keys, "left").select(
        *[merged(c).cast(types[c]).alias(c) for c in target.columns]
    )
    known = target.select(*keys).join(latest.select(*keys), keys, "left_semi")
    added = latest.join(known, keys, "left_anti").select(*[
        (F.col(c) if c in latest.columns else F.lit(None)).cast(types[c]).alias(c)
        for c in target.columns
    ])
    return updated.unionByName(added)


def upsert_discovered_models(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert of a targeted collection: raises the relevance flag, keeps 'organic'."""
    refreshed = (
        "base_model", "pipeline_tag", "library_name", "downloads", "likes", "tags",
        "card_content", "last_modified", "ingested_at",
    )
    rules = {
        "is_lora_relevant": F.lit(True),
        "collection_source": F.when(
            F.col("old.collection_source") == "organic", F.lit("organic")
        ).otherwise(F.col("new.collection_source")),
    }
    return upsert(target, batch, ["model_id"], refreshed, [F.col("ingested_at")], rules)


def upsert_enriched_repos(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert of an enrichment: everything is renewed but the id and the name first stored."""
    renewed = [c for c in target.columns if c not in ("repo_id", "repo_name")]
    return upsert(target, batch, ["repo_id"], renewed, [F.col("enriched_at")])


def upsert_files(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert of fetched files by place; a file keeps the ``file_id`` it has."""
    keys = ["repo_full_name", "file_path"]
    renewed = [c for c in target.columns if c not in (*keys, "file_id")]
    return upsert(target, batch, keys, renewed, [F.col("fetched_at")])


def insert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The batch rows to append: first per key, none whose key is stored already."""
    keys = list(keys)
    first = pick_per_key(batch, keys, order)
    known = target.select(*keys).join(first.select(*keys), keys, "left_semi")
    return first.join(known, keys, "left_anti")


def mark_done(target: DataFrame, done: DataFrame, key: str, flag: str) -> DataFrame:
    """Set ``flag`` on the target rows whose key is in ``done``."""
    seen = done.select(key).distinct().withColumn("_done", F.lit(True))
    return target.join(seen, key, "left").select(*[
        F.coalesce(F.col("_done"), F.col(c)).alias(c) if c == flag else F.col(c)
        for c in target.columns
    ])


# --- versioned folders -------------------------------------------------------------


def complete_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers n of the finished ``name=n`` folders under ``path``, ascending."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(
        int(f.split("=")[1])
        for f in found
        if f.startswith(f"{name}=") and system.exists(fs.Path(f"{path}/{f}/_SUCCESS"))
    )


def write_version(df: DataFrame, path: str) -> int:
    """Write ``df`` as the next version of the table; readers see it once complete."""
    done = complete_folders(df.sparkSession, path, "version")
    version = done[-1] + 1 if done else 1
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest complete version of a table (or a given one)."""
    done = complete_folders(spark, path, "version")
    if not done:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/version={done[-1] if version is None else version}")


def export_tables(
    tables: Mapping[str, DataFrame], out: str, drop: Mapping[str, Sequence[str]] | None = None
) -> list[tuple[str, int, str]]:
    """Write every table to parquet; row counts are observed while writing."""
    written = []
    for name, df in tables.items():
        seen = Observation(f"export_{name}")
        slim = df.drop(*(drop or {}).get(name, ()))
        path = f"{out}/{name}.parquet"
        slim.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        written.append((name, seen.get["rows"], path))
    return written
