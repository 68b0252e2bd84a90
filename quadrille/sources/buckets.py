"""Tables laid out in hash buckets of their key: an upsert rewrites only the buckets it touches.

A table is a folder with ``data/version=v/bucket=b`` and ``manifest/version=v``. A manifest names
for every bucket the version whose folder holds it, and is written last: a reader sees all of an
upsert or nothing of it, and a job that dies half way leaves a folder that no manifest names, which
the next attempt replaces. Buckets that a batch does not touch are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.operators.skew import pick_per_key
from quadrille.session import cut_lineage
from quadrille.sources.sinks import complete_folders, upsert

BUCKET = "key_bucket"
# A manifest has one row per bucket and is read by the driver.
MOST_BUCKETS = 100_000


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, version: int) -> None:
    """``df`` (with its bucket) as the folder of ``version``; a bucket that is large is several files."""
    spread = df.hint("rebalance", BUCKET)
    spread.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/data/version={version}")


def _publish(spark: SparkSession, path: str, version: int, held: Mapping[int, int], buckets: int, keys: Sequence[str]) -> None:
    rows = [(b, v, buckets, list(keys)) for b, v in sorted(held.items())] or [(None, None, buckets, list(keys))]
    schema = "bucket INT, version INT, buckets INT, keys ARRAY<STRING>"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[int, int], int, list[str]]:
    """(version, bucket -> version that holds it, buckets, keys) of the newest version, or a given one."""
    done = complete_folders(spark, f"{path}/manifest", "version")
    if not done:
        raise FileNotFoundError(path)
    version = done[-1] if version is None else version
    rows = spark.read.parquet(f"{path}/manifest/version={version}").collect()  # at most MOST_BUCKETS
    held = {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}
    return version, held, rows[0]["buckets"], rows[0]["keys"]


def create_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> int:
    """Write ``df`` as version 1 of a bucketed table. A key's rows share a bucket; NULL keys too."""
    if not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MOST_BUCKETS}")
    if complete_folders(df.sparkSession, f"{path}/manifest", "version"):
        raise FileExistsError(path)
    if BUCKET in df.columns:
        raise ValueError(f"{BUCKET} is the name of the layout's own column")
    df.limit(0).write.mode("overwrite").parquet(f"{path}/schema")
    _write(df.withColumn(BUCKET, bucket_of(keys, buckets)), path, 1)
    held = {b: 1 for b in _written(df.sparkSession, path, 1)}
    _publish(df.sparkSession, path, 1, held, buckets, keys)
    return 1


def _written(spark: SparkSession, path: str, version: int) -> list[int]:
    """The buckets that a version's folder holds."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = fs.Path(f"{path}/data/version={version}")
    names = [s.getPath().getName() for s in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))


def _of(spark: SparkSession, path: str, held: Mapping[int, int]) -> DataFrame:
    schema = spark.read.parquet(f"{path}/schema").schema
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/version={v}/{BUCKET}={b}" for b, v in sorted(held.items())])


def read_buckets(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of its newest version, or a given one."""
    return _of(spark, path, manifest(spark, path, version)[1])


def read_keys(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is in ``wanted``; only the buckets of these keys are opened."""
    _, held, buckets, keys = manifest(spark, path)
    asked = wanted.select(*keys).distinct()
    touched = {r[0] for r in asked.select(bucket_of(keys, buckets)).distinct().collect()}
    return _of(spark, path, {b: v for b, v in held.items() if b in touched}).join(asked, keys, "left_semi")


def upsert_buckets(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    update: Sequence[str],
    order: Sequence[Column],
    rules: Mapping[str, Column] | None = None,
) -> tuple[int, list[int]]:
    """Merge ``batch`` into the table as :func:`quadrille.sources.sinks.upsert` does.

    Returns the new version and the buckets that were rewritten. The batch is reduced to its last
    row per key once; an empty batch makes no version. Key columns of the batch are cast to the
    table's types, so that equal keys share a bucket. A NULL in a key equals no stored one: of a
    batch's rows with the same key, NULLs included, the last is inserted.
    """
    version, held, buckets, keys = manifest(spark, path)
    types = {f.name: f.dataType for f in spark.read.parquet(f"{path}/schema").schema.fields}
    typed = batch.withColumns({k: F.col(k).cast(types[k]) for k in keys})
    latest = pick_per_key(typed, keys, order, last=True)
    latest = cut_lineage(latest.withColumn(BUCKET, bucket_of(keys, buckets)))
    touched = sorted(r[0] for r in latest.select(BUCKET).distinct().collect())  # at most ``buckets``
    if not touched:
        return version, []
    old = _of(spark, path, {b: held[b] for b in touched if b in held})
    merged = upsert(old, latest.drop(BUCKET), keys, update, order, rules)
    _write(merged.withColumn(BUCKET, bucket_of(keys, buckets)), path, version + 1)
    _publish(spark, path, version + 1, {**held, **{b: version + 1 for b in touched}}, buckets, keys)
    return version + 1, touched
