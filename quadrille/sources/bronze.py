"""Bronze tables in: parquet, JSON, CSV or a JDBC database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.schemas import WAREHOUSE_TABLES, bronze_schema


def bytes_to_text(df: DataFrame) -> DataFrame:
    """Decode every binary column as UTF-8 text."""
    return df.select(*[
        F.decode(F.col(f.name), "UTF-8").alias(f.name)
        if isinstance(f.dataType, T.BinaryType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def conform(df: DataFrame, schema: T.StructType, optional: Sequence[str] = ()) -> DataFrame:
    """Bring a loaded frame to ``schema``: decode bytes, cast, put in order.

    A column that is not there is an error, unless ``optional`` names it; then it is NULL.
    """
    present = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in present and f.name not in optional]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    decoded = bytes_to_text(df)
    return decoded.select(*[
        (F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ])


def read_table(
    spark: SparkSession, path: str, name: str, fmt: str = "parquet", optional: Sequence[str] = ()
) -> DataFrame:
    """One bronze table. Text formats are read with the schema, never inferred."""
    schema = bronze_schema(name)
    if fmt == "parquet":
        return conform(spark.read.parquet(path), schema, optional)
    options = {"header": "true"} if fmt == "csv" else {}
    return spark.read.format(fmt).options(**options).schema(schema).load(path)


def load_bronze(
    spark: SparkSession,
    root: str,
    names: Sequence[str] = WAREHOUSE_TABLES,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """All bronze tables under ``root``, one folder (or file) per table."""
    suffix = ".parquet" if fmt == "parquet" else ""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    tables = {}
    for name in names:
        folder = hadoop.Path(f"{root}/{name}")
        exists = folder.getFileSystem(conf).exists(folder)
        tables[name] = read_table(
            spark, f"{root}/{name}" if exists else f"{root}/{name}{suffix}", name, fmt
        )
    return tables


def read_database(
    spark: SparkSession,
    url: str,
    name: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 64,
    **options: str,
) -> DataFrame:
    """A bronze table over JDBC, read in ``splits`` parallel ranges of a number column."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    if split_column and bounds:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", splits)
        )
    return conform(reader.options(**options).load(), bronze_schema(name))
