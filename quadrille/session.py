"""Session settings and the shared folder that cut lineage is written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. AQE sizes shuffles from what was really
# written and splits skewed join partitions; UTC keeps naive timestamps stable.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # JSON objects that repeat a key keep the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: int | str = "*", app: str = "quadrille") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure lineage cuts land in the folder the cluster names.

    The folder comes from ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one disk, may fall back to a scratch folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="quadrille-checkpoint-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files.

    Parquet rather than checkpoint(): later steps read only the columns and rows they need, and
    plans know the size. The folder is the application's own and goes with its checkpoints.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
