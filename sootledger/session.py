"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# What a cluster session should run with. Partition counts are left to adaptive
# execution, which merges small shuffle partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows can hold long texts: small batches bound what a Python worker holds at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# A sort or join holds what its task reads. With these a task of the footprint reads about 16 MB of a shuffle, however
# large the tables are and however few partitions the session asks for; adaptive execution merges smaller ones.
SPREAD = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    if not package.is_dir():
        return  # imported from an archive that was shipped already
    archive = Path(tempfile.mkdtemp(prefix="sootledger-")) / "sootledger.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def tune(spark: SparkSession, spread: bool = False) -> SparkSession:
    """Apply the runtime settings to an existing session and send it the package.

    `spread` adds those that bound what a task of joins and windows over the warehouse reads.
    """
    for key, value in (SETTINGS | SPREAD if spread else SETTINGS).items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def local_session(name: str, cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names in spark.checkpoint.dir.

    Only a local session, which has no such folder, gets one of its own.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            folder = tempfile.mkdtemp(prefix="sootledger-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
