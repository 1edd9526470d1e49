"""Session settings every operator relies on, and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC makes month buckets and offset timestamps mean the same everywhere; ANSI
# makes bad numbers fail instead of turning into nulls; AQE resizes shuffles,
# splits skewed join partitions and broadcasts only sides whose size it has seen.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A landed page's text has up to some 100 kB: 4,096 of them, the default, and the room to grow
    # that the reader takes are over a GB for each task.
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    # The JVM never compiles a method of more than 8,000 bytes of code, as those that make or check a
    # page's text would be; beyond, expressions are split over small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows that are sorted already are grouped as they come.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Pages of few resources are written side by side; sorting them by resource first would copy and spill them.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> None:
    """This package on the Python workers' path; on a cluster without a shared installation use --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, the cluster's shared folder.

    A machine-local folder stands in only where the setting is missing and the
    whole of Spark runs on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="storeledger-")
    return f"{base.rstrip('/')}/storeledger/{purpose}-{uuid.uuid4().hex}"
