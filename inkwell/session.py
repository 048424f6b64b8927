"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings only: they can be applied to a session somebody else built.
RUNTIME_CONF = {
    # naive event timestamps are read as UTC instants
    "spark.sql.session.timeZone": "UTC",
    # a broken unit in a UTF-16 file is a replacement character, not a failed job
    "spark.sql.legacy.codingErrorAction": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # folders of many small files: hundreds to a task instead of 32
    "spark.sql.files.openCostInBytes": str(256 << 10),
    # rows of long texts or tables: a Python worker holds so much of them at once
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing stays with whoever submits the job."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the local bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("inkwell")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is
    used only with a local master, where driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="inkwell-")
