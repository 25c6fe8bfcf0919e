"""Session construction and shared-storage helpers.

On a cluster the session is created by the platform; the library only reads
its settings. ``build_session`` is for local runs, tests and the benchmark.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import SparkSession

# Settings that make a local run behave like the cluster plan: AQE re-plans
# joins and partition counts from real shuffle sizes and splits skewed join
# partitions; timestamps are zone-free so oracle comparisons are stable.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # PySpark otherwise records the Python call site of every column function
    # with extra JVM round trips; plan building becomes ~3x faster without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # delete checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "clickscope",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` where the cluster names one; only where it is
    unset, a folder of its own beside the tables, in the session's warehouse.
    A warehouse on a local disk is no shared folder, so on a cluster it is
    refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        local = urlparse(warehouse).scheme in ("", "file") and not spark.conf.get("spark.hadoop.fs.defaultFS", "")
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share; the warehouse is a local one")
        folder = f"{warehouse}/_checkpoints"
    spark.sparkContext.setCheckpointDir(folder)
    return folder
