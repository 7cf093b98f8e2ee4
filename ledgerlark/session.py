"""Session settings the plans expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",  # merged down to what the data needs
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no stack capture per column expression
}


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with: adaptive execution has a setting of its own for it."""
    conf = spark.conf
    adaptive = all(conf.get(f"spark.sql.adaptive.{x}") == "true" for x in ("enabled", "coalescePartitions.enabled"))
    first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) if adaptive else None
    return int(first or conf.get("spark.sql.shuffle.partitions"))


def local_session(cpus: int | str = 8, app: str = "ledgerlark", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench; on a cluster spark-submit supplies the master and sizes."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(cpus),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
