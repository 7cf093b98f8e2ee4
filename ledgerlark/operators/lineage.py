"""Materialising an intermediate frame so that an executor loss cannot change it between two reads."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only in local mode where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlark-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


_written: list[str] = []


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder as parquet and continue from the files (an action).

    Unlike a row-format checkpoint the copy is columnar, so later readers prune columns and see exact sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def copies_written() -> int:
    """How many copies exist; pass it to discard_copies to drop only later ones."""
    return len(_written)


def discard_copies(spark: SparkSession, since: int = 0) -> None:
    """Delete the copies this process wrote, once no frame reads them any more."""
    conf = spark._jsc.hadoopConfiguration()
    while len(_written) > since:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
