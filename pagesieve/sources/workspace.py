"""Where intermediate tables and checkpoints go: the folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a private folder only in local mode without it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named
    set_already = spark.sparkContext.getCheckpointDir()
    if set_already:
        return set_already
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="pagesieve-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def _own_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pagesieve/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the application's part of the shared folder."""
    return f"{_own_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Remove the application's intermediate tables: results that still read them are lost."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """A table written to the shared folder and read back: lineage ends here, columns can be pruned."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
