"""Session settings this workload wants; a cluster may override any of them."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Hot origins, seeds and jobs: measured at run time, split by the engine.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows here are costly to compute on, so merged partitions stay small.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # Bodies are wide: smaller splits keep a task's batches in memory.
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # URL state of the streaming form outgrows the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(app: str, master: str | None = None, **more: str) -> SparkSession:
    """A session with the settings above; ``more`` uses '_' for '.' in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in more.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
