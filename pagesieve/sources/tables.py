"""The given tables, read as they are: no shuffle carries a body."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def relation(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The same as SQL text."""
    return f"parquet.`{sf_dir}/{name}.parquet`"


ROWS_A_TASK = 10_000  # rows from which a response of a few kB is built and taken apart: some seconds
LEAST_ROWS_A_TASK = 256


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for costly work on ``rows`` rows: their number grows with the rows; few rows use every core."""
    wanted = max(math.ceil(rows / ROWS_A_TASK), 2 * spark.sparkContext.defaultParallelism)
    return max(min(wanted, math.ceil(rows / LEAST_ROWS_A_TASK)), 1)


def spread_relation(spark: SparkSession, sf_dir: str, name: str) -> str:
    """``relation`` with its rows dealt over as many tasks as work on each row needs.

    Scans are split by bytes and never inside a row group, so a table of many thin rows in one
    group would be one task, however much is made of each row. Rows are counted from the
    footers and shuffled as they are in the table, before bodies are built from them.
    """
    table = given(spark, sf_dir, name)
    tasks = tasks_for(spark, table.count())
    plain = relation(spark, sf_dir, name)
    if table.rdd.getNumPartitions() >= tasks:
        return plain
    return f"(select /*+ repartition({tasks}) */ * from {plain})"
