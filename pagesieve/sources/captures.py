"""Reading captured responses and the requests they answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import strip
from .tables import given

# A response together with the request it answers, so that neither profiling nor
# extraction has to join (and shuffle) the bodies. ``error`` is the network error
# of a fetch that gave no response; status and body are null then. ``fetched_at``
# bounds the state of streams and says which capture a later job may use.
CAPTURE_SCHEMA = T.StructType(
    [
        T.StructField("capture_id", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("job_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("fields_text", T.StringType()),
        T.StructField("outputs_text", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


def capture_scan(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Captured responses from Parquet, JSON lines or ORC with the fixed schema."""
    return spark.read.schema(CAPTURE_SCHEMA).format(file_format).load(path)


def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given ``pages`` as plain HTML responses, status 200."""
    return given(spark, sf_dir, "pages").select(
        F.col("page_id").alias("job_id"),
        "url",
        F.lit(200).alias("status"),
        F.lit("text/html").alias("content_type"),
        F.lit(None).cast("string").alias("error"),
        F.col("html").alias("body"),
    )


def name_list(text: Column) -> Column:
    """Comma-separated names: trimmed, empty ones dropped, order and repeats kept."""
    return F.filter(F.transform(F.split(text, ","), strip), lambda n: n != "")


def with_request(captures: DataFrame) -> DataFrame:
    """Turn the request texts into ``fields`` and ``outputs`` arrays."""
    outputs = F.coalesce("outputs_text", F.lit(fixed.DEFAULT_OUTPUTS))
    return (
        captures.withColumn("fields", name_list(F.col("fields_text")))
        .withColumn("outputs", name_list(outputs))
        .drop("fields_text", "outputs_text")
    )
