"""Shared by the text operators: words, stored intermediate tables, global numbering."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.workspace import new_folder

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
    "array<binary>": pa.list_(pa.binary()), "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()),
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Gapless positions from 0 in a total order, without one task that sees all rows.

    Ranges of the order are stored, numbered each on its own and shifted by the
    size of the ranges before (one small row per range).
    """
    n = parallelism(df.sparkSession)
    ranges = stored(
        df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select(
        "_range",
        F.coalesce(
            F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (
        ranges.withColumn("_place", place)
        .join(before, "_range")
        .withColumn(name, F.col("_place") + F.col("_before"))
        .drop("_place", "_before", "_range")
    )


def per_text(docs: DataFrame, carried: list[str], schema: str, work, rows_at_once: int = 256) -> DataFrame:
    """Carried columns and what ``work(texts)`` returns (a list per column of ``schema``), by Arrow batches.

    Texts go to Python ``rows_at_once`` at a time; carried columns pass untouched, nulls included.
    """

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(a, rows_at_once)
                made = work(part.column("text").to_pylist())
                arrays = [part.column(c) for c in carried] + [
                    pa.array(made[f.name], f.type) for f in fields
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    kept = docs.select(*carried)
    more = T.StructType.fromDDL(schema)
    fields = [pa.field(f.name, _ARROW[f.dataType.simpleString()]) for f in more.fields]
    names = [*carried, *(f.name for f in fields)]
    columns = list(dict.fromkeys([*carried, "text"]))
    return docs.select(*columns).mapInArrow(run, T.StructType([*kept.schema.fields, *more.fields]))


def of_text(kind: str, work, rows_at_once: int = 256):
    """A column function of texts: ``work(texts)`` gives a list of values of type ``kind``.

    Only its argument goes to Python; the other columns of a row stay in the JVM.
    """

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made = []
            for a in range(0, len(batch), rows_at_once):
                made += work(batch.slice(a, rows_at_once).to_pylist())
            yield pa.array(made, _ARROW[kind])

    return run
