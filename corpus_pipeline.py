"""A corpus from raw documents: stages applied one after another, each stored as Parquet.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All
but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesieve.llm import mixing, near_dup, packing, quality, toxicity
from pagesieve.llm.common import documents, stored

# A line of more than 20 distinct texts of a host is boilerplate, however many texts the host has.
LINES = quality.Limits(host_share=0.0)


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; learned from the labelled ones among ``docs``.

    Null and empty texts are scored like a text without words, rows without an id
    and repeated rows each for themselves. An empty table gives an empty one.
    """
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("doc"))
    return toxicity.score(whole, model, carried=("doc",)).where("predicted = 0").select("doc.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go; boilerplate lines go from the rest.

    Null and empty texts have no words and go; a null source is a host of its own;
    repeated rows and rows without an id are judged each.
    """
    return quality.cleaned(docs, LINES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least id.

    Documents without an id can't be told apart and stay, as do null and empty texts.
    Repeated rows of one id become one; of different texts under one id that with
    the least digest stays.
    """
    found = stored(near_dup.near_duplicates(docs).where("kept and doc_id is not null").groupBy("doc_id").count(), "kept")
    # Whole texts are grouped only where an id is repeated.
    once = docs.join(found.where("count = 1"), "doc_id", "left_semi")
    several = docs.join(found.where("count > 1"), "doc_id", "left_semi")
    named = several.select("doc_id", F.struct(F.md5(F.coalesce("text", F.lit(""))).alias("key"), F.struct(*docs.columns).alias("doc")).alias("row"))
    first = named.groupBy("doc_id").agg(F.min("row").alias("row")).select("row.doc.*")
    return once.select(docs.columns).unionByName(first).unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for.

    Null and empty texts have size 0 and stay once; a null source is the last one.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequences and offsets.

    A null or empty text is one end token; repeated rows are packed each.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxic_out),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Learned scores and token ids have no SQL form; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
