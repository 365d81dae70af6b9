"""The numbered operators as queries over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import new_folder
from . import (
    chat, fingerprints, language, lm_scores, mixing, near_dup, packing, quality, sharding, spelling, toxicity, turn_repair, warc,
)
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return toxicity.score(docs, toxicity.learn(docs, spark.read.parquet(f"{sf}/labels.parquet")))


@query
def op2_stupid_backoff(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scores.scores(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"), least=1, order=lm_scores.ORDER, leave_out=True)


@query
def op3_weighted_sampling_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf))


@query
def op4_nearest_centroid_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return language.classify(docs, language.learn(docs))


@query
def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_line_frequency_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(documents(spark, sf)).verdicts.drop("row", "text_key", "source")


@query
def op7_kd_tree_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(documents(spark, sf), shards=8)


@query
def op8_budgeted_chat_windows(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    added = spark.sql(f"select * from values (-7L, 0L, 'user', '{marks}'), (-7L, 1L, 'assistant', '{marks}') as t(conv_id, turn, role, text)")
    return chat.read_back(chat.windows(turns.unionByName(added)))


@query
def op9_capped_water_filling(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf))


@query
def op10_superminhash_near_dup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf))


@query
def op11_turn_repair(spark: SparkSession, sf: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(spark.read.parquet(f"{sf}/conversations.parquet")))


@query
def op12_zip_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "archives")
    warc.write(warc.captures(spark.read.parquet(f"{sf}/pages.parquet"), "page_id", "url", "html"), path)
    found = warc.resolved(warc.read_back(spark, path, with_payload=False))
    page = [F.col(c).cast("long").alias(name) for c, name in (("own", "page_id"), ("refers_to", "refers_to"))]
    return found.select(page[0], "payload_bytes", "payload_digest", "record_type", page[1])


@query
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(documents(spark, sf))
