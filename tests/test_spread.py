"""Rows of a given table are dealt over tasks before costly work; the walk over tags leaves out what ends nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesieve.functions import fixed, markup
from pagesieve.operators import extraction
from pagesieve.plans.queries import _arrivals
from pagesieve.sources import derived
from pagesieve.sources.tables import ROWS_A_TASK, tasks_for


def test_bodies_are_built_in_as_many_tasks_as_the_rows_need(spark, tmp_path):
    """One small file with one row group was one task, however many bodies were built from it."""
    keys = spark.range(3000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 1500).alias("p_partkey"))
    part = keys.select(
        "p_partkey", F.lit("a part").alias("p_name"), F.lit("Brand#1").alias("p_brand"), F.lit("TYPE").alias("p_type"),
        F.lit(9.5).alias("p_retailprice"),
    )
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    whole = spark.sql(derived.LISTING_CAPTURES.replace("@part@", f"parquet.`{tmp_path}/part.parquet`"))
    spread = derived.derive(spark, derived.LISTING_CAPTURES, str(tmp_path))
    assert whole.rdd.getNumPartitions() == 1
    sizes = spread.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 12 and max(sizes) <= 400 and sum(sizes) == 3000
    assert spread.exceptAll(whole).isEmpty() and whole.exceptAll(spread).isEmpty()


def test_tasks_grow_with_the_rows(spark):
    assert [tasks_for(spark, n) for n in (0, 1, 256, 257)] == [1, 1, 1, 2]
    assert tasks_for(spark, 1_200 * ROWS_A_TASK) == 1_200


def test_leaves_are_not_walked_and_change_no_extent(spark):
    pages = [
        "", "no tag", "<div class=card><p>x</p></div>", "<div class=card>open<p>x</p><br><b></b>",
        "<div><div class=card><i></div>x</div></i><p class=item></p><img class=card><p>z",
        "</p><section><p class=card><section></section><p></section></p><li></li>", "<p></P><p class=card/></p><a></b></a>",
    ]

    def is_card(t):
        return F.coalesce(markup.attribute(t, "class").rlike(fixed.CARD_CLASS), F.lit(False))

    def of(leaves):
        return F.transform(markup.extents(F.col("t"), is_card, leaves=leaves), lambda e: F.struct(e["first"], e["last"], e["depth"]))

    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "n int, p string").withColumn("t", markup.tags(F.col("p")))
    rows = df.select("p", of(True).alias("all"), of(False).alias("few")).collect()
    assert [r["few"] for r in rows] == [r["all"] for r in rows]
    assert sum(len(r["few"]) for r in rows) == 7

    walked = df.select(F.size(markup._branching(F.transform("t", lambda t, i: F.struct(
        i.alias("at"), F.regexp_extract(t, "([a-z]+)", 1).alias("key"), F.startswith(t, F.lit("</")).alias("closing"),
        F.lit(True).alias("stays"), F.contains(t, F.lit("class")).alias("wanted"),
    )))).alias("n")).collect()
    assert walked[2].n == 2  # the card's own two tags


def test_card_texts_of_odd_cards(spark):
    cards = [(None,), ("",), ("plain",), ("<h2> </h2><a>  b &amp; c </a>",), ("<p class=price>&pound;5</p>",), ("now $ 7.5 only",), ("<h1>",)]
    df = spark.createDataFrame(cards, "c string")
    got = df.select(extraction.card_title(F.col("c")).alias("t"), extraction.card_price(F.col("c")).alias("p")).collect()
    assert [r.t for r in got] == ["", "", "", "b & c", "", "", ""]
    assert [r.p for r in got] == [None, "", "", "", "£5", "$ 7.5", ""]


def test_a_step_of_arrivals_is_as_many_files_as_its_rows_need(spark, tmp_path):
    """Each step was one file, so one task made all items of it; steps stay in the order of their time."""
    part = spark.range(4400).select(
        F.col("id").alias("p_partkey"), F.lit("a part").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
        F.lit("TYPE").alias("p_type"), F.lit(9.5).alias("p_retailprice"),
    )
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    seen = []

    def note(batch, n):
        seen.append(tuple(batch.selectExpr("count(distinct file)", "min(job_id)", "max(job_id)", "count(*)").first()))

    arrivals = _arrivals(spark, str(tmp_path), derived.XML_CAPTURES).withColumn("file", F.input_file_name())
    run = arrivals.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    assert len(seen) == 4 and {files for files, *_ in seen} == {tasks_for(spark, min(n for *_, n in seen))} != {1}
    assert sum(n for *_, n in seen) == 4400
    assert all(a[2] < b[1] for a, b in zip(seen, seen[1:], strict=False))
