"""Sinks, the store across batches, streaming restarts, entry points."""

from __future__ import annotations

import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from sql_answers import answers

import __spark_entry__ as spec
from pagesieve.operators import cleaning
from pagesieve.plans.queries import QUERIES
from pagesieve.sources import sinks
from pagesieve.sources.workspace import new_folder

SF = "/root/testdata/sf0.001"


def items(spark, rows):
    return spark.createDataFrame(
        [(j, 0, p, t, u, pr, "s", x, k) for p, (j, t, u, pr, x, k) in enumerate(rows)],
        "job_id long, page_seq int, pos int, title string, url string, price string, source string, "
        "extra map<string,string>, keys array<string>",
    )


def test_csv_columns_are_the_union_in_first_seen_order(spark):
    rows = [
        (1, 'a "q", b', "u1", None, {"stock": "3"}, ["stock", "url", "title", "source"]),
        (2, "line\nbreak", "u2", "5", None, ["title", "url", "price", "source"]),
    ]
    path = new_folder(spark, "t-csv")
    back = sinks.read_csv(spark, sinks.export_csv(items(spark, rows), path))
    assert back.columns == ["job_id", "title", "url", "source", "stock", "price"]
    assert {r.title: (r.stock, r.price) for r in back.collect()} == {'a "q", b': ("3", None), "line\nbreak": (None, "5")}
    few = sinks.read_csv(spark, sinks.export_csv(items(spark, rows), path, most=3))
    assert few.columns == ["job_id", "title", "url", "source", "more"]
    assert {r.job_id: r.more for r in few.collect()} == {"1": '{"stock":"3"}', "2": None}
    assert not sinks.export_csv(items(spark, rows).where("false"), new_folder(spark, "t-none"))


def test_store_ignores_known_urls_and_survives_replay(spark):
    path = new_folder(spark, "t-store")
    keys = ["title"]
    first = items(spark, [(1, "a", "u1", None, None, keys), (1, "b", "u2", None, None, keys), (2, "late", "u1", None, None, keys)])
    second = items(spark, [(3, "c", "u3", None, None, keys), (3, "again", "u1", None, None, keys)])
    assert sinks.store_batch(first, path, 1, "a").count() == 2
    for _ in range(2):
        written = sinks.store_batch(second, path, 1, "b")  # the number of another writer's batch
        assert {(r.job_id, r.inserted) for r in sinks.inserted_counts(written).collect()} == {(3, 1)}
    assert {(r.title, r.url) for r in sinks.read_store(spark, path).collect()} == {("a", "u1"), ("b", "u2"), ("c", "u3")}


def test_entry_and_names(spark):
    assert spec.entry(spark).count() == 50
    assert set(QUERIES) == set(answers()) <= set(spec.queries())
    assert set(spec.oracle_sql()) <= set(spec.queries())


def test_bodies_are_not_shuffled(spark):
    """The flagship reads two columns and moves neither the page nor its text."""
    plan = spec.queries()["items_per_page"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in plan
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("body" in e or "html" in e or "RoundRobin" in e for e in exchanges)
    scan = spec.queries()["capture_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in scan


@pytest.mark.parametrize(
    "name",
    ["capture_scan", "job_request_scan", "sensitive_field_gate", "robots_rule_table", "source_profile", "scrape_route",
     "json_project_fields", "xml_node_to_map", "in_page_dedup", "next_page_edges", "price_clean", "items_per_page",
     "job_metrics", "decision_log", "store_insert_count", "stream_dedup_url"],
)
def test_query_agrees_with_sql(spark, name):
    assert differences(spec.queries()[name](spark, SF), connect(SF), spec.oracle_sql()[name]) is None
