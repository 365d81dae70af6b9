"""Every operator as a query over the given tables (or inputs derived from them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, markup, urls
from ..functions.text import settled, split_key, squeeze
from ..operators import asof, cleaning, crawl, extraction, policy, profile, reporting, routing
from ..sources import captures as source
from ..sources import derived, sinks
from ..sources.tables import given, tasks_for
from ..sources.workspace import new_folder, stored
from ..streaming import ingest
from . import run as plan

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_RUNS: dict[tuple[str, str], plan.Run] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def forget_runs() -> None:
    """Drop remembered runs (the benchmark measures each query from scratch)."""
    _RUNS.clear()


# --- shared inputs ------------------------------------------------------------------
def _captures(spark: SparkSession, sf: str) -> DataFrame:
    return source.with_request(derived.derive(spark, derived.CAPTURES, sf))


def _robots(spark: SparkSession, sf: str) -> DataFrame:
    return derived.derive(spark, derived.ROBOTS_FILES, sf)


def _profile(spark: SparkSession, sf: str, keep: bool = False) -> DataFrame:
    return profile.source_profile(policy.field_gate(_captures(spark, sf)), keep)


def _html(spark: SparkSession, sf: str) -> DataFrame:
    """HTML responses that are taken apart: job_id, url, fields, html, dom."""
    caps = _captures(spark, sf)
    html = profile.content_flags(F.col("content_type"))["is_html"]
    readable = F.col("error").isNull() & ~profile.blocked_status(F.col("status")) & html
    return caps.where(readable).select(
        "job_id", "url", "fields", F.col("body").alias("html"), markup.dom(F.col("body")).alias("dom")
    )


def _anchored(spark: SparkSession, sf: str) -> DataFrame:
    return settled(_html(spark, sf).withColumn("anchors", markup.anchors(F.col("dom"))))


def _kind(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    return source.with_request(derived.derive(spark, sql, sf))


def _assessed(spark: SparkSession, sf: str) -> DataFrame:
    return plan.assess(_captures(spark, sf))


def _decided(spark: SparkSession, sf: str) -> DataFrame:
    return plan.decide(_assessed(spark, sf), _robots(spark, sf))


def _run(spark: SparkSession, sf: str) -> plan.Run:
    """The run over all captures; its checkpointed tables serve many reports."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        _RUNS[key] = plan.run_jobs(_captures(spark, sf), _robots(spark, sf))
    return _RUNS[key]


def _walkable(spark: SparkSession, sf: str) -> DataFrame:
    """Readable HTML responses as the walk sees them, with page columns."""
    caps = _captures(spark, sf)
    html = profile.content_flags(F.col("content_type"))["is_html"]
    pages = caps.where(html & ~profile.blocked_status(F.col("status")) & F.col("body").isNotNull())
    return settled(markup.with_page_columns(pages, "body").drop("body", "text"))


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    html = profile.content_flags(F.col("content_type"))["is_html"]
    return crawl.page_facts(_captures(spark, sf).where(html), _robots(spark, sf))


def _joined(c: str) -> Column:
    return F.array_join(c, "|")


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


# --- sources and sinks ----------------------------------------------------------------
@query
def capture_scan(spark, sf):
    return source.page_scan(spark, sf).select(
        "job_id", "url", F.col("status").cast("long").alias("status"), "content_type",
        profile.body_bytes(F.col("body")).cast("long").alias("body_bytes"),
    )


@query
def job_capture_asof(spark, sf):
    """For every job the capture it may use: the last of its URL that is not later."""
    asks, fetches = (derived.derive(spark, sql, sf) for sql in (derived.ASKS, derived.FETCHES))
    return asof.latest_before(asks, fetches, "url", ("job_id", "asked_at"), ("capture_id", "fetched_at"))


@query
def job_request_scan(spark, sf):
    return _captures(spark, sf).select(
        "job_id", "url", _joined("fields").alias("fields"), F.size("fields").cast("long").alias("n_fields"),
        _joined("outputs").alias("outputs"),
    )


def _for_output(run: plan.Run, output: str) -> DataFrame:
    wanted = run.jobs.where(F.array_contains("outputs", output)).select(
        split_key(F.col("job_id")).alias("_key")
    )
    return run.unique.join(wanted, split_key(F.col("job_id")) == F.col("_key"), "left_semi")


@query
def export_csv(spark, sf):
    folder = sinks.export_csv(_for_output(_run(spark, sf), "csv"), new_folder(spark, "csv"))
    return sinks.read_csv(spark, folder).withColumn("job_id", F.col("job_id").cast("long"))


def _page_items(spark: SparkSession, sf: str, batch: str = "true") -> DataFrame:
    pages = markup.with_page_columns(source.page_scan(spark, sf).where(batch), "body")
    items = pages.withColumn(
        "items", extraction.link_items(F.col("anchors"), F.col("dom"), F.col("url"))
    )
    return cleaning.valid(cleaning.validate(cleaning.clean_items(extraction.exploded(items))))


def _two_batches(spark: SparkSession, sf: str) -> str:
    path = new_folder(spark, "store")
    sinks.store_batch(_page_items(spark, sf, "url like 'https:%'"), path, 1)
    sinks.store_batch(_page_items(spark, sf), path, 2)
    return path


@query
def store_insert_or_ignore(spark, sf):
    return sinks.read_store(spark, _two_batches(spark, sf)).select("title", "url", "source")


@query
def store_insert_count(spark, sf):
    stored = sinks.read_store(spark, _two_batches(spark, sf))
    return stored.groupBy("batch_id", "job_id").agg(F.count(F.lit(1)).alias("inserted"))


@query
def run_report_json(spark, sf):
    path = new_folder(spark, "reports")
    jobs = _with_inserted(_run(spark, sf))
    sinks.write_reports(reporting.run_reports(jobs, {"csv": "csv", "sqlite": "store"}), path)
    counts = ", ".join(f"{c} long" for c in reporting.COUNTS)
    schema = (
        "url string, risk_level string, allowed boolean, authorization_status string, "
        "selected_strategy string, scrape_route struct<route:string,confidence:string>, "
        "source_profile struct<link_count:long,error:string>, "
        f"{counts}, warnings array<string>, errors array<string>, decisions array<struct<layer:string,decision:string,reason:string>>, "
        "output_paths struct<csv:string,sqlite:string>"
    )
    return spark.read.schema(schema).json(path).select(
        "url", "risk_level", "allowed", "authorization_status", "selected_strategy",
        "scrape_route.route", "scrape_route.confidence", "source_profile.link_count",
        F.col("source_profile.error").alias("profile_error"), *reporting.COUNTS,
        F.size("warnings").cast("long").alias("warnings"), F.size("errors").cast("long").alias("errors"),
        F.array_join(
            F.transform("decisions", lambda d: F.concat_ws(": ", d["layer"], d["decision"], d["reason"])), "|"
        ).alias("decisions"),
        F.col("output_paths.csv").alias("csv_path"), F.col("output_paths.sqlite").alias("store_path"),
    )


def _with_inserted(run: plan.Run) -> DataFrame:
    """Job rows with the number of items an empty store takes from each."""
    stored = run.jobs.sparkSession.createDataFrame([], sinks.STORE_SCHEMA)
    fresh = sinks.unseen(sinks.first_items(_for_output(run, "sqlite")), stored)
    return run.jobs.join(sinks.inserted_counts(fresh), "job_id", "left").fillna(0, ["inserted"])


def _log(spark: SparkSession, sf: str) -> DataFrame:
    jobs = _with_inserted(_run(spark, sf))
    return reporting.decision_log(jobs, reporting.job_decisions(stored=F.col("inserted")))


@query
def decision_log(spark, sf):
    path = new_folder(spark, "decisions")
    sinks.write_by(_log(spark, sf), path, "layer")
    return spark.read.parquet(path).select("job_id", *_long("seq"), "layer", "decision", "reason")


@query
def quarantine_sink(spark, sf):
    path = new_folder(spark, "quarantine")
    sinks.write_quarantine(_run(spark, sf).checked, path)
    return spark.read.parquet(path).select(
        "job_id", *_long("page_seq", "pos"), "title", "url", "price", "_validation_error"
    )


@query
def warning_error_log(spark, sf):
    return reporting.message_log(_run(spark, sf).jobs)


# --- policy ---------------------------------------------------------------------------
@query
def field_normalise(spark, sf):
    return _captures(spark, sf).select(
        "job_id", F.array_join(policy.normalised(F.col("fields")), "|").alias("requested")
    )


@query
def sensitive_field_gate(spark, sf):
    return policy.field_gate(_captures(spark, sf)).select(
        "job_id", "risk_level", "risk_decision", _joined("blocked_fields").alias("blocked_fields"), "risk_reason"
    )


@query
def robots_rule_table(spark, sf):
    return policy.robots_rule_table(_robots(spark, sf)).select(
        "origin", *_long("group_no"), _joined("agents").alias("agents"), *_long("rule_no"), "allow", "path"
    )


@query
def robots_url_decision(spark, sf):
    jobs = _captures(spark, sf).select("job_id", "url")
    return policy.robots_decision(jobs, _robots(spark, sf)).select(
        "job_id", "url", "robots_decision", "robots_reason"
    )


@query
def robots_fetch_outcome(spark, sf):
    return policy.fetch_outcome(_robots(spark, sf)).select(
        "origin", F.col("status").cast("long").alias("status"), "outcome"
    )


@query
def authorization_gate(spark, sf):
    jobs = policy.field_gate(_captures(spark, sf)).select("job_id", "url", "risk_level", "status", "error")
    return policy.authorization_gate(policy.robots_decision(jobs, _robots(spark, sf))).select(
        "job_id", "blocked_by", "allowed", "authorization_status"
    )


# --- profile --------------------------------------------------------------------------
@query
def status_block(spark, sf):
    return _captures(spark, sf).select(
        "job_id", *_long("status"), profile.blocked_status(F.col("status")).alias("blocked"),
        profile.blocked_status_reason(F.col("status")).alias("reason"),
    )


@query
def content_type_flags(spark, sf):
    flags = profile.content_flags(F.col("content_type"))
    return _captures(spark, sf).select("job_id", *[c.alias(n) for n, c in flags.items()])


@query
def html_size(spark, sf):
    return _captures(spark, sf).select(
        "job_id", profile.body_bytes(F.col("body")).cast("long").alias("html_size")
    )


@query
def anchor_explode(spark, sf):
    return (
        _anchored(spark, sf)
        .select("job_id", F.explode("anchors").alias("a"))
        .select(
            "job_id", F.col("a.no").cast("long").alias("no"), "a.href", "a.rel", "a.cls", "a.id",
            F.array_join("a.texts", " ").alias("text"),
        )
    )


@query
def link_count(spark, sf):
    return _anchored(spark, sf).select("job_id", F.size("anchors").cast("long").alias("link_count"))


@query
def title_candidates_count(spark, sf):
    return _html(spark, sf).select(
        "job_id", markup.heading_count(F.col("dom")).cast("long").alias("title_candidates_count")
    )


@query
def visible_text(spark, sf):
    dom = F.col("dom")
    return _html(spark, sf).select(
        "job_id", markup.joined_text(dom).alias("profiler_text"),
        markup.joined_text(markup.without_noscript(dom)).alias("router_text"),
    )


@query
def js_heavy(spark, sf):
    dom, html = F.col("dom"), F.col("html")
    return (
        _html(spark, sf)
        .withColumns(
            {
                "text": markup.joined_text(dom),
                "router_text": markup.joined_text(markup.without_noscript(dom)),
                "scripts": markup.script_elements(html),
                "script_tags": F.regexp_count(html, F.lit(r"(?i)<script\b")),
            }
        )
        .select(
            "job_id", *_long("scripts", "script_tags"),
            profile.js_heavy(F.col("scripts"), F.col("text")).alias("profiler_js_heavy"),
            routing.router_js_heavy(F.col("script_tags"), F.length("router_text")).alias("router_js_heavy"),
        )
    )


def _with_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _anchored(spark, sf).withColumn("labels", profile.anchor_labels(F.col("anchors")))


@query
def pagination_signals(spark, sf):
    return _with_labels(spark, sf).select(
        "job_id",
        F.array_join(profile.pagination_signals(F.col("labels"), F.col("dom")), "|").alias("signals"),
    )


@query
def next_page_candidates_count(spark, sf):
    return _with_labels(spark, sf).select(
        "job_id", profile.next_page_count(F.col("labels")).cast("long").alias("next_page_candidates")
    )


@query
def price_candidates_count(spark, sf):
    return derived.derive(spark, derived.PRICE_TEXTS, sf).select(
        "l_orderkey", "l_linenumber", profile.price_count(F.col("price")).cast("long").alias("prices")
    )


@query
def field_evidence_title(spark, sf):
    return _anchored(spark, sf).select(
        "job_id", profile.title_evidence(F.col("dom"), F.col("anchors")).alias("evidence")
    )


@query
def field_evidence_url(spark, sf):
    return _anchored(spark, sf).select("job_id", (F.size("anchors") > 0).alias("evidence"))


@query
def field_evidence_price(spark, sf):
    return _html(spark, sf).withColumn("text", markup.joined_text(F.col("dom"))).select(
        "job_id", (profile.price_count(F.col("text")) > 0).alias("evidence")
    )


@query
def field_evidence_availability(spark, sf):
    return derived.derive(spark, derived.STOCK_TEXTS, sf).select(
        "o_orderkey", profile.availability_evidence(F.col("text")).alias("evidence")
    )


_ASKED = ["the", "que", "und", "para", "license"]


@query
def field_evidence_generic(spark, sf):
    asked = F.array(*[F.lit(f) for f in _ASKED])
    no = F.lit(False)
    seen = {"title": no, "url": no, "price": no, "availability": no}
    return given(spark, sf, "documents").select(
        "doc_id", F.array_join(profile.field_hits(asked, F.lower("text"), seen), "|").alias("hits")
    )


@query
def visible_field_hits(spark, sf):
    return _profile(spark, sf).select(
        "job_id", _joined("visible_field_hits").alias("hits"), "data_visible_in_html"
    )


@query
def source_profile(spark, sf):
    return _profile(spark, sf).select(
        "job_id", *_long("status_code", "html_size", "next_page_candidates_count", "link_count",
                         "title_candidates_count", "price_candidates_count"),
        "content_type", "is_json", "is_xml", "is_html", "js_heavy", "has_pagination", "pagination_detected",
        "data_visible_in_html", _joined("pagination_signals").alias("pagination_signals"),
        _joined("visible_field_hits").alias("visible_field_hits"), "profile_error",
    )


# --- strategy and routing ---------------------------------------------------------------
def _local_strategy(spark: SparkSession, sf: str) -> DataFrame:
    """Strategy before robots rules: gate, status and profile only."""
    allowed = (
        (F.col("risk_level") == "low")
        & F.col("error").isNull()
        & ~profile.blocked_status(F.col("status_code"))
    )
    return _profile(spark, sf).withColumn("strategy", routing.strategy(allowed))


@query
def strategy_select(spark, sf):
    return _local_strategy(spark, sf).select(
        "job_id", "strategy", routing.strategy_reason(F.col("strategy")).alias("strategy_reason")
    )


@query
def looks_like_json(spark, sf):
    return _captures(spark, sf).select("job_id", routing.looks_like_json(F.col("body")).alias("json_like"))


@query
def looks_like_xml(spark, sf):
    return _captures(spark, sf).select("job_id", routing.looks_like_xml(F.col("body")).alias("xml_like"))


@query
def url_suffix_test(spark, sf):
    return _captures(spark, sf).select(
        "job_id", urls.path_ends_with(F.col("url"), [".json"]).alias("json_url"),
        urls.path_ends_with(F.col("url"), [".xml", ".rss", ".atom"]).alias("xml_url"),
    )


@query
def blocked_pattern(spark, sf):
    low = _captures(spark, sf).select("job_id", F.lower("body").alias("low"))
    return low.select("job_id", routing.blocked_pattern(F.col("low")).alias("pattern"))


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    """The router's content signals need the captures alone."""
    return routing.html_signals(_captures(spark, sf).select("job_id", F.col("body").alias("content")), "content")


@query
def target_structure_count(spark, sf):
    return _signals(spark, sf).select("job_id", *_long("target_like_structure_count"))


@query
def html_signals(spark, sf):
    return _signals(spark, sf).select(
        "job_id", "html_provided", *_long("html_length", "script_count", "visible_text_length",
                                          "target_like_structure_count", "html_next_page_candidates_count"),
        "blocked_pattern", "json_like_content", "xml_like_content", "html_has_pagination",
        _joined("html_pagination_signals").alias("html_pagination_signals"),
    )


@query
def metadata_signals(spark, sf):
    return routing.metadata_signals(_profile(spark, sf)).select(
        "job_id", *_long("status_code", "meta_next_page_candidates"), "meta_content_type", "meta_is_json",
        "meta_is_xml", "meta_is_html", "meta_js_heavy", "meta_data_visible", "meta_has_pagination",
        _joined("meta_pagination_signals").alias("meta_pagination_signals"),
        _joined("meta_field_hits").alias("meta_field_hits"), "profile_error",
    )


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    # The router reads a page's dom and anchors; what else the profile made of it is not copied on.
    pages = settled(_profile(spark, sf, keep=True).drop("html", "tags", "pieces", "text")).withColumnRenamed("body", "content")
    return routing.scrape_route(settled(routing.html_signals(pages, "content")), with_html=True)


@query
def scrape_route(spark, sf):
    return _routed(spark, sf).select("job_id", "route", "confidence", "recommended_next_step")


@query
def scrape_route_metadata(spark, sf):
    return routing.scrape_route(_profile(spark, sf), with_html=False).select(
        "job_id", "route", "confidence", "recommended_next_step"
    )


@query
def route_reasons(spark, sf):
    return _routed(spark, sf).select("job_id", _joined("route_reasons").alias("reasons"))


@query
def route_explanation(spark, sf):
    return _routed(spark, sf).select("job_id", routing.route_explanation().alias("explanation"))


@query
def effective_extractor(spark, sf):
    return _decided(spark, sf).select("job_id", "allowed", "strategy", "route", "extractor")


@query
def dispatch_union(spark, sf):
    assessed = stored(plan.assess(_captures(spark, sf), for_walks=True), "assessed")
    decided = stored(plan.decide(assessed, _robots(spark, sf)), "decided")
    items = plan.dispatch_items(assessed, decided, _robots(spark, sf))
    return items.select("job_id", *_long("page_seq", "pos"), "title", "url", "price", "source")


@query
def manual_review_queue(spark, sf):
    return reporting.review_queue(_run(spark, sf).jobs)


@query
def strategy_route_disagreement(spark, sf):
    return reporting.strategy_route_table(_decided(spark, sf))


# --- extraction -----------------------------------------------------------------------
def _json(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.json_records(_kind(spark, sf, derived.JSON_CAPTURES))


@query
def json_records(spark, sf):
    read = settled(_json(spark, sf).select("job_id", "records"))
    rows = read.select("job_id", F.posexplode("records").alias("pos", "rec"))
    return rows.select(
        "job_id", *_long("pos"),
        *[F.get_json_object("rec", f"$.{k}").alias(k) for k in ("title", "price", "stock", "href")],
    )


def _json_items(spark: SparkSession, sf: str) -> DataFrame:
    items = _json(spark, sf).withColumn(
        "items", extraction.json_items(F.col("records"), F.col("fields"))
    )
    items = settled(items.select("job_id", "items"))
    return settled(items.select("job_id", F.explode("items").alias("i")).select("job_id", "i.*"))


@query
def json_project_fields(spark, sf):
    items = _json_items(spark, sf)
    value = F.when(F.col("key") == "source", F.col("source"))
    for name in ("title", "url", "price"):
        value = F.when(F.col("key") == name, F.col(name)).otherwise(value)
    rows = items.withColumn("key", F.explode("keys"))
    return rows.select(
        "job_id", *_long("pos"), "key",
        F.coalesce(value, F.try_element_at("extra", F.col("key"))).alias("value"),
    )


@query
def json_url_alias(spark, sf):
    items = _json_items(spark, sf).where(F.array_contains("keys", "url"))
    return items.select("job_id", *_long("pos"), "url")


@query
def json_failures(spark, sf):
    read = _json(spark, sf)
    decided = read.withColumn("decision", extraction.fetch_decision("json", F.col("records").isNotNull()))
    return decided.select("job_id", "decision", extraction.fetch_warning("json", F.col("decision")).alias("warning"))


def _xml(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.xml_records(_kind(spark, sf, derived.XML_CAPTURES))


def _xml_rows(spark: SparkSession, sf: str) -> DataFrame:
    read = settled(_xml(spark, sf).select("job_id", "records"))
    return read.select("job_id", F.posexplode("records").alias("pos", "r")).select(
        "job_id", *_long("pos"), "r.tag", "r.children"
    )


@query
def xml_records(spark, sf):
    return _xml_rows(spark, sf).select("job_id", "pos", "tag")


@query
def xml_repeated_children(spark, sf):
    return _xml_rows(spark, sf).where(~F.col("tag").isin(fixed.XML_RECORD_TAGS)).select("job_id", "pos", "tag")


@query
def xml_node_to_map(spark, sf):
    keys = F.array_distinct(F.transform("children", lambda c: c["tag"]))
    rows = _xml_rows(spark, sf).withColumn("key", F.explode(keys))
    return rows.select(
        "job_id", "pos", "key", extraction.xml_value(F.col("children"), F.col("key")).alias("value")
    )


@query
def xml_project_fields(spark, sf):
    items = _xml(spark, sf).withColumn(
        "items", extraction.xml_items(F.col("records"), F.col("fields"))
    )
    return settled(items.select("job_id", "items")).select("job_id", F.explode("items").alias("i")).select(
        "job_id", F.col("i.pos").cast("long").alias("pos"), "i.title", "i.url", "i.price", "i.source",
        F.col("i.extra")["note"].alias("note"), F.size("i.keys").cast("long").alias("n_keys"),
    )


@query
def xml_failures(spark, sf):
    read = _xml(spark, sf)
    decided = read.withColumn("decision", extraction.fetch_decision("xml", F.col("records").isNotNull()))
    return decided.select("job_id", "decision", extraction.fetch_warning("xml", F.col("decision")).alias("warning"))


def _links(spark: SparkSession, sf: str) -> DataFrame:
    items = _anchored(spark, sf).withColumn(
        "items", extraction.link_items(F.col("anchors"), F.col("dom"), F.col("url"))
    )
    return extraction.exploded(items)


@query
def html_links(spark, sf):
    return _links(spark, sf).where(F.col("source") == fixed.SOURCE_LINKS).select(
        "job_id", *_long("pos"), "title", "url", "source"
    )


@query
def html_title_fallback(spark, sf):
    return _links(spark, sf).where(F.col("source") == fixed.SOURCE_TITLE).select("job_id", "title", "url", "source")


def _cards(spark: SparkSession, sf: str) -> DataFrame:
    pages = extraction.card_segments(_walkable(spark, sf).drop("anchors"))
    pages = settled(pages.select("job_id", urls.base_parts(F.col("url")).alias("base"), "cards"))
    return pages.select("job_id", "base", F.posexplode("cards").alias("pos", "card"))


@query
def card_segments(spark, sf):
    return _cards(spark, sf).select("job_id", *_long("pos"), "card")


@query
def card_title(spark, sf):
    return _cards(spark, sf).select(
        "job_id", *_long("pos"), extraction.card_title(F.col("card")).alias("title")
    )


@query
def card_url(spark, sf):
    return _cards(spark, sf).select(
        "job_id", *_long("pos"), extraction.card_url(F.col("card"), F.col("base")).alias("url")
    )


@query
def card_price(spark, sf):
    return _cards(spark, sf).select(
        "job_id", *_long("pos"), extraction.card_price(F.col("card")).alias("price")
    )


def _page_records(spark: SparkSession, sf: str) -> DataFrame:
    records = extraction.page_records(_walkable(spark, sf))
    return settled(records.select("job_id", "fields", "records", "had_cards"))


@query
def in_page_dedup(spark, sf):
    rows = _page_records(spark, sf).select("job_id", F.explode("records").alias("r"))
    return rows.select("job_id", F.col("r.pos").cast("long").alias("pos"), "r.title", "r.url", "r.price")


@query
def card_link_fallback(spark, sf):
    pages = _page_records(spark, sf)
    rows = pages.where(~F.col("had_cards")).select("job_id", F.explode("records").alias("r"))
    return rows.select("job_id", F.col("r.pos").cast("long").alias("pos"), "r.title", "r.url")


@query
def shape_item(spark, sf):
    rows = _page_records(spark, sf).select(
        "job_id", F.explode(F.transform("records", lambda r: extraction.shaped(r, F.col("fields")))).alias("i")
    )
    return rows.select(
        "job_id", F.col("i.pos").cast("long").alias("pos"), "i.title", "i.url", "i.price",
        F.array_join("i.keys", "|").alias("keys"),
    )


@query
def next_page_edges(spark, sf):
    linked = settled(crawl.next_page_links(_walkable(spark, sf)).select("job_id", "next_urls"))
    edges = linked.select("job_id", F.posexplode("next_urls").alias("ord", "next_url"))
    return edges.select("job_id", *_long("ord"), "next_url")


@query
def bounded_crawl(spark, sf):
    seeds = _html(spark, sf).select("url")
    return crawl.bounded_walk(seeds, _facts(spark, sf)).select("seed", *_long("page_seq"), "url")


SMALL_LIMIT = 8  # far below the default of 100, so that the limit bites on this data


@query
def item_limit(spark, sf):
    jobs = _html(spark, sf).select("job_id", "url", "fields")
    items = crawl.crawl_items(jobs, _facts(spark, sf), max_items=SMALL_LIMIT)
    return items.select("job_id", *_long("page_seq", "pos"), "title", "url", "price")


@query
def crawl_status_skip(spark, sf):
    facts = _facts(spark, sf)
    return facts.select(
        "url", F.size("next_urls").cast("long").alias("links"), F.size("records").cast("long").alias("items")
    )


# --- cleaning, validation, deduplication --------------------------------------------------
@query
def squeeze_whitespace(spark, sf):
    return given(spark, sf, "documents").select("doc_id", squeeze(F.col("text")).alias("text"))


@query
def url_resolve(spark, sf):
    rows = _anchored(spark, sf).select(
        "job_id", urls.base_parts(F.col("url")).alias("base"), F.explode("anchors").alias("a")
    )
    return rows.select(
        "job_id", F.col("a.no").cast("long").alias("no"), "a.href",
        urls.resolve(F.col("base"), squeeze(F.col("a.href"))).alias("url"),
    )


@query
def price_clean(spark, sf):
    return derived.derive(spark, derived.PRICE_TEXTS, sf).select(
        "l_orderkey", "l_linenumber", cleaning.clean_price(F.col("price")).alias("price")
    )


def _one_page_items(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_items(extraction.exploded(_assessed(spark, sf)))


@query
def clean_items(spark, sf):
    return _one_page_items(spark, sf).select("job_id", *_long("pos"), "title", "url", "price", "source")


@query
def rule_title(spark, sf):
    return _one_page_items(spark, sf).select(
        "job_id", *_long("pos"), "source", cleaning.title_error().alias("error")
    )


@query
def rule_url(spark, sf):
    return _one_page_items(spark, sf).select(
        "job_id", *_long("pos"), "source", cleaning.url_error().alias("error")
    )


@query
def rule_price(spark, sf):
    return derived.derive(spark, derived.PRICE_TEXTS, sf).select(
        "l_orderkey", "l_linenumber", cleaning.price_error().alias("error")
    )


@query
def validate_split(spark, sf):
    return _run(spark, sf).checked.select(
        "job_id", *_long("page_seq", "pos"), "title", "url", "price", "validation_error"
    )


@query
def validation_summary(spark, sf):
    return cleaning.validation_summary(_run(spark, sf).checked)


@query
def dedup_first_by_url(spark, sf):
    return _run(spark, sf).unique.select("job_id", *_long("page_seq", "pos"), "title", "url", "price", "copies")


@query
def duplicates_removed(spark, sf):
    return _run(spark, sf).jobs.select("job_id", "duplicates_removed")


# --- job reports ------------------------------------------------------------------------
@query
def job_metrics(spark, sf):
    return _run(spark, sf).jobs.select("job_id", *reporting.COUNTS)


@query
def job_status(spark, sf):
    return _run(spark, sf).jobs.select("job_id", reporting.job_failed().alias("failed"))


@query
def run_summary(spark, sf):
    return reporting.run_summary(_run(spark, sf).jobs)


@query
def audit_trail_query(spark, sf):
    return reporting.audit_trail(_log(spark, sf)).select("job_id", *_long("seq"), "layer", "decision", "reason")


# --- flagship ---------------------------------------------------------------------------
@query
def items_per_page(spark, sf):
    """Links of every page: extracted, cleaned, checked, counted."""
    pages = markup.with_page_columns(source.page_scan(spark, sf), "body")
    items = pages.withColumn(
        "items", extraction.link_items(F.col("anchors"), F.col("dom"), F.col("url"))
    )
    checked = cleaning.validate(cleaning.clean_items(extraction.exploded(items)))
    return cleaning.job_item_counts(checked)


# --- streaming --------------------------------------------------------------------------
def _arrivals(spark: SparkSession, sf: str, sql: str, steps: int = 4) -> DataFrame:
    """Captures as a stream: written in the order of their time, one step's files arrive per trigger.

    Every step has the same number of files, which grows with the rows: they are tasks of
    the trigger that reads them, and of the job that writes them.
    """
    path, rows = new_folder(spark, "arrivals"), stored(derived.derive(spark, sql, sf), "captures")
    time = F.unix_timestamp("fetched_at")
    cuts = rows.agg(F.percentile_approx(time, [i / steps for i in range(1, steps)], 1000)).first()[0] or []
    spans = [
        (F.lit(True) if low is None else time >= low) & (F.lit(True) if high is None else time < high)
        for low, high in zip([None, *cuts], [*cuts, None], strict=True)
    ]
    files = tasks_for(spark, min(rows.agg(*map(F.count_if, spans)).first()))
    for span in spans:
        part = rows.where(span)
        part = part.coalesce(1) if files == 1 else part.repartition(files)
        part.write.mode("append").parquet(path)
    return ingest.capture_stream(spark, path, files)


@query
def stream_ingest(spark, sf):
    arrivals = _arrivals(spark, sf, derived.CAPTURES)
    out = new_folder(spark, "stream-items")
    items = ingest.checked_items(arrivals, _robots(spark, sf)).drop("extra")
    ingest.to_parquet(items, out, new_folder(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(out).select(
        "job_id", *_long("pos"), "title", "url", "price", "source", "validation_error"
    )


def _stream_valid(spark: SparkSession, sf: str) -> DataFrame:
    arrivals = _arrivals(spark, sf, derived.CAPTURES)
    return cleaning.valid(ingest.checked_items(arrivals, _robots(spark, sf))).drop("extra")


@query
def stream_dedup_url(spark, sf):
    """State bounded by event time; repeats later than that are caught by the store."""
    out = new_folder(spark, "stream-urls")
    ingest.to_store(ingest.first_seen_urls(_stream_valid(spark, sf)), out, new_folder(spark, "stream-state")).awaitTermination()
    return sinks.read_store(spark, out).select("url")


@query
def stream_crawl_queue(spark, sf):
    """Walks of the jobs a stream of captures hands on: queue as it arrives, then the walk."""
    arrivals, out = _arrivals(spark, sf, derived.CAPTURES), new_folder(spark, "crawl-queue")
    queue = ingest.crawl_queue(arrivals, _robots(spark, sf))
    ingest.to_parquet(queue, out, new_folder(spark, "stream-state")).awaitTermination()
    jobs = spark.read.schema(queue.schema).parquet(out)
    items = crawl.crawl_items(jobs, _facts(spark, sf))
    return items.select("job_id", *_long("page_seq", "pos"), "title", "url", "price")


@query
def stream_store(spark, sf):
    out = new_folder(spark, "stream-store")
    ingest.to_store(_stream_valid(spark, sf), out, new_folder(spark, "stream-state")).awaitTermination()
    return sinks.read_store(spark, out).select("url")
