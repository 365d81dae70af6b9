"""The whole job run: captures and robots files in, job rows and items out.

Order of work, chosen so that response bodies are read once per scan and never
shuffled:

1. one narrow pass over the captures: gate, profile, strategy, one-page items and
   what walks need of each page; its result is stored as Parquet, without bodies;
2. robots rules join the thin columns of it by origin;
3. crawl jobs walk the page facts, which are other columns of it;
4. items are cleaned, checked and checkpointed; counts and dedup shuffle them by
   (job, url), which spreads a job that holds most rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import settled
from ..operators import asof, cleaning, crawl, extraction, policy, profile, reporting, routing
from ..sources.workspace import ensure_checkpoint_dir, stored

JOB_COLUMNS = ["job_id", "url", "fields", "outputs"]


@dataclass
class Run:
    jobs: DataFrame      # one row per job, all verdicts and counts
    checked: DataFrame   # every item of an allowed job, with validation_error
    unique: DataFrame    # valid items, first per (job, url)


def assess(captures: DataFrame, for_walks: bool = False) -> DataFrame:
    """Narrow pass over responses: gate, profile, tentative strategy, one-page items.

    ``items`` holds what the extractor would give if the job is allowed; crawl
    jobs get theirs later. ``json_read`` and ``xml_read`` tell parse failures.
    ``for_walks`` adds ``next_urls`` and ``walk_records`` of HTML pages, from the
    same dom and anchors.
    """
    # Every border below copies the row, so wide columns leave as soon as their last reader is done.
    df = settled(profile.source_profile(policy.field_gate(captures), keep_page_columns=True).drop("html", "text"))
    if for_walks:
        df = crawl.with_walk_columns(df)
    df = df.drop("tags", "pieces")
    reached = (
        (F.col("risk_level") == "low")
        & F.col("error").isNull()
        & ~profile.blocked_status(F.col("status_code"))
    )
    df = df.withColumn("strategy", routing.strategy(reached))
    df = routing.scrape_route(df, with_html=False)
    df = df.withColumn("_extractor", routing.extractor(reached))
    kind = F.col("_extractor")
    df = df.withColumn("_json", F.when(kind.isin("api_json", "api_like_json"), F.col("body")))
    df = df.withColumn("_xml", F.when(kind == "api_xml", F.col("body")))
    links = extraction.link_items(F.col("anchors"), F.col("dom"), F.col("url"))
    df = settled(df.withColumn("_links", F.when(kind == "static_html", links)).drop("body", "dom", "anchors"))
    df = extraction.json_records(df, "_json").withColumnRenamed("records", "_json_records")
    df = extraction.xml_records(df, "_xml").withColumnRenamed("records", "_xml_records")
    items = (
        F.when(kind == "static_html", F.col("_links"))
        .when(F.col("_json").isNotNull(), extraction.json_items(F.col("_json_records"), F.col("fields")))
        .when(F.col("_xml").isNotNull(), extraction.xml_items(F.col("_xml_records"), F.col("fields")))
    )
    return settled(
        df.withColumns(
            {
                "items": items,
                "json_read": F.col("_json_records").isNotNull(),
                "xml_read": F.col("_xml_records").isNotNull(),
            }
        ).drop(
            "_links", "_json", "_xml", "_json_records", "_xml_records", "_extractor",
            "strategy", "route", "confidence", "route_reasons", "recommended_next_step",
        )
    )


def decide(assessed: DataFrame, robots_files: DataFrame, user_agent: str = fixed.USER_AGENT) -> DataFrame:
    """One thin row per job: robots verdict, authorization, strategy, route, extractor."""
    thin = assessed.drop("items", "next_urls", "walk_records")
    df = policy.robots_decision(thin, robots_files, user_agent).drop("origin", "asked", "outcome")
    # The gate looks at the raw status; a skipped profiler leaves no profile.
    df = policy.authorization_gate(df.withColumn("status", F.col("status_code"))).drop("status")
    skipped = F.col("blocked_by").isin("risk_engine", "robots_checker")
    seen = F.coalesce(~skipped, F.lit(True))
    df = df.withColumns({c: F.when(seen, F.col(c)) for c in [*profile.PROFILE_COLUMNS, "profile_error"]})
    df = df.withColumn("strategy", routing.strategy(F.col("allowed")))
    df = df.withColumn("strategy_reason", routing.strategy_reason(F.col("strategy")))
    df = routing.scrape_route(df, with_html=False)
    return df.withColumn("route_explanation", routing.route_explanation()).withColumn(
        "extractor", routing.extractor(F.col("allowed"))
    )


def dispatch_items(
    assessed: DataFrame, decided: DataFrame, robots_files: DataFrame,
    user_agent: str = fixed.USER_AGENT,
) -> DataFrame:
    """Items of all extractors together, for allowed jobs only, with base_url.

    One-page items are in the assessed rows already; jobs that robots rules
    block leave before their items are exploded, one row per job. Crawl jobs add
    the items of their walk; ``assessed`` was made for walks.
    """
    stopped = decided.where(~F.col("allowed")).select("job_id")
    one_page = extraction.exploded(
        assessed.select("job_id", "url", "items").where("size(items) > 0").join(stopped, "job_id", "left_anti")
    )
    facts = assessed.where("next_urls is not null").select(
        "job_id", "url", "next_urls", F.col("walk_records").alias("records")
    )
    wanted = ["job_id", "url", "fields", *(c for c in ("max_pages", "max_items") if c in decided.columns)]
    crawl_jobs = decided.where("extractor = 'scrapy'").select(*wanted)
    return one_page.unionByName(
        crawl.crawl_items(crawl_jobs, crawl.fetchable(facts, robots_files, user_agent))
    )


def captures_of_jobs(jobs: DataFrame, captures: DataFrame) -> DataFrame:
    """Each job with the capture it may use: the last of its URL not later than ``asked_at``.

    ``jobs``: job_id, url, asked_at (null: now) and their own columns (fields, outputs,
    limits); ``captures``: capture_id, url, fetched_at and the response. Which capture
    a job uses is decided on thin rows; a job without one is an unanswered fetch
    (error), a capture no job uses gives nothing.
    """
    chosen = asof.latest_before(jobs, captures, "url", ("job_id", "asked_at"), ("capture_id", "fetched_at"))
    known = [c for c in captures.columns if c not in jobs.columns or c == "capture_id"]
    asked = jobs.drop("capture_id").join(chosen, "job_id")
    found = asked.join(captures.select(*known), "capture_id", "left")
    missing = F.when(F.col("capture_id").isNull(), F.lit("not captured"))
    return found.withColumn("error", F.coalesce("error", missing)).drop("asked_at")


def run_jobs(
    captures: DataFrame, robots_files: DataFrame, user_agent: str = fixed.USER_AGENT, jobs: DataFrame | None = None
) -> Run:
    """Run every job of ``captures`` (with fields and outputs) to checked items.

    With ``jobs`` apart, each takes its capture as of its time (see ``captures_of_jobs``).
    Columns ``max_pages`` and ``max_items`` limit a job's own walk; ``cut`` of the job
    rows names the limit a walk reached.
    """
    if jobs is not None:
        captures = captures_of_jobs(jobs, captures)
    ensure_checkpoint_dir(captures.sparkSession)
    assessed = stored(assess(captures, for_walks=True), "assessed")
    decided = stored(decide(assessed, robots_files, user_agent), "decided")
    items = dispatch_items(assessed, decided, robots_files, user_agent)
    checked = stored(cleaning.validate(cleaning.clean_items(items)), "checked")
    unique = cleaning.first_by_url(cleaning.valid(checked))
    rows = reporting.with_counts(decided, cleaning.job_item_counts(checked))
    walked = decided.where("extractor = 'scrapy'")
    cut = crawl.cut_jobs(walked, checked.join(walked.select("job_id"), "job_id", "left_semi"))
    rows = rows.join(cut, "job_id", "left")
    return Run(jobs=rows, checked=checked, unique=unique)
