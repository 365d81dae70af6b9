"""Bounded walks over captured pages along next-page links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, markup, urls
from ..functions.text import settled, split_key, strip
from ..sources.workspace import new_folder, stored
from . import policy
from .extraction import ITEM, page_records, shaped
from .profile import blocked_status


def next_page_links(pages: DataFrame) -> DataFrame:
    """Add ``next_urls``: absolute same-host next-page links, distinct, in order.

    Needs url, dom, tags, anchors. Only pages with a paging class or id somewhere are
    walked for the anchors inside such an element.
    """
    def is_paging(t: Column) -> Column:
        seen = [F.coalesce(markup.attribute(t, name).rlike(fixed.PAGING_CLASS), F.lit(False)) for name in ("class", "id")]
        # Most tags don't hold the word at all, so their attributes need not be read.
        return F.when(t.rlike(fixed.PAGING_CLASS), seen[0] | seen[1]).otherwise(False)

    tag = F.when(markup.has_paging_element(F.col("dom")), F.col("tags"))
    pages = settled(
        pages.withColumns({"_inside": markup.spans(tag, is_paging), "_base": urls.base_parts(F.col("url"))})
    )
    base, host = F.col("_base"), F.lower(F.col("_base")["netloc"])

    def is_next(a: Column) -> Column:
        inside = F.exists("_inside", lambda e: (e["first"] < a["at"]) & (a["at"] < e["last"]))
        return F.coalesce(inside, F.lit(False)) | markup.is_paging_link(a)

    targets = F.transform(
        F.filter("anchors", is_next), lambda a: urls.resolve(base, strip(a["href"]))
    )
    same_host = F.filter(targets, lambda u: F.lower(urls.netloc(u)) == host)
    return pages.withColumn("next_urls", F.array_distinct(same_host)).drop("_inside", "_base")


def with_walk_columns(pages: DataFrame) -> DataFrame:
    """Add ``next_urls`` and ``walk_records`` to rows with url, dom and anchors."""
    return page_records(next_page_links(pages)).withColumnRenamed("records", "walk_records").drop("had_cards")


def fetchable(
    facts: DataFrame, robots_files: DataFrame, user_agent: str = fixed.USER_AGENT
) -> DataFrame:
    """What a walk may use of page facts (job_id, url, next_urls, records).

    Pages that robots rules forbid are left out, as a page that was not fetched; of
    several captures of a URL the lowest job_id counts. The rows are stored by column:
    no round of a walk computes them again, and none reads the records.
    """
    one = Window.partitionBy("url").orderBy("job_id")
    first = facts.withColumn("_n", F.row_number().over(one)).where(F.col("_n") == 1)
    decided = policy.robots_decision(first.drop("_n", "job_id"), robots_files, user_agent)
    return stored(decided.where("robots_decision <> 'blocked'").select("url", "next_urls", "records"), "facts")

def page_facts(
    captures: DataFrame, robots_files: DataFrame, user_agent: str = fixed.USER_AGENT
) -> DataFrame:
    """What a walk needs of each captured page: url, next_urls, records.

    Blocked responses give nothing and are left out. The bodies stay in the scan.
    """
    readable = captures.where(~blocked_status(F.col("status")) & F.col("body").isNotNull())
    view = markup.with_page_columns(readable.select("job_id", "url", "body"), "body")
    facts = with_walk_columns(settled(view.drop("text", "body")))
    thin = settled(facts.select("job_id", "url", "next_urls", F.col("walk_records").alias("records")))
    return fetchable(thin, robots_files, user_agent)


ROUNDS = 5  # rounds of a walk in one plan, before its state is stored


def bounded_walk(seeds: DataFrame, facts: DataFrame, max_pages: int = fixed.MAX_PAGES) -> DataFrame:
    """(seed, page_seq, url): pages visited from each distinct seed, breadth first.

    ``seeds`` has url and, where seeds differ, their own ``max_pages``; a seed that
    occurs several times is walked once, as far as the largest of them. State is one
    row per seed (visited urls, at most ``max_pages``; frontier). A round looks the
    frontier up in the facts, keeps the first pages found (the rank filter cuts each
    partition before the shuffle) and builds the next frontier; a page many seeds reach
    is split by adaptive execution (see ``split_key``). After ROUNDS rounds the state is
    stored and only seeds that can go on are read again, so a plan is as large for 500
    pages as for 5, and the walk ends when no seed has a frontier left.
    """
    spark = seeds.sparkSession
    own = F.coalesce(F.max("max_pages"), F.lit(max_pages)) if "max_pages" in seeds.columns else F.max(F.lit(max_pages))
    starts = seeds.groupBy(F.col("url").alias("seed")).agg(own.cast("int").alias("most"))
    if "max_pages" in seeds.columns:
        starts = stored(starts, "seeds")
        max_pages = starts.agg(F.max("most")).first()[0] or 0
    edges = facts.select(split_key(F.col("url")).alias("_key"), F.col("url").alias("_url"), "next_urls")
    state = starts.select("seed", "most", F.array().cast("array<string>").alias("visited"), F.array("seed").alias("frontier"))
    state = state.where("most > 0")
    going = (F.size("frontier") > 0) & (F.size("visited") < F.col("most"))
    folder, step = new_folder(spark, "walk"), 0
    while True:
        for _ in range(min(ROUNDS, max_pages)):
            state = _walk_round(state, edges, max_pages)
        state.write.parquet(f"{folder}/step={step}")
        walked = spark.read.schema(state.schema).parquet(f"{folder}/step={step}")
        state = walked.where(going)
        if max_pages <= ROUNDS or state.isEmpty():
            break
        step += 1
    ended = spark.read.schema(state.schema).parquet(folder)
    if max_pages > ROUNDS:
        ended = ended.where(~going)
    return ended.select("seed", F.posexplode("visited").alias("page_seq", "url"))


def _walk_round(state: DataFrame, edges: DataFrame, max_pages: int) -> DataFrame:
    """One step of every seed: its frontier looked up, the first pages found visited."""
    host = F.lower(urls.netloc(F.col("seed")))
    first_found = Window.partitionBy("seed").orderBy(F.col("_url").isNull(), "ord")
    asked = state.select("seed", "most", "visited", F.posexplode_outer("frontier").alias("ord", "url"))
    found = (
        asked.join(edges, split_key(F.col("url")) == F.col("_key"), "left")
        .withColumn("rank", F.row_number().over(first_found))
        .where(F.col("rank") <= max_pages)
    )
    taken = F.when(
        F.col("_url").isNotNull() & (F.col("rank") <= F.col("most") - F.size("visited")),
        F.struct("rank", "url", "next_urls"),
    )
    grouped = found.groupBy("seed").agg(
        F.first("most").alias("most"), F.first("visited").alias("visited"), F.sort_array(F.collect_list(taken)).alias("new")
    )
    visited = F.concat("visited", F.transform("new", lambda p: p["url"]))
    onward = F.filter(
        F.flatten(F.transform("new", lambda p: p["next_urls"])),
        lambda u: F.lower(urls.netloc(u)) == host,
    )
    return grouped.select("seed", "most", visited.alias("visited"), onward.alias("_next")).select(
        "seed", "most", "visited", F.array_except("_next", "visited").alias("frontier")
    )

def with_limits(jobs: DataFrame, max_pages: int, max_items: int) -> DataFrame:
    """Crawl jobs with their own ``max_pages`` and ``max_items``, or the defaults where they have none."""
    def own(name: str, default: int) -> Column:
        value = F.coalesce(F.col(name).cast("int"), F.lit(default)) if name in jobs.columns else F.lit(default)
        return value.alias(name)

    return jobs.select("job_id", "url", "fields", own("max_pages", max_pages), own("max_items", max_items))


def crawl_items(
    jobs: DataFrame, facts: DataFrame, max_pages: int = fixed.MAX_PAGES, max_items: int = fixed.MAX_ITEMS
) -> DataFrame:
    """Items of each crawl job (job_id, url, fields and, where wanted, max_pages and max_items).

    A seed is walked once, as far as its most generous job allows; the first pages
    and items of a longer walk are those of a shorter one, so each job's limits cut
    the common walk.
    """
    limited = with_limits(jobs, max_pages, max_items)
    seeds = limited
    if {"max_pages", "max_items"} & set(jobs.columns):
        max_items = limited.agg(F.max("max_items")).first()[0] or 0
    else:
        seeds = limited.drop("max_pages")
    walk = bounded_walk(seeds, facts, max_pages)
    found = facts.select(split_key(F.col("url")).alias("_key"), "records")
    records = walk.join(found, split_key(F.col("url")) == F.col("_key")).select(
        "seed", "page_seq", F.explode("records").alias("r")
    )
    kept = item_limit(records.select("seed", "page_seq", "r.pos", "r"), "seed", max_items, rank="_n")
    items = (
        limited.join(
            kept,
            (split_key(F.col("url")) == split_key(F.col("seed")))
            & (F.col("page_seq") < F.col("max_pages")) & (F.col("_n") <= F.col("max_items")),
        )
        .select(
            "job_id", F.col("url").alias("base_url"), "page_seq",
            shaped(F.col("r"), F.col("fields")).cast(ITEM).alias("i"),
        )
    )
    return items.select("job_id", "base_url", "page_seq", "i.*")


def cut_jobs(
    jobs: DataFrame, items: DataFrame, max_pages: int = fixed.MAX_PAGES, max_items: int = fixed.MAX_ITEMS
) -> DataFrame:
    """(job_id, cut): crawl jobs whose items reach a limit of theirs: ``max_items``, else ``max_pages``."""
    seen = items.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"), (F.max("page_seq") + 1).alias("pages"))
    cut = F.when(F.col("n") >= F.col("max_items"), "max_items").when(F.col("pages") >= F.col("max_pages"), "max_pages")
    joined = with_limits(jobs, max_pages, max_items).join(seen, "job_id")
    return joined.select("job_id", cut.alias("cut")).where("cut is not null")


def item_limit(items: DataFrame, key: str, limit: int = fixed.MAX_ITEMS, rank: str | None = None) -> DataFrame:
    """First ``limit`` rows per key in walk order, with their ``rank`` if it is named.

    The rank filter is applied within each partition before rows are shuffled,
    so even a key with a third of all rows sends only ``limit`` per partition.
    """
    order = Window.partitionBy(key).orderBy("page_seq", "pos")
    first = items.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit)
    return first.withColumnRenamed("_rank", rank) if rank else first.drop("_rank")
