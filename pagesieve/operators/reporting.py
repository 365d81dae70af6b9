"""Decision log, messages, counts and reports, all from one row per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .profile import PROFILE_COLUMNS, blocked_status_reason, profile_reason

COUNTS = [
    "raw_items_count", "clean_items_count", "valid_items_count", "invalid_items_count",
    "duplicates_removed",
]
LAYERS = [
    "risk_engine", "robots_checker", "source_profiler", "strategy_selector", "routing", "extractor",
    "cleaner", "validator", "deduplicator", "csv_exporter", "sqlite_store",
]
_DECISION = "struct<seq:int,layer:string,decision:string,reason:string>"


def with_counts(decided: DataFrame, counts: DataFrame) -> DataFrame:
    """Job rows with item counts; jobs without items get zeros."""
    df = decided.join(counts, "job_id", "left")
    return df.fillna(0, COUNTS)


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def extractor_decision() -> Column:
    kind = F.col("extractor")
    return (
        F.when(kind.isin("api_json", "api_like_json"),
               F.when(F.col("json_read"), "json_extracted").otherwise("json_parse_failed"))
        .when(kind == "api_xml", F.when(F.col("xml_read"), "xml_extracted").otherwise("xml_parse_failed"))
        .when(kind.isin("static_html", "scrapy"), "extracted")
        .when(kind.isin("selenium", "manual_review"), F.concat(kind, F.lit("_skipped")))
    )


def extractor_note() -> Column:
    """Warning of an extractor that gives nothing; null for one that ran."""
    kind, url = F.col("extractor"), F.col("url")
    out = F.when(
        extractor_decision() == "json_parse_failed", _text("json_extractor: invalid JSON from ", url)
    ).when(extractor_decision() == "xml_parse_failed", _text("xml_extractor: invalid XML from ", url))
    for name, note in fixed.SKIPPED_NOTE.items():
        out = out.when(
            kind == name,
            f"Strategy '{name}' was selected but its extractor is not implemented in V1. "
            f"{note} No items extracted.",
        )
    return out


def _extractor_reason() -> Column:
    kind, url, n = F.col("extractor"), F.col("url"), F.col("raw_items_count")
    return (
        F.when(extractor_note().isNotNull(), extractor_note())
        .when(kind == "static_html",
              _text("Extracted ", n, " raw item(s) from ", url,
                    " using static HTML extraction (requests + BeautifulSoup)."))
        .when(kind == "scrapy",
              _text("Extracted ", n, " raw item(s) from paginated HTML using Scrapy "
                    f"with max_pages={fixed.MAX_PAGES}, max_items={fixed.MAX_ITEMS}, "
                    "same-domain pagination only."))
        .when(kind == "api_xml", _text("Extracted ", n, " raw item(s) from ", url, " using XML extraction."))
        .otherwise(_text("Extracted ", n, " raw item(s) from ", url, " using API-like JSON extraction."))
    )


def job_decisions(csv_path: str = "csv", store_path: str = "store", stored: Column | None = None) -> Column:
    """Decisions of one job, in order, as an array: no grouping needed."""
    risk = F.col("risk_level") == "high"
    by = F.coalesce("blocked_by", F.lit(""))
    earlier = by.isin("risk_engine", "robots_checker")
    raw, unique, doubles = (F.col(c) for c in ("raw_items_count", "valid_items_count", "duplicates_removed"))
    inserted = F.lit(0) if stored is None else stored
    rows = {
        "risk_engine": (F.lit(True), F.col("risk_decision"), F.col("risk_reason")),
        "robots_checker": (
            F.lit(True),
            F.when(risk, "skipped").otherwise(F.col("robots_decision")),
            F.when(risk, "Job already blocked by a previous layer; robots check skipped.")
            .otherwise(F.col("robots_reason")),
        ),
        "source_profiler": (
            F.lit(True),
            F.when(earlier, "skipped").when(by == "source_profiler", "blocked").otherwise("profiled"),
            F.when(earlier, "Job already blocked by a previous layer; profiling skipped.")
            .when(F.col("profile_error").isNotNull(), F.col("profile_error"))
            .when(by == "source_profiler", blocked_status_reason(F.col("status_code")))
            .otherwise(profile_reason()),
        ),
        "strategy_selector": (F.lit(True), F.col("strategy"), F.col("strategy_reason")),
        "routing": (F.lit(True), F.col("route"), F.array_join("route_reasons", "; ")),
        "extractor": (F.col("extractor").isNotNull(), extractor_decision(), _extractor_reason()),
        "cleaner": (
            F.lit(True),
            F.when(raw == 0, "skipped").otherwise("cleaned"),
            F.when(raw == 0, "No raw items to clean.").otherwise(
                _text("Cleaned ", raw, " item(s): normalised whitespace, resolved relative URLs against '",
                      F.col("url"), "', cleaned price strings.")
            ),
        ),
        "validator": (
            F.lit(True), F.lit("validated"),
            _text(unique + doubles, " item(s) valid, ", F.col("invalid_items_count"), " item(s) invalid. "
                  "Rules: title required, url must be http/https, price must be numeric."),
        ),
        "deduplicator": (
            F.lit(True), F.lit("deduplicated"),
            _text("Removed ", doubles, " duplicate(s) using 'url' as the key. ", unique,
                  " unique item(s) remain."),
        ),
        "csv_exporter": (
            F.array_contains("outputs", "csv"),
            F.when(unique == 0, "skipped").otherwise("exported"),
            F.when(unique == 0, "No valid items to export.").otherwise(
                _text("Wrote ", unique, f" item(s) to CSV: {csv_path}")
            ),
        ),
        "sqlite_store": (
            F.array_contains("outputs", "sqlite"),
            F.when(unique == 0, "skipped").otherwise("stored"),
            F.when(unique == 0, "No valid items to store.").otherwise(
                _text("Inserted ", inserted, f" new item(s) into SQLite at {store_path}. "
                      "Duplicate URLs were ignored (url is UNIQUE).")
            ),
        ),
    }
    entries = [
        F.when(
            there,
            F.struct(
                F.lit(LAYERS.index(layer)).alias("seq"), F.lit(layer).alias("layer"),
                decision.alias("decision"), reason.alias("reason"),
            ).cast(_DECISION),
        )
        for layer, (there, decision, reason) in rows.items()
    ]
    return F.array_compact(F.array(*entries))


def decision_log(jobs: DataFrame, decisions: Column | None = None) -> DataFrame:
    """(job_id, seq, layer, decision, reason)."""
    entries = job_decisions() if decisions is None else decisions
    return jobs.select("job_id", F.explode(entries).alias("d")).select("job_id", "d.*")


def audit_trail(log: DataFrame) -> DataFrame:
    """The log as shown to people: reasons cut, ordered by job and step."""
    return log.withColumn("reason", F.left("reason", F.lit(fixed.TRAIL_WIDTH))).orderBy("job_id", "seq")


def warnings() -> Column:
    return F.array_compact(
        F.array(
            F.when(
                (F.col("risk_level") == "low") & (F.col("robots_decision") == "warning"),
                F.col("robots_reason"),
            ),
            extractor_note(),
        )
    )


def errors() -> Column:
    by = F.col("blocked_by")
    return F.array_compact(
        F.array(
            F.when(by == "risk_engine", F.col("risk_reason")),
            F.when(by == "robots_checker", F.col("robots_reason")),
            F.when(
                by == "source_profiler",
                F.coalesce("profile_error", blocked_status_reason(F.col("status_code"))),
            ),
        )
    )


def message_log(jobs: DataFrame) -> DataFrame:
    """(job_id, severity, message) of warnings and errors."""
    def tagged(severity: str, texts: Column) -> Column:
        return F.transform(
            texts, lambda t: F.struct(F.lit(severity).alias("severity"), t.alias("message"))
        )

    both = F.concat(tagged("warning", warnings()), tagged("error", errors()))
    return jobs.select("job_id", F.explode(both).alias("m")).select("job_id", "m.*")


def job_failed() -> Column:
    return ~F.col("allowed") | (F.size(errors()) > 0)


def run_summary(jobs: DataFrame) -> DataFrame:
    return jobs.select(
        "job_id", "url", "risk_level", "allowed", "authorization_status", "strategy", "route",
        "confidence", "raw_items_count", "valid_items_count", "invalid_items_count",
        "duplicates_removed", job_failed().alias("failed"),
    )


def run_reports(jobs: DataFrame, output_paths: dict[str, str] | None = None) -> DataFrame:
    """(job_id, report): one JSON document per job, blocked jobs too.

    A projection of the job row; the stamp is the only value that varies. With a
    column ``inserted`` the report tells how many rows were really stored, with a
    column ``cut`` which limit a walk reached. A path
    is given for outputs that were asked for and had items to write.
    """
    profile = F.struct(
        *[F.col(c) for c in PROFILE_COLUMNS], F.col("profile_error").alias("error")
    )
    route = F.when(
        F.col("route").isNotNull(),
        F.struct(
            "route", "confidence", F.col("route_reasons").alias("reasons"), "recommended_next_step"
        ),
    )
    paths = output_paths or {}
    written = F.array_compact(
        F.array(
            *(
                F.when(
                    F.array_contains("outputs", output) & (F.col("valid_items_count") > 0),
                    F.struct(F.lit(output).alias("key"), F.lit(path).alias("value")),
                )
                for output, path in paths.items()
            )
        )
    ).cast("array<struct<key:string,value:string>>")
    report = F.struct(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("generated_at"),
        "url", "fields", "outputs", "risk_level", "allowed", "authorization_status",
        profile.alias("source_profile"),
        F.col("strategy").alias("selected_strategy"),
        "strategy_reason",
        route.alias("scrape_route"),
        "route_explanation",
        *COUNTS,
        warnings().alias("warnings"),
        errors().alias("errors"),
        F.transform(
            job_decisions(
                paths.get("csv", "csv"), paths.get("sqlite", "store"),
                F.col("inserted") if "inserted" in jobs.columns else None,
            ),
            lambda d: F.struct(d["layer"], d["decision"], d["reason"]),
        ).alias("decisions"),
        F.map_from_entries(written).alias("output_paths"),
        *([F.col("cut").alias("limit_reached")] if "cut" in jobs.columns else []),
    )
    return jobs.select("job_id", F.to_json(report).alias("report"))


def strategy_route_table(jobs: DataFrame) -> DataFrame:
    """How often each strategy meets each route; the route names are known."""
    from .routing import ROUTES

    return jobs.groupBy("strategy").pivot("route", ROUTES).count().fillna(0, ROUTES)


def review_queue(jobs: DataFrame) -> DataFrame:
    """Jobs that no extractor can serve, with the note for the reviewer."""
    return jobs.where(F.col("extractor").isin("selenium", "manual_review")).select(
        "job_id", "url", "strategy", extractor_decision().alias("decision"),
        extractor_note().alias("note"),
    )
