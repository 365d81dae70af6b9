"""Strategy, route, reasons and the extractor that will run. Pure projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, markup, urls
from ..functions.text import any_of, first_of, strip
from .profile import anchor_labels, next_page_count, pagination_signals

STRATEGIES = list(fixed.STRATEGY_REASON)
ROUTES = [
    "static_html", "scrapy_crawl", "browser_render", "api_like_json", "api_like_xml",
    "fallback_manual_review",
]
# case -> route, confidence, key of the recommended next step
_CASES = {
    "stop": ("fallback_manual_review", "red", "stop"),
    "json": ("api_like_json", "green", "json"),
    "xml": ("api_like_xml", "green", "xml"),
    "unseen_js": ("browser_render", "yellow", "render"),
    "unseen_crawl": ("scrapy_crawl", "yellow", "crawl"),
    "unseen_static": ("static_html", "yellow", "static"),
    "unseen": ("fallback_manual_review", "yellow", "fetch"),
    "short": ("browser_render", "yellow", "short"),
    "scripts": ("browser_render", "yellow", "scripts"),
    "crawl": ("scrapy_crawl", "green", "crawl"),
    "static": ("static_html", "green", "static"),
    "unclear": ("fallback_manual_review", "red", "unclear"),
}


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def strategy(allowed: Column) -> Column:
    """First match wins, from ``allowed`` and the profile columns."""
    visible = _true(F.col("data_visible_in_html"))
    paged = _true(F.col("has_pagination")) | _true(F.col("pagination_detected"))
    heavy, html = _true(F.col("js_heavy")), _true(F.col("is_html"))
    return (
        F.when(~allowed, "blocked")
        .when(_true(F.col("is_json")), "api_json")
        .when(_true(F.col("is_xml")), "api_xml")
        .when(html & visible & paged, "scrapy")
        .when(html & visible & ~heavy, "static_html")
        .when(html & heavy, "selenium")
        .otherwise("manual_review")
    )


def strategy_reason(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for key, text in fixed.STRATEGY_REASON.items():
        out = F.when(name == key, F.lit(text)).otherwise(out)
    return out


# --- content tests ------------------------------------------------------------
def parses_as_json(text: Column) -> Column:
    """The whole text is one JSON value.

    Wrapped as array and as object value, so that text after a complete value
    (which the JSON functions ignore) is noticed.
    """
    options = {"allowSingleQuotes": "false"}
    as_array = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", options)
    as_value = F.from_json(F.concat(F.lit('{"k":'), text, F.lit("}")), "map<string,string>", options)
    return _true((F.size(as_array) == 1) & as_value.isNotNull())


def looks_like_json(content: Column) -> Column:
    bare = strip(content)
    return F.when(_true(F.left(bare, F.lit(1)).isin("{", "[")), parses_as_json(bare)).otherwise(False)


def looks_like_xml(content: Column) -> Column:
    bare = strip(content)
    low = F.lower(bare)
    starts = any_of([F.startswith(low, F.lit(s)) for s in fixed.XML_STARTS])
    records = any_of([bare.rlike(rf"(?is)<{t}\b[^>]*>.*</{t}>") for t in fixed.XML_RECORD_TAGS])
    return F.when(_true(F.startswith(bare, F.lit("<"))), starts | records).otherwise(False)


def blocked_pattern(low_html: Column) -> Column:
    """First phrase, in list order, found anywhere in the lower-cased source."""
    return first_of(fixed.BLOCKED_PHRASES, lambda p: F.contains(low_html, F.lit(p)))


def router_js_heavy(scripts: Column, text_length: Column) -> Column:
    return (scripts >= fixed.ROUTE_SCRIPTS_FROM) & (text_length < fixed.ROUTE_TEXT_UNDER)


def html_signals(df: DataFrame, html: str = "html") -> DataFrame:
    """Add the 11 content signals of the router.

    Where ``df`` carries ``dom`` and ``anchors`` of its pages (see
    ``with_page_columns``), they are used and only other content is taken apart here.
    """
    source = F.col(html)
    dom = F.col("dom") if "dom" in df.columns else F.lit(None).cast("string")
    known = F.col("anchors") if "anchors" in df.columns else None
    df = df.withColumns(
        {
            "html_provided": source.isNotNull(),
            "html_length": F.coalesce(F.length(source), F.lit(0)),
            "_low": F.lower(source),
            "json_like_content": looks_like_json(source),
            "_xml_like": looks_like_xml(source),
        }
    )
    markup_only = ~F.col("json_like_content") & ~F.col("_xml_like")
    df = df.withColumns(
        {
            "blocked_pattern": blocked_pattern(F.col("_low")),
            "xml_like_content": ~F.col("json_like_content") & F.col("_xml_like"),
            "_html": F.when(markup_only, source),
            "_dom": F.when(markup_only, F.coalesce(dom, markup.dom(F.when(dom.isNull(), source)))),
        }
    )
    own = markup.anchors(F.col("_dom") if known is None else F.when(known.isNull(), F.col("_dom")))
    df = df.withColumns(
        {
            "_anchors": own if known is None else F.coalesce(F.when(F.col("_dom").isNotNull(), known), own),
            "_bare": markup.without_noscript(F.col("_dom")),
        }
    )
    anchors, bare = F.col("_anchors"), F.col("_bare")
    bare_anchors = F.when(
        F.contains(F.col("_low"), F.lit("<noscript")), F.size(markup.anchors(bare))
    ).otherwise(F.size(anchors))
    df = df.withColumns({"_labels": anchor_labels(anchors), "_bare_text": markup.joined_text(bare)})

    def counted(c: Column) -> Column:
        return F.when(F.col("_dom").isNotNull(), c).otherwise(0)

    df = df.withColumns(
        {
            "script_count": counted(F.regexp_count("_html", F.lit(r"(?i)<script\b"))),
            "visible_text_length": counted(F.length("_bare_text")),
            "target_like_structure_count": counted(markup.structure_count(bare, bare_anchors)),
            "html_pagination_signals": F.coalesce(
                pagination_signals(F.col("_labels"), F.col("_dom")), F.array().cast("array<string>")
            ),
            "html_next_page_candidates_count": counted(next_page_count(F.col("_labels"))),
        }
    ).withColumn("html_has_pagination", F.size("html_pagination_signals") > 0)
    return df.drop(
        "_low", "_xml_like", "_html", "_dom", "_anchors", "_labels", "_bare", "_bare_text"
    )


def metadata_signals(df: DataFrame) -> DataFrame:
    """Profile columns with the router's defaults, prefixed ``meta_``."""
    names = F.array().cast("array<string>")
    return df.withColumns(
        {
            "meta_content_type": F.coalesce("content_type", F.lit("")),
            "meta_is_json": _true(F.col("is_json")),
            "meta_is_xml": _true(F.col("is_xml")),
            "meta_is_html": _true(F.col("is_html")),
            "meta_js_heavy": _true(F.col("js_heavy")),
            "meta_data_visible": _true(F.col("data_visible_in_html")),
            "meta_has_pagination": _true(F.col("has_pagination")) | _true(F.col("pagination_detected")),
            "meta_pagination_signals": F.coalesce("pagination_signals", names),
            "meta_next_page_candidates": F.coalesce("next_page_candidates_count", F.lit(0)),
            "meta_field_hits": F.coalesce("visible_field_hits", names),
        }
    )


def scrape_route(df: DataFrame, with_html: bool) -> DataFrame:
    """Add route, confidence, route_reasons, recommended_next_step.

    ``df`` carries url and the profile columns; with ``with_html`` also the
    signals of ``html_signals``. Without it the router sees metadata only.
    """
    df = metadata_signals(df)
    no, zero = F.lit(False), F.lit(0)
    provided = F.col("html_provided") if with_html else no
    phrase = F.col("blocked_pattern") if with_html else F.lit(None).cast("string")
    json_text = F.col("json_like_content") if with_html else no
    xml_text = F.col("xml_like_content") if with_html else no
    length = F.col("html_length") if with_html else zero
    scripts = F.col("script_count") if with_html else zero
    text_length = F.col("visible_text_length") if with_html else zero
    structures = F.col("target_like_structure_count") if with_html else zero
    html_paged = F.col("html_has_pagination") if with_html else no

    status, kind = F.col("status_code"), F.lower("meta_content_type")
    status_hit = _true(status.isin(fixed.BLOCKED_STATUS))
    failed = F.col("profile_error").isNotNull()
    json_url = urls.path_ends_with(F.col("url"), [".json"])
    xml_url = urls.path_ends_with(F.col("url"), [".xml", ".rss", ".atom"])
    visible, paged = F.col("meta_data_visible"), F.col("meta_has_pagination")
    xml_kind = any_of([F.contains(kind, F.lit(w)) for w in ("xml", "rss", "atom")])
    case = (
        F.when(status_hit | failed | phrase.isNotNull(), "stop")
        .when(json_url | F.contains(kind, F.lit("json")) | F.col("meta_is_json") | json_text, "json")
        .when(xml_url | xml_kind | F.col("meta_is_xml") | xml_text, "xml")
        .when(~provided & F.col("meta_js_heavy"), "unseen_js")
        .when(~provided & visible & paged, "unseen_crawl")
        .when(~provided & visible, "unseen_static")
        .when(~provided, "unseen")
        .when(length < fixed.ROUTE_SHORT_UNDER, "short")
        .when(router_js_heavy(scripts, text_length), "scripts")
        .when(
            (text_length >= fixed.ROUTE_TEXT_UNDER) | (structures > 0) | visible,
            F.when(html_paged | paged, "crawl").otherwise("static"),
        )
        .otherwise("unclear")
    )
    df = df.withColumn("_case", case)
    at = F.col("_case")

    def said(cases: list[str], text, extra=None) -> Column:
        test = at.isin(cases)
        text = F.lit(text) if isinstance(text, str) else text
        return F.when(test if extra is None else test & extra, text)

    unseen = ["unseen_js", "unseen_crawl", "unseen_static", "unseen"]
    before, after = fixed.REASON_STATUS
    reasons = F.array_compact(
        F.array(
            said(["stop"], F.concat(F.lit(before), status.cast("string"), F.lit(after)), status_hit),
            said(["stop"], fixed.REASON_PROFILE_ERROR, failed),
            said(["stop"], F.concat(F.lit(fixed.REASON_PHRASE), phrase), phrase.isNotNull()),
            said(["json"], fixed.REASON_JSON),
            said(["json"], fixed.REASON_JSON_URL, json_url),
            said(["xml"], fixed.REASON_XML),
            said(["xml"], fixed.REASON_XML_URL, xml_url),
            said(["xml"], fixed.REASON_XML_PROFILE, F.col("meta_is_xml")),
            said(unseen, fixed.REASON_NO_HTML),
            said(["unseen_js"], fixed.REASON_JS),
            said(["unseen_crawl", "unseen_static"], fixed.REASON_VISIBLE),
            said(["unseen_crawl"], fixed.REASON_PAGED),
            said(["short"], fixed.REASON_SHORT),
            said(["scripts"], fixed.REASON_SCRIPTS),
            said(["scripts"], fixed.REASON_LOW_TEXT),
            said(["crawl"], fixed.REASON_HTML_VISIBLE),
            said(["crawl"], fixed.REASON_HTML_PAGED),
            said(["static"], fixed.REASON_STATIC),
            said(["static"], fixed.REASON_STRUCTURE, structures > 0),
            said(["unclear"], fixed.REASON_NONE),
        )
    )

    def looked_up(index: int, through=lambda v: v) -> Column:
        out = F.lit(None).cast("string")
        for name, row in _CASES.items():
            out = F.when(at == name, F.lit(through(row[index]))).otherwise(out)
        return out

    return (
        df.withColumns(
            {
                "route": looked_up(0),
                "confidence": looked_up(1),
                "route_reasons": reasons,
                "recommended_next_step": looked_up(2, fixed.NEXT_STEP.get),
            }
        )
        .drop("_case", *[c for c in df.columns if c.startswith("meta_")])
    )


def route_explanation() -> Column:
    lines = F.array_join(
        F.transform("route_reasons", lambda r: F.concat(F.lit("  - "), r)), "\n"
    )
    return F.concat(
        F.lit("Scrape route: "), F.col("route"), F.lit(" ("), F.col("confidence"),
        F.lit(")\nReasons:\n"), lines,
        F.lit("\nRecommended next step: "), F.col("recommended_next_step"),
    )


def extractor(allowed: Column) -> Column:
    """The extractor that runs; null when the job may not be extracted."""
    return F.when(
        allowed,
        F.when(F.col("route") == "api_like_json", "api_like_json").otherwise(F.col("strategy")),
    )
