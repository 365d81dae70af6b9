"""Source profile: what one captured response shows. One projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, markup
from ..functions.text import bool_repr, list_repr
from .policy import normalised

PROFILE_COLUMNS = [
    "status_code", "content_type", "html_size", "is_json", "is_xml", "is_html", "js_heavy",
    "has_pagination", "pagination_detected", "pagination_signals", "next_page_candidates_count",
    "data_visible_in_html", "visible_field_hits", "link_count", "title_candidates_count",
    "price_candidates_count",
]


def blocked_status(status: Column) -> Column:
    return F.coalesce(status.isin(fixed.BLOCKED_STATUS), F.lit(False))


def blocked_status_reason(status: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, reason in fixed.BLOCKED_STATUS_REASON.items():
        out = F.when(status == code, F.lit(reason)).otherwise(out)
    return out


def content_flags(content_type: Column) -> dict[str, Column]:
    low = F.lower(F.coalesce(content_type, F.lit("")))
    return {
        "is_json": F.contains(low, F.lit("application/json")) | F.contains(low, F.lit("text/json")),
        "is_xml": F.contains(low, F.lit("application/xml")) | F.contains(low, F.lit("text/xml")),
        "is_html": F.contains(low, F.lit("text/html")),
    }


def body_bytes(body: Column) -> Column:
    return F.octet_length(body)


def anchor_labels(anchors: Column) -> Column:
    """Paging labels of each anchor: array of arrays, in document order."""
    return F.transform(anchors, lambda a: markup.paging_labels(a))


def pagination_signals(labels: Column, dom: Column) -> Column:
    """Distinct labels in first-seen order; the element label comes last."""
    element = F.when(
        markup.has_paging_element(dom), F.array(F.lit(fixed.SIGNAL_ELEMENT))
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.flatten(labels), element))


def next_page_count(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda one: F.size(one) > 0))


def price_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(fixed.PROFILE_PRICE))


def title_evidence(dom: Column, anchors: Column) -> Column:
    return (
        (markup.page_title(dom) != "")
        | (markup.heading_count(dom) > 0)
        | F.exists(anchors, lambda a: F.size(a["texts"]) > 0)
    )


def availability_evidence(text: Column) -> Column:
    return text.rlike(fixed.AVAILABILITY)


def field_hits(fields: Column, low_text: Column, seen: dict[str, Column]) -> Column:
    """Normalised requested names that have evidence, in request order."""
    def has(f: Column) -> Column:
        return (
            F.when(f.isin(fixed.TITLE_NAMES), seen["title"])
            .when(f.isin(fixed.URL_NAMES), seen["url"])
            .when(f == "price", seen["price"])
            .when(f == "availability", seen["availability"])
            .otherwise(F.contains(low_text, f))
        )

    return F.filter(normalised(fields), has)


def js_heavy(scripts: Column, text: Column) -> Column:
    return (scripts > fixed.PROFILE_SCRIPTS_OVER) & (F.length(text) < fixed.PROFILE_TEXT_UNDER)


def source_profile(captures: DataFrame, keep_page_columns: bool = False) -> DataFrame:
    """Add the 16 profile columns and ``profile_error``.

    Only HTML that is not status-blocked is taken apart; other rows carry null
    markup through the same expressions, which then cost nothing.
    """
    reached = F.col("error").isNull()
    stop = blocked_status(F.col("status_code"))
    flags = {
        name: F.when(reached, flag & ~stop)
        for name, flag in content_flags(F.col("content_type")).items()
    }
    df = captures.withColumnRenamed("status", "status_code").withColumns(
        {
            "status_code": F.when(reached, F.col("status_code")),
            "content_type": F.when(reached, F.lower("content_type")),
            "html_size": F.when(reached, body_bytes(F.col("body"))),
            **flags,
            "html": F.when(flags["is_html"], F.col("body")),
            "profile_error": F.when(
                ~reached,
                F.concat(F.lit("Network error while profiling "), F.col("url"), F.lit(": "), F.col("error")),
            ),
        }
    )
    df = markup.with_page_columns(df, "html")
    dom, anchors, text = F.col("dom"), F.col("anchors"), F.col("text")
    df = df.withColumns(
        {
            "_labels": anchor_labels(anchors),
            "_scripts": markup.script_elements(F.col("html")),
            "_title_seen": title_evidence(dom, anchors),
            "_low_text": F.lower(text),
            "_headings": markup.heading_count(dom),
            "_prices": price_count(text),
        }
    )
    labels = F.col("_labels")
    seen = {
        "title": F.col("_title_seen"),
        "url": F.size(anchors) > 0,
        "price": F.col("_prices") > 0,
        "availability": availability_evidence(text),
    }

    def measured(c: Column, empty) -> Column:
        """Zero, false or empty for reached responses that are no HTML."""
        return F.when(reached, F.when(dom.isNotNull(), c).otherwise(empty))

    no_names = F.array().cast("array<string>")
    df = df.withColumns(
        {
            "link_count": measured(F.size(anchors), F.lit(0)),
            "title_candidates_count": measured(F.col("_headings"), F.lit(0)),
            "price_candidates_count": measured(F.col("_prices"), F.lit(0)),
            "js_heavy": measured(js_heavy(F.col("_scripts"), text), F.lit(False)),
            "pagination_signals": measured(pagination_signals(labels, dom), no_names),
            "next_page_candidates_count": measured(next_page_count(labels), F.lit(0)),
            "visible_field_hits": measured(field_hits(F.col("fields"), F.col("_low_text"), seen), no_names),
        }
    )
    df = df.withColumns(
        {
            "has_pagination": F.when(reached, F.size("pagination_signals") > 0),
            "pagination_detected": F.when(reached, F.size("pagination_signals") > 0),
            "data_visible_in_html": F.when(reached, F.size("visible_field_hits") > 0),
        }
    ).drop("_labels", "_scripts", "_title_seen", "_low_text", "_headings", "_prices")
    return df if keep_page_columns else df.drop("html", *markup.PAGE_COLUMNS)


def profile_reason() -> Column:
    """Decision text of a profiled response, from the profile columns."""
    def part(label: str, c: Column) -> list[Column]:
        return [F.lit(label), c]

    return F.concat(
        F.lit("Profiled "), F.col("url"),
        *part(": status=", F.col("status_code").cast("string")),
        *part(", is_html=", bool_repr(F.col("is_html"))),
        *part(", is_json=", bool_repr(F.col("is_json"))),
        *part(", is_xml=", bool_repr(F.col("is_xml"))),
        *part(", js_heavy=", bool_repr(F.col("js_heavy"))),
        *part(", pagination=", bool_repr(F.col("has_pagination"))),
        *part(", pagination_signals=", list_repr(F.col("pagination_signals"))),
        *part(", next_page_candidates=", F.col("next_page_candidates_count").cast("string")),
        *part(", data_visible=", bool_repr(F.col("data_visible_in_html"))),
        *part(", field_hits=", list_repr(F.col("visible_field_hits"))),
        *part(", links=", F.col("link_count").cast("string")),
        F.lit("."),
    )
