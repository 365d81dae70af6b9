"""Scalar expressions against the Python standard library."""

from __future__ import annotations

import html
import re
import urllib.parse
import urllib.robotparser

import pytest
from pyspark.sql import functions as F

from pagesieve.functions import fixed, markup, trees, urls
from pagesieve.functions.text import decode_entities, is_number, squeeze
from pagesieve.operators import policy


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


BASES = [
    "https://example.com", "https://example.com/", "https://example.com/section/",
    "https://example.com/a/b?x=1#f", "http://h:8080/a//b/c", "https://example.com/a/b/",
]
REFS = [
    "/about", "sub/page", "https://other.com/page", "//cdn.example/x", "?page=2", "#top", "", "..",
    "../x", "../../../x", "./y", "a/./b/../c", "/a/../b/.", "mailto:a@b.c", "javascript:void(0)",
    "http://other.com", "HTTPS://Other.com/x", "x?y=/../z", "/a//b", "b//c", "https://other.com?q",
    "https:rel", "/x#", "/x?", "x y", "//", "/..", "tel:1",
]


def test_resolve_matches_urljoin(spark):
    pairs = [(b, r) for b in BASES for r in REFS]
    df = spark.createDataFrame(pairs, "b string, r string").select(
        "b", "r", urls.base_parts(F.col("b")).alias("p")
    )
    rows = df.select("b", "r", urls.resolve(F.col("p"), F.col("r")).alias("u")).collect()
    wrong = [(x.b, x.r, x.u) for x in rows if x.u != urllib.parse.urljoin(x.b, x.r)]
    assert wrong == []


def test_paths_from_the_root_need_only_the_site(spark):
    """The short way for most references gives what the long way gives."""
    refs = [
        "/p/1", "/list?page=2", "/a//b", "/a//", "/", "/.", "/.x", "/a/.b", "/a/..", "/a?", "/a?b?c", "/a?b/../c", "/a?b#c", "/a#", "///", "//h",
        "//h/x", "/a:b", "/a?x=http://h", "/é/ü?ö", "/a.b/c..d", "/a?..", "/" + "a/" * 5_000 + "b",
    ]
    pairs = [(b, r) for b in BASES for r in refs]
    df = spark.createDataFrame(pairs, "b string, r string").select("b", "r", urls.base_parts(F.col("b")).alias("p"))
    rows = df.select("b", "r", urls.resolve(F.col("p"), F.col("r")).alias("u"), F.col("r").rlike(urls._ROOTED).alias("short")).collect()
    assert [(x.b, x.r, x.u) for x in rows if x.u != urllib.parse.urljoin(x.b, x.r) and x.r not in ("///", "//h")] == []
    short = {x.r for x in rows if x.short}
    assert {"/p/1", "/list?page=2", "/a//b", "/", refs[-1]} <= short and not short & {"/.", "/.x", "/a/..", "/a?", "//h", "///", "/a#"}


def test_quote_and_unquote(spark):
    values = ["/a b*~?=é+", "/list%3Fpage", "100%", "%zz%41", "a+b", "/p/%E2%82%AC"]
    assert column(spark, values, urls.quote) == [urllib.parse.quote(v) for v in values]
    assert column(spark, values, urls.unquote) == [urllib.parse.unquote(v) for v in values]


def test_is_number_matches_float(spark):
    values = [
        "1", "1.", ".5", "1e3", "-1.5E-2", "1_000", "1__0", "_1", "nan", "Infinity", "+inf", "1d", "0x1p3",
        "", " 7 ", "1 2", "N/A", "٣", "1.2.3", "1299.00", "e5",
    ]

    def ok(v):
        try:
            float(v)
            return True
        except ValueError:
            return False

    assert column(spark, values, is_number) == [ok(v) for v in values]


def test_squeeze_is_unicode_aware(spark):
    values = ["  Hello \t\n World  ", "a  b", "　x\x1c\x85y ", "", "plain"]
    assert column(spark, values, squeeze) == [re.sub(r"\s+", " ", v).strip() for v in values]


def test_entities_are_decoded_once(spark):
    values = ["a &amp; b", "&amp;lt;", "&#8364;5 &#x41;&#X62;", "&copy;&middot;&nbsp;", "&lt;b&gt;", "AT&T &x", "&&amp;"]
    assert column(spark, values, decode_entities) == [html.unescape(v) for v in values]


def test_numeric_references_match_the_standard_library(spark):
    points = [0, 1, 9, 10, 11, 13, 38, 65, 0x7F, *range(0x80, 0xA0), 0xA0, 0xD7FF, 0xD800, 0xDE00, 0xDFFF, 0xE000, 0xFDD0,
              0xFFFD, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFD, 0x10FFFF, 0x110000, 9999999, 10**9, 10**30]
    texts = [f for n in points for f in (f"a&#{n};b", f"a&#x{n:x};b", f"&#X{n:X};", f"&#{n:040d};", f"&#x{n:040x};")]
    texts += ["&#xD83D;&#xDE00;", "&#;", "&#x;", "&#xg;", "&amp;#65;"]
    assert column(spark, texts, decode_entities) == [html.unescape(t) for t in texts]


def test_attributes_step_over_quoted_values(spark):
    tags = {
        'title="see href=fake now" href="/real"': "/real",
        "title='href=\"x\"' href='/r'": "/r",
        'data-x="a href=1"': None,
        'title="href=/fake" HREF = /bare class=x': "/bare",
        'class="a" href="/b?x=1&amp;y"': "/b?x=1&y",
        'href="" title="href=no"': "",
        "disabled href=/c": "/c",
    }
    assert column(spark, list(tags), lambda c: markup.attribute(c, "href")) == list(tags.values())


def test_price_patterns(spark):
    texts = ["$29.99", "Price: 25.00 JOD", "12 sarongs", "€5", "EUR 5", "no price", "£1,299.00 and 3 usd", "â\x82¬ 5"]
    counts = column(spark, texts, lambda c: F.regexp_count(c, F.lit(fixed.PROFILE_PRICE)))
    assert counts == [1, 1, 1, 0, 1, 0, 2, 1]


def test_availability_needs_word_edges(spark):
    texts = ["Status: In Stock", "out-of-stock", "unavailable", "reavailable", "pre order!", "shipshape"]
    assert column(spark, texts, lambda c: c.rlike(fixed.AVAILABILITY)) == [True, True, True, False, True, False]


def test_visible_text_and_anchor_rules(spark):
    page = (
        "<title>T &amp; x</title><!-- <a href='/no'>no</a> --><script>if (a<b) '<a href=x>'</script>"
        "<p> one\n two </p><a href='/a'> A <b>B</b></a><a name=q>none</a><a href=/c>open <a href=\"/d\"></a>"
    )
    df = spark.createDataFrame([(page,)], "html string").select(markup.dom(F.col("html")).alias("dom"))
    row = df.select(
        markup.joined_text(F.col("dom")).alias("text"), markup.anchors(F.col("dom")).alias("a")
    ).first()
    assert row.text == "T & x one\n two A B none open"
    assert [(a.href, a.texts) for a in row.a] == [("/a", ["A", "B"]), ("/c", ["open"]), ("/d", [])]


ROBOTS = [
    "User-agent: *\nDisallow: /de/\nAllow: /",
    "# c\nUSER-AGENT: pagesieve # us\nuser-agent: b\nAllow: /en/1\nDisallow: /en/\n\nDisallow: /lost\nUser-agent: *\nDisallow: /",
    "Disallow: /early\nUser-agent: gone\n\nUser-agent: *\nCrawl-delay: 3\nUser-agent: sieve\nDisallow: /fr/*\nDisallow:",
    "", "User-agent: *\n \nDisallow: /x\r\nAllow: /x/y", "User-agent: *\nDisallow: /a%3fb\nDisallow: /q?a=1",
    "User-agent: other\nDisallow: /\nUser-agent: *\nAllow: /p\nDisallow: /p/q\nUser-agent: *\nDisallow: /",
    "User-agent:\nDisallow: /z", "User-agent: PageSieve/9\nDisallow: /",
]
PATHS = ["", "/", "/de/1", "/en/1", "/en/2", "/fr/x", "/fr/*", "/x/y", "/a?b", "/q?a=1&b=2", "/p/q", "/lost", "/é#top", "/z"]


def test_robots_decisions_match_the_standard_library(spark):
    files = spark.createDataFrame(
        [(f"http://h{i}", 200, None, body) for i, body in enumerate(ROBOTS)],
        "origin string, status int, error string, body string",
    )
    asked = [(i * 100 + j, f"http://h{i}{p}") for i in range(len(ROBOTS)) for j, p in enumerate(PATHS)]
    jobs = spark.createDataFrame(asked, "job_id long, url string")
    got = {r.url: r.robots_decision for r in policy.robots_decision(jobs, files).collect()}
    want = {}
    for i, body in enumerate(ROBOTS):
        parser = urllib.robotparser.RobotFileParser()
        parser.parse(body.splitlines())
        for p in PATHS:
            url = f"http://h{i}{p}"
            want[url] = "permitted" if parser.can_fetch(fixed.USER_AGENT, url) else "blocked"
    assert got == want


@pytest.mark.parametrize(
    ("status", "error", "expected"),
    [(401, None, "blocked"), (403, None, "blocked"), (404, None, "permitted"), (503, None, "blocked"),
     (None, "refused", "warning"), (200, None, "permitted")],
)
def test_robots_fetch_outcomes(spark, status, error, expected):
    files = spark.createDataFrame([("http://h", status, error, "")], "origin string, status int, error string, body string")
    jobs = spark.createDataFrame([(1, "http://h/x")], "job_id long, url string")
    assert policy.robots_decision(jobs, files).first().robots_decision == expected


def test_json_helper_search_order():
    assert trees.first_objects('[{"a":1}, 2, {"b":2}]') == ['{"a": 1}', '{"b": 2}']
    assert trees.first_objects('{"z":[{"n":0}],"data":{"items":[{"n":1}]}}') == ['{"n": 1}']
    assert trees.first_objects('{"tags":["a"],"results":[{"n":2}]}') == ['{"n": 2}']
    assert trees.first_objects('{"items":{"deep":{"list":[{"n":3}]}},"products":[{"n":4}]}') == ['{"n": 3}']
    assert trees.first_objects('{"items":[]}') == []
    assert trees.first_objects("[1,2] x") is None
