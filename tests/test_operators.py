"""Operators on small fixtures with known results."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pagesieve.functions import fixed, markup
from pagesieve.operators import cleaning, crawl, extraction, policy, profile, routing

MINIMAL = (
    "<html><head><title>Example Domain</title></head><body><h1>Example Domain</h1>"
    "<p>For use in examples.</p><a href='https://www.iana.org/domains/reserved'>More information...</a></body></html>"
)
SCRIPTED = "<html><head>" + "<script>var x=1;</script>" * 10 + "</head><body><p>Hi</p></body></html>"
LISTING = (
    '<html><body><article class="product-card"><h2>Widget Pro</h2><a href="/products/widget">View</a>'
    '<p class="price">$29.99</p></article><div class="listing item"><a href="/products/gadget">Gadget</a>'
    "<span>Price: 15 JOD</span></div></body></html>"
)
PAGED = (
    '<html><body><a rel="next" href="/products?page=2">More</a>'
    '<a href="https://other.example/products?page=2">next</a><a href="/about">About</a></body></html>'
)


def captures(spark, rows):
    """rows of (url, body, content_type, status, fields)."""
    return spark.createDataFrame(
        [(i, u, f, ["csv"], s, c, None, b) for i, (u, b, c, s, f) in enumerate(rows)],
        "job_id long, url string, fields array<string>, outputs array<string>, status int, "
        "content_type string, error string, body string",
    )


def no_robots(spark):
    return spark.createDataFrame([], "origin string, status int, error string, body string")


def profiles(spark, bodies, fields, status=200, kind="text/html"):
    df = captures(spark, [("https://example.com", b, kind, status, fields) for b in bodies])
    return profile.source_profile(policy.field_gate(df)).orderBy("job_id")


# --- policy -----------------------------------------------------------------------
def test_every_sensitive_name_blocks(spark):
    rows = [("u", "", "", 200, ["title", f" {n.upper()} "]) for n in fixed.SENSITIVE_FIELDS]
    rows += [("u", "", "", 200, ["email", "title"]), ("u", "", "", 200, ["passwords"])]
    got = [r.risk_level for r in policy.field_gate(captures(spark, rows)).orderBy("job_id").collect()]
    assert got == ["high"] * 22 + ["low", "low"]


# --- profile ----------------------------------------------------------------------
@pytest.mark.parametrize(
    ("body", "field", "seen"),
    [
        (MINIMAL, "title", True), (MINIMAL, "url", True), (MINIMAL, "price", False),
        ("<h1>Main</h1>", "title", True), ("<a href='/p'>Click</a>", "heading", True),
        ("<p>Some text.</p>", "title", False), ("<h1>x</h1>", "href", False),
        ("<p>$29.99</p>", "price", True), ("<p>Out of Stock</p>", "availability", True),
        ("<h1>Product</h1>", "availability", False), ("<p>author: Jane</p>", "Author ", True),
        ("<p>Nothing here.</p>", "author", False),
    ],
)
def test_field_evidence(spark, body, field, seen):
    row = profiles(spark, [body], [field]).first()
    assert row.data_visible_in_html is seen
    assert row.visible_field_hits == ([field.strip().lower()] if seen else [])


def test_status_codes_zero_the_profile(spark):
    for status in fixed.BLOCKED_STATUS:
        row = profiles(spark, [MINIMAL], ["title"], status).first()
        assert (row.status_code, row.is_html, row.link_count, row.pagination_signals) == (status, False, 0, [])
    assert profiles(spark, [MINIMAL], ["title"], 404).first().link_count == 1


def test_script_heavy(spark):
    assert [r.js_heavy for r in profiles(spark, [SCRIPTED, MINIMAL], ["title"]).collect()] == [True, False]


PAGING_FORMS = [
    '<a rel="next" href="/x">More</a>', '<a rel="nofollow NEXT" href="/x">m</a>', "<a href='/x'>Next</a>",
    '<a href="/x">&gt;</a>', '<a href="/x">»</a>', '<a href="/x">التالي</a>', '<a href="/x">الصفحة التالية</a>',
    '<a href="/list?page=2">2</a>', '<a href="/page/2">2</a>', '<a href="/l?offset=20">m</a>',
    '<a href="/l?a=1&amp;cursor=z">m</a>', '<a class="pager-link" href="/x">2</a>',
    '<div id="pagination"><a href="/x">2</a></div>',
]


def test_pagination_forms(spark):
    got = profiles(spark, PAGING_FORMS + ['<a href="/homepage=1">x</a>', MINIMAL], ["title"]).collect()
    assert [r.has_pagination for r in got] == [True] * len(PAGING_FORMS) + [False, False]


# --- routing ----------------------------------------------------------------------
def routes(spark, rows):
    """rows of (url, html, profile columns as dict)."""
    df = captures(spark, [(u, h, None, 200, ["title"]) for u, h, _ in rows])
    flags = ["is_json", "is_xml", "is_html", "js_heavy", "data_visible_in_html", "has_pagination", "pagination_detected"]
    meta = spark.createDataFrame(
        [(i, *[m.get(f) for f in flags], m.get("status_code"), m.get("error")) for i, (_, _, m) in enumerate(rows)],
        "job_id long, " + ", ".join(f"{f} boolean" for f in flags) + ", status_code int, profile_error string",
    )
    names = F.lit(None).cast("array<string>")
    df = df.select("job_id", "url", "body").join(meta, "job_id").withColumns(
        {"content_type": F.lit(""), "pagination_signals": names, "visible_field_hits": names,
         "next_page_candidates_count": F.lit(0)}
    )
    return routing.scrape_route(routing.html_signals(df, "body"), with_html=True).orderBy("job_id").collect()


def test_routes(spark):
    normal = "<html><body><h1>Products</h1><article class='product-card'><a href='/w'>Widget</a><p>Reliable.</p></article></body></html>"
    xml = "\n<?xml version='1.0'?><items><item><title>A</title></item></items>"
    visible = {"data_visible_in_html": True, "is_html": True}
    e = "https://example.com/"
    cases = [
        (e + "data.json", None, {}, "api_like_json"), (e + "api", '{"items": [{"title": "W"}]}', {}, "api_like_json"),
        (e + "p.xml", None, {}, "api_like_xml"), (e + "feed", None, {"is_xml": True}, "api_like_xml"),
        (e + "feed", xml, {}, "api_like_xml"), (e + "products", normal, {}, "static_html"),
        (e + "products", normal + '<nav class="pagination"><a rel="next" href="?page=2">N</a></nav>', {}, "scrapy_crawl"),
        (e + "products", None, {**visible, "pagination_detected": True}, "scrapy_crawl"),
        (e + "app", "<html><head>" + "<script>w={};</script>" * 8 + "</head><body><div id='app'></div></body></html>", {}, "browser_render"),
        (e + "b", "<html><body><h1>Access denied</h1><p>CAPTCHA required.</p></body></html>", {}, "fallback_manual_review"),
        (e + "x", None, visible, "static_html"), (e + "x", None, {}, "fallback_manual_review"),
        (e + "x", "<p>short</p>", {}, "browser_render"), (e + "x", None, {"js_heavy": True}, "browser_render"),
        (e + "x", normal, {"status_code": 429, "error": "gone"}, "fallback_manual_review"),
        (e + "x", "<html><body>" + "<span></span>" * 10 + "</body></html>", {}, "fallback_manual_review"),
    ]
    got = routes(spark, [c[:3] for c in cases])
    assert [r.route for r in got] == [c[3] for c in cases]
    assert all(r.route_reasons for r in got)
    assert got[9].route_reasons == [fixed.REASON_PHRASE + "access denied"]
    assert len(got[14].route_reasons) == 2 and got[14].confidence == "red"
    assert fixed.REASON_HTML_PAGED in got[6].route_reasons


def test_content_tests(spark):
    texts = ['{"a":1,"a":2}', "[1,2] x", "[1],[2]", " [NaN] ", "{'a':1}", '{"a":"\t"}', '"x"', "[1]] [2", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r[0] for r in df.select(routing.looks_like_json(F.col("t"))).collect()]
    assert got == [True, False, False, True, False, False, False, False, False, False]


# --- extraction -------------------------------------------------------------------
def json_rows(spark, body, fields):
    df = extraction.json_records(captures(spark, [("u", body, "", 200, fields)]))
    row = df.select(extraction.json_items(F.col("records"), F.col("fields")).alias("i")).first()
    return row.i


@pytest.mark.parametrize(
    ("body", "url"),
    [
        ('[{"title":"A","url":"/a","x":1}, 7]', "/a"), ('{"items":[{"title":"A","url":"/a"}]}', "/a"),
        ('{"products":[{"title":"A","path":"/p"}]}', "/p"), ('{"data":[{"title":"A","link":"/l"}]}', "/l"),
        ('{"data":{"items":[{"title":"A","href":"/h"}]}}', "/h"), ('{"r":{"q":{"z":[{"title":"A","url":"/z"}]}}}', "/z"),
        ('{"items":"[{}]","data":[{"title":"A","title":"A","url":"/dup"}]}', "/dup"),
    ],
)
def test_json_shapes(spark, body, url):
    (item,) = json_rows(spark, body, ["title", "url"])
    assert (item.title, item.url, item.source, item.keys) == ("A", url, "api_like_json", ["title", "url", "source"])


def test_json_null_is_present_and_bad_json_is_told(spark):
    (item,) = json_rows(spark, '[{"title":null,"url":null,"href":"/x","n":{"a":[1]}}]', ["title", "url", "n", "gone"])
    assert (item.title, item.url, item.keys) == (None, None, ["title", "url", "n", "source"])
    assert item.extra == {"n": '{"a":[1]}'} and item.nonstring == ["n"]
    assert json_rows(spark, "<html>not json</html>", ["title"]) is None


def xml_rows(spark, body, fields):
    df = extraction.xml_records(captures(spark, [("u", body, "", 200, fields)]))
    return df.select(extraction.xml_items(F.col("records"), F.col("fields")).alias("i")).first().i


def test_xml_shapes(spark):
    item = "<title> A <b>B</b></title><url>/a</url><title>last</title><note/>"
    for body in (
        f"<items><item>{item}</item></items>", f"<products><x><product>{item}</product></x></products>",
        f'<feed xmlns="http://n"><Entry>{item}</Entry></feed>',
    ):
        (got,) = xml_rows(spark, body, ["title", "url", "note", "link"])
        assert (got.title, got.url, got.keys) == ("last", "/a", ["title", "url", "source"])
    two = xml_rows(spark, "<c><r><title>1</title></r><o><t>x</t></o><r><title>2</title></r><r>bare</r></c>", ["title"])
    assert [i.title for i in two] == ["1", "2"]
    (own,) = xml_rows(spark, "<items><item>hello<b/></item></items>", ["item"])
    assert own.extra == {"item": "hello"}
    assert xml_rows(spark, "<items><item><title>Broken</items>", ["title"]) is None


def page_view(spark, html, url="https://shop.example/products"):
    df = captures(spark, [(url, html, "text/html", 200, ["title", "url", "price"])])
    return markup.with_page_columns(df, "body")


def test_cards(spark):
    rows = extraction.page_records(page_view(spark, LISTING)).first().records
    assert [(r.title, r.url, r.price) for r in rows] == [
        ("Widget Pro", "https://shop.example/products/widget", "$29.99"),
        ("Gadget", "https://shop.example/products/gadget", "15 JOD"),
    ]


def test_cards_with_inner_card_classes(spark):
    html = (
        '<ul class="items"><li class="item"><div class="card-body"><h3 class="card-title">One</h3>'
        '<a class="card-link" href="/1">go</a><b class="price now">5 USD</b></div></li></ul>'
    )
    rows = extraction.page_records(page_view(spark, html)).first().records
    assert [(r.title, r.url, r.price) for r in rows] == [("One", "https://shop.example/1", "5 USD")]


def test_links_when_there_are_no_cards(spark):
    html = '<a href="/one">One</a><a href="/one">One</a><a href="#">x</a><a href="javascript:x()">y</a><a href="/two"></a>'
    rows = extraction.page_records(page_view(spark, html)).first().records
    assert [(r.title, r.url) for r in rows] == [("One", "https://shop.example/one"), ("/two", "https://shop.example/two")]


def test_static_links_and_title_fallback(spark):
    def items(html):
        view = page_view(spark, html)
        return view.select(extraction.link_items(F.col("anchors"), F.col("dom"), F.col("url")).alias("i")).first().i

    assert [(i.title, i.url) for i in items('<a href=" /a ">x <b>y</b></a><a href="#part"></a><a href="">e</a>')] == [
        ("xy", "/a"), ("#part", "#part")
    ]
    (only,) = items("<title> Lone </title><a href='#'>t</a>")
    assert (only.title, only.url, only.source) == ("Lone", "https://shop.example/products", "static_html_fallback")


def test_next_links_stay_on_the_host(spark):
    inside = '<nav class="pager"><p><a href="/all">all</a></p></nav><a href="/out">out</a>'
    for html, want in ((PAGED, ["https://shop.example/products?page=2"]), (inside, ["https://shop.example/all"])):
        assert crawl.next_page_links(page_view(spark, html)).first().next_urls == want


def crawl_site(spark):
    """Ten pages in a chain with a skip link; the fourth forbidden, one foreign link."""
    def body(n):
        return (
            f'<div class="card"><a href="/i/{n}">I{n}</a></div><a rel="next" href="/l?page={n + 1}">n</a>'
            f'<a href="/l?page={n + 2}">s</a><a href="https://other.example/?page=1">next</a>'
        )

    return captures(
        spark,
        [(f"https://s.example/l?page={n}", body(n), "text/html", 403 if n == 3 else 200, ["title", "link"]) for n in range(10)],
    )


def test_bounded_walk_and_limits(spark):
    pages = crawl_site(spark)
    facts = crawl.page_facts(pages, no_robots(spark))
    walk = crawl.bounded_walk(pages.where("job_id = 0"), facts).orderBy("page_seq").collect()
    assert [w.url[-1] for w in walk] == ["0", "1", "2", "4", "5"]
    jobs = pages.where("job_id in (0, 9, 3)").select("job_id", "url", "fields")
    items = crawl.crawl_items(jobs, facts, max_items=3).orderBy("job_id", "page_seq").collect()
    assert [(i.job_id, i.title) for i in items] == [(0, "I0"), (0, "I1"), (0, "I2"), (9, "I9")]
    assert items[0].keys == ["title", "url", "source"]


def test_jobs_have_limits_of_their_own(spark):
    pages = crawl_site(spark)
    facts = crawl.page_facts(pages, no_robots(spark))
    one = pages.where("job_id = 0").select("url", "fields")
    limits = spark.createDataFrame([(1, 2, None), (2, None, 1), (3, 1, 1), (4, None, None)], "job_id long, max_pages int, max_items int")
    jobs = limits.join(one)
    items = crawl.crawl_items(jobs, facts)
    counts = {r.job_id: (r["count"], r.pages) for r in items.groupBy("job_id").agg(F.count("*").alias("count"), F.countDistinct("page_seq").alias("pages")).collect()}
    assert counts == {1: (2, 2), 2: (1, 1), 3: (1, 1), 4: (5, 5)}
    assert {r.job_id: r.cut for r in crawl.cut_jobs(jobs, items).collect()} == {1: "max_pages", 2: "max_items", 3: "max_items", 4: "max_pages"}


def test_the_walk_obeys_robots_rules(spark):
    pages = crawl_site(spark)
    robots = spark.createDataFrame(
        [("https://s.example", 200, None, "User-agent: *\nDisallow: /l?page=2\n"), ("https://s.example", None, "timeout", None)],
        "origin string, status int, error string, body string",
    )
    facts = crawl.page_facts(pages, robots)
    walk = [w.url[-1] for w in crawl.bounded_walk(pages.where("job_id = 0"), facts).orderBy("page_seq").collect()]
    assert "2" not in walk and walk[0] == "0"
    assert policy.robots_decision(pages.select("job_id", "url"), robots).count() == pages.count()


def test_one_seed_shared_by_many_jobs_is_walked_once(spark):
    pages = crawl_site(spark)
    facts = crawl.page_facts(pages, no_robots(spark))
    one = pages.where("job_id = 0").select("url", "fields")
    jobs = spark.range(500).withColumnRenamed("id", "job_id").join(one)
    assert crawl.bounded_walk(jobs, facts).count() == 5
    assert crawl.crawl_items(jobs, facts).count() == 2500


# --- cleaning and validation ----------------------------------------------------------
def raw_items(spark, rows, base="https://example.com"):
    """rows of (title, url, price)."""
    return spark.createDataFrame(
        [(1, base, 0, i, t, u, p, "s", None, ["title"], None) for i, (t, u, p) in enumerate(rows)],
        "job_id long, base_url string, page_seq int, pos int, title string, url string, price string, "
        "source string, extra map<string,string>, keys array<string>, nonstring array<string>",
    )


def test_cleaning(spark):
    rows = [
        ("  Hello   World  ", "  https://example.com/a  ", "£12.99"), ("Page", "/about", "$1,299.00"),
        ("External", "https://other.com/page", "N/A"), ("t", "", "12,99"), ("t", None, "15 JOD"), ("t", "x", " "),
    ]
    got = cleaning.clean_items(raw_items(spark, rows)).orderBy("pos").collect()
    assert [(r.title, r.url, r.price) for r in got] == [
        ("Hello World", "https://example.com/a", "12.99"), ("Page", "https://example.com/about", "1299.00"),
        ("External", "https://other.com/page", None), ("t", "https://example.com", "1299"),
        ("t", None, None), ("t", "https://example.com/x", ""),
    ]


def test_validation_rules(spark):
    u = "https://example.com"
    rows = [
        ("Hello", u, "12.99"), ("x", u, None), (None, u, None), ("", u, None), ("   ", u, None), ("x", None, None),
        ("x", "", None), ("x", "ftp://e", None), ("x", "/about", None), ("x", "HTTP://e", None), ("x", "http://e", "free"),
        ("0", "http://e", "nan"),
    ]
    checked = cleaning.validate(raw_items(spark, rows)).orderBy("pos").collect()
    starts = [None, None, "Missing or", "Missing or", "Missing or", "Missing 'url", "Missing 'url", "Invalid", "Invalid",
              "Invalid", "'price'", None]
    assert [r.validation_error and r.validation_error[: len(s or "")] for r, s in zip(checked, starts)] == starts


def test_numbers_count_as_missing_titles_only_when_not_text(spark):
    items = raw_items(spark, [("0", "http://e", None), ("7", "http://e", None)])
    typed = items.withColumn("nonstring", F.array(F.lit("title")))
    assert [r.validation_error is None for r in cleaning.validate(typed).orderBy("pos").collect()] == [False, True]


def test_dedup_keeps_the_first_whatever_the_partitions(spark):
    """A hot job, a hot URL, rows in any order: the same result."""
    rows = [("t%d" % i, "http://e/%d" % (0 if i % 3 else i % 50), None) for i in range(3000)]
    items = cleaning.validate(raw_items(spark, rows))
    want = {}
    for i, (t, u, _) in enumerate(rows):
        want.setdefault(u, t)
    for seed in (1, 2):
        mixed = items.repartition(random.Random(seed).randint(2, 9), "title")
        unique = cleaning.first_by_url(cleaning.valid(mixed)).collect()
        assert {r.url: r.title for r in unique} == want and sum(r.copies for r in unique) == 3000
    counts = cleaning.job_item_counts(items).first()
    assert (counts.raw_items_count, counts.valid_items_count, counts.duplicates_removed) == (3000, len(want), 3000 - len(want))
