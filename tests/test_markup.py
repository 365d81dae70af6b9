"""Columns of markup against plain walkers over whole documents, and the standard library."""

from __future__ import annotations

import html
import html.entities
import random
import re
import xml.etree.ElementTree as ElementTree
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagesieve.functions import fixed, markup
from pagesieve.functions.text import decode_entities, let
from pagesieve.operators import crawl, extraction
from pagesieve.plans.queries import QUERIES


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


# --- plain walkers -----------------------------------------------------------------
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*)>""")
_CLASS = re.compile(r"""\sclass\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_CLASS_OR_ID = re.compile(r"""\s(?:class|id)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_CARD = re.compile(fixed.CARD_CLASS.replace("(?iu)", "(?i)"))
_PAGING = re.compile(fixed.PAGING_CLASS.replace("(?iu)", "(?i)"))
_VOID = set(fixed.VOID)


def element_extents(text: str, attribute: re.Pattern, wanted: re.Pattern) -> list[list[int]]:
    """[start, end, first anchor no, last anchor no] of elements with a wanted value.

    A closing tag ends the nearest open element of its name and all inside it;
    what is still open at the end reaches to the end.
    """
    found: list[list[int]] = []
    open_tags: list[tuple[str, int]] = []
    open_names: dict[str, int] = {}
    anchor_no = 0
    for m in _TAG.finditer(text):
        closing, name, rest = m.group(1), m.group(2).lower(), m.group(3)
        if closing:
            while open_names.get(name):
                top, slot = open_tags.pop()
                open_names[top] -= 1
                if slot >= 0:
                    found[slot][1] = m.start()
                    found[slot][3] = anchor_no - 1
                if top == name:
                    break
            continue
        slot = -1
        if any(wanted.search(v) for v in attribute.findall(rest)):
            slot = len(found)
            found.append([m.end(), m.end(), anchor_no + (name == "a"), -1])
        if name == "a" and rest[:1].isspace():
            anchor_no += 1
        if name not in _VOID and not rest.endswith("/"):
            open_tags.append((name, slot))
            open_names[name] = open_names.get(name, 0) + 1
    for _, slot in open_tags:
        if slot >= 0:
            found[slot][1] = len(text)
            found[slot][3] = anchor_no - 1
    return found


def xml_elements(text: str) -> list[dict] | None:
    """Record candidates: elements with child elements; null when the text is not well formed.

    Those of the first record tag that occurs; without one, the root's children
    that have twins (``twins``: children of the root with that name). Text is taken
    of candidates only, so nesting around them is not copied level by level.
    """
    def name(tag: str) -> str:
        return tag.rpartition("}")[2].lower()

    def inner(node) -> str:
        return "".join(node.itertext()).strip()

    try:
        root = ElementTree.fromstring(text)
    except (ElementTree.ParseError, ValueError):
        return None
    twins = Counter(name(child.tag) for child in root)
    parents = []
    todo = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        kids = list(node)
        if kids:
            parents.append((node, depth, name(node.tag)))
        todo.extend((kid, depth + 1) for kid in reversed(kids))
    there = {tag for _, _, tag in parents}
    record = next((t for t in fixed.XML_RECORD_TAGS if t in there), None)
    out = []
    for node, depth, tag in parents:
        if tag != record if record else depth != 1 or twins[tag] < 2:
            continue
        parts = [{"tag": name(k.tag), "text": inner(k)} for k in node]
        blank = not any(p["text"] for p in parts)
        out.append(
            {
                "depth": depth,
                "tag": tag,
                "twins": twins[tag] if depth == 1 else 0,
                "text": inner(node) if blank else "",
                "children": parts,
            }
        )
    return out


def plain_records(text):
    nodes = None if text is None else xml_elements(text)
    if nodes is None:
        return None
    return [
        (n["tag"], [(n["tag"], n["text"])] if n["text"] else [(c["tag"], c["text"]) for c in n["children"] if c["text"]])
        for n in nodes
        if n["tag"] in fixed.XML_RECORD_TAGS or any(c["text"] for c in n["children"])
    ]


# --- references ---------------------------------------------------------------------
def test_all_named_references_match_the_standard_library(spark):
    texts = []
    for name in html.entities.html5:
        bare = name.rstrip(";")
        texts += [f"a &{name} b", f"a&{bare}b;c", f"&{bare}=1&{name}&{bare}", f"&{bare}", f"&{bare.upper()};{bare}&"]
    texts += ["&" + "x" * 40 + ";", "&amp;lt;", "&#8364 &#x41g &#65", "&notit; &notin; &not;in", "& &; &&amp &\n", "&#38;amp;", "&Aacute", "&é;"]
    assert column(spark, texts, decode_entities) == [html.unescape(t) for t in texts]


# --- tags, anchors ------------------------------------------------------------------
def test_quoted_values_end_no_tag(spark):
    pages = {
        '<p>a<a title="x > y" href="/r?a=1&amp;b">T <b class=\'q > r\'>in</b></a> end <a href=/z>Z': ("a T in end Z", [("/r?a=1&b", ["T", "in"]), ("/z", ["Z"])]),
        '<a title="unclosed href=/x>y</a>': ("y", [("/x", ["y"])]),
        '<div class="a"id="pager"href=x><a href = "1" rel=next>n</a></div>': ("n", [("1", ["n"])]),
        '<a\nhref="n">k</a >m</a><abbr href=1>q</abbr>': ("k m q", [("n", ["k"])]),
        "": ("", []),
    }
    texts = column(spark, list(pages), markup.joined_text)
    found = [[(a.href, a.texts) for a in r] for r in column(spark, list(pages), markup.anchors)]
    assert list(zip(texts, found, strict=True)) == list(pages.values())
    assert column(spark, [None], markup.anchors) == [None]


def test_tags_that_have_a_value(spark):
    pattern = markup.tag_having("class|id", "(?i:pager)")
    tags = {
        '<nav class="Pager">': True, '<nav id=xpagerx>': True, "<p data-x='pager' title=\"a > b\" class='my pager'>": True,
        '<nav title="class=pager">': False, '<nav data-class="pager">': False, '<nav class="x" id="y">pager': False, "</nav class=pager>": False,
    }
    assert column(spark, list(tags), lambda c: c.rlike(pattern)) == list(tags.values())


def _random_page(rnd):
    parts = []
    for _ in range(rnd.randrange(0, 40)):
        name = rnd.choice(["div", "section", "a", "p", "img", "nav", "span", "DIV", "li"])
        kind = rnd.random()
        own = rnd.choice(["", " class='card'", ' class="item x" title="a > b"', " id=pager", ' class=pagination href="/x"', " href=/q", " data-x='card'"])
        if kind < 0.35:
            parts.append(f"</{name}>")
        elif kind < 0.9:
            parts.append(f"<{name}{own}{rnd.choice(['', '', '', '/', ' /'])}>")
        parts.append(rnd.choice(["", "t", "u &amp; v"]))
    return "".join(parts)


def test_extents_match_a_plain_walk(spark):
    rnd = random.Random(5)
    deep = "<div class=card>" * 200 + "x" + "</div>" * 200
    big = "<html>" + "<div class='x'><p>one</p><span class=card><b>t</b><img class=item></span></div>" * 12_000 + "</html>"
    pages = [*(_random_page(rnd) for _ in range(300)), deep, big]

    def has(names, pattern):
        return lambda t: F.coalesce(*(F.nullif(markup.attribute(t, n).rlike(pattern), F.lit(False)) for n in names), F.lit(False))

    def cards(p):
        return markup.inner_markup(p["t"], p["p"], markup.extents(p["t"], has(["class"], fixed.CARD_CLASS)))

    def pagers(p):
        inside = markup.extents(p["t"], has(["class", "id"], fixed.PAGING_CLASS))
        anchors = markup.anchors_of(p["t"], p["p"])
        return F.transform(inside, lambda e: F.transform(F.filter(anchors, lambda a: (e["first"] < a["at"]) & (a["at"] < e["last"])), lambda a: a["no"]))

    def of(expression):
        return lambda d: let(F.struct(markup.tags(d).alias("t"), markup.pieces(d).alias("p")), expression)

    assert len(big) > 900_000
    assert column(spark, pages, of(cards)) == [[t[a:b] for a, b, _, _ in element_extents(t, _CLASS, _CARD)] for t in pages]
    got = column(spark, pages[:-1], of(pagers))
    for page, found in zip(pages, got, strict=False):
        linked = set(a.no for a in column(spark, [page], markup.anchors)[0]) if any(found) else set()
        want = [[n for n in range(lo, hi + 1) if n in linked] for _, _, lo, hi in element_extents(page, _CLASS_OR_ID, _PAGING)]
        if any(found) or any(want):
            assert found == want, page
            break  # one page with pagers is enough for the slow part


def test_spans_match_extents(spark):
    """First and last of wanted elements without a step for each tag: whole, unclosed, crossed and deeply nested ones."""
    rnd = random.Random(8)
    rows = "".join(f"<li class=item><a href=/{i}><b>{i}</b></a><br><img src=x/></li>" for i in range(400))
    pages = [
        *(_random_page(rnd) for _ in range(300)), f"<html><body><ul class=listing>{rows}</ul></body></html>", f"<ul class=listing>{rows}<li class=card>",
        "<div>" * 12 + "<p class=card><i></i></p>" + "</div>" * 12, "<p class=card>" * 12 + "</p>" * 12, "<div class=card><br></br></div></p>",
        "<p class=card/><P CLASS=card></p ><p class=card></section></p>", "<div class=card><x></div></x><div1 class=item></div></div1>", "", "no tag",
    ]

    def is_card(t):
        return F.coalesce(markup.attribute(t, "class").rlike(fixed.CARD_CLASS), F.lit(False))

    def places(extent):
        return F.transform(extent, lambda e: F.struct(e["first"].alias("first"), e["last"].alias("last")))

    both = lambda t: F.struct(markup.spans(t, is_card).alias("spans"), places(markup.extents(t, is_card)).alias("extents"))
    got = column(spark, pages, lambda d: let(markup.tags(d), both))
    assert [r.spans for r in got] == [r.extents for r in got]
    assert len(got[300].spans) == 401 and sum(len(r.spans) for r in got[:300]) > 300
    assert column(spark, [None], lambda d: markup.spans(markup.tags(d), is_card)) == [None]


def test_short_ways_give_what_the_long_ways_give(spark):
    """Texts with the marks that spans and pieces use themselves, names in capitals, quotes of both kinds."""
    odd = "<P CLASS=card\x01x>a\x01b<b\x02>c</b><br class=item\x01/>\x02</p\x01><LI Class='item'/></br></!x><!x class=card>"

    def is_card(t):
        return F.coalesce(markup.attribute(t, "class").rlike(fixed.CARD_CLASS), F.lit(False))

    def places(extent):
        return F.transform(extent, lambda e: F.struct(e["first"].alias("first"), e["last"].alias("last")))

    both = lambda t: F.struct(markup.spans(t, is_card).alias("spans"), places(markup.extents(t, is_card)).alias("extents"))
    [got] = column(spark, [odd], lambda d: let(markup.tags(d), both))
    assert got.spans == got.extents and len(got.spans) == 3

    texts = [odd, odd.replace("\x01", ""), "<a>", "no tag", "", None]
    assert column(spark, texts, markup.pieces) == column(spark, texts, lambda d: F.split(d, fixed.TAG))
    assert column(spark, texts[0:1], markup.pieces)[0][1] == "a\x01b"

    quoted = {'"x"': "x", "'x'": "x", "\"'x'\"": "'x'", "x": "x", '""': "", "": ""}
    assert column(spark, list(quoted), markup.unquoted) == list(quoted.values())
    tags = ["<a CLASS=x>", "<a id=1>", "<a title='class=y'>", "<a class=''>", None]
    assert column(spark, tags, lambda t: markup.attribute(t, "class")) == ["x", None, None, "", None]


def test_a_paging_link_has_a_label(spark):
    links = [
        "<a href=/x rel='No Next'>1</a>", "<a href=/x> NEXT </a>", "<a href='/x?page=2'>1</a>", "<a href=/x class=pager>1</a>",
        "<a href=/x id=Next-Page>1</a>", "<a href=/x rel=nextish class=x id=y>1</a>", "<a href=''></a>", "<a href=/x><b>ne</b><b>xt</b></a>",
    ]
    both = lambda a: F.struct(markup.is_paging_link(a).alias("is"), (F.size(markup.paging_labels(a, squeezed=True)) > 0).alias("has"))
    got = [found for [found] in column(spark, links, lambda d: F.transform(markup.anchors(d), both))]
    assert [r["is"] for r in got] == [r["has"] for r in got] == [True] * 5 + [False] * 3


# --- XML ----------------------------------------------------------------------------
XML = [
    "<a><b>1</b></a>", "<a></b>", "<a>1</a>junk", "<a/><b/>", "", " <a/> ", "\n<?xml version='1.0'?><a/>",
    "<?xml version='1.0' encoding='utf-16'?><r><item><t>x</t></item></r>", "<a>&undefined;</a>",
    "<r><item><t>a &amp; b &#x20AC;&#128;</t><u/></item></r>", "<a x='1' x='2'/>", "<n:a/>",
    "<n:a xmlns:n='u'><n:item><n:T>1</n:T></n:item></n:a>", "<a>\x01</a>", "<a>x]]>y</a>", "<a><!-- -- --></a>",
    "<a><item><t>q<![CDATA[<x>&]]>z</t></item></a>", "<!DOCTYPE a><a><p><b>1</b></p><p><b> </b></p><q/></a>", "<a>1", "plain", None,
    "<a><b></a></b>", "<a/><!-- c --><?pi x?>", "<a>\ufffe</a>", "<a:b:c xmlns:a='u'/>", "<r><item/><product><t>\r\n1\r</t></product></r>",
    "<r><rec><a>1</a></rec><rec><a></a></rec><rec>t<a></a></rec><z><a>1</a></z></r>",
    "<r><item>own<b/></item><item><b>x<c>y</c>z</b><b>w</b></item></r>", "<r><item><item><t>in</t></item></item></r>",
    "<a><x title='a > b'><item><t>1</t></item></x></a>", "\ufeff<a><item><t>1</t></item></a>", "<r a:b='1'/>", "<r xmlns:a='u' a:b='1'/>",
    "<r>" + "<a>y" * 100 + "<item><title>t</title></item>" + "</a>" * 100 + "</r>", "<r>" + "<a>x" * 200 + "</a>" * 200 + "</r>",
    "<entry><x>1</x></entry>", "<a><b>1</b></a><!-- x -->  ", "<r><é><k>1</k></é><é><k>2</k></é></r>", "<r><A><k>1</k></A><a><k>2</k></a></r>",
    "<r>" + "".join(f"<item><title>{i}</title><url>/p/{i}</url></item>" for i in range(3000)) + "</r>",
]


def test_xml_records_match_the_standard_library(spark):
    df = spark.createDataFrame(list(enumerate(XML)), "i int, body string")
    got = [
        None if r.records is None else [(n.tag, [(c.tag, c.text) for c in n.children]) for n in r.records]
        for r in extraction.xml_records(df).orderBy("i").collect()
    ]
    assert got == [plain_records(t) for t in XML]


def test_own_entities_are_refused(spark):
    """A document that declares entities and uses them counts as not well formed."""
    df = spark.createDataFrame([("<!DOCTYPE a [<!ENTITY e 'v'>]><a><item><t>&e;</t></item></a>",)], "body string")
    assert extraction.xml_records(df).first().records is None


@pytest.mark.parametrize("name", ["card_segments", "next_page_edges", "xml_records", "xml_node_to_map", "xml_project_fields", "xml_failures"])
def test_markup_needs_no_python_worker(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "MapInArrow" not in plan


def test_fallback_is_told_from_priceless_cards(spark):
    pages = [
        (1, "http://h/", "<div class=card><h2>no price</h2></div><a href=/x>x</a>"), (2, "http://h/", "<a href=/x>x</a>"),
        (3, "http://h/", "<div class=card>.</div><a href=/y>y</a>"),
    ]
    df = markup.with_page_columns(spark.createDataFrame(pages, "job_id int, url string, body string"), "body")
    rows = {r.job_id: r for r in extraction.page_records(df).collect()}
    assert {i: r.had_cards for i, r in rows.items()} == {1: True, 2: False, 3: False}
    assert [r.title for r in rows[1].records] == ["no price"] and [r.url for r in rows[3].records] == ["http://h/y"]
    assert "had_cards" not in crawl.with_walk_columns(df).columns
