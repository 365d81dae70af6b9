"""Records from responses: links, cards, JSON and XML items.

Every extractor gives ``array<ITEM>`` in the row of its response, so the wide
body never leaves the scan; items are exploded afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, markup, trees, urls, xml
from ..functions.text import let, settled, squeeze, strip
from .policy import normalised
from .profile import blocked_status
from .routing import parses_as_json

# One extracted record. ``keys`` lists the names it has, in order; ``nonstring``
# those whose JSON value is not a text; other names than the four go to extra.
ITEM = (
    "struct<pos:int,title:string,url:string,price:string,source:string,"
    "extra:map<string,string>,keys:array<string>,nonstring:array<string>>"
)
_NO_EXTRA = "map<string,string>"


def _item(pos, title, url, price, source, keys, extra=None, nonstring=None) -> Column:
    none = F.lit(None)
    return F.struct(
        pos.cast("int").alias("pos"),
        title.cast("string").alias("title"),
        url.cast("string").alias("url"),
        price.cast("string").alias("price"),
        F.lit(source).alias("source"),
        (none if extra is None else extra).cast(_NO_EXTRA).alias("extra"),
        keys.alias("keys"),
        (none if nonstring is None else nonstring).cast("array<string>").alias("nonstring"),
    )


def usable_href(href: Column) -> Column:
    return (href != "") & ~F.startswith(href, F.lit("javascript:")) & (href != "#")


# --- links ----------------------------------------------------------------------
def link_items(anchors: Column, dom: Column, url: Column) -> Column:
    """Every usable anchor; without one, a single item from the page title."""
    keys = F.array(F.lit("title"), F.lit("url"), F.lit("source"))
    none = F.lit(None)
    usable = F.filter(
        F.transform(
            anchors,
            lambda a: F.struct(
                strip(a["href"]).alias("href"), F.array_join(a["texts"], "").alias("text")
            ),
        ),
        lambda a: usable_href(a["href"]),
    )
    links = F.transform(
        usable,
        lambda a, i: _item(
            i, F.when(a["text"] == "", a["href"]).otherwise(a["text"]), a["href"], none,
            fixed.SOURCE_LINKS, keys,
        ),
    )
    title = markup.page_title(dom)
    fallback = F.array(
        _item(
            F.lit(0), F.when(title == "", url).otherwise(strip(title)), url, none,
            fixed.SOURCE_TITLE, keys,
        )
    )
    return F.when(F.size(links) > 0, links).otherwise(fallback)


# --- cards ----------------------------------------------------------------------
def _squeezed_text(inner: Column) -> Column:
    def shown(m: Column) -> Column:
        # Most hold one text and no tag.
        alone = ~F.contains(m, F.lit("<"))
        return F.when(m == "", m).when(alone, squeeze(strip(markup.decode_entities(m)))).otherwise(squeeze(markup.joined_text(m)))

    return let(inner, shown)


def _first_filled(texts: list[Column]) -> Column:
    """First text that is not empty, each made once and only if those before it are empty; else ''."""
    return F.coalesce(*[let(text, lambda t: F.when(t != "", t)) for text in texts], F.lit(""))


def _first_inner(card: Column, tag: str) -> Column:
    end = rf"(?:</{tag}\s*>|\z)" if tag != "a" else r"(?:</a\s*>|<a\s|\z)"
    inner = F.regexp_extract(card, rf"(?is)<{tag}(?:\s{fixed.INSIDE})?>(.*?){end}", 1)
    return _squeezed_text(inner)


def _first_classed(card: Column, name: str) -> Column:
    word = rf"""(?:"(?:[^">]*\s)?{name}(?:\s[^">]*)?"|'(?:[^'>]*\s)?{name}(?:\s[^'>]*)?'|{name}(?=[\s>]))"""
    opened = rf"<([a-zA-Z][a-zA-Z0-9]*+)(?=[\s/]){markup.attributes_until(rf'(?i:class)\s*+=\s*+{word}')}"
    pattern = rf"(?s){opened}{fixed.INSIDE}>(.*?)(?:(?i:</\1\s*>)|\z)"
    return _squeezed_text(F.regexp_extract(card, pattern, 2))


def card_title(card: Column) -> Column:
    found = [_first_inner(card, t) for t in ("h1", "h2", "h3", "a")] + [_first_classed(card, "title")]
    return _first_filled(found)


def card_href(card: Column) -> Column:
    """Target of the card's first anchor that has one."""
    href = markup.attributes_until(r"""href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++)""", r"href\s*+=")
    raw = F.regexp_extract(card, rf"(?is)<a(?=[\s/]){href}", 1)
    return let(raw, lambda v: strip(markup.decode_entities(markup.unquoted(v))))


def card_url(card: Column, base: Column) -> Column:
    return let(
        card_href(card),
        lambda href: F.when(usable_href(href), urls.resolve(base, href)).otherwise(F.lit("")),
    )


def card_price(card: Column) -> Column:
    marked = _first_classed(card, "price")
    found = squeeze(F.regexp_extract(markup.joined_text(card), fixed.CARD_PRICE, 0))
    return let(marked, lambda m: F.when(m != "", m).otherwise(found))


def _first_per_key(df: DataFrame, column: str) -> DataFrame:
    """Keep the first entry per (title, url) inside one row's array.

    Sorted by key and position, an entry is first when its left neighbour has
    another key: n log n in place, no shuffle, no limit on the array.
    """
    by_key = F.sort_array(
        F.transform(
            F.col(column),
            lambda c, i: F.struct(
                c["title"].alias("title"), c["url"].alias("url"), i.alias("pos"), c["price"].alias("price")
            ),
        )
    )
    df = df.withColumn("_by_key", by_key)

    def is_first(c: Column, i: Column) -> Column:
        left = F.get("_by_key", i - 1)
        return (i == 0) | (left["title"] != c["title"]) | (left["url"] != c["url"])

    in_order = F.sort_array(
        F.transform(
            F.filter("_by_key", is_first),
            lambda c: F.struct(
                c["pos"].alias("pos"), c["title"].alias("title"), c["url"].alias("url"),
                c["price"].alias("price"),
            ),
        )
    )
    return df.withColumn(column, in_order).drop("_by_key")


def card_segments(pages: DataFrame) -> DataFrame:
    """Add ``cards``: inner markup of each card-like element (nested ones too).

    Needs dom, tags and pieces; pages without a card-like class are not walked.
    """
    has_cards = F.col("dom").rlike(markup.tag_having("class", fixed.CARD_CLASS))
    tag, text = F.when(has_cards, F.col("tags")), F.col("pieces")

    def is_card(t: Column) -> Column:
        # Most tags don't hold the word at all, so their attributes need not be read.
        return F.when(t.rlike(fixed.CARD_CLASS), F.coalesce(markup.attribute(t, "class").rlike(fixed.CARD_CLASS), F.lit(False))).otherwise(False)

    pages = settled(pages.withColumn("_extents", markup.spans(tag, is_card)))
    return pages.withColumn("cards", markup.inner_markup(F.col("tags"), F.col("pieces"), F.col("_extents"))).drop("_extents")


def page_records(pages: DataFrame) -> DataFrame:
    """Add ``records``: the (pos, title, url, price) of a listing page, and ``had_cards``.

    Cards first; a page without usable cards falls back to its links.
    """
    kind = "array<struct<title:string,url:string,price:string>>"
    pages = card_segments(pages).withColumn("_base", urls.base_parts(F.col("url")))
    base = F.col("_base")
    pages = pages.withColumn(
        "records",
        F.coalesce(
            F.filter(
                F.transform(
                    "cards",
                    lambda c: F.struct(
                        card_title(c).alias("title"), card_url(c, base).alias("url"),
                        card_price(c).alias("price"),
                    ),
                ),
                lambda r: (r["title"] != "") | (r["url"] != ""),
            ),
            F.array().cast(kind),
        ),
    ).drop("cards")
    pages = settled(pages.withColumn("had_cards", F.size("records") > 0))
    base = F.col("_base")

    def link(a: Column) -> Column:
        text, href = squeeze(F.array_join(a["texts"], " ")), strip(a["href"])
        return F.struct(
            F.when(text == "", href).otherwise(text).alias("title"),
            urls.resolve(base, href).alias("url"),
            F.lit("").alias("price"),
        )

    usable = F.filter("anchors", lambda a: usable_href(strip(a["href"])))
    pages = pages.withColumn(
        "records",
        F.when(F.col("had_cards"), F.col("records")).otherwise(F.transform(usable, link)),
    ).drop("_base")
    return _first_per_key(settled(pages), "records")


def shaped(record: Column, fields: Column) -> Column:
    """A listing record cut to the requested names, blanks dropped."""
    wanted = normalised(fields)
    groups = {"title": fixed.TITLE_NAMES, "url": fixed.URL_NAMES, "price": ["price"]}
    values = {
        name: F.when(
            F.arrays_overlap(wanted, F.array(*[F.lit(n) for n in names])) & (record[name] != ""),
            record[name],
        )
        for name, names in groups.items()
    }
    keys = F.array_compact(
        F.array(*[F.when(v.isNotNull(), F.lit(n)) for n, v in values.items()], F.lit("source"))
    )
    return _item(
        record["pos"], values["title"], values["url"], values["price"], fixed.SOURCE_CARDS, keys
    )


# --- JSON -----------------------------------------------------------------------
def json_records(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``records``: texts of the payload's first list of objects; null = no JSON.

    A top list and the usual containers are found in the JVM on VARIANT. What
    that cannot settle (document order, deep nesting, repeated keys) goes to the
    Arrow helper; settled rows reach it as null.
    """
    text = F.col(body)
    df = df.withColumn(
        "_doc",
        F.when(parses_as_json(text), F.try_parse_json(text)),
    )

    def objects(path: str) -> Column:
        got = F.try_variant_get(F.col("_doc"), path, "array<variant>")
        texts = F.transform(got, lambda v: F.to_json(v))
        return F.filter(texts, lambda t: F.startswith(t, F.lit("{")))

    def absent(path: str) -> Column:
        """No list of objects can hide below this path."""
        return F.try_variant_get(F.col("_doc"), path, "map<string,variant>").isNull()

    df = df.withColumn("_top", objects("$")).withColumn("_items", objects("$.items"))
    df = df.withColumn("_products", objects("$.products")).withColumn("_data", objects("$.data"))
    df = df.withColumn("_data_items", objects("$.data.items"))
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    settled = (
        F.when(F.col("_top").isNotNull(), F.col("_top"))
        .when(some("_items"), F.col("_items"))
        .when(~absent("$.items"), F.lit(None))
        .when(some("_products"), F.col("_products"))
        .when(~absent("$.products"), F.lit(None))
        .when(some("_data"), F.col("_data"))
        .when(some("_data_items"), F.col("_data_items"))
    )
    df = df.withColumn("_settled", settled)
    df = df.withColumn("_open", F.when(F.col("_settled").isNull(), text))
    df = df.withColumn("_walked", trees.json_first_objects("_open"))
    return df.withColumn("records", F.coalesce("_settled", "_walked")).drop(
        "_doc", "_top", "_items", "_products", "_data", "_data_items", "_settled", "_open", "_walked"
    )


def json_items(records: Column, fields: Column) -> Column:
    """Requested names present in each record; url falls back to its aliases."""
    asked = F.array_distinct(fields)
    opened = F.transform(
        records, lambda r: F.struct(F.from_json(r, "map<string,variant>").alias("m"))
    )

    def item(x: Column, i: Column) -> Column:
        m = x["m"]
        url_key = F.lit(None).cast("string")
        for alias in reversed(fixed.JSON_URL_ALIASES):
            url_key = F.when(F.map_contains_key(m, alias), F.lit(alias)).otherwise(url_key)

        def holder(f: Column) -> Column:
            """Name in the record that gives field f, null when none does."""
            return F.when(f == "url", url_key).when(F.map_contains_key(m, f), f)

        def text(key: Column) -> Column:
            return F.try_variant_get(F.element_at(m, key), "$", "string")

        def value(name: str) -> Column:
            key = holder(F.lit(name))
            return F.when(F.array_contains(asked, name) & key.isNotNull(), text(key))

        present = F.filter(asked, lambda f: holder(f).isNotNull())
        others = F.filter(present, lambda f: ~f.isin("title", "url", "price", "source"))
        typed = F.filter(
            present,
            lambda f: ~F.schema_of_variant(F.element_at(m, holder(f))).isin("STRING", "VOID")
            & (f != "source"),
        )
        return _item(
            i, value("title"), value("url"), value("price"), fixed.SOURCE_JSON,
            F.array_distinct(F.concat(present, F.array(F.lit("source")))),
            F.map_from_arrays(others, F.transform(others, lambda f: text(holder(f)))),
            typed,
        )

    return F.transform(opened, item)


# --- XML ------------------------------------------------------------------------
def xml_records(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``records``: chosen record elements as (tag, children); null = not well formed.

    Elements with child elements that have the first record tag which occurs, at any
    depth; without one, children of the root whose name occurs again there and that
    hold some child text.
    """
    df = settled(xml.with_elements(df, body, "_text", "_elements"))
    kids = lambda e: e["next"] > e["no"] + 1

    def of(tag: str) -> Column:
        return F.filter("_elements", lambda e: (e["name"] == tag) & kids(e))

    def node(e: Column, alone: bool) -> Column:
        """Tag and children with text; ``alone``: without any, the element stands for itself."""
        inside = F.slice("_elements", e["no"] + 2, e["next"] - e["no"] - 1)
        children = F.transform(
            F.filter(inside, lambda c: c["depth"] == e["depth"] + 1),
            lambda c: F.struct(c["name"].alias("tag"), xml.inner_text("_text", c).alias("text")),
        )
        own = F.array(F.struct(e["name"].alias("tag"), xml.inner_text("_text", e).alias("text"))) if alone else children

        def kept(some: Column) -> Column:
            return F.when(F.size(some) > 0, some).otherwise(F.filter(own, lambda c: c["text"] != ""))

        return F.struct(e["name"].alias("tag"), let(F.filter(children, lambda c: c["text"] != ""), kept).alias("children"))

    top = F.array_sort(F.transform(F.filter("_elements", lambda e: e["depth"] == 1), lambda e: e["name"]))
    twins = let(top, lambda names: F.array_distinct(F.filter(names, lambda n, i: F.get(names, i - 1) == n)))
    df = settled(df.withColumn("_twins", twins))
    repeated = F.filter("_elements", lambda e: (e["depth"] == 1) & kids(e) & F.array_contains("_twins", e["name"]))
    found = F.filter(F.transform(repeated, lambda e: node(e, False)), lambda r: F.size(r["children"]) > 0)
    for tag in reversed(fixed.XML_RECORD_TAGS):
        found = F.when(F.size(of(tag)) > 0, F.transform(of(tag), lambda e: node(e, True))).otherwise(found)
    return df.withColumn("records", found).drop("_text", "_elements", "_twins")


def xml_value(children: Column, name: Column) -> Column:
    """Text of the last child of that name; null when there is none."""
    return F.try_element_at(F.filter(children, lambda c: c["tag"] == name), F.lit(-1))["text"]


def xml_items(records: Column, fields: Column) -> Column:
    asked = F.array_distinct(fields)

    def item(r: Column, i: Column) -> Column:
        kids = r["children"]

        def value(name: str) -> Column:
            return F.when(F.array_contains(asked, name), xml_value(kids, F.lit(name)))

        present = F.filter(asked, lambda f: F.exists(kids, lambda c: c["tag"] == f))
        others = F.filter(present, lambda f: ~f.isin("title", "url", "price", "source"))
        return _item(
            i, value("title"), value("url"), value("price"), fixed.SOURCE_XML,
            F.array_distinct(F.concat(present, F.array(F.lit("source")))),
            F.map_from_arrays(others, F.transform(others, lambda f: xml_value(kids, f))),
        )

    return F.transform(records, item)


# --- outcomes -------------------------------------------------------------------
def fetch_decision(kind: str, readable: Column) -> Column:
    """Decision of the JSON or XML extractor on one response (status, error)."""
    return (
        F.when(F.col("error").isNotNull(), f"{kind}_fetch_failed")
        .when(blocked_status(F.col("status")), f"{kind}_blocked_status")
        .when(~readable, f"{kind}_parse_failed")
        .otherwise(f"{kind}_extracted")
    )


def fetch_warning(kind: str, decision: Column) -> Column:
    name = kind.upper()
    return (
        F.when(
            decision == f"{kind}_fetch_failed",
            F.concat(
                F.lit(f"{kind}_extractor: network error fetching "), F.col("url"), F.lit(": "), F.col("error")
            ),
        )
        .when(
            decision == f"{kind}_blocked_status",
            F.concat(
                F.lit(f"{kind}_extractor: HTTP "), F.col("status").cast("string"),
                F.lit(
                    " indicates the endpoint is blocked, private, or rate limited. "
                    "No extraction attempted."
                ),
            ),
        )
        .when(
            decision == f"{kind}_parse_failed",
            F.concat(F.lit(f"{kind}_extractor: invalid {name} from "), F.col("url")),
        )
    )


def exploded(df: DataFrame, items: str = "items", carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per item of one-page jobs: job_id, base_url, page_seq 0, ITEM fields, ``carried`` columns."""
    packed = settled(df.select("job_id", "url", items, *carried))
    return packed.select(
        "job_id", F.col("url").alias("base_url"), F.lit(0).alias("page_seq"), *carried,
        F.explode(items).alias("_i"),
    ).select("job_id", "base_url", "page_seq", *carried, "_i.*")
