"""Markup as columns: tags, texts, attributes, elements.

A document is taken apart once, into its tags and the texts between them. The tag
pattern steps over quoted values, so a '>' inside one ends nothing. Comments, scripts
and styles are cut first. An anchor ends at its closing tag or at the next anchor.
Extents of nested elements come from a walk over the tags with a stack. Everything
here is an expression over one row: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed
from .text import any_of, decode_entities, let, settled, squeeze, strip

def dom(html: Column) -> Column:
    """Markup without comments, scripts and styles; '<!>' marks the cuts."""
    return F.regexp_replace(html, fixed.TRIVIA, "<!>")


def without_noscript(d: Column) -> Column:
    return F.regexp_replace(d, fixed.NOSCRIPT, "<!>")


def script_elements(html: Column) -> Column:
    cuts = F.regexp_extract_all(html, F.lit(fixed.TRIVIA), F.lit(0))
    return F.size(F.filter(cuts, lambda x: F.lower(F.left(x, F.lit(7))) == "<script"))


# --- tags and texts ---------------------------------------------------------------
def tags(d: Column) -> Column:
    """All tags in document order, as written."""
    return F.regexp_extract_all(d, F.lit(fixed.TAG), F.lit(0))


_MARK = "\x01"  # a character that hardly any text has


def pieces(d: Column) -> Column:
    """The texts between tags as written: one more than tags, text ``i + 1`` follows tag ``i``."""
    # A pattern is compiled for every text it splits, a single character is not: tags are made one first.
    one = F.split(F.regexp_replace(d, fixed.TAG, _MARK), _MARK)
    marked = F.when(F.contains(d, F.lit(_MARK)), F.split(d, fixed.TAG)).otherwise(one)
    return F.when(~F.contains(d, F.lit("<")), F.array(d)).otherwise(marked)


def _between(values: Column, first: Column, count: Column) -> Column:
    """``count`` values from place ``first`` (from 0); unlike a slice it reads no other value."""
    places = F.when(count > 0, F.sequence(first, first + count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.get(values, i))


def _shown(texts: Column) -> Column:
    """Non-empty trimmed texts, references decoded, in order."""
    some = F.filter(texts, lambda t: t != "")
    return F.filter(F.transform(some, lambda t: strip(decode_entities(t))), lambda t: t != "")


def text_nodes(d: Column) -> Column:
    """Non-empty trimmed texts between tags, in order."""
    return _shown(pieces(d))


def joined_text(d: Column, sep: str = " ") -> Column:
    return F.array_join(text_nodes(d), sep)


# --- attributes -------------------------------------------------------------------
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']*+)"""


def attributes_until(target: str, stop: str | None = None) -> str:
    """Pattern of a tag's attributes up to one that ``target`` matches; values are stepped over.

    ``stop`` matches where ``target`` does, without groups (default: ``target``).
    """
    stop = stop or target
    gap = r"""(?:[\s/"']++|(?<=["'])|^)"""
    return rf"""(?:{gap}(?!{stop})[^\s>"'/][^\s=>"'/]*+(?:\s*+=\s*+{_VALUE})?+)*+[\s/"']*+{target}"""


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, null when the attribute is missing.

    The tag is read attribute by attribute, stepping over quoted values; the first of
    that name counts. ``tag`` may lack its '<name'. One without the name anywhere is not read.
    """
    target = rf"""{name}\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++)"""
    own = attributes_until(target, rf"{name}\s*+=")
    raw = F.regexp_extract(tag, rf"(?is)^(?:</?[a-z!?][^\s>/]*+)?{own}", 1)
    value = let(raw, lambda v: F.when(v != "", decode_entities(unquoted(v))))
    return F.when(F.contains(F.lower(tag), F.lit(name)), value)


def unquoted(value: Column) -> Column:
    """An attribute's value as matched, without the quotes around it."""
    quoted = F.startswith(value, F.lit('"')) | F.startswith(value, F.lit("'"))
    return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def tag_having(names: str, value: str, tag: str = "[a-zA-Z]") -> str:
    """Pattern of an opening tag up to an attribute (``names``) whose value matches ``value`` somewhere.

    A quote that is left open reaches to the next '>'.
    """
    target = rf"""(?i:{names})\s*+=\s*+(?:"[^">]*?(?:{value})|'[^'>]*?(?:{value})|"[^"]*?(?:{value})|'[^']*?(?:{value})|[^\s"'>]*?(?:{value}))"""
    return rf"<{tag}[^\s>/]*+{attributes_until(target)}"


_PAGING_WORD = "(?i:pagination|pager|next-page)"
_RECORD_WORD = "item|product|card|result"


# --- anchors ----------------------------------------------------------------------
def anchors_of(tag: Column, text: Column) -> Column:
    """Array of anchors that have an href, in document order, from tags and pieces.

    ``no`` counts all anchor tags (also those without href) from 0, ``at`` is the
    anchor's place among all tags.
    """
    def marked(t: Column, i: Column) -> Column:
        return F.struct(i.cast("int").alias("at"), t.alias("tag"))

    def cut(marks: Column) -> Column:
        return F.transform(
            marks,
            lambda m, k: F.struct(
                m["at"].alias("at"), m["tag"].alias("tag"),
                F.coalesce(F.get(marks, k + 1)["at"], F.size(tag)).alias("until"),
            ),
        )

    def parse(a: Column) -> Column:
        return F.struct(
            a["no"].alias("no"),
            a["at"].alias("at"),
            a["href"].alias("href"),
            F.coalesce(attribute(a["tag"], "rel"), F.lit("")).alias("rel"),
            F.coalesce(attribute(a["tag"], "class"), F.lit("")).alias("cls"),
            F.coalesce(attribute(a["tag"], "id"), F.lit("")).alias("id"),
            _shown(_between(text, a["at"] + 1, a["until"] - a["at"])).alias("texts"),
        )

    # Anchor tags and their ends: where the next of them stands, an anchor is over.
    marks = F.filter(F.transform(tag, marked), lambda m: m["tag"].rlike(r"^<(?:[aA]\s|/[aA][\s>])"))
    opened = F.filter(let(marks, cut), lambda m: F.substr(m["tag"], F.lit(2), F.lit(1)) != "/")
    found = F.transform(
        opened,
        lambda m, no: F.struct(
            no.cast("int").alias("no"), m["at"].alias("at"), m["tag"].alias("tag"), m["until"].alias("until"),
            attribute(m["tag"], "href").alias("href"),
        ),
    )
    return F.transform(F.filter(found, lambda a: a["href"].isNotNull()), parse)


def anchors(d: Column) -> Column:
    """``anchors_of`` a document that is not taken apart yet."""
    return let(
        F.struct(tags(d).alias("tags"), pieces(d).alias("pieces")),
        lambda p: F.when(d.isNotNull(), anchors_of(p["tags"], p["pieces"])),
    )


def page_title(d: Column) -> Column:
    """Text of the title element as written ('' when empty or missing)."""
    return decode_entities(F.regexp_extract(d, rf"(?is)<title(?:\s{fixed.INSIDE})?>([^<]*)</title", 1))


def heading_count(d: Column) -> Column:
    return F.regexp_count(d, F.lit(r"(?i)<h[1-3]\b"))


def _is_paging(c: Column) -> Column:
    return (c != "") & c.rlike(fixed.PAGING_CLASS)


def _is_next_rel(rel: Column) -> Column:
    return (rel != "") & F.array_contains(F.split(F.lower(squeeze(rel)), " "), "next")


def link_text(a: Column) -> Column:
    return F.lower(F.array_join(a["texts"], " "))


def paging_labels(a: Column, squeezed: bool = False) -> Column:
    """Labels of the tests by which one anchor looks like a next-page link."""
    text = squeeze(link_text(a)) if squeezed else link_text(a)
    return F.array_compact(
        F.array(
            F.when(_is_next_rel(a["rel"]), fixed.SIGNAL_REL),
            let(
                text,
                lambda t: F.when(t.isin(fixed.NEXT_TEXTS), F.concat(F.lit(fixed.SIGNAL_TEXT), t)),
            ),
            F.when(a["href"].rlike(fixed.PAGING_HREF), fixed.SIGNAL_HREF),
            F.when(_is_paging(a["cls"]) | _is_paging(a["id"]), fixed.SIGNAL_ANCHOR),
        )
    )


def is_paging_link(a: Column) -> Column:
    """Whether an anchor has any of ``paging_labels`` (squeezed): no label is made, the first test that holds ends it."""
    tests = [
        _is_paging(a["cls"]), _is_paging(a["id"]), _is_next_rel(a["rel"]), a["href"].rlike(fixed.PAGING_HREF),
        squeeze(link_text(a)).isin(fixed.NEXT_TEXTS),
    ]
    return any_of([F.coalesce(t, F.lit(False)) for t in tests])


def has_paging_element(d: Column) -> Column:
    return d.rlike(tag_having("class|id", _PAGING_WORD))


def structure_count(d: Column, anchor_count: Column) -> Column:
    """Blocks and headings, plus anchors, plus elements with a record-like class."""
    blocks = F.regexp_count(d, F.lit(r"(?i)<(?:article|table|ul|ol|h[1-3])\b"))
    return blocks + anchor_count + F.regexp_count(d, F.lit(tag_having("class", _RECORD_WORD)))


# --- extents of elements ----------------------------------------------------------
_CHUNK = 128  # tags walked before what they ended is put with the rest
_ENTRY, _SLOT = "\x02", "\x01"


def _walked(steps: Column) -> Column:
    """Ends of wanted elements, from ``steps``: at, key, closing, stays (waits for an end), wanted.

    The open elements are a text, the innermost first: their names, for wanted ones a
    slot (number among the opening tags, depth, place) behind their ``key``. A closing tag ends the innermost
    open element of its name and all inside it; one that nothing waits for is passed over.
    The state of an aggregate is copied for every element, so it stays small: tags are
    walked in chunks and only a chunk's own ends are in it.
    """
    event = "struct<ended:string,at:int,next:int>"
    none = F.array().cast(f"array<{event}>")

    def with_state(open_: Column, depth: Column, no: Column, events: Column) -> Column:
        return F.struct(open_.alias("open"), depth.alias("depth"), no.alias("no"), events.alias("events"))

    def told(acc: Column, s: Column, ended: Column, opened: Column) -> Column:
        one = F.struct(ended.alias("ended"), s["at"].alias("at"), opened.alias("next")).cast(event)
        return F.concat(acc["events"], F.array(one))

    def opening(acc: Column, s: Column) -> Column:
        slot = F.concat_ws(":", acc["no"].cast("string"), acc["depth"].cast("string"), s["at"].cast("string"))
        entry = F.when(s["wanted"], F.concat(s["key"], slot)).otherwise(s["key"])
        opened = acc["no"] + 1
        return (
            F.when(s["stays"], with_state(F.concat(entry, acc["open"]), acc["depth"] + 1, opened, acc["events"]))
            .when(s["wanted"], with_state(acc["open"], acc["depth"], opened, told(acc, s, entry, opened)))
            .otherwise(with_state(acc["open"], acc["depth"], opened, acc["events"]))
        )

    def closing(acc: Column, s: Column) -> Column:
        def at(innermost: Column) -> Column:
            def ending(left: Column) -> Column:
                """``left``: where the open elements that stay open begin."""
                def gone(ended: Column) -> Column:
                    alone = F.when(innermost == 1, 1)
                    number = F.coalesce(alone, F.length(ended) - F.length(F.translate(ended, _ENTRY, "")))
                    events = F.when(ended.rlike(f"{_SLOT}[0-9]"), told(acc, s, ended, acc["no"])).otherwise(acc["events"])
                    return with_state(F.substr(acc["open"], left), acc["depth"] - number, acc["no"], events)

                return let(F.substr(acc["open"], F.lit(1), left - 1), gone)

            return F.when(innermost > 0, let(F.call_function("locate", F.lit(_ENTRY), acc["open"], innermost + 1), ending)).otherwise(acc)

        return let(F.instr(acc["open"], s["key"]), at)

    def step(acc: Column, s: Column) -> Column:
        return F.when(s["closing"], closing(acc, s)).otherwise(opening(acc, s))

    def state(acc: Column, events: Column) -> Column:
        return F.struct(*(acc[c].alias(c) for c in ("open", "depth", "no")), events.alias("events"))

    def chunk(acc: Column, part: Column) -> Column:
        return F.aggregate(part, state(acc, none), step, lambda end: state(end, F.concat(acc["events"], end["events"])))

    def chunks(all_steps: Column) -> Column:
        last = F.greatest(F.floor((F.size(all_steps) - 1) / _CHUNK), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last.cast("int")), lambda k: F.slice(all_steps, k * _CHUNK + 1, F.lit(_CHUNK)))

    start = F.struct(F.lit(_ENTRY).alias("open"), F.lit(0).alias("depth"), F.lit(0).alias("no"), none.alias("events"))
    return F.aggregate(let(steps, chunks), start, chunk)


def _branching(steps: Column) -> Column:
    """Steps of ``_walked`` without those that end nothing: unwanted elements with no tag inside."""
    def opens(s: Column) -> Column:
        return ~s["closing"] & ~s["wanted"]

    def leaf(all_steps: Column, k: Column) -> Column:
        s, behind = F.get(all_steps, k), F.get(all_steps, k + 1)
        return F.coalesce(opens(s) & s["stays"] & behind["closing"] & (s["key"] == behind["key"]), F.lit(False))

    def kept(all_steps: Column) -> Column:
        def wait(s: Column, k: Column) -> Column:
            return F.when(s["closing"], ~leaf(all_steps, k - 1)).when(opens(s), s["stays"] & ~leaf(all_steps, k)).otherwise(True)

        return F.filter(all_steps, wait)

    return let(steps, kept)


def _extents_of(steps: Column, count: Column) -> Column:
    """Extents (see ``extents``) of the wanted elements among ``steps``; ``count``: the number of tags."""
    def of(event: Column) -> Column:
        slots = F.filter(F.split(event["ended"], _ENTRY), lambda e: e.rlike(f"{_SLOT}[0-9]"))

        def extent(e: Column) -> Column:
            number = F.split(F.substring_index(e, _SLOT, -1), ":")
            return F.struct(
                number[0].cast("int").alias("no"), number[2].cast("int").alias("first"), event["at"].alias("last"),
                event["next"].alias("next"), number[1].cast("int").alias("depth"),
            )

        return F.transform(slots, extent)

    def all_of(walk: Column) -> Column:
        rest = F.struct(walk["open"].alias("ended"), count.alias("at"), walk["no"].alias("next"))
        return F.array_sort(F.flatten(F.transform(F.concat(walk["events"], F.array(rest)), of)))

    return let(_walked(steps), all_of)


def extents(
    tag: Column, wanted: Callable[[Column], Column], void: list[str] = fixed.VOID, name: str = "[a-zA-Z]", leaves: bool = True
) -> Column:
    """Wanted elements in document order: no, first, last, next, depth.

    ``tag``: all tags; ``wanted`` tells of an opening one whether its element is asked
    for. no: its number among the opening tags; first, last: places of the tag that
    opens it and of the one that ends it (itself without content; the number of tags
    if it stays open); next: the number the first opening tag behind it has. Without
    ``leaves`` unwanted elements with no tag inside are not walked: most of a page's tags
    end nothing but themselves. no and next then count the others only.
    """
    def seen(t: Column, i: Column) -> Column:
        return F.struct(
            i.cast("int").alias("at"),
            F.lower(F.regexp_extract(t, rf"^</?({name}[^\s/>{_SLOT}{_ENTRY}]*)", 1)).alias("name"),
            F.startswith(t, F.lit("</")).alias("closing"),
            t.alias("tag"),
        )

    def judged(s: Column) -> Column:
        single = F.endswith(s["tag"], F.lit("/>"))
        return F.struct(
            s["at"].alias("at"), F.concat(F.lit(_ENTRY), s["name"], F.lit(_SLOT)).alias("key"), s["closing"].alias("closing"),
            (~s["closing"] & ~single & (~s["name"].isin(void) if void else F.lit(True))).alias("stays"),
            (~s["closing"] & wanted(s["tag"])).alias("wanted"),
        )

    steps = F.transform(F.filter(F.transform(tag, seen), lambda s: s["name"] != ""), judged)

    return _extents_of(steps if leaves else _branching(steps), F.size(tag))


_PASSES = 8  # levels of elements that are taken out of the text of a page's tags
_PAIR = rf"{_ENTRY}([^{_SLOT}/]++){_SLOT}([0-9:]*+)\|([0-9:;]*+){_ENTRY}/\1{_SLOT}([0-9]++;)"
_WAITING = r"[0-9]:\|"
# Tags as ``spans`` first writes them: no elements and unwanted ones without content; wanted ones without; the others.
_VOID_NAME = rf"(?:{'|'.join(fixed.VOID)})(?=[\s/>])[^{_SLOT}]*+"
_SINGLE = rf"[a-z][^{_SLOT}]*+(?<=/>)"
_NOTHING = (
    rf"{_ENTRY}(?:</?+[^a-z/][^{_SLOT}]*+{_SLOT}(?:[0-9]++[:;])?+\|?+"
    rf"|(?:</?+{_VOID_NAME}|<{_SINGLE}){_SLOT}(?:\||[0-9]++;))"
)
_ALONE = rf"{_ENTRY}<(?:{_VOID_NAME}|{_SINGLE}){_SLOT}([0-9]++):\|"
_TAG_NAME = rf"{_ENTRY}<(/?[a-z][^\s/>{_SLOT}]*+)[^{_SLOT}]*+{_SLOT}"


def spans(tag: Column, wanted: Callable[[Column], Column]) -> Column:
    """Wanted elements in document order: first and last as ``extents`` gives them, without a step for each tag.

    The tags are written as one short text of names; a wanted one's has its place, an end has its own. An
    element with no tag left inside ends nothing but itself, so all of these are taken out by one search, and only
    wanted ones leave both places; a few searches empty most pages. Where a wanted element still waits then
    (nobody closes it or one around or inside it, or it is nested deeper), the tags that are left are walked.
    """
    def written(t: Column, i: Column) -> Column:
        """A tag, its place behind it where that is asked for; names are cut out of the whole text, not of each tag."""
        plain = F.when(F.contains(t, F.lit(_SLOT)) | F.contains(t, F.lit(_ENTRY)), F.translate(t, _SLOT + _ENTRY, "  ")).otherwise(t)
        place = F.when(F.startswith(t, F.lit("</")), F.concat(i.cast("string"), F.lit(";")))
        return F.concat(F.lit(_ENTRY), plain, F.lit(_SLOT), place.when(wanted(t), F.concat(i.cast("string"), F.lit(":|"))).otherwise("|"))

    def named(text: Column) -> Column:
        text = F.regexp_replace(F.lower(text), _NOTHING, "")
        return F.regexp_replace(F.regexp_replace(text, _ALONE, "$1:$1;"), _TAG_NAME, f"{_ENTRY}$1{_SLOT}")

    def taken_out(text: Column) -> Column:
        return F.when(text.rlike(_WAITING), F.regexp_replace(text, _PAIR, "$2$4$3")).otherwise(text)

    def step(t: Column) -> Column:
        place = F.regexp_extract(t, rf"{_SLOT}([0-9]+)", 1)
        return F.struct(
            F.when(place != "", place.cast("int")).otherwise(0).alias("at"),
            F.concat(F.lit(_ENTRY), F.regexp_extract(t, rf"^./?([^{_SLOT}]*{_SLOT})", 1)).alias("key"),
            F.startswith(t, F.lit(f"{_ENTRY}/")).alias("closing"), F.lit(True).alias("stays"), F.endswith(t, F.lit(":")).alias("wanted"),
        )

    def told(text: Column) -> Column:
        """Spans of the elements taken out and of those still to be walked for."""
        places = F.transform(
            F.regexp_extract_all(text, F.lit("[0-9]+:[0-9]+;"), F.lit(0)),
            lambda m: let(F.split(m, "[:;]"), lambda p: F.struct(p[0].cast("int").alias("first"), p[1].cast("int").alias("last"))),
        )
        rest = F.transform(F.regexp_extract_all(text, F.lit(rf"{_ENTRY}[^{_SLOT}]++{_SLOT}[0-9]*+[:;]?+"), F.lit(0)), step)
        walked = F.transform(_extents_of(rest, F.size(tag)), lambda e: F.struct(e["first"].alias("first"), e["last"].alias("last")))
        return F.sort_array(F.when(text.rlike(_WAITING), F.concat(places, walked)).otherwise(places))

    text = named(F.array_join(F.transform(tag, written), ""))
    for _ in range(_PASSES):
        text = let(text, taken_out)
    return let(text, told)


def inner_markup(tag: Column, text: Column, extent: Column) -> Column:
    """Markup inside each of the elements (see ``extents``), from tags and pieces."""
    def cut(p: Column) -> Column:
        return F.transform(
            extent,
            lambda e: F.when(
                e["last"] > e["first"],
                F.concat(
                    F.get(p["text"], e["first"] + 1),
                    F.array_join(F.slice(p["whole"], e["first"] + 2, e["last"] - e["first"] - 1), ""),
                ),
            ).otherwise(""),
        )

    def joined(p: Column) -> Column:
        whole = F.transform(p["tag"], lambda t, i: F.concat(t, F.get(p["text"], i.cast("int") + 1)))
        return let(F.struct(p["text"].alias("text"), whole.alias("whole")), cut)

    return let(F.struct(tag.alias("tag"), text.alias("text")), joined)


def with_page_columns(df: DataFrame, html: str) -> DataFrame:
    """Add the columns other operators share, each computed once per row."""
    taken = df.withColumn("dom", dom(F.col(html))).withColumns({"tags": tags(F.col("dom")), "pieces": pieces(F.col("dom"))})
    # Lambdas look into these arrays for each element: they must not be copied into them.
    taken = settled(taken)
    return taken.withColumns(
        {
            "anchors": anchors_of(F.col("tags"), F.col("pieces")),
            "text": F.array_join(_shown(F.col("pieces")), " "),
        }
    )


PAGE_COLUMNS = ("dom", "tags", "pieces", "anchors", "text")
