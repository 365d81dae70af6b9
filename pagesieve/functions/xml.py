"""XML as columns: well-formedness, elements, texts.

Spark's own XML reader decides whether a text is well formed; what it does not look
at (a second root, text behind the root, prefixes nobody declared) is tested on the
tags. A well-formed text has a regular token grammar, so its elements come from the
same walk as those of HTML. Nothing here is Python code at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed, markup
from .text import let, settled, strip

_NAME = r"[^\s<>/!?=]"
_TOKEN = (
    r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<![A-Z][^\[>]*+(?:\[[^\]]*+\]\s*+)?>"
    rf"|</?{_NAME}{fixed.INSIDE}>"
)
# What belongs to no element: comments, processing instructions, the document type.
_ASIDE = r"^<(?:!--|\?|![A-Z])"
# The references every XML text may use.
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _reads(text: Column) -> Column:
    """Whether the built-in reader accepts the text; field names no element can have."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "not read"}
    return F.from_xml(text, "`no element` string, `not read` string", options)["not read"].isNull()


def _prefixes_declared(tokens: Column) -> Column:
    """Every prefix of an element or attribute name is declared somewhere; no name has two."""
    opened = F.filter(tokens, lambda t: t.rlike(rf"^<{_NAME}"))
    bare = F.array_join(F.transform(opened, lambda t: F.regexp_replace(t, r""""[^"]*+"|'[^']*+'""", "''")), "")
    used = F.regexp_extract_all(bare, F.lit(r"[<\s]([^\s<>/=:'\"]+):[^\s<>/='\"]"), F.lit(1))
    declared = F.regexp_extract_all(bare, F.lit(r"\sxmlns:([^\s=]+)"), F.lit(1))
    known = F.concat(declared, F.array(F.lit("xml"), F.lit("xmlns")))
    return F.when(F.contains(bare, F.lit(":")), (F.size(F.array_except(used, known)) == 0) & ~bare.rlike(r"[<\s][^\s<>/=:'\"]*:[^\s<>/=:'\"]*:")).otherwise(True)


def decode(text: Column) -> Column:
    """References of a well-formed text: the five names and numbers."""
    def char(name: Column) -> Column:
        number = F.when(F.startswith(name, F.lit("#x")), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2)))
        out = F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32")
        for key, value in _NAMED.items():
            out = F.when(name == key, F.lit(value)).otherwise(out)
        return out

    def piece(p: Column, i: Column) -> Column:
        end = F.instr(p, F.lit(";"))
        return F.when(i == 0, p).otherwise(F.concat(char(F.substr(p, F.lit(1), end - 1)), F.substr(p, end + 1)))

    def decoded(t: Column) -> Column:
        return F.array_join(F.transform(F.split(t, "&"), piece), "")

    return F.when(F.contains(text, F.lit("&")), decoded(text)).otherwise(text)


def with_elements(df: DataFrame, body: str, texts: str, elements: str) -> DataFrame:
    """Add ``texts`` and ``elements`` of well-formed rows; null where the text is not well formed.

    texts: what stands behind each token; elements: name (local, lower case), no, first,
    last, next, depth in document order (see ``markup.extents``), no being the index.
    """
    text = F.regexp_replace(F.regexp_replace(F.col(body), r"^\x{FEFF}", ""), r"\r\n?", "\n")
    df = settled(df.withColumn("_x_body", text))
    read = _reads(F.col("_x_body")) & ~F.col("_x_body").rlike(r"[\x{FFFE}\x{FFFF}]")
    df = settled(df.withColumn("_x_body", F.when(read, F.col("_x_body"))))
    df = df.withColumns({"_x_tokens": F.regexp_extract_all("_x_body", F.lit(_TOKEN), F.lit(0)), "_x_between": F.split("_x_body", _TOKEN)})
    df = df.withColumn("_x_tokens", F.when(_prefixes_declared(F.col("_x_tokens")), F.col("_x_tokens")))
    df = settled(df.withColumn("_x_extents", markup.extents(F.col("_x_tokens"), lambda t: F.lit(True), [], _NAME)))

    def local(e: Column) -> Column:
        tag = F.get("_x_tokens", e["first"])
        return F.lower(F.regexp_extract(tag, rf"^<(?:[^\s<>/!?=:]*:)?({_NAME}*)", 1))

    named = F.transform(
        "_x_extents",
        lambda e: F.struct(local(e).alias("name"), *(e[c].alias(c) for c in ("no", "first", "last", "next", "depth"))),
    )

    def content(t: Column, i: Column) -> Column:
        between = F.get("_x_between", i.cast("int") + 1)
        own = F.when(F.startswith(t, F.lit("<![CDATA[")), F.substr(t, F.lit(10), F.length(t) - 12)).otherwise("")
        return F.concat(own, decode(between))

    # One root; around it nothing but blanks, comments and instructions.
    root = F.get("_x_extents", F.lit(0))
    around = F.concat(
        F.slice("_x_between", F.lit(1), root["first"] + 1), F.slice("_x_between", root["last"] + 2, F.size("_x_tokens") + 1)
    )
    behind = F.slice("_x_tokens", root["last"] + 2, F.size("_x_tokens") + 1)
    single = (
        (root["next"] == F.size("_x_extents")) & F.forall(around, lambda x: strip(x) == "") & F.forall(behind, lambda t: t.rlike(_ASIDE))
    )
    df = df.withColumn("_x_extents", F.when(single, F.col("_x_extents")))
    df = df.withColumns({elements: named, texts: F.when(F.col("_x_extents").isNotNull(), F.transform("_x_tokens", content))})
    return df.drop("_x_body", "_x_tokens", "_x_between", "_x_extents")


def inner_text(texts: str, e: Column) -> Column:
    """Trimmed text of an element, that of nested ones included."""
    return strip(F.array_join(F.slice(texts, e["first"] + 1, e["last"] - e["first"]), ""))
