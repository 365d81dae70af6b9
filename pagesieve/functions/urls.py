"""URL expressions: parts, origins, resolving a reference against a base."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
# Absolute web URLs that resolving leaves as they are, whatever the base.
_FINISHED = r"(?s)^https?://[^/?#]+(?:/[^?#]*)?(?:\?[^#]+)?(?:#.+)?$"
# A path from the root, without dot segments, perhaps with a query: it only needs the site before it.
_ROOTED = r"^(?!//)(?:/(?!\.)[^/?#\s]*+)++(?:\?[^#\s]++)?+$"


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, _SCHEME, 1))


def netloc(u: Column) -> Column:
    """Host and port as written; empty when there is none."""
    return F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def path(u: Column) -> Column:
    return F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query(u: Column) -> Column:
    """Query with its '?', empty when there is none."""
    return F.regexp_extract(u, r"^[^?#]*(\?[^#]+)", 1)


def fragment(u: Column) -> Column:
    return F.regexp_extract(u, r"(?s)^[^#]*(#.+)$", 1)


def origin(u: Column) -> Column:
    return F.concat(scheme(u), F.lit("://"), netloc(u))


def path_ends_with(u: Column, endings: list[str]) -> Column:
    p = F.lower(path(u))
    out = F.endswith(p, F.lit(endings[0]))
    for e in endings[1:]:
        out = out | F.endswith(p, F.lit(e))
    return out


def base_parts(u: Column) -> Column:
    """A base URL taken apart once, to be used for many references."""
    return F.struct(
        u.alias("full"),
        scheme(u).alias("scheme"),
        netloc(u).alias("netloc"),
        path(u).alias("path"),
        query(u).alias("query"),
    )


def _without_dots(p: Column) -> Column:
    """Fold '.' and '..' segments; only paths that contain some pay for it."""
    none = F.array().cast("array<string>")

    def fold(segments: Column) -> Column:
        kept = F.aggregate(
            segments,
            none,
            lambda kept, s: F.when(
                s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
            )
            .when(s == ".", kept)
            .otherwise(F.concat(kept, F.array(s))),
        )
        tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
        joined = F.array_join(F.concat(kept, tail), "/")
        return F.regexp_replace(joined, "^(?!/)", "/")

    return let(
        p,
        lambda v: F.when(v.rlike(r"(?:^|/)\.\.?(?:/|$)"), let(F.split(v, "/"), fold)).otherwise(v),
    )


def resolve(base: Column, ref: Column) -> Column:
    """Absolute form of ``ref`` on a page whose ``base_parts`` are given."""
    site = F.concat(base["scheme"], F.lit("://"), base["netloc"])
    folder = F.concat(F.regexp_extract(base["path"], r"^(.*)/", 1), F.lit("/"))

    def split_ref(r: Column) -> Column:
        s = r["scheme"]
        rest = F.when(s == "", r["ref"]).otherwise(F.substr(r["ref"], F.length(s) + 2))
        return let(
            rest,
            lambda v: F.struct(
                r["ref"].alias("ref"),
                s.alias("scheme"),
                F.regexp_extract(v, r"^//([^/?#]*)", 1).alias("host"),
                F.regexp_extract(v, r"^(?://[^/?#]*)?([^?#]*)", 1).alias("path"),
                query(v).alias("query"),
                fragment(v).alias("fragment"),
            ),
        )

    def join(r: Column) -> Column:
        p, q, frag = r["path"], r["query"], r["fragment"]
        slash = F.when((p == "") | F.startswith(p, F.lit("/")), F.lit("")).otherwise(F.lit("/"))
        whole = F.when(F.startswith(p, F.lit("/")), p).otherwise(
            F.regexp_replace(F.concat(folder, p), "/{2,}", "/")
        )
        return (
            F.when((r["scheme"] != "") & (r["scheme"] != base["scheme"]), r["ref"])
            .when(
                r["host"] != "",
                F.concat(base["scheme"], F.lit("://"), r["host"], slash, p, q, frag),
            )
            .when(p == "", F.concat(site, base["path"], F.when(q == "", base["query"]).otherwise(q), frag))
            .otherwise(F.concat(site, _without_dots(whole), q, frag))
        )

    def parsed(v: Column) -> Column:
        return let(F.struct(v.alias("ref"), scheme(v).alias("scheme")), split_ref)

    return let(
        ref,
        lambda v: F.when(v == "", base["full"])
        .when(v.rlike(_ROOTED), F.concat(site, v))
        .when(v.rlike(_FINISHED), v)
        .otherwise(let(parsed(v), join)),
    )


def quote(c: Column) -> Column:
    """Percent-encode all but letters, digits, '_.-~' and '/'."""
    out = F.url_encode(c)
    for coded, plain in [("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")]:
        out = F.replace(out, F.lit(coded), F.lit(plain))
    return out


def unquote(c: Column) -> Column:
    """Percent-decode; '%' signs that start no code stay as they are."""
    safe = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(F.contains(c, F.lit("%")), F.try_url_decode(safe)).otherwise(c)
