"""Text expressions: white space, entities, numbers. All JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed, references


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    Inside lambdas there is no common-subexpression elimination; a one-element
    array binds the value instead of repeating its expression.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settled(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed here and not again above.

    The optimizer copies column expressions into the filters and projections
    that use them; with chains of costly columns the copies multiply. A one-row
    generator is a border it does not copy across. It stays in the same stage.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def split_key(c: Column) -> Column:
    """A join key that no side is laid out by already.

    Adaptive execution splits a hot key only when the join itself shuffles both
    sides. Where one side comes out of a grouping or a checkpoint by the same
    column, joining on this derived key makes the join do so.
    """
    return F.concat(c.cast("string"), F.lit("|"))


def strip(c: Column) -> Column:
    """Trim every Unicode white space character at both ends."""
    return F.btrim(c, F.lit(fixed.WS_CHARS))


def squeeze(c: Column) -> Column:
    """White space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, fixed.WS + "+", " "))


def is_number(c: Column) -> Column:
    """Text that reads as a floating point number (kept as text, never cast)."""
    return c.rlike(fixed.NUMBER)


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def _code_point(name: Column) -> Column:
    """Code point of a numeric reference ('#65', '#x41;'); U+FFFD where there is no such character."""
    hexadecimal = F.lower(F.left(name, F.lit(2))) == "#x"
    digits = F.regexp_replace(name, r"^#[xX]?0*(?=[^;])|;", "")
    short = F.length(digits) <= F.when(hexadecimal, 6).otherwise(7)
    number = F.when(short, F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("long"))
    known = ((number > 0) & (number < 0xD800)) | number.between(0xE000, 0x10FFFF)
    return F.when(known, number).otherwise(0xFFFD)


def _numeric(name: Column) -> Column:
    """Character of a numeric reference; '' for controls and non-characters."""
    def char(point: Column) -> Column:
        shown = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        nothing = (
            point.between(0x1, 0x8) | point.between(0xE, 0x1F) | (point == 0xB) | (point == 0x7F)
            | point.between(0xFDD0, 0xFDEF) | ((point % 0x10000) >= 0xFFFE)
        )
        return F.when(nothing, "").otherwise(F.translate(shown, fixed.C1, fixed.C1_SHOWN))

    return let(_code_point(name), char)


def decode_entities(c: Column) -> Column:
    """Named and numeric character references, as the standard library reads them, in one pass.

    Splitting at '&' decodes each reference once, so '&amp;lt;' gives '&lt;'. A name
    without its semicolon counts as far as it begins with one that may lack it.
    """
    def piece(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, references.REFERENCE, 1)
        return F.when(i == 0, p).otherwise(let(name, lambda n: one(p, n)))

    def behind(p: Column, name: Column) -> Column:
        return F.substr(p, F.length(name) + 1)

    def opened(p: Column, name: Column) -> Column:
        return F.when(name != "", F.concat(references.named(name), behind(p, name))).otherwise(F.concat(F.lit("&"), p))

    def one(p: Column, name: Column) -> Column:
        char = F.when(F.startswith(name, F.lit("#")), _numeric(name)).otherwise(references.named(name))
        rest = let(F.regexp_extract(name, references.OPEN_NAME, 1), lambda n: opened(p, n))
        return let(char, lambda v: F.when(v.isNotNull(), F.concat(v, behind(p, name))).otherwise(rest))

    def decoded(text: Column) -> Column:
        return F.array_join(F.transform(F.split(text, "&"), piece), "")

    return let(c, lambda t: F.when(F.contains(t, F.lit("&")), decoded(t)).otherwise(t))


def first_of(values: list[str], test) -> Column:
    """First literal (in list order) that passes ``test``; null when none does."""
    out = F.when(test(values[0]), F.lit(values[0]))
    for v in values[1:]:
        out = out.when(test(v), F.lit(v))
    return out


def any_of(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def list_repr(c: Column) -> Column:
    """An array of names in the bracketed, quoted form used in decision texts."""
    return F.when(F.size(c) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("['"), F.array_join(c, "', '"), F.lit("']"))
    )


def bool_repr(c: Column) -> Column:
    return F.when(c, F.lit("True")).otherwise(F.lit("False"))
