"""Document fingerprints by consistent weighted sampling. DataFrame functions only.

A text is its distinct words, each weighing as often as it occurs. For every
sample a word k draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from hashes of itself;
with t = floor(ln w / r + b) its key is ln c - r (t - b + 1). The word of the least
key, with its t, is the sample. Two texts have equal samples with the probability
of their generalised Jaccard similarity, sum of least over sum of greatest weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, parallelism

SAMPLES = 32
_UNIT = float(1 << 32)


def _uniforms(word: Column, salt: int) -> tuple[Column, Column]:
    """Two uniform numbers in (0, 1) from one hash of a word's hash."""
    h = F.xxhash64(word, F.lit(salt))
    return (F.shiftrightunsigned(h, 32) + 0.5) / _UNIT, (h.bitwiseAND(F.lit(0xFFFFFFFF)) + 0.5) / _UNIT


def sample(word: Column, log_weight: Column, n: int) -> Column:
    """The n-th draw of a word: its key as order-keeping upper bits, word and t hashed as lower ones."""
    u1, u2 = _uniforms(word, 3 * n)
    u3, u4 = _uniforms(word, 3 * n + 1)
    b, _ = _uniforms(word, 3 * n + 2)
    r = -F.ln(u1 * u2)
    t = F.floor(log_weight / r + b)
    key = F.ln(-F.ln(u3 * u4)) - r * (t - b + 1)
    # No word (a text without words): the key, and so the draw, is null.
    upper = ((F.when(key < -511, -511.0).otherwise(key) + 512) * float(1 << 21)).cast("long")
    return F.shiftleft(upper, 32).bitwiseOR(F.xxhash64(word, t).bitwiseAND(F.lit(0xFFFFFFFF)))


def settled(rows: DataFrame, *costly: str) -> DataFrame:
    """The same rows, with the costly columns computed here and not again in what uses them.

    The optimizer does not copy across a one-row generator. The other columns pass
    as they are, so a partitioning by them stays known.
    """
    plain = [c for c in rows.columns if c not in costly]
    return rows.select(*plain, F.inline(F.array(F.struct(*costly))))


def weighted_words(texts: DataFrame, text: str) -> DataFrame:
    """texts with ``words``: the hashes of distinct words and how often each occurs."""
    carried = [c for c in texts.columns if c != text]
    hashed = F.transform(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), lambda w: F.xxhash64(w))
    rows = settled(texts.select(*carried, F.sort_array(hashed).alias("h")), "h")
    starts = F.filter(
        F.transform("h", lambda x, i: F.when((i == 0) | (F.get("h", i - 1) != x), i)), lambda i: i.isNotNull()
    )
    rows = settled(rows.withColumn("starts", starts), "starts")
    runs = F.transform(
        "starts",
        lambda s, i: F.struct(
            F.get("h", s).alias("word"), (F.coalesce(F.get("starts", i + 1), F.size("h")) - s).alias("times")
        ),
    )
    return rows.select(*carried, runs.alias("words"))


def signatures(texts: DataFrame, text: str, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """keys and ``signature`` (samples longs; null without words) of every row, keys telling rows apart.

    If ``texts`` is hash-partitioned by some of the keys, nothing is shuffled.
    """
    exploded = weighted_words(texts, text).select(*keys, F.inline_outer("words"))
    drawn = exploded.withColumn("log_weight", F.ln("times"))
    least = [F.min(sample(F.col("word"), F.col("log_weight"), n)).alias(f"s{n}") for n in range(samples)]
    made = drawn.groupBy(*keys).agg(*least)
    return made.select(*keys, F.when(F.col("s0").isNotNull(), F.array(*(f"s{n}" for n in range(samples)))).alias("signature"))


def written(signature: Column) -> Column:
    """A signature as text: eight hexadecimal digits per sample; empty without words."""
    low = F.transform(signature, lambda s: F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.coalesce(F.lower(F.array_join(low, "")), F.lit(""))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples; two texts without words are alike, one is like no other."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.coalesce(equal / samples, (a.isNull() & b.isNull()).cast("double"))


def in_buckets(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``bucket``: ranges of descending doc_id of about equal rows, null ids last."""
    n = 4 * parallelism(docs.sparkSession)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    bounds = F.array(*(F.lit(b) for b in sorted(set(cuts)))) if cuts else F.array().cast("array<bigint>")
    above = F.size(F.filter(bounds, lambda b: b > F.col("doc_id")))
    bucket = F.when(F.col("doc_id").isNull(), len(set(cuts)) + 1).otherwise(above)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), bucket.alias("bucket"))


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness to each other and the next.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many of the next document in descending doc_id (ties by text, null
    ids last, after the last the first). ``docs`` needs doc_id and text. Null texts
    are empty; a single document is its own next; an empty table gives an empty
    result; other columns are ignored. Texts are shuffled once, to the ranges.
    """
    rows = in_buckets(docs)
    # The first text of every range also stands, marked, behind the range before it.
    first = rows.groupBy("bucket").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down"), "text")).alias("head")
    )
    along = Window.orderBy("bucket")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = first.select(
        "bucket", F.coalesce(F.lead("head.text").over(along), F.first("head.text").over(whole)).alias("text")
    )
    marked = rows.withColumn("last", F.lit(0)).unionByName(
        behind.select(F.lit(None).cast("long").alias("doc_id"), "text", "bucket", F.lit(1).alias("last"))
    )
    order = Window.partitionBy("bucket").orderBy("last", F.desc_nulls_last("doc_id"), "text")
    placed = marked.withColumn("place", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    sides = settled(placed.select("bucket", "place", "last", "doc_id", "text", edited.alias("edited")), "edited")
    sides = sides.select(
        "bucket",
        "place",
        "last",
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.posexplode(F.when(F.col("last") == 0, F.array("text", "edited")).otherwise(F.array("text"))).alias("side", "words_of"),
    )
    keys = ["bucket", "place", "side", "last", "doc_id", "n_chars", "edited_sha256"]
    made = signatures(sides, "words_of", keys, samples)
    # A document's rows: its text, its edited text; then the next document's text.
    on = Window.partitionBy("bucket").orderBy("place", "side")
    out = made.withColumn("own_edited", F.lead("signature", 1).over(on)).withColumn("next", F.lead("signature", 2).over(on))
    return out.where("side = 0 and last = 0").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("signature")).alias("fingerprint"),
        written(F.col("own_edited")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("own_edited"), samples).alias("near_edited"),
        likeness(F.col("signature"), F.col("next"), samples).alias("near_next"),
    )
