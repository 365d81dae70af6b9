"""Cleaning, validation and deduplication of extracted items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, urls
from ..functions.text import is_blank, is_number, squeeze

ITEM_FIELDS = ["title", "url", "price", "source", "extra", "keys", "nonstring"]


def _is_text(name) -> Column:
    """The item's value of that name is a text (JSON may give other types)."""
    return ~F.coalesce(F.array_contains("nonstring", name), F.lit(False))


def clean_price(price: Column) -> Column:
    """Currency signs, commas and white space off; null unless a number is left."""
    bare = F.regexp_replace(price, fixed.PRICE_STRIP, "")
    return F.when(is_number(bare), bare)


def clean_items(items: DataFrame) -> DataFrame:
    """Squeeze texts, resolve URLs against ``base_url``, reduce prices. Narrow."""
    df = items.withColumn("_base", urls.base_parts(F.col("base_url")))
    base = F.col("_base")
    price = squeeze(F.col("price"))

    def other(k: Column, v: Column) -> Column:
        text = squeeze(v)
        return F.when(
            _is_text(k), F.when(k.isin("href", "link"), urls.resolve(base, text)).otherwise(text)
        ).otherwise(v)

    return (
        df.withColumn("title", F.when(_is_text("title"), squeeze(F.col("title"))).otherwise(F.col("title")))
        .withColumn("_url", squeeze(F.col("url")))
        .withColumn(
            "url", F.when(_is_text("url"), urls.resolve(base, F.col("_url"))).otherwise(F.col("url"))
        )
        .withColumn(
            "price",
            F.when(_is_text("price"), F.when(price == "", price).otherwise(clean_price(price))).otherwise(
                F.col("price")
            ),
        )
        .withColumn("extra", F.when(F.col("extra").isNotNull(), F.transform_values("extra", other)))
        .drop("_base", "_url", "base_url")
    )


def _empty(name: str) -> Column:
    """Null, empty, or a JSON value that counts as nothing (0, false, [], {})."""
    c = F.col(name)
    typed_nothing = ~_is_text(name) & (c.isin("false", "[]", "{}") | c.rlike(r"^-?0(?:\.0+)?(?:[eE].*)?$"))
    return c.isNull() | (c == "") | typed_nothing


def title_error() -> Column:
    return F.when(_empty("title") | is_blank(F.col("title")), F.lit(fixed.ERROR_TITLE))


def url_error() -> Column:
    u = F.col("url")
    web = F.startswith(u, F.lit("http://")) | F.startswith(u, F.lit("https://"))
    return F.when(_empty("url"), F.lit(fixed.ERROR_URL)).when(
        ~web, F.concat(F.lit(fixed.ERROR_SCHEME), u, F.lit("'."))
    )


def price_error() -> Column:
    p = F.col("price")
    return F.when(
        p.isNotNull() & ~is_number(p), F.concat(F.lit(fixed.ERROR_PRICE), p, F.lit("'."))
    )


def validate(items: DataFrame) -> DataFrame:
    """Add ``validation_error``: the first rule that fails, null for valid items."""
    return items.withColumn("validation_error", F.coalesce(title_error(), url_error(), price_error()))


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("validation_error").isNull()).drop("validation_error")


def invalid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("validation_error").isNotNull())


def first_by_url(valid_items: DataFrame, keys: tuple[str, ...] = ("job_id",)) -> DataFrame:
    """First item per key and URL in (page_seq, pos) order, with ``copies`` seen.

    An aggregate, so copies collapse in each partition before the shuffle; the
    shuffle is on key and URL, which spreads a job that holds most rows.
    """
    group = [*keys, "url"]
    rest = [c for c in valid_items.columns if c not in group]
    order = [c for c in ("job_id", "page_seq", "pos") if c in rest]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return (
        valid_items.groupBy(*group)
        .agg(first.alias("_first"), F.count(F.lit(1)).alias("copies"))
        .select(*group, "_first.*", "copies")
    )


def validation_summary(checked: DataFrame) -> DataFrame:
    """Counts per job and rule; combined in each partition before the shuffle."""
    error = F.col("validation_error")

    def failed(start: str) -> Column:
        return F.count_if(F.coalesce(F.startswith(error, F.lit(start)), F.lit(False)))

    return checked.groupBy("job_id").agg(
        F.count_if(error.isNull()).alias("valid_count"),
        F.count_if(error.isNotNull()).alias("invalid_count"),
        failed(fixed.ERROR_TITLE).alias("title_errors"),
        (failed(fixed.ERROR_URL) + failed(fixed.ERROR_SCHEME)).alias("url_errors"),
        failed(fixed.ERROR_PRICE).alias("price_errors"),
    )


def job_item_counts(checked: DataFrame) -> DataFrame:
    """raw, clean, valid (after dedup), invalid and duplicate counts per job.

    Two steps: by (job, url) first, which spreads and shrinks a hot job, then by
    job over one row per distinct URL.
    """
    error = F.col("validation_error")
    per_url = (
        checked.withColumn("_key", F.when(error.isNull(), F.col("url")))
        .groupBy("job_id", "_key")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(error.isNotNull()).alias("bad"))
    )
    good = F.col("_key").isNotNull()
    return per_url.groupBy("job_id").agg(
        F.sum("n").alias("raw_items_count"),
        F.sum("n").alias("clean_items_count"),
        F.count_if(good).alias("valid_items_count"),
        F.sum("bad").alias("invalid_items_count"),
        F.sum(F.when(good, F.col("n") - 1).otherwise(0)).alias("duplicates_removed"),
    )
