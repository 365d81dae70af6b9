"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Each source asks for its weight's part of the wanted total. Sources that would
pass their maximum of epochs are clamped there and the excess is shared again by
weight, until none passes. A source's target is then met by whole repetitions of
all its documents and one fractional repetition: documents in a seeded order
until the rest is used up, the last one in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, numbered, stored

WEIGHTS, TOTAL_SHARE, MAX_EPOCHS, SEED = (3, 1, 2), 1.5, 2, "mix-1"
_BUCKET = 4  # hexadecimal digits of the seeded order by which sizes are summed first


def word_count(text: Column) -> Column:
    """Words of a text; none in a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _place(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Thin rows: doc_id, source, size and the seeded place of the document in its source."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _place(seed).alias("place"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) for ``sizes`` (source, size).

    Weights go round the sources in code point order, null last. Clamping is
    repeated over the table of sources; what reaches the driver is two sums a turn.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    places = numbered(sources, order, "at")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int"))
    table = stored(places.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    cap = epochs * F.col("source_size")
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    full, free = 0, table.agg(F.sum("weight")).first()[0] or 0
    while True:
        # A clamped source stays clamped: the level only rises.
        clamped = (F.col("weight") * (total - full) > cap * free) if free else F.lit(True)
        row = table.agg(F.sum(F.when(clamped, cap)), F.sum(F.when(~clamped, F.col("weight")))).first()
        now = (row[0] or 0, row[1] or 0)
        if now == (full, free):
            break
        full, free = now
    target = F.when(clamped, cap.cast("double"))
    if free:
        target = target.otherwise(F.col("weight") * F.lit(total - full) / F.lit(float(free)))
    return table.select("source", "source_size", target.alias("target"))


def plan(thin: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source: epochs all documents get, and where in the seeded order the last epoch ends.

    A document before ``cut`` is taken once more, one at it ``part`` of ``tied``
    (all words at that place) times its size, one after it not.
    """
    amounts = wanted.select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("epochs"),
    ).withColumn("more", F.floor("target") - F.col("epochs") * F.col("source_size"))
    amounts = amounts.select("source", F.struct("source_size", "target", "epochs", "more").alias("amount"))

    def crossing(rows: DataFrame, keys: list[str], place: str, more: Column) -> DataFrame:
        """The first place at which the running sum of sizes passes what is left to take."""
        upto = F.sum("size").over(Window.partitionBy(*keys).orderBy(place))
        running = rows.withColumn("before", upto - F.col("size")).where((F.col("before") <= more) & (more < F.col("before") + F.col("size")))
        return running.withColumn("left", more - F.col("before"))

    by_bucket = thin.groupBy("source", F.substring("place", 1, _BUCKET).alias("bucket")).agg(F.sum("size").alias("size"))
    named = (
        by_bucket.alias("l")
        .join(amounts.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
        .select("l.*", "amount")
    )
    buckets = crossing(named, ["source"], "bucket", F.col("amount.more")).select(
        "source", F.col("bucket").alias("at_bucket"), F.col("left").alias("bucket_left")
    )
    inside = thin.alias("l").join(
        buckets.alias("r"),
        F.col("l.source").eqNullSafe(F.col("r.source")) & (F.substring("place", 1, _BUCKET) == F.col("at_bucket")),
    ).select("l.source", "place", "size", "bucket_left")
    places = inside.groupBy("source", "place").agg(F.sum("size").alias("size"), F.max("bucket_left").alias("bucket_left"))
    cuts = crossing(places, ["source"], "place", F.col("bucket_left")).select(
        F.col("source").alias("cut_source"), F.col("place").alias("cut"), F.col("left").alias("part"), F.col("size").alias("tied")
    )
    return amounts.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left").select("source", "amount.*", "cut", "part", "tied")


def taken(plans: DataFrame, rows: DataFrame) -> DataFrame:
    """rows (source, place, size, ..) with source_size, target, epochs, extra and taken."""
    extra = (
        F.when(F.col("place") < F.col("cut"), F.col("size"))
        .when(F.col("place") == F.col("cut"), F.floor(F.col("part") * F.col("size") / F.col("tied")))
        .otherwise(0)
        .cast("long")
    )
    joined = rows.alias("l").join(plans.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    return (
        joined.select("l.*", "source_size", "target", F.col("epochs").cast("long").alias("epochs"), extra.alias("extra"))
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("extra"))
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, extra, taken for every row.

    ``docs`` needs doc_id, text and source; other columns are ignored. A null text
    has size 0, a null source is the last source, documents without an id share one
    place in the order. Rows of one id and source share what is taken at their
    place. An empty table gives an empty result.
    """
    thin = stored(sized(docs, seed), "sizes")
    return taken(stored(plan(thin, targets(thin, weights, share, epochs)), "mix-plan"), thin).drop("place")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE, epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, the last in part; columns of ``docs``."""
    thin = stored(sized(docs, seed), "sizes")
    # Stored, the plan's size is known: few sources are broadcast by the planner, many are joined by sort-merge.
    plans = stored(plan(thin, targets(thin, weights, share, epochs)), "mix-plan")
    # The document travels as one column, so no column of it can clash.
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), "source", word_count(F.col("text")).alias("size"), _place(seed).alias("place")
    )
    counted = taken(plans, rows)
    # Words with the white space behind them; white space at the start counts as no word.
    pieces = F.split("doc.text", f"(?<={SPACE})(?=[^\\x20\\x09-\\x0D])")
    lead = F.when(F.col("doc.text").rlike(f"^{SPACE}"), 1).otherwise(0)
    part = F.array_join(F.slice(pieces, F.lit(1), F.col("extra").cast("int") + lead), "")
    part = F.regexp_replace(part, f"{SPACE}+$", "")
    cut = F.col("doc").withField("text", part)
    if "n_chars" in docs.columns:
        cut = cut.withField("n_chars", F.length(part).cast(docs.schema["n_chars"].dataType))
    whole = F.col("epochs") + (F.col("extra") == F.col("size")).cast("long")
    copies = F.when(F.col("size") > 0, F.array_repeat("doc", whole.cast("int"))).otherwise(F.array("doc"))
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    every = F.when(some, F.concat(copies, F.array(cut))).otherwise(copies)
    return counted.select(F.explode(every).alias("doc")).select("doc.*")
