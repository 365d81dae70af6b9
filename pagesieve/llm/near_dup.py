"""Near duplicates: SuperMinHash signatures, banding, verification on full sets, union-find.

Steps, each a table:

1. ``shingled``: one thin row per document (set size, set digest, band hashes).
2. Equal sets are one class; only classes go on, so copies never meet in pairs.
3. Classes that share a band value form a bucket; its least class is the pivot.
   A class joins the group of every pivot it meets, so two classes that share any
   bucket share a group. Groups are cut into blocks of bounded size, with the
   pivot in each.
4. Inside a block all pairs are verified on full shingle sets and only a spanning
   set of links leaves the task.
5. Groups of several blocks whose classes are not yet one component: each class
   off the group's main component is verified against all blocks, in blocks.

No pair that shares a band is left out. With 24 bands of 4 values two sets of
similarity 0.85 share none with probability 2e-8.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parallelism, per_text, stored
from .components import components
from .superminhash import band_hashes, shingle_set, signatures, spanning_links

BANDS, ROWS, WIDTH, PERCENT = 24, 4, 5, 85
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 500_000
_SHINGLED = "n_shingles long, set_key binary, bands array<long>"


def _digest(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def shingled(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Set size, set digest and band hashes of every document; no words (or no text): null digest."""

    def sign(texts: list[str | None]) -> dict[str, list]:
        sets = [shingle_set(t, width) for t in texts]
        hashes = band_hashes(signatures(sets, bands * rows), rows)
        return {
            "n_shingles": [len(s) for s in sets],
            "set_key": [_digest(s) for s in sets],
            "bands": [h if len(s) else None for h, s in zip(hashes, sets, strict=True)],
        }

    return per_text(docs.where("doc_id is not null"), ["doc_id"], _SHINGLED, sign)


def _groups(classes: DataFrame) -> DataFrame:
    """(pivot, class_id): every class with the pivots of its buckets, pivots included."""
    exploded = classes.select("class_id", F.posexplode("bands").alias("band", "value"))
    buckets = (
        exploded.groupBy("band", "value")
        .agg(F.min("class_id").alias("pivot"), F.max("class_id").alias("last"))
        .where("pivot < last")
    )
    met = exploded.join(buckets, ["band", "value"]).select("pivot", "class_id").distinct()
    return stored(met, "groups")


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(class_id, shingles): the full sets of the classes of some groups, taken from the texts."""

    def cut(texts: list[str | None]) -> dict[str, list]:
        sets = [shingle_set(t, width) for t in texts]
        return {"digest": [_digest(s) for s in sets], "shingles": [s.tobytes() for s in sets]}

    texts = docs.select(F.col("doc_id").alias("class_id"), "text").where("class_id is not null")
    # Texts are shuffled whatever the sizes: the wanted ids grow with them.
    found = per_text(
        texts.join(wanted.hint("merge"), "class_id"), ["class_id", "set_key"], "digest binary, shingles binary", cut
    ).where("digest = set_key")
    return stored(found.select("class_id", "shingles").dropDuplicates(["class_id"]), "sets")


def _spanning(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links (a, b) between the labels of each block (rows: keys, class_id, label, shingles)."""

    def link(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates("class_id").sort_values("class_id")
        ids = block["class_id"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
        found = spanning_links(sets, block["label"].to_numpy(), percent) if len(ids) > 1 else []
        return pd.DataFrame({"a": [ids[i] for i, _ in found], "b": [ids[j] for _, j in found]}, dtype="int64")

    return rows.groupBy(*keys).applyInPandas(link, "a long, b long")


def _blocks(groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """groups with the number of blocks their pivot's group is cut into, and the class's block."""
    wide = groups.join(sizes, "class_id")
    count = wide.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"))
    blocks = count.select(
        "pivot",
        F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
    )
    return stored(
        wide.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")),
        "blocks",
    )


def _links(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    groups = _groups(classes)
    wanted = groups.select("class_id").distinct().join(classes.select("class_id", "set_key", "n_shingles"), "class_id")
    wanted = stored(wanted, "wanted")
    sets = _sets_of(docs, wanted.select("class_id", "set_key"), width)
    placed = _blocks(groups, wanted.select("class_id", "n_shingles"))
    n = parallelism(docs.sparkSession)

    everywhere = placed.where("class_id = pivot").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    first = placed.where("class_id <> pivot").unionByName(everywhere).select("pivot", "block", "class_id")
    first = first.join(sets, "class_id").withColumn("label", F.col("class_id"))
    links = stored(_spanning(first.repartition(n, "pivot", "block"), ["pivot", "block"], percent), "links")

    # Groups of several blocks: what is not yet joined to the pivot's component meets all blocks.
    cut = placed.where("blocks > 1")
    if cut.isEmpty():
        return links
    label = components(links)
    named = (
        cut.join(label.withColumnRenamed("node", "class_id"), "class_id", "left")
        .withColumn("label", F.coalesce("component", "class_id"))
        .drop("component")
    )
    main = named.where("class_id = pivot").select("pivot", F.col("label").alias("main"))
    named = stored(named.join(main, "pivot"), "named")
    off = named.where("label <> main")
    chunks = off.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES).cast("int").alias("by_count"),
                                      F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("by_weight"))
    chunks = chunks.select("pivot", F.greatest("by_count", "by_weight").alias("chunks"))
    chunk = F.pmod(F.xxhash64("class_id", F.lit(1)), F.col("chunks")).cast("int")
    members = named.join(chunks, "pivot").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    others = off.join(chunks, "pivot").withColumn("chunk", chunk).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    columns = ["pivot", "block", "chunk", "class_id", "label"]
    second = members.select(*columns).unionByName(others.select(*columns)).distinct().join(sets, "class_id")
    keys = ["pivot", "block", "chunk"]
    more = _spanning(second.repartition(n, *keys), keys, percent)
    return links.unionByName(stored(more, "links"))


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``docs`` needs doc_id and text; other columns are ignored. A null or empty
    text is linked with nothing. A null doc_id is linked with nothing, has a null
    component and is kept. doc_id is the key: repeated rows get equal results, and
    of several texts under one id that are least in their groups of copies, the
    one with the least digest is compared. An empty table gives an empty result.
    Texts of any length are read whole.
    """
    table = stored(shingled(docs, width, bands, rows), "shingled")
    full = table.where("set_key is not null")
    classes = stored(
        full.groupBy("set_key").agg(
            F.min("doc_id").alias("class_id"),
            F.max("doc_id").alias("last"),
            F.min("n_shingles").alias("n_shingles"),
            F.min("bands").alias("bands"),
        ),
        "classes",
    )
    one_each = classes.groupBy("class_id").agg(
        F.min(F.struct("set_key", "n_shingles", "bands")).alias("least")
    ).select("class_id", "least.*")
    found = stored(components(_links(docs, one_each, width, percent)), "components")
    moved = (
        classes.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("set_key", "last", "class_id", F.coalesce("component", "class_id").alias("component_id"))
        .where("last > component_id")
        .select("set_key", "component_id")
    )
    joined = full.join(moved, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    alone = table.where("set_key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    nameless = docs.where("doc_id is null").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    return (
        joined.unionByName(alone)
        .unionByName(nameless)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
