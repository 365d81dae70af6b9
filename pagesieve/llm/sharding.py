"""Sharding by a k-d tree over document metadata.

Points are groups of equal texts, so copies share a shard; a point weighs the
bytes of its group. A node is split along its relatively widest dimension at the
weighted median, until a leaf is one target's worth of bytes. Medians are found
by histograms over the whole table of points, all nodes of a level at once; only
bin totals reach the driver, a bounded number a turn.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BIN_ROWS = 32_768  # bin totals that reach the driver at once; 16 bins a node at least
SLOT_ROWS = 20_000  # rows numbered together


def ordinal(text: Column) -> Column:
    """A number that orders texts by their first six bytes; 0 for null."""
    digits = F.substring(F.rpad(F.hex(F.coalesce(text, F.lit("")).cast("binary")), 12, "0"), 1, 12)
    return F.conv(digits, 16, 10).cast("double")


def metadata(docs: DataFrame) -> dict[str, Column]:
    """The dimensions of the document table: length (in doublings), source and language."""
    known = {"source": ordinal(F.col("source")), "lang": ordinal(F.col("lang"))}
    return {"length": F.log2(F.col("size").cast("double")), **{k: v for k, v in known.items() if k in docs.columns}}


def thin_rows(docs: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, the text's digest and the dimensions."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    kept = [c for c in ("source", "lang") if c in docs.columns]
    rows = docs.select(
        "doc_id", *kept, (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("digest")
    )
    values = [F.coalesce(v, F.lit(0.0)).alias(f"d{i}") for i, v in enumerate(dimensions.values())]
    return rows.select("doc_id", "size", "text_crc32", "digest", *values)


@dataclass
class Node:
    """leaves: how many shards it still becomes; dim -1: by digest alone."""

    name: int
    leaves: int
    weight: float = 0.0
    dim: int = -1
    below: float = 0.0  # weight wanted to the left
    low: list[float] = field(default_factory=list)
    high: list[float] = field(default_factory=list)
    value: float | None = None
    tie: int | None = None


def _table(points: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """One row per node of a level: as many as shards at most, so points meet them without a shuffle."""
    return F.broadcast(points.sparkSession.createDataFrame(rows, schema))


def _search(points: DataFrame, nodes: list[Node], key: Column, low: dict, high: dict, before: dict) -> tuple[dict, dict]:
    """Per node the key at which the running weight passes ``below``, and the weight before that key.

    A turn keeps, of each node's keys, the bin the crossing is in; keys are doubles.
    """
    open_nodes = {n.name: n for n in nodes}
    found = {}
    while open_nodes:
        count = max(16, BIN_ROWS // len(open_nodes))
        bounds = _table(points, [(n, float(low[n]), float(high[n])) for n in open_nodes], "node long, low double, high double")
        rows = points.join(bounds, "node").withColumn("key", key).where("key >= low and key <= high")
        width = F.greatest(F.col("high") - F.col("low"), F.lit(1e-300))
        at = F.least(F.floor((F.col("key") - F.col("low")) / width * count), F.lit(count - 1))
        bins = rows.groupBy("node", at.alias("bin")).agg(F.sum("weight").alias("w"), F.min("key").alias("a"), F.max("key").alias("b"))
        by_node: dict[int, list] = {}
        for r in bins.collect():
            by_node.setdefault(r.node, []).append(r)
        for name, node in list(open_nodes.items()):
            total = before[name]
            own = sorted(by_node[name], key=lambda r: r.bin)
            for r in own:
                if total + r.w >= node.below or r is own[-1]:
                    break
                total += r.w
            before[name], low[name], high[name] = total, r.a, r.b
            if r.a == r.b:
                found[name] = (r.a, r.w)
                del open_nodes[name]
    return found, before


def _split(points: DataFrame, nodes: list[Node], dims: int) -> None:
    """Set dim, value and tie of every node: right of it is what lies beyond (value, tie)."""
    chosen = _table(points, [(n.name, n.dim) for n in nodes], "node long, dim int")
    here = points.join(chosen, "node")
    value = F.coalesce(*[F.when(F.col("dim") == i, F.col(f"d{i}")) for i in range(dims)], F.lit(0.0))
    here = here.withColumn("v", value)
    flat = {n.name: n.dim < 0 for n in nodes}
    low = {n.name: 0.0 if flat[n.name] else n.low[n.dim] for n in nodes}
    high = {n.name: 0.0 if flat[n.name] else n.high[n.dim] for n in nodes}
    found, before = _search(here, nodes, F.col("v"), low, high, {n.name: 0.0 for n in nodes})
    for n in nodes:
        n.value = found[n.name][0]
    # Among equal values the digest decides; its hash is spread evenly.
    at = _table(points, [(n.name, n.value) for n in nodes], "node long, value double")
    equal = here.join(at, "node").where("v = value").drop("value")
    edge = float(1 << 53)
    found, before = _search(equal, nodes, F.col("tie").cast("double"), {n.name: 0.0 for n in nodes}, {n.name: edge for n in nodes}, before)
    for n in nodes:
        tie, weight = found[n.name]
        # The point on the edge goes to the side that is then nearer to its share.
        n.tie = int(tie) if before[n.name] + weight - n.below <= n.below - before[n.name] else int(tie) - 1


def _go_down(points: DataFrame, nodes: list[Node], dims: int) -> DataFrame:
    """The points with the names of the nodes below."""
    rows = [(n.name, n.dim, n.value, n.tie) for n in nodes]
    cuts = _table(points, rows, "node long, dim int, value double, edge long")
    value = F.coalesce(*[F.when(F.col("dim") == i, F.col(f"d{i}")) for i in range(dims)], F.lit(0.0))
    right = (value > F.col("value")) | ((value == F.col("value")) & (F.col("tie") > F.col("edge")))
    down = F.when(F.col("dim").isNull(), F.col("node")).otherwise(F.col("node") * 2 + right.cast("long"))
    return points.join(cuts, "node", "left").withColumn("node", down).drop("dim", "value", "edge")


def tree(points: DataFrame, dims: int, leaves: int) -> tuple[DataFrame, dict[int, int]]:
    """Points with their leaf's node name, and the shard number of each leaf.

    ``points``: digest, tie (0 to 2^53), weight, node (1), d0.. A node of k leaves is split in
    the proportion of floor(k / 2) to the rest; the dimension is the one whose
    extent is the greatest share of the whole table's extent.
    """
    open_nodes, done, root = [Node(1, leaves)], [], None
    while True:
        wide = [n for n in open_nodes if n.leaves > 1]
        done += [n for n in open_nodes if n.leaves == 1]
        if not wide:
            break
        names = _table(points, [(n.name,) for n in wide], "node long")
        extents = [f(f"d{i}") for i in range(dims) for f in (F.min, F.max)]
        rows = points.join(names, "node").groupBy("node").agg(F.sum("weight").alias("weight"), *[e.alias(f"e{i}") for i, e in enumerate(extents)])
        seen = {r.node: r for r in rows.collect()}
        split, below = [], []
        for n in wide:
            r = seen.get(n.name)
            left = n.leaves // 2
            if r is not None:
                n.weight, n.low, n.high = r.weight, [r[f"e{2 * i}"] for i in range(dims)], [r[f"e{2 * i + 1}"] for i in range(dims)]
                root = root or [max(b - a, 1e-300) for a, b in zip(n.low, n.high, strict=True)]
                shares = [(b - a) / w for a, b, w in zip(n.low, n.high, root, strict=True)]
                n.dim = max(range(dims), key=shares.__getitem__) if dims and max(shares) > 0 else -1
                n.below = n.weight * left / n.leaves
                split.append(n)
            below += [Node(2 * n.name, left), Node(2 * n.name + 1, n.leaves - left)]
        if split:
            _split(points, split, dims)
            points = stored(_go_down(points, split, dims), "points")
        open_nodes = below
    depth = max((n.name.bit_length() for n in done), default=1)
    order = sorted((n.name for n in done), key=lambda x: x << (depth - x.bit_length()))
    return points, {name: i for i, name in enumerate(order)}


def slots(rows: DataFrame, count: int, shards: int) -> DataFrame:
    """rows with ``slot``: gapless from 0 in each shard; parts of a shard are numbered apart and shifted."""
    parts = max(1, -(-count // (shards * SLOT_ROWS)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(parts)))
    sizes = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "digest")) - 1
    return rows.withColumn("place", place).join(before, ["shard", "part"]).withColumn("slot", (F.col("before") + F.col("place")).cast("long"))


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dimensions: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Either a number of shards or the bytes a shard should have. Sizes of shards
    differ from an equal share by no more than the largest group of equal texts. A
    null text is as an empty one, null dimensions count as 0, null ids sort first,
    repeated rows are placed each. An empty table gives an empty result. Only
    doc_id, text and the columns of the dimensions are read.
    """
    dimensions = metadata(docs) if dimensions is None else dimensions
    thin = stored(thin_rows(docs, dimensions), "thin")
    dims = len(dimensions)
    count, total = thin.agg(F.count(F.lit(1)), F.sum("size")).first()
    leaves = shards or max(1, -(-(total or 0) // (target_bytes or 1)))
    tie = F.shiftrightunsigned(F.xxhash64("digest"), 11)
    points = stored(
        thin.groupBy("digest").agg(F.sum("size").cast("double").alias("weight"), *[F.min(f"d{i}").alias(f"d{i}") for i in range(dims)])
        .withColumns({"tie": tie, "node": F.lit(1).cast("long")}),
        "points",
    )
    placed, numbers = tree(points, dims, leaves)
    names = _table(placed, list(numbers.items()), "node long, shard int")
    rows = thin.select("doc_id", "size", "text_crc32", "digest").join(placed.join(names, "node").select("digest", "shard"), "digest")
    rows = stored(rows, "sharded")
    return slots(rows, count, leaves).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
