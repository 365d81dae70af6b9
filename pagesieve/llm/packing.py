"""Best-fit packing into fixed-length sequences, certified by dual-feasible bounds.

Documents are tokenised and cut into thin piece rows once. Pieces are dealt to
parts of bounded size and each part is packed by best-fit decreasing. Dual
feasible functions bound each part's number of sequences from below; a part that
meets its bound is done but for its least filled sequence. All other sequences
that are not full are opened, their pieces exchanged among fewer new parts and
packed again, as long as that saves sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parallelism, stored
from .token_ids import encoder

CAPACITY, END_ID, PART_PIECES, ROUNDS = 4096, 1, 50_000, 6


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``capacity`` ids; ``with_ids`` adds them as bytes.

    A document is its text's ids, then ``end_id``; a null or empty text is that id alone.
    """
    end = np.array([end_id], "<u4").tobytes()
    names = ["piece", "start", "length", "ids_crc32", "ids"][: 5 if with_ids else 4]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                rows = []
                for i, ids in enumerate(ids_of.encode(part.column("text").to_pylist())):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append((i, n, at // 4, len(own) // 4, zlib.crc32(own), own))
                i, *columns = zip(*rows, strict=True)
                arrays = [part.column("doc_id").take(pa.array(i)), pa.array(columns[0], pa.int32())]
                arrays += [pa.array(c) for c in columns[1 : len(names)]]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *names])

    schema = docs.select("doc_id").schema
    for name, kind in zip(names, ("integer", "long", "long", "long", "binary"), strict=False):
        schema = schema.add(name, kind)
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of sequences any packing needs, by two families of dual feasible functions.

    Thresholds: lengths below k count nothing, those above capacity - k a whole
    sequence, the rest themselves. Roundings: floor((k + 1) x) / k, x a share of
    the capacity, where that is no whole number.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.float64)
    size = np.arange(capacity + 1)
    upto = np.cumsum(count * size)
    over = np.cumsum(count[::-1])[::-1]
    k = np.arange(1, capacity // 2 + 1)
    thresholds = over[capacity - k + 1] + (upto[capacity - k] - upto[k - 1]) / capacity
    best = max([0.0, *np.ceil(thresholds - 1e-9)])
    for k in range(1, 25):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size / capacity, (scaled // capacity) / k)
        best = max(best, float(np.ceil((count * value).sum() - 1e-9)))
    return int(best)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of lengths given in decreasing order; the fullest sequence that fits takes each."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some sequence has room r
    used = 0
    for i, n in enumerate(lengths.tolist()):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, own, used = capacity, used, used + 1
        sequence[i], offset[i] = own, capacity - room
        if left := room - n:
            by_room[left].append(own)
            rooms |= 1 << left
    return sequence, offset


def _pack_parts(rows: DataFrame, count: int, turn: int, capacity: int, part_pieces: int) -> DataFrame:
    """Deal rows to parts of about ``part_pieces`` and pack each; loose: may be exchanged."""
    parts = max(1, -(-count // part_pieces))
    n = min(parallelism(rows.sparkSession), parts)

    def pack(part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "descending"), ("row", "ascending")])
        lengths = part.column("length").to_numpy()
        sequence, offset = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(sequence, lengths)
        loose = fill < capacity
        if len(fill) == lower_bound(lengths, capacity):  # certified: only its least filled can be merged
            loose &= np.arange(len(fill)) == int(fill.argmin())
        key = (turn << 56) + (part.column("part")[0].as_py() << 28)
        return (
            part.drop_columns(["part"])
            .append_column("sequence_id", pa.array(key + sequence))
            .append_column("offset", pa.array(offset))
            .append_column("loose", pa.array(loose[sequence]))
        )

    columns = [c for c in rows.columns if c not in ("sequence_id", "offset", "loose", "part")]
    part = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(parts)).alias("part")
    schema = rows.select(*columns).schema.add("sequence_id", "long").add("offset", "long").add("loose", "boolean")
    return stored(
        rows.select(*columns, part).repartition(n, "part").groupBy("part").applyInArrow(pack, schema), "packed"
    )


def _opened(packed: DataFrame) -> tuple[int, int]:
    """(pieces, sequences) that may be exchanged."""
    loose = packed.where("loose")
    row = loose.agg(F.count(F.lit(1)), F.sum((F.col("offset") == 0).cast("long"))).first()
    return row[0], row[1] or 0


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
    part_pieces: int = PART_PIECES, rounds: int = ROUNDS, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their sequence_id and offset, gapless in each sequence.

    ``docs``: doc_id and text; other columns are ignored. Null ids stay null;
    repeated rows are packed as often as they occur; an empty table packs nothing.
    """
    table = pieces(docs, tokenizer, capacity, end_id, with_ids)
    table = stored(table.withColumn("row", F.monotonically_increasing_id()), "pieces")
    rows, done = table, []
    packed = _pack_parts(rows, table.count(), 0, capacity, part_pieces)
    for turn in range(1, rounds):
        count, sequences = _opened(packed)
        if sequences < 2:
            break
        again = _pack_parts(packed.where("loose"), count, turn, capacity, part_pieces)
        if again.where("offset = 0").count() >= sequences:
            break
        done.append(packed.where("not loose"))
        packed = again
    for settled in done:
        packed = packed.unionByName(settled)
    return packed.drop("row", "loose")
