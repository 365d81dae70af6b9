"""Stupid-backoff scores from n-gram counts partitioned by hash.

Texts are token ids between start signs and an end sign. Each task packs the
distinct n-grams of some texts, one row per hash class of their contexts (all
tokens but the last). A class has every count of its n-grams and of their
contexts, so it is counted and scored where its packs meet; sums are then added
up by the texts they were packed with:

    S(c | a b) = n(a b c) / n(a b .)    if the table has a b c (seen ``least`` times or more)
               = BACKOFF * S(c | b)     otherwise
    S(c)       = n(c) / N

N-grams that back off go on to the next shorter order with the shorter n-grams'
counts, in the same way. Counts cover all documents. Where the counted texts are the
scored ones, a text would vouch for itself: with ``leave_out`` its own occurrences
are taken off every count it meets (n-gram, context, N), so that what only it says
backs off. Packs carry a text's own counts of the shorter n-grams for that. Only sums
by token, bounded by the vocabulary, pass through the driver. Classes grow in number
with the corpus; one with a very frequent context is larger, and its packs stay
compressed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored
from .token_ids import encoder

BACKOFF, LEAST, PART_GRAMS = 0.4, 2, 8_000_000
ORDER = 3
START, END = 49_406, 49_407
_TEXTS_AT_ONCE, _GRAMS_AT_ONCE, _TEXT_BYTES_A_GRAM = 256, 2_000_000, 3
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_TOKEN = np.uint64(16)
# Kinds of rows: n-grams to count, to score, or both; sums of texts, those of single tokens; ids of texts.
_COUNT, _SCORE, _BOTH, _SUMS, _SINGLE, _IDS = range(6)


def grams(ids: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (16 bits a token, the last one lowest) of all n-grams of the texts, and how many each text has."""
    before, end = np.full(order - 1, START, "<u4").tobytes(), np.array([END], "<u4").tobytes()
    seq = np.frombuffer(b"".join([x for i in ids for x in (before, i, end)]), "<u4").astype(np.uint64)
    size = np.array([len(i) // 4 + 1 for i in ids], np.int64)
    starts = np.cumsum(size + order - 1) - (size + order - 1)
    code = seq.copy()
    for k in range(1, order):
        code[k:] |= seq[:-k] << np.uint64(16 * k)
    whole = np.ones(len(seq), bool)
    for k in range(order - 1):
        whole[starts + k] = False
    return code[whole], size


def _mask(tokens: int) -> np.uint64:
    return np.uint64((1 << 16 * tokens) - 1)


def _groups(key: np.ndarray, shifts: list[int], times: np.ndarray | None = None) -> list[np.ndarray]:
    """For each shift: how many rows (or ``times``) have the key of each row, its lowest bits shifted out. One sort serves all."""
    at = np.argsort(key)
    ordered, out = key[at], []
    for shift in shifts:
        part = ordered >> np.uint64(shift)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.empty(0, np.int64)
        size = np.diff(np.append(first, len(part)))
        n = np.empty(len(key), np.int64)
        n[at] = np.repeat(size if times is None or not len(first) else np.add.reduceat(times[at], first), size)
        out.append(n)
    return out


def own_counts(code: np.ndarray, size: np.ndarray, order: int) -> list[np.ndarray]:
    """What each text itself adds to the counts of its shorter n-grams; ``code`` and ``size`` as ``grams`` gives them.

    For each order from ``order`` - 1 to 2 the n-gram and its context, then the last
    token. At most 65,536 texts at once.
    """
    token = [code >> np.uint64(16 * k) & _mask(1) for k in range(order - 1)]  # the last one first
    of_text = np.repeat(np.arange(len(size), dtype=np.uint64), size)

    def counts(tokens: list[np.ndarray]) -> list[np.ndarray]:
        key = of_text
        for t in tokens:
            key = key << _TOKEN | t
        return _groups(key, [16 * k for k in range(len(tokens))])

    longest, contexts = counts(token), counts(token[1:])
    return [x for pair in zip(longest, contexts, strict=False) for x in pair] + longest[-1:]


def part_of(code: np.ndarray, parts: int) -> np.ndarray:
    """The hash class of the n-grams' contexts."""
    return ((((code >> _TOKEN) + np.uint64(1)) * _SPREAD >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as they need."""
    return a.astype(np.min_scalar_type(a.max())) if a.dtype.kind == "u" and len(a) else a


def _zip(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes."""
    arrays = [_narrow(a) for a in arrays]
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.itemsize))], "<u4")
    raw = head.tobytes() + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unzip(data: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays, each of the kind given (u or f); those after them are of the last kind."""
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    shape = np.frombuffer(raw, "<u4", 2 * n, 4).reshape(n, 2).tolist()
    out, at = [], 4 + 8 * n
    for (rows, size), kind in zip(shape, [*kinds, *kinds[-1:] * (n - len(kinds))], strict=True):
        out.append(np.frombuffer(raw, np.uint8, rows * size, at).reshape(size, rows).T.copy().view(f"<{kind}{size}").reshape(-1))
        at += rows * size
    return out


def _packs(
    code: np.ndarray, batch: np.ndarray, owner: np.ndarray, times: np.ndarray, parts: int, own: list[np.ndarray] = (), merge: bool = True
) -> Iterator[tuple[int, bytes]]:
    """(part, pack) of each class: its n-grams, who (batch and owner) has each how often, and ``own_counts`` if given.

    ``batch`` is one for all rows or one each. ``merge``: owners ascend, and equal rows become one.
    """
    part = part_of(code, parts)
    by_part = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    for p, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        if a == b:
            continue
        its = by_part[a:b]
        its = its[np.argsort(code[its], kind="stable")]
        gram, who, n = code[its], owner[its], times[its]
        new = np.concatenate([[True], gram[1:] != gram[:-1]])
        if merge:
            first = np.flatnonzero(new | np.concatenate([[True], who[1:] != who[:-1]]))
            its, gram, who, n, new = its[first], gram[first], who[first], np.add.reduceat(n, first), new[first]
        starts = np.flatnonzero(new)
        step, size = np.diff(gram[starts], prepend=np.uint64(0)), np.diff(np.append(starts, len(gram)))
        names = batch[its] if len(batch) > 1 else batch
        yield p, _zip(step, *(x.astype("<u8") for x in (names, size, who, n)), *(o[its] for o in own))


def _opened(pack: bytes) -> list[np.ndarray]:
    """The pack's n-grams, the batch of all rows or of each, the number of rows of each n-gram, owners, times, own counts."""
    step, *more = _unzip(pack, "u")
    return [np.cumsum(step, dtype=np.uint64), *(x.astype(np.int64) for x in more)]


class _Sums:
    """Sums of texts of many batches, added up as they come."""

    def __init__(self) -> None:
        self.held, self.size, self.joined = [], 0, 0

    def add(self, batch: np.ndarray, owner: np.ndarray, total: np.ndarray, tokens: np.ndarray) -> None:
        self.held.append((np.broadcast_to(batch, owner.shape), owner, total, tokens))
        self.size += len(owner)
        if self.size > max(_GRAMS_AT_ONCE, 2 * self.joined):
            self._join()

    def _join(self) -> None:
        batch, owner, total, tokens = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((owner, batch))
        batch, owner = batch[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (batch[1:] != batch[:-1]) | (owner[1:] != owner[:-1])]))
        self.held = [(batch[first], owner[first], np.add.reduceat(total[order], first), np.add.reduceat(tokens[order], first))]
        self.size = self.joined = len(first)

    def rows(self, kind: int, part: int) -> Iterator[tuple]:
        """A row per batch."""
        if self.size:
            self._join()
            batch, owner, total, tokens = self.held[0]
            names, first = np.unique(batch, return_index=True)
            for name, a, b in zip(names.tolist(), first, [*first[1:], len(batch)], strict=True):
                yield kind, part, name, None, _sums(owner[a:b], total[a:b], tokens[a:b], False)


def _sums(owner: np.ndarray, total: np.ndarray, tokens: np.ndarray, seen: bool) -> bytes:
    return _zip(owner.astype("<u8"), total, *(x.astype("<u8") for x in (tokens, tokens * seen)))


def _rows(made: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(ids), pa.binary()]
    columns = list(zip(*made, strict=True)) if made else [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["kind", "part", "batch", "ids", "data"],
    )


def _exploded(docs: DataFrame, tokenizer: str, order: int, parts: int, kind: int, schema: T.StructType, leave_out: bool = False) -> DataFrame:
    """The packs of all texts (null ones are empty), and a row with the ids of the texts of each batch."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, number = encoder(tokenizer), TaskContext.get().partitionId() << 32
        made_of, named, held = [], [], 0

        def packed() -> pa.RecordBatch:
            code, size, *own = (np.concatenate(x) for x in zip(*made_of, strict=True))
            owner = np.repeat(np.arange(len(size)), size)
            packs = _packs(code, np.array([number]), owner, np.ones(len(code), np.int64), parts, own)
            made = [(kind, p, number, None, data) for p, data in packs]
            if kind != _COUNT:
                made.append((_IDS, number % parts, number, [x for n in named for x in n.to_pylist()], None))
            return _rows(made, named[0].type)

        for batch in batches:
            for a in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                part = batch.slice(a, _TEXTS_AT_ONCE)
                code, size = grams(ids_of.encode(part.column("text").to_pylist()), order)
                made_of.append((code, size, *(x.astype("<u4") for x in (own_counts(code, size, order) if leave_out else []))))
                named.append(part.column("doc_id"))
                held += len(code)
                if held > _GRAMS_AT_ONCE:
                    yield packed()
                    made_of, named, held, number = [], [], 0, number + 1
        if made_of:
            yield packed()

    return docs.select("doc_id", "text").mapInArrow(explode, schema)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, inverse = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
    return gram, np.bincount(inverse, np.concatenate([n for _, n in held])).astype(np.int64)


def _table(packs: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the packs and how often each occurs."""
    held, size = [(np.empty(0, np.uint64), np.empty(0, np.int64))], 0
    for pack in packs:
        gram, _, texts, _, times, *_ = _opened(pack)
        held.append((gram, np.add.reduceat(times, np.cumsum(texts) - texts)))
        size += len(gram)
        if size > max(_GRAMS_AT_ONCE, 2 * len(held[0][0])):
            held, size = [_merged(held)], 0
    return _merged(held)


def _scored(
    packs: DataFrame, level: int, order: int, least: int, parts: int, closed: bool, leave_out: bool, schema: T.StructType
) -> DataFrame:
    """Sums of the n-grams that are in the table; if not ``closed``, what the next shorter order needs."""
    pa_ids = to_arrow_type(schema["ids"].dataType.elementType)
    cost = (order - level) * np.log10(BACKOFF)
    mask = _mask(level - 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(list)
        for rows in batches:
            for row in range(rows.num_rows):
                kind, part = (rows.column(c)[row].as_py() for c in ("kind", "part"))
                if kind == _IDS:
                    yield rows.slice(row, 1)
                else:
                    held[part].append((kind, rows.column("data")[row].as_py()))
        for part in sorted(held):
            packed = held.pop(part)
            gram, n = _table(data for kind, data in packed if kind != _SCORE)
            first = np.flatnonzero(np.diff(gram >> _TOKEN, prepend=~(gram[:1] >> _TOKEN)))
            all_of = np.add.reduceat(n, first) if len(first) else n
            of = np.repeat(all_of, np.diff(np.append(first, len(gram))))
            if not leave_out:
                value = np.log10(n) - np.log10(of) + cost
                known = n >= least
            sums, rests = _Sums(), []
            for kind, data in packed:
                if kind == _COUNT:
                    continue
                its, batch, texts, owner, times, *own = _opened(data)
                at = np.minimum(np.searchsorted(gram, its), max(0, len(gram) - 1))
                if leave_out:
                    if level == order:
                        context = np.cumsum(np.diff(its >> _TOKEN, prepend=its[:1] >> _TOKEN) > 0).astype(np.uint64)
                        key = np.repeat(context, texts) << np.uint64(32) | owner.astype(np.uint64)
                        own = [times, *_groups(key, [0], times), *own]
                    (mine, mine_of), own = own[:2], own[2:]
                    others, others_of = np.repeat(n[at], texts) - mine, np.repeat(of[at], texts) - mine_of
                    hits = others >= max(1, least)
                    worth = np.where(hits, np.log10(np.maximum(others, 1)) - np.log10(np.maximum(others_of, 1)) + cost, 0.0)
                else:
                    hit = (gram[at] == its) & known[at] if len(gram) else np.zeros(len(its), bool)
                    worth = np.repeat(np.where(hit, value[at], 0.0) if len(gram) else np.zeros(len(its)), texts)
                    hits = np.repeat(hit, texts)
                if len(batch) == 1:
                    tokens = np.bincount(owner, times * hits).astype(np.int64)
                    some = np.flatnonzero(tokens)
                    data = _sums(some, np.bincount(owner, worth * times)[some], tokens[some], level == order)
                    yield _rows([(_SUMS, part, int(batch[0]), None, data)], pa_ids)
                elif hits.any():
                    sums.add(batch[hits], owner[hits], (worth * times)[hits], times[hits])
                if not closed and not hits.all():
                    gone = ~hits
                    names = batch[gone] if len(batch) > 1 else np.repeat(batch, gone.sum())
                    rests.append([np.repeat(its, texts)[gone] & mask, names, *(x[gone].astype("<u4") for x in (owner, times, *own))])
            yield _rows(list(sums.rows(_SUMS, part)), pa_ids)
            if rests:
                code, names, *more = (np.concatenate(x) for x in zip(*rests, strict=True))
                yield _rows([(_SCORE, p, -1, None, d) for p, d in _packs(code, names, *more[:2], parts, more[2:], merge=False)], pa_ids)
            if not closed and len(gram):
                none = np.zeros(len(gram), np.int64)
                yield _rows([(_COUNT, p, -1, None, d) for p, d in _packs(gram & mask, none[:1], none, n, parts)], pa_ids)

    return packs.repartition(parts, "part").mapInArrow(score, schema)


def _by_token(counts: DataFrame) -> np.ndarray:
    """How often each token occurs: at most 65,536 rows."""

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for data in rows.column("data").to_pylist():
                token, _, _, _, n, *_ = _opened(data)
                yield pa.RecordBatch.from_arrays([pa.array(token.astype(np.int64)), pa.array(n)], names=["token", "n"])

    out = np.zeros(1 << 16)
    for row in counts.select("data").mapInArrow(flat, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect():
        out[row.token] = row.n
    return out


def _by_text(sums: DataFrame, schema: T.StructType, n_all: float | None) -> DataFrame:
    """A row per text from the sums of its batch; ``n_all``: single tokens are still to be divided by what other texts have of these."""

    def add(rows: pa.Table) -> pa.Table:
        named = rows.filter(pc.equal(rows.column("kind"), _IDS)).column("ids").combine_chunks().flatten()
        total, (tokens, seen, single) = np.zeros(len(named)), np.zeros((3, len(named)), np.int64)
        for kind, data in zip(rows.column("kind").to_pylist(), rows.column("data").to_pylist(), strict=True):
            if data is not None:
                own, x, *whole = _unzip(data, "u", "f", "u")
                t, s = (w.astype(np.int64) for w in whole)
                total[own] += x
                tokens[own] += t
                seen[own] += s
                if kind == _SINGLE:
                    single[own] += t
        if n_all is not None:
            total -= single * np.log10(np.maximum(1.0, n_all - tokens))
        return pa.table([named, pa.array(tokens), pa.array(seen), pa.array(total)], names=[f.name for f in schema])

    return sums.groupBy("batch").applyInArrow(add, schema)


def scores(
    docs: DataFrame, tokenizer: str, corpus: DataFrame | None = None, least: int = LEAST, part_grams: int = PART_GRAMS, order: int = 2,
    leave_out: bool = False,
) -> DataFrame:
    """doc_id, n_tokens (end sign included), n_seen, log10_score, mean_log10 for every row of ``docs``.

    ``order``: tokens of the longest n-grams, 2 to 4. ``n_seen`` are the tokens whose
    longest n-gram is in the table. Counts are of ``corpus`` (by default ``docs``); a
    token it lacks counts once. ``leave_out``: a row is scored by the counts of all
    other rows, so rows of equal text count for each other; not with a ``corpus``.
    ``docs``: doc_id and text, read from files; other columns are ignored. A null or
    empty text is start and end alone. Null ids stay null, repeated rows are scored
    each, an empty table gives an empty result. Sums are rounded to 6 digits, as their
    order is not fixed.
    """
    if not 2 <= order <= 4:
        raise ValueError("order must be 2, 3 or 4")
    if leave_out and corpus is not None:
        raise ValueError("texts are left out of their own counts only")
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType.fromDDL("kind int, part int, batch long").add("ids", T.ArrayType(id_type)).add("data", "binary")
    size = sum(d.agg(F.sum(F.octet_length("text"))).first()[0] or 0 for d in (docs, corpus) if d is not None)
    parts = max(1, -(-size // (_TEXT_BYTES_A_GRAM * part_grams)))
    closed = corpus is None and least <= 1 and not leave_out
    n_all = None
    packs = _exploded(docs, tokenizer, order, parts, _BOTH if corpus is None else _SCORE, schema, leave_out)
    if corpus is not None:
        packs = packs.unionByName(_exploded(corpus.withColumn("doc_id", F.lit(None).cast(id_type)), tokenizer, order, parts, _COUNT, schema))
    sums = []
    for level in range(order, 1, -1):
        out = _scored(packs, level, order, least, parts, closed, leave_out, schema)
        if closed:
            sums.append(out)
            break
        out = stored(out, f"order{level}")
        sums.append(out.where(F.col("kind").isin(_SUMS, _IDS)))
        packs = out.where(F.col("kind").isin(_SCORE, _COUNT))
    else:
        after = _by_token(packs.where(F.col("kind") == _COUNT))
        cost = (order - 1) * np.log10(BACKOFF)
        lost = cost + np.log10(np.maximum(after, 1.0) / max(1.0, float(after.sum())))
        n_all = float(after.sum()) if leave_out else None

        def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = _Sums()
            for rows in batches:
                for data in rows.column("data").to_pylist():
                    token, batch, texts, owner, times, *own = _opened(data)
                    token = np.repeat(token.astype(np.int64), texts)
                    worth = cost + np.log10(np.maximum(1.0, after[token] - own[0])) if leave_out else lost[token]
                    sums.add(batch, owner, worth * times, times)
            yield _rows(list(sums.rows(_SINGLE, 0)), pa_ids)

        pa_ids = to_arrow_type(id_type)
        sums.append(packs.where(F.col("kind") == _SCORE).mapInArrow(last, schema))
    whole = sums[0]
    for more in sums[1:]:
        whole = whole.unionByName(more)
    columns = T.StructType().add("doc_id", id_type).add("n_tokens", "long").add("n_seen", "long").add("sum", "double")
    by_text = _by_text(whole, columns, n_all)
    return by_text.select(
        "doc_id", "n_tokens", "n_seen", F.round("sum", 6).alias("log10_score"), F.round(F.col("sum") / F.col("n_tokens"), 6).alias("mean_log10")
    )
