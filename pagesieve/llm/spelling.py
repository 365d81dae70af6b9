"""Spelling variants: words one edit apart, found by tries of letter-group counts.

A word is a vector: how many of its letters belong to each of LEVELS. A trie over the
vectors has one level per letter group; a node's children are the counts of its
group. One edit changes a vector by at most one count more and one less, so a search
walks the trie depth first with a budget of one surplus and one deficit, and the words
of the leaves it reaches are verified letter by letter.

The trie is cut at its first levels: every combination of counts there is a shard, a
sub-trie built inside one task. A word is looked up in its own shard and in those its
budget reaches; of two shards only the later one in order is asked by the earlier, as
nearness is mutual. How many levels the cut has follows from the shards' sizes. A shard
that is still too large is cut into blocks, its visitors into chunks, every block
meeting every chunk: bounded tasks, no pair lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MODULUS, LEAST_LETTERS, LEAST_COUNT, RATIO = 97, 5, 3, 2
SHARD_WORDS, CHUNK_WORDS = 40_000, 120_000
HELD_WORDS = 200_000  # distinct words a task holds before it sends counts on

# The letters of a word, and letter groups; all other letters are the last group.
LETTERS = r"[a-zÀ-ÿ]"
LEVELS = (
    "e", "a", "n", "i", "r", "t", "s", "o", "u", "l", "d", "h", "c", "m", "g", "b", "p", "f", "v", "kw", "yz", "qxj",
    "é", "èê", "äàâá", "öóô", "üúù", "çñ",
)
CUTS = range(2, 9)  # levels above the shards, at least and at most

LEAF, LEAF_PAIRS, PAIRS = 12, 256, 400_000
WIDTH = 48  # letters compared at once; longer words are compared one by one

_KIND = np.full(256, len(LEVELS), np.int64)
for _i, _letters in enumerate(LEVELS):
    for _letter in _letters:
        _KIND[ord(_letter)] = _i


# --- words -----------------------------------------------------------------------
def runs(text: str, least: int) -> list[str]:
    """Maximal runs of letters with at least ``least`` of them; only A-Z are lower-cased."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return re.findall(f"{LETTERS}{{{least},}}", low)


def word_of(run: str, crc: int, modulus: int) -> str:
    """The run, without one letter where the modulus divides its checksum."""
    if crc % modulus:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, modulus: int = MODULUS, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of all whole texts with their occurrences. A null id stands as no text, a null text has no word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def table() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{batch.column('id')[i].as_py()}:".encode())
                # A run shorter than a word never becomes one.
                for run, n in Counter(runs(text, least_letters)).items():
                    crc = zlib.crc32(run.encode(), start)
                    word = run if crc % modulus else word_of(run, crc, modulus)
                    if len(word) >= least_letters:
                        seen[word] += n
                if len(seen) >= HELD_WORDS:
                    yield table()
        yield table()

    thin = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counted = thin.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- one sub-trie (inside a task) ---------------------------------------------------
class Block:
    """Words as arrays: counts of letter groups, letters from the left and from the right."""

    def __init__(self, own: list[str]):
        raw = [w.encode("latin-1") for w in own]
        self.words = own
        self.length = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(raw)), self.length)
        n = len(LEVELS) + 1
        counts = np.bincount(owner * n + _KIND[flat], minlength=len(raw) * n).reshape(len(raw), n)
        # Beyond 120 of a group (words of letters by the hundred) counts stand modulo 120: nothing is lost, the leaves decide.
        self.counts = np.where(counts > 120, 0, counts).astype(np.int8)
        self.huge = (counts > 119).any(axis=1)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        keep = place < WIDTH
        self.left = np.zeros((len(raw), WIDTH), np.uint8)
        self.left[owner[keep], place[keep]] = flat[keep]
        back = np.repeat(self.length, self.length) - 1 - place
        keep = back < WIDTH
        self.right = np.zeros((len(raw), WIDTH), np.uint8)
        self.right[owner[keep], back[keep]] = flat[keep]

    def __len__(self) -> int:
        return len(self.words)


def near(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    a, b = sorted((a, b), key=len)
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at:] == b[at + 1 :] if len(a) < len(b) else a[at + 1 :] == b[at + 1 :]


def _first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of the first letter that differs; the width where none does."""
    differs = a != b
    at = differs.argmax(axis=1)
    return np.where(differs[np.arange(len(at)), at], at, a.shape[1])


def verified(d: Block, q: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (d[i], q[j]) are one edit apart: a common beginning and end that leave one letter."""
    a, b = d.length[i], q.length[j]
    width = int(min(WIDTH, max(a.max(initial=0), b.max(initial=0))))
    before = _first_difference(d.left[i, :width], q.left[j, :width])
    ok = before < np.maximum(a, b)  # equal words are no pair
    after = np.zeros(len(i), np.int64)
    after[ok] = _first_difference(d.right[i[ok], :width], q.right[j[ok], :width])
    same = before + after
    ok &= (abs(a - b) <= 1) & (same >= np.maximum(a, b) - 1)
    long = np.flatnonzero(np.maximum(a, b) > WIDTH)
    ok[long] = [near(d.words[i[k]], q.words[j[k]]) for k in long]
    return ok


def search(d: Block, q: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of a dictionary word and a query within the budget, verified: the trie of ``d`` walked depth first.

    All queries that can still reach a node go down with it, each with what is left of its budget.
    """
    if not len(d) or not len(q):
        return
    order = np.lexsort(d.counts.T[::-1])
    trie, levels = d.counts[order], d.counts.shape[1]
    wild_d, wild_q = d.huge.any(), q.huge.any()
    found_d, found_q, held = [], [], 0
    one = np.ones(len(q), bool)
    todo = [(0, len(d), 0, np.arange(len(q)), one, one)]

    def checked() -> tuple[np.ndarray, np.ndarray]:
        i, j = order[np.concatenate(found_d)], np.concatenate(found_q)
        ok = verified(d, q, i, j)
        return i[ok], j[ok]

    while todo:
        low, high, level, j, more, less = todo.pop()
        n = high - low
        if level == levels or n <= LEAF or n * len(j) <= LEAF_PAIRS:
            at, k = np.repeat(np.arange(low, high), len(j)), np.tile(np.arange(len(j)), n)
            if level < levels:  # what is left of the vectors must fit what is left of the budget
                change = trie[at, level:] - q.counts[j[k], level:]
                fits = (change.max(axis=1) <= more[k]) & (change.min(axis=1) >= -less[k].astype(np.int8))
                fits &= ((change > 0).sum(axis=1) <= 1) & ((change < 0).sum(axis=1) <= 1)
                if wild_d or wild_q:
                    fits |= d.huge[order[at]] | q.huge[j[k]]
                at, k = at[fits], k[fits]
            if len(at):
                found_d.append(at)
                found_q.append(j[k])
                held += len(at)
                if held >= PAIRS:
                    yield checked()
                    found_d, found_q, held = [], [], 0
            continue
        column, own = trie[low:high, level], q.counts[j, level]
        cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:], strict=False):
            change = column[a] - own
            keep = (change == 0) | ((change == 1) & more) | ((change == -1) & less)
            if wild_d or wild_q:
                keep |= q.huge[j] | (wild_d and bool(d.huge[order[low + a : low + b]].any()))
            if keep.any():
                change = change[keep]
                todo.append((low + a, low + b, level + 1, j[keep], more[keep] & (change != 1), less[keep] & (change != -1)))
    if held:
        yield checked()


class Best:
    """Per word of a block: how many are near, and the most frequent of them (ties: first in code point order)."""

    def __init__(self, size: int):
        self.near, self.key = np.zeros(size, np.int64), np.full(size, -1, np.int64)

    def add(self, at: np.ndarray, key: np.ndarray) -> None:
        self.near += np.bincount(at, minlength=len(self.near))
        np.maximum.at(self.key, at, key)


_BITS = 20  # of a key, for the place in code point order; the rest is the count


def _keys(own: list[str], n: np.ndarray) -> np.ndarray:
    order = np.empty(len(own), np.int64)
    order[sorted(range(len(own)), key=own.__getitem__)] = np.arange(len(own))
    return (np.minimum(n, (1 << 42) - 1) << _BITS) | ((1 << _BITS) - 1 - order)


def met(own: pa.Table, visitors: pa.Table, inside: bool) -> pa.Table:
    """(word, n_near, form_n, form) for words of ``own`` and ``visitors`` that are near one of ``own``; inside: also own with own."""
    d, q = own.column("word").to_pylist(), visitors.column("word").to_pylist()
    n = np.concatenate([t.column("n").to_numpy() for t in (own, visitors)]).astype(np.int64)
    keys, best = _keys(d + q, n), Best(len(d) + len(q))
    block = Block(d)
    if q:
        for i, j in search(block, Block(q)):
            best.add(i, keys[len(d) + j])
            best.add(len(d) + j, keys[i])
    if inside:
        for i, j in search(block, block):  # both ways round
            best.add(i, keys[j])
    hit = np.flatnonzero(best.near)
    by_key = np.argsort(keys)
    form = by_key[np.searchsorted(keys, best.key[hit], sorter=by_key)]
    whole = d + q
    return pa.table(
        {
            "word": pa.array([whole[x] for x in hit], pa.string()), "n_near": pa.array(best.near[hit]),
            "form_n": pa.array(n[form]), "form": pa.array([whole[x] for x in form], pa.string()),
        }
    )


# --- shards ------------------------------------------------------------------------
def _level(word: Column, letters: str) -> Column:
    return (F.length(word) - F.length(F.translate(word, letters, ""))).cast("int")


def _reached(cut: int) -> list[list[int]]:
    """Changes of the first ``cut`` counts one edit can make that lead to a later shard."""
    unit = np.eye(cut, dtype=int)
    both = [unit[a] - unit[b] for a in range(cut) for b in range(cut) if a != b]
    return [c.tolist() for c in [*unit, *both] if c[np.flatnonzero(c)[0]] > 0]


def _neighbours(df: DataFrame, cut: int) -> DataFrame:
    """The rows of ``df`` (shard, ..) with ``shard`` moved to every later one within the budget."""
    moves = F.array(*[F.array(*map(F.lit, c)) for c in _reached(cut)])
    moved = df.withColumn("_move", F.explode(moves))
    return moved.withColumn("shard", F.zip_with("shard", "_move", lambda a, b: a + b)).drop("_move").where(F.array_min("shard") >= 0)


def _cut(vectors: DataFrame, shard_words: int) -> int:
    """The least number of levels whose shards are small enough, or the most there may be."""
    for cut in CUTS:
        shards = vectors.groupBy(F.slice("levels", 1, cut).alias("shard")).agg(F.sum("words").alias("words"))
        if (shards.agg(F.max("words")).first()[0] or 0) <= shard_words:
            return cut
    return CUTS[-1]


def near_words(table: DataFrame, shard_words: int = SHARD_WORDS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(word, n, n_near, form_n, form): per word how many others are near and the most frequent of them.

    ``table``: distinct words with their counts n.
    """
    levels = F.array(*[_level(F.col("word"), g) for g in LEVELS[: CUTS[-1]]])
    placed = stored(table.select("word", "n", levels.alias("levels")), "spelling")
    vectors = stored(placed.groupBy("levels").agg(F.count(F.lit(1)).alias("words")), "vectors")
    cut = _cut(vectors, shard_words)
    shard = F.slice("levels", 1, cut).alias("shard")
    shards = vectors.groupBy(shard).agg(F.sum("words").alias("words"))
    visits = _neighbours(shards, cut).groupBy("shard").agg(F.sum("words").alias("visitors"))
    sizes = shards.join(visits, "shard", "left").select(
        "shard",
        F.ceil(F.col("words") / shard_words).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil((F.col("words") + F.coalesce("visitors", F.lit(0))) / chunk_words)).cast("int").alias("chunks"),
    )
    sizes = stored(sizes, "shards")

    def of(count: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("word", F.lit(seed)), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    rows = placed.select("word", "n", shard)
    own = rows.join(sizes, "shard").withColumn("block", of("blocks", 1)).withColumn("chunk", each("chunks"))
    foreign = _neighbours(rows, cut).join(sizes, "shard").withColumn("chunk", of("chunks", 2)).withColumn("block", each("blocks"))
    # Words of one shard but of different blocks: the earlier block visits the later one.
    split = rows.join(sizes.where("blocks > 1"), "shard").withColumn("home", of("blocks", 1)).withColumn("chunk", of("chunks", 2))
    split = split.withColumn("block", each("blocks")).where("home < block")
    columns = ["shard", "block", "chunk", "word", "n"]
    meeting = own.select(*columns, F.lit(True).alias("own")).unionByName(
        foreign.select(*columns, F.lit(False).alias("own")).unionByName(split.select(*columns, F.lit(False).alias("own")))
    )

    def meet(group: pa.Table) -> pa.Table:
        mine = group.column("own")
        inside = group.column("chunk")[0].as_py() == 0
        return met(group.filter(mine), group.filter(pa.compute.invert(mine)), inside)

    parts = meeting.groupBy("shard", "block", "chunk").applyInArrow(meet, "word string, n_near long, form_n long, form string")
    whole = parts.select("word", F.lit(None).cast("long").alias("n"), "n_near", "form_n", "form").unionByName(
        placed.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    )
    first = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form")))
    found = whole.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("first"))
    return found.select("word", "n", "n_near", (-F.col("first")["less"]).alias("form_n"), F.col("first")["form"].alias("form"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to the last. Counts at least double on the way, so a few doublings end it."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = now.join(next_, F.col("root") == F.col("at"), "left")
        after = stored(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(
    docs: DataFrame, modulus: int = MODULUS, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO,
    shard_words: int = SHARD_WORDS, chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of ``docs`` (doc_id, text; other columns are ignored).

    Words have ``least_letters`` letters and ``least_count`` occurrences at least. A
    word's form is the most frequent near word (ties: first in code point order) that is
    ``ratio`` times as frequent; root: forms followed to the last. Null and empty texts
    have no words, repeated rows count each, an empty table gives an empty result.
    """
    found = stored(near_words(words(docs, modulus, least_letters, least_count), shard_words, chunk_words), "near-words")
    has = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    named = found.select("word", F.when(has, F.col("form")).alias("form"), "n", "n_near", F.when(has, F.col("form_n")).alias("form_n"))
    roots = _roots(named.where("form is not null"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
