"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Learning uses a bounded sample of labelled documents. From one half of it the
lexicon for the other half's features is learned, and the other way round, so
that the trees do not see a lexicon that knows their own labels. Trees are fitted
on three quarters of the sample, the calibration on the rest. Scoring uses the
lexicon of the whole sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, of_text, stored

SAMPLE_ROWS = 16_000
LEXICON_TERMS = 4_000
STEMS = (4, 5)  # characters of the word beginnings that stand for a word's forms
FOLDS, HELD_OUT = 5, 0

# Second-person words of the languages the corpora hold.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie tu te toi ton ta tes "
    "vous votre vos tú ti tuyo tus usted ustedes vosotros".split()
)
# Signs commonly written for letters.
LEET = str.maketrans("013457@$", "oieastas")
NEAR = 5  # words between a lexicon hit and a second-person word

FEATURES = (
    "strong_density", "strong_share", "mild_density", "any_hit", "second_person_near", "second_person_density",
    "capitals", "shouted_words", "exclamation", "punctuation", "symbols", "obfuscated", "digits", "log_words",
)

_EDGE = ".,!?;:\"'()[]{}<>«»„“”…-–—*#%&$|"
_MIXED = re.compile(r"[^\W\d_]+[\d@$*]+[^\W\d_]+|^(?:[^\W\d_][.\-_*]){2,}[^\W\d_]$")
_SHOUT = re.compile(r"\b[^\W\d_a-zß-ÿ]{3,}\b")


def terms(word: str) -> list[str]:
    """What of a word may stand in the lexicon: the plain word and, with a mark, its beginning."""
    plain = word.lower().translate(LEET) if _MIXED.search(word) else word.lower()
    plain = plain.replace(".", "").replace("*", "").replace("_", "")
    if len(plain) < 3 or len(plain) > 40:
        return []
    return [plain, *("^" + plain[:n] for n in STEMS if len(plain) > n)]


def counted(text: str) -> Counter:
    """Distinct words of a text, freed of marks at the edges, with their counts."""
    out: Counter = Counter()
    for raw, n in Counter(text.split()).items():
        if word := raw.strip(_EDGE):
            out[word] += n
    return out


@dataclass
class Lexicon:
    """Terms with their log odds; bounded by LEXICON_TERMS."""

    strong: frozenset[str]
    mild: frozenset[str]

    @staticmethod
    def learn(rows: list[tuple[str, int, int]], toxic: int, clean: int, size: int) -> Lexicon:
        """rows: (term, toxic documents, clean documents) of the sample."""
        strong, mild = [], []
        for term, a, b in rows:
            odds = math.log((a + 0.2) / (toxic + 0.4)) - math.log((b + 0.2) / (clean + 0.4))
            if a >= 3 and odds > 3.5:
                strong.append((a * odds, term))
            elif a >= 3 and odds > 1.5 or a == 2 and b == 0:
                mild.append((a * odds, term))
        best = lambda found: frozenset(t for _, t in sorted(found, reverse=True)[:size])
        return Lexicon(best(strong), best(mild))


def _unicode_kinds() -> np.ndarray:
    """Kind of each code point below 65536: 1 upper, 2 lower, 3 digit, 4 '!', 5 sentence mark, 6 symbol, 0 other."""
    kinds = np.zeros(65536, np.uint8)
    for cp in range(65536):
        ch = chr(cp)
        if ch.isupper():
            kinds[cp] = 1
        elif ch.isalpha():
            kinds[cp] = 2
        elif ch.isdigit():
            kinds[cp] = 3
        elif ch == "!":
            kinds[cp] = 4
        elif ch in ".,;:?'\"-()":
            kinds[cp] = 5
        elif 32 < cp < 127:
            kinds[cp] = 6
    return kinds


_KINDS: list[np.ndarray] = []


def features(text: str | None, lexicon: Lexicon, memory: dict[str, int]) -> list[float]:
    """The dense features of one whole text; all 0 for a null or empty one.

    memory: word -> bits (1 strong, 2 mild, 4 second person, 8 obfuscated), bounded by the caller.
    """
    if not text:
        return [0.0] * len(FEATURES)
    if not _KINDS:
        _KINDS.append(_unicode_kinds())
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = np.bincount(_KINDS[0][np.minimum(code, 65535)], minlength=7)
    letters = max(1, int(kind[1] + kind[2]))
    totals = [0, 0, 0, 0]
    hits = []
    words = 0
    distinct = counted(text)
    for word, n in distinct.items():
        words += n
        bits = memory.get(word)
        if bits is None:
            own = terms(word)
            bits = (
                any(t in lexicon.strong for t in own)
                | any(t in lexicon.mild for t in own) << 1
                | (word.lower() in SECOND_PERSON) << 2
                | bool(_MIXED.search(word)) << 3
            )
            memory[word] = bits
        if bits:
            for i in range(4):
                if bits >> i & 1:
                    totals[i] += n
            if bits & 1:
                hits.append(word)
    words = max(1, words)
    near = 0
    if hits:
        wanted = set(hits)
        sequence = [w.strip(_EDGE) for w in text.split()]
        second = np.array([i for i, w in enumerate(sequence) if w.lower() in SECOND_PERSON])
        at = np.array([i for i, w in enumerate(sequence) if w in wanted])
        if len(second) and len(at):
            next_one = np.searchsorted(second, at)
            after = second[np.minimum(next_one, len(second) - 1)]
            before = second[np.maximum(next_one - 1, 0)]
            near = int((np.minimum(abs(after - at), abs(at - before)) <= NEAR).sum())
    chars = max(1, len(code))
    return [
        100.0 * totals[0] / words, len(hits) / len(distinct) if distinct else 0.0, 100.0 * totals[1] / words,
        float(totals[0] > 0), near / max(1, totals[0]), 100.0 * totals[2] / words,
        kind[1] / letters, (len(_SHOUT.findall(text)) if kind[1] > 0.2 * letters else 0) / words,
        kind[4] / chars, kind[5] / chars, kind[6] / chars, 100.0 * totals[3] / words, kind[3] / chars,
        math.log1p(words),
    ]


def with_features(docs: DataFrame, carried: list[str], lexicon: Lexicon) -> DataFrame:
    """The carried columns and ``features``; of a row only its text goes to Python."""
    memory: dict[str, int] = {}

    def work(texts: list[str | None]) -> list[list[float]]:
        if len(memory) > 300_000:
            memory.clear()
        return [features(t, lexicon, memory) for t in texts]

    return docs.select(*carried, of_text("array<double>", work)("text").alias("features"))


def _term_counts(sample: DataFrame) -> DataFrame:
    """(half, term, toxic, clean): documents of the sample a term occurs in."""

    def count(batches):
        import pyarrow as pa

        seen: Counter = Counter()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("half", "label", "text"))
            for half, label, text in zip(*columns, strict=True):
                own = {t for w in counted(text or "") for t in terms(w)}
                seen.update((half, t, label) for t in own)
        half, term, label = zip(*seen, strict=True) if seen else ((), (), ())
        n = list(seen.values())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(half, pa.int32()), pa.array(term, pa.string()),
                pa.array([c * (x == 1) for c, x in zip(n, label, strict=True)], pa.int64()),
                pa.array([c * (x == 0) for c, x in zip(n, label, strict=True)], pa.int64()),
            ],
            names=["half", "term", "toxic", "clean"],
        )

    rows = sample.select("half", "label", "text").mapInArrow(count, "half int, term string, toxic long, clean long")
    return rows.groupBy("half", "term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class Model:
    """What has been learned; constant: the score of all if one label only was seen."""

    constant: float
    lexicon: Lexicon | None = None
    trees: object = None
    levels: object = None


def _sample(docs: DataFrame, labels: DataFrame, rows: int, seed: int) -> DataFrame:
    """The labelled documents that come first in a seeded order of ids: at most ``rows``."""
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    learnable = known.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    # A bounded top list: each task keeps ``rows`` at most.
    first = learnable.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(first, "doc_id").dropDuplicates(["doc_id"])
    part = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(8)).cast("int")
    return stored(texts.withColumn("half", part % 2).withColumn("part", part), "toxic-sample")


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> Model:
    """Fit lexicon, trees and calibration on at most ``sample_rows`` labelled documents.

    Rows with crc32(doc_id) mod 5 = 0 are never learned from. Several labels of one
    document: toxic if any is. One label only, or none at all: a constant score.
    """
    sample = _sample(docs, labels, sample_rows, seed)
    sizes = {(r.half, r.label): r.n for r in sample.groupBy("half", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = ([sizes.get((h, x), 0) for h in (0, 1)] for x in (1, 0))
    total = sum(toxic) + sum(clean)
    if min(toxic) < 1 or min(clean) < 1:
        return Model(sum(toxic) / total if total else 0.0)
    counts = stored(_term_counts(sample), "toxic-terms")
    found = counts.groupBy("term").agg(
        *(F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{h}") for h in (0, 1) for c in ("toxic", "clean"))
    )
    # Only terms of two toxic documents or more that are far likelier in them: few, and cut at a bound.
    odds = (F.col("toxic0") + F.col("toxic1") + 0.2) / (F.col("clean0") + F.col("clean1") + 0.2)
    rows = (
        found.where("toxic0 + toxic1 >= 2").where(odds > 2.0 * sum(toxic) / sum(clean))
        .orderBy(F.desc((F.col("toxic0") + F.col("toxic1")) * F.log(odds)), "term").limit(4 * LEXICON_TERMS).collect()
    )
    by_half = [
        Lexicon.learn([(r.term, r[f"toxic{h}"], r[f"clean{h}"]) for r in rows], toxic[h], clean[h], LEXICON_TERMS)
        for h in (0, 1)
    ]
    lexicon = Lexicon.learn(
        [(r.term, r.toxic0 + r.toxic1, r.clean0 + r.clean1) for r in rows], sum(toxic), sum(clean), LEXICON_TERMS
    )
    halves = [
        with_features(sample.where(F.col("half") == h), ["doc_id", "label", "part"], by_half[1 - h]) for h in (0, 1)
    ]
    table = stored(halves[0].unionByName(halves[1]), "toxic-features")
    vectors = table.withColumn("vector", array_to_vector("features")).withColumn("label", F.col("label").cast("double"))
    # Where a part lacks a label (tiny samples), trees and calibration both use the whole sample.
    whole = {(r.fitted, r.label) for r in vectors.select((F.col("part") < 6).alias("fitted"), "label").distinct().collect()}
    fitted, rest = (vectors.where("part < 6"), vectors.where("part >= 6")) if len(whole) == 4 else (vectors, vectors)
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=12, maxDepth=3, stepSize=0.3, seed=seed, checkpointInterval=-1
    ).fit(fitted)
    levels = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="level").fit(
        trees.transform(rest).select("label", _margin())
    )
    return Model(sum(toxic) / total, lexicon, trees, levels)


def _margin() -> Column:
    return vector_to_array(F.col("probability"))[1].alias("margin")


def score(docs: DataFrame, model: Model, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.5) for every row of ``docs`` (doc_id, text).

    Columns named in ``carried`` come along. Null and empty texts have the features of a text without words. A null doc_id
    has a null held_out. Repeated rows are scored each; other columns are ignored.
    """
    held = (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    if model.trees is None:
        return docs.select(
            "doc_id", *carried, held, F.lit(model.constant).alias("score"), F.lit(int(model.constant >= 0.5)).alias("predicted")
        )
    made = with_features(docs, ["doc_id", *carried], model.lexicon).withColumn("vector", array_to_vector("features"))
    out = model.levels.transform(model.trees.transform(made).select("doc_id", *carried, held, _margin()))
    # The level is a step function; the margin itself parts what a step ties.
    out = out.select("doc_id", *carried, "held_out", (0.999 * F.col("level") + 0.001 * F.col("margin")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
