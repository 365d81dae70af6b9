"""Language by nearest centroid: normalised TF-IDF vectors of hashed character n-grams.

Each language is several clusters (spherical k-means over a bounded sample of its
labelled documents). A text gets the language of the centroid with the greatest
cosine; a text farther from it than 99 % of the centroid's own members is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, per_text, stored

DIMENSIONS = 4096
SAMPLE_PER_LANGUAGE, CLUSTERS = 400, 4
FOLDS, HELD_OUT = 3, 1
UNDETERMINED = "und"
_CHUNK = 1 << 20  # code points looked at together

_LETTER: list[np.ndarray] = []


def _letters(code: np.ndarray) -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(65536)]))
    out = _LETTER[0][np.minimum(code, 65535)]
    for c in np.unique(code[code > 65535]):
        out[code == c] = chr(int(c)).isalpha()
    return out


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams of letters and word borders; None without a letter."""
    total = None
    text = (text or "").lower()
    for a in range(0, len(text), _CHUNK):
        code = np.frombuffer(text[a : a + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters(code)
        if not letter.any():
            continue
        code = np.where(letter, code, 0)
        code = np.concatenate([[0], code[letter | np.concatenate([[True], letter[:-1]])], [0]]).astype(np.uint32)
        one = code * np.uint32(0x9E3779B1)
        two = one[:-1] + code[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] + code[2:] * np.uint32(0xC2B2AE35)
        grams = np.concatenate([one[code > 0], two + np.uint32(1), three + np.uint32(2)])
        grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        own = np.bincount(grams >> np.uint32(20), minlength=DIMENSIONS)
        total = own if total is None else total + own
    return total


def _rows(counts: list[np.ndarray | None]) -> np.ndarray:
    return np.array([np.zeros(DIMENSIONS) if c is None else np.log1p(c) for c in counts], np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def spherical_clusters(rows: np.ndarray, clusters: int, turns: int = 12) -> np.ndarray:
    """Unit centroids of unit rows; started from rows at even ranks of likeness to the mean."""
    k = min(clusters, len(rows))
    start = np.argsort(rows @ rows.mean(axis=0), kind="stable")[((np.arange(k) + 0.5) * len(rows) / k).astype(int)]
    centres = rows[start]
    for _ in range(turns):
        own = (rows @ centres.T).argmax(axis=1)
        centres = _unit(np.array([rows[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))]))
    return centres


@dataclass
class Centroids:
    languages: list[str]
    idf: np.ndarray
    vectors: np.ndarray  # one unit row per centroid
    least: np.ndarray  # cosine below which a text is rejected


def learn(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, clusters: int = CLUSTERS, seed: int = 11) -> Centroids | None:
    """Centroids from the first ``per_language`` documents of each language in a seeded order of ids.

    Only rows with a letter, a language and crc32(doc_id) mod 3 <> 1 are learned
    from. What reaches the driver is ``clusters`` vectors per language. No such row: None.
    """
    usable = docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).where("lang is not null and text rlike '\\\\p{L}'")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
    ids = usable.select("doc_id", "lang").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language)
    texts = docs.select("doc_id", "text").join(ids.select("doc_id", "lang").distinct(), "doc_id")
    sample = stored(
        per_text(texts, ["lang"], "vector array<double>", lambda t: {"vector": [r for r in _rows([ngram_counts(x) for x in t])]})
        .where("exists(vector, x -> x > 0)"),
        "language-sample",
    )

    def seen(batches):
        for batch in batches:
            rows = np.array([np.asarray(v) for v in batch.column("vector").to_numpy(zero_copy_only=False)])
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(DIMENSIONS)), pa.array((rows > 0).sum(axis=0))], names=["dim", "n"]
                )

    total = sample.count()
    if not total:
        return None
    found = sample.select("vector").mapInArrow(seen, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n"))
    df = np.zeros(DIMENSIONS)
    for row in found.collect():
        df[row.dim] = row.n
    idf = (np.log((1 + total) / (1 + df)) + 0.1).astype(np.float32)

    def cluster(group: pa.Table) -> pa.Table:
        rows = _unit(np.array([np.asarray(v) for v in group.column("vector").to_numpy()], np.float32) * idf)
        centres = spherical_clusters(rows, clusters)
        cosines = rows @ centres.T
        own = cosines.argmax(axis=1)
        least = [float(np.quantile(cosines[own == k, k], 0.01)) if (own == k).any() else 0.0 for k in range(len(centres))]
        return pa.table(
            {"lang": [group.column("lang")[0].as_py()] * len(centres), "centre": [c.astype(float) for c in centres], "least": least}
        )

    rows = sample.groupBy("lang").applyInArrow(cluster, "lang string, centre array<double>, least double").collect()
    rows.sort(key=lambda r: (r.lang, r.centre))
    return Centroids(
        [r.lang for r in rows], idf, np.array([r.centre for r in rows], np.float32), np.array([r.least for r in rows])
    )


def classify(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine, 0 to 1), rejected for every row (doc_id, text).

    Null texts, texts without a letter and an empty model give ``und`` with score
    0, rejected. A text that is rejected keeps the nearest language and says so in
    ``rejected``. Long texts are read whole, in chunks. Repeated rows are
    classified each; other columns are ignored.
    """

    def work(texts: list[str | None]) -> dict[str, list]:
        counts = [ngram_counts(t) for t in texts]
        none = [c is None or model is None for c in counts]
        if model is None:
            names, best, least = [""] * len(texts), np.zeros(len(texts)), np.ones(len(texts))
        else:
            cosines = _unit(_rows(counts) * model.idf) @ model.vectors.T
            at = cosines.argmax(axis=1)
            names, best, least = [model.languages[k] for k in at], cosines.max(axis=1), model.least[at]
        best = np.where(none, 0.0, np.clip(best.astype(float), 0, 1))
        return {
            "lang_pred": [UNDETERMINED if n else x for n, x in zip(none, names, strict=True)],
            "score": best,
            "rejected": np.array(none) | (best < least),
        }

    held = (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    out = per_text(docs, ["doc_id"], "lang_pred string, score double, rejected boolean", work)
    return out.select("doc_id", held, "lang_pred", "score", "rejected")
