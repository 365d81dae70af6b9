"""Quality rules: base counts per text, and lines that too many documents of a host share.

Lines are normalised (A-Z lower-cased, digits as 0, white space squeezed) and
hashed to 128 bits. A line of more distinct texts of its host than the limit is
boilerplate. Copies of one text count once. What is left of a document without
such lines decides: a depleted document is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_text, stored
from .superminhash import mix

_BLANK = b" \t\n\x0b\x0c\r"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

_COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "line_keys array<binary>, line_words array<bigint>"
)


@dataclass(frozen=True)
class Limits:
    """Limits of the rules."""

    least_words: int = 50
    most_repeated_percent: int = 50
    # A line is boilerplate beyond this number of its host's distinct texts, however many the host has,
    # and, if a share is given, beyond this share of them.
    host_texts: int = 20
    host_share: float = 0.0
    # Less than this percentage of words left: depleted.
    least_left_percent: int = 30


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more in the text, the first one included."""
    if len(words) < 4:
        return 0
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    window = mix((h[:-2] * _GOLDEN + h[1:-1]) * _GOLDEN + h[2:])
    _, inverse, count = np.unique(window, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    if not twice.any():
        return 0
    inside = np.zeros(len(words), bool)
    for i in range(3):
        inside[i : len(words) - 2 + i] |= twice
    return int(inside.sum())


def line_key(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(line.lower().translate(_DIGITS).split()))


def counts(text: str | None) -> tuple:
    """The columns of _COUNTS for one whole text; all 0 for a null or empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen, repeats = set(), 0
    lines: dict[bytes, int] = {}
    for line in raw.split(b"\n"):
        if not line.strip(_BLANK):
            continue
        if line in seen:
            repeats += 1
        seen.add(line)
        key = line_key(line)
        lines[key] = lines.get(key, 0) + len(line.split())
    blanks = sum(text.count(c) for c in _BLANK.decode())
    return (
        len(words), len(text) - blanks, sum(text.count(c) for c in SYMBOLS), repeats, repeated_words(words),
        list(lines), list(lines.values()),
    )


def _work(texts: list[str | None]) -> dict[str, list]:
    names = [c.split()[0] for c in _COUNTS.split(", ")]
    return dict(zip(names, map(list, zip(*map(counts, texts), strict=True)), strict=True))


def _host(source: Column) -> Column:
    """The source; documents without one share a host of their own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _text_key(text: Column) -> Column:
    """Digest of a whole text, taken in the JVM; a null text has that of an empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


@dataclass
class Judged:
    verdicts: DataFrame  # a row per document
    boilerplate: DataFrame  # row, keys: lines to remove, for documents that have some


def judge(docs: DataFrame, limits: Limits = Limits()) -> Judged:
    """Base counts, base_failed, n_left (words outside boilerplate lines) and kept for every row.

    ``docs`` needs doc_id, text and source. Null and empty texts have no words and
    fail. Null ids stay null, a null source is a host of its own, repeated rows are
    judged each and count as one text. An empty table gives an empty result.
    """
    keyed = docs.select("doc_id", "source", "text", _text_key(F.col("text")).alias("text_key"))
    table = per_text(keyed, ["doc_id", "source", "text_key"], _COUNTS, _work)
    table = stored(
        table.withColumn("row", F.monotonically_increasing_id()).withColumn("host", _host(F.col("source"))), "quality"
    )
    lines = table.select("row", "host", "text_key", F.arrays_zip("line_keys", "line_words").alias("zipped")).select(
        "row", "host", "text_key", F.inline("zipped").alias("line", "words")
    )
    shared = (
        lines.select("host", "line", "text_key").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts"))
    )
    over = shared.where(F.col("texts") > limits.host_texts)
    if limits.host_share > 0:
        hosts = table.select("host", "text_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_texts"))
        over = over.join(hosts, "host").where(F.col("texts") > limits.host_share * F.col("host_texts"))
    frequent = stored(over.select("host", "line"), "frequent")
    removed = stored(
        lines.join(frequent, ["host", "line"]).groupBy("row").agg(F.sum("words").alias("gone"), F.collect_list("line").alias("keys")),
        "removed",
    )
    failed = (F.col("n_words") < limits.least_words) | (
        100 * F.col("n_repeat_words") > limits.most_repeated_percent * F.col("n_words")
    )
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    verdicts = (
        table.drop("line_keys", "line_words", "host")
        .join(removed.select("row", "gone"), "row", "left")
        .withColumn("base_failed", failed)
        .withColumn("n_left", left)
        .withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_left") >= limits.least_left_percent * F.col("n_words")))
        .drop("gone")
    )
    return Judged(verdicts, removed.select("row", "keys"))


def without_lines(text: str, keys: set[bytes]) -> str:
    """The text without its lines of these keys."""
    return "\n".join(x for x in text.split("\n") if line_key(x.encode("utf-8", "surrogatepass")) not in keys)


def cleaned(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that are kept, without their boilerplate lines; columns as in ``docs``.

    Verdicts meet documents on id, source and text digest, null-safe, so null ids
    and repeated rows get their own. n_chars follows a changed text, if it is there.
    """
    judged = judge(docs, limits)
    keep = judged.verdicts.where("kept").join(judged.boilerplate, "row", "left")
    keep = keep.select("doc_id", "source", "text_key", "keys").dropDuplicates(["doc_id", "source", "text_key"])
    keep = keep.toDF("k_id", "k_source", "k_text", "k_keys")

    def remove(texts: pa.Array, keys: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), keys.to_pylist(), strict=True)
        return pa.array([t if k is None else without_lines(t or "", set(k)) for t, k in pairs], pa.string())

    # The document travels as one column, so no column of it can clash.
    whole = docs.select(F.struct(*docs.columns).alias("doc"), _text_key(F.col("text")).alias("own"))
    both = whole.join(
        keep,
        F.col("doc.doc_id").eqNullSafe(F.col("k_id"))
        & F.col("doc.source").eqNullSafe(F.col("k_source"))
        & (F.col("own") == F.col("k_text")),
    )
    # Texts without a line to remove reach the helper as null.
    changed = F.col("k_keys").isNotNull()
    shorter = F.arrow_udf(remove, "string")(F.when(changed, F.col("doc.text")), "k_keys")
    named = both.select("doc", changed.alias("changed"), shorter.alias("shorter"))
    doc = F.col("doc").withField("text", F.col("shorter"))
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length("shorter").cast(docs.schema["n_chars"].dataType))
    return named.select(F.when(F.col("changed"), doc).otherwise(F.col("doc")).alias("doc")).select("doc.*")
