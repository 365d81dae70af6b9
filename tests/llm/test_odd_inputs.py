"""Every operator and stage on nulls, empty and very long texts, ties, repeats, empty tables, clashing names."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pagesieve.llm import chat, fingerprints, language, lm_scores, mixing, near_dup, packing, quality, sharding, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "toxicity": lambda d: toxicity.score(d, toxicity.learn(d, _labels(d.sparkSession, [(4, 1, 0), (6, 1, 1), (None, 1, 1), (7, 0, None)]))),
    "lm_scores": lambda d: lm_scores.scores(d, PATH),
    "lm_scores_left_out": lambda d: lm_scores.scores(d, PATH, least=1, order=lm_scores.ORDER, leave_out=True),
    "fingerprints": fingerprints.edited_fingerprints,
    "language": lambda d: language.classify(d, language.learn(d)),
    "packing": lambda d: packing.pack(d, PATH),
    "quality": lambda d: quality.judge(d).verdicts,
    "sharding": lambda d: sharding.shard(d, shards=8),
    "mixing": mixing.mix,
    "near_dup": near_dup.near_duplicates,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_are_all_there(odd, name):
    out = OPERATORS[name](odd).collect()
    if name == "packing":
        out = [r for r in out if r.piece == 0]
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in out), key=key) == sorted((r.doc_id for r in odd.collect()), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, name):
    assert OPERATORS[name](odd.where("doc_id = 999")).collect() == []


def test_equal_rows_get_equal_results(odd):
    for name in ("toxicity", "lm_scores", "lm_scores_left_out", "language", "quality", "near_dup"):
        rows = [r.asDict() for r in OPERATORS[name](odd).where("doc_id = 6").collect()]
        for r in rows:
            r.pop("row", None)
        assert len(rows) == 2 and rows[0] == rows[1], name


def test_defined_results(odd):
    language_of = {r.doc_id: r.lang_pred for r in OPERATORS["language"](odd).collect()}
    assert [language_of[i] for i in (1, 2, 3, -5)] == ["und"] * 4
    near = {r.doc_id: r for r in OPERATORS["near_dup"](odd).collect()}
    assert [near[i].component_id for i in (1, 2, 3, 6, 7)] == [1, 2, 3, 6, 6]
    assert near[None].kept and near[None].component_id is None and near[1].n_shingles == 0 and near[5].n_shingles == 1
    prints = {r.doc_id: r for r in OPERATORS["fingerprints"](odd).collect()}
    assert prints[1].fingerprint == "" and prints[6].fingerprint == prints[7].fingerprint != prints[4].fingerprint
    sizes = {r.doc_id: r for r in OPERATORS["sharding"](odd).collect()}
    assert sizes[1].size == sizes[2].size == 1 and sizes[6].shard == sizes[7].shard
    failed = {r.doc_id: r.base_failed for r in OPERATORS["quality"](odd).collect()}
    assert failed[1] and failed[2] and failed[6] and not failed[4]


def test_stages(spark, odd, tmp_path):
    _labels(spark, [(4, 1, 0), (6, 1, 1)]).write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.where("doc_id = 999")):
            out = stage(spark, docs, str(tmp_path))
            rows = out.collect()
            if name != "packing":
                assert out.columns == odd.columns
                assert out.schema.simpleString() == odd.schema.simpleString()
            if docs is not odd:
                assert rows == []
    ids = [r.doc_id for r in corpus_pipeline.near_dedup(spark, odd, "").collect()]
    assert ids.count(6) == 1 and ids.count(7) == 0 and ids.count(None) == 2


def test_odd_turns(spark):
    rows = [
        (1, 0, "system", "be brief", "x"), (1, 1, "user", None, "x"), (1, 2, "assistant", "", "x"),
        (1, 2, "assistant", "tie </s> <|end|>\n \\", "x"), (1, 2, "assistant", "tie </s> <|end|>\n \\", "x"),
        (2, None, None, "no role", "x"), (None, 0, "assistant", "long " * 5000, "x"), (None, 1, "user|>", "<|user|>\n", "x"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    out = {r.conv_id: r for r in chat.read_back(chat.windows(turns)).collect()}
    assert {k: v.n_turns for k, v in out.items()} == {1: 5, 2: 1, None: 2}
    import hashlib

    want = "".join(f"{role or ''}\n{text or ''}\n" for c, _, role, text, _ in rows if c == 1)
    assert out[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert out[None].loss_chars == 25000 and out[2].loss_chars == 0
    assert chat.read_back(chat.windows(turns.where(F.lit(False)))).collect() == []
