"""Spelling variants against a plain program over all words."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagesieve.llm import spelling
from pagesieve.llm.queries import QUERIES


def plain_words(docs):
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if crc % 97 == 0:
                run = run[: crc % len(run)] + run[crc % len(run) + 1 :]
            if len(run) >= 5:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    near = defaultdict(set)
    masked = defaultdict(list)
    for w in counts:
        for i in range(len(w)):
            masked[w[:i], w[i + 1 :]].append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in masked.values():
        for a in group:
            near[a].update(x for x in group if x != a)
    best = {w: min(own, key=lambda x: (-counts[x], x)) for w, own in near.items() if own}
    form = {w: f for w, f in best.items() if counts[f] >= 2 * counts[w]}
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near.get(w, ())), counts[form[w]] if w in form else None)
    return out


def as_tuples(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query(spark, sf, docs):
    want = plain_variants(plain_words((r.doc_id, r.text) for r in docs.collect()))
    got = as_tuples(QUERIES["op13_spelling_variants"](spark, sf))
    assert got == want and sum(v[0] is not None for v in got.values()) > 20


@pytest.mark.parametrize("sizes", [(40, 100), (300, 70), (5, 3)])
def test_blocks_and_chunks_lose_no_pair(spark, docs, sizes):
    part = docs.where("doc_id % 4 = 0").cache()
    want = plain_variants(plain_words((r.doc_id, r.text) for r in part.collect()))
    assert as_tuples(spelling.variants(part, shard_words=sizes[0], chunk_words=sizes[1])) == want


def test_odd_rows(spark, odd):
    want = plain_variants(plain_words((r.doc_id, r.text) for r in odd.collect()))
    assert as_tuples(spelling.variants(odd)) == want
    assert spelling.variants(odd.where("doc_id = 999")).collect() == []


def test_very_long_words(spark):
    x, y, z = "x" * 300_000, "x" * 299_999 + "y", "x" * 299_999
    a, b = "a" * 130 + "b", "a" * 131
    rows = list(enumerate([x] * 3 + [y] * 9 + [z] * 4 + [a] * 3 + [b] * 8 + ["zoëah Zoéah zoéah"] * 6))
    got = as_tuples(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), modulus=10**10))
    assert got == {
        x: (y, y, 3, 2, 9), y: (None, y, 9, 2, None), z: (y, y, 4, 2, 9), a: (b, b, 3, 1, 8), b: (None, b, 8, 1, None),
        "zoëah": ("zoéah", "zoéah", 6, 1, 12), "zoéah": (None, "zoéah", 12, 1, None),
    }


words = st.text("abeé×n", min_size=1, max_size=7)


@settings(max_examples=200, deadline=None)
@given(st.sets(words, min_size=1, max_size=60), st.data())
def test_search_finds_all_near_pairs(own, data):
    own = sorted(own)
    cut = data.draw(st.integers(0, len(own)))
    d, q = own[:cut], own[cut:]
    if d and q:
        got = {(d[a], q[b]) for i, j in spelling.search(spelling.Block(d), spelling.Block(q)) for a, b in zip(i, j, strict=True)}
        assert got == {(a, b) for a in d for b in q if one_edit(a, b)}
    for a in own[:8]:
        for b in own:
            assert spelling.near(a, b) == one_edit(a, b)
