"""Shingle sets and SuperMinHash signatures of a batch of texts (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width``-word shingles; fewer words: one; no words: none.

    On bytes, lower() changes A-Z only and split() parts at ASCII white space only.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    total = np.full(n, min(width, len(h)), np.uint64)
    for i in range(min(width, len(h))):
        total = total * np.uint64(_GOLDEN) + h[i : i + n]
    return np.unique(mix(total))


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row of ``m`` values per set; equal values at a place with probability Jaccard.

    Step j deals element e's j-th rank to place p_e[j] of a random permutation of
    its own, with value j + u. After step j no later step can lower a value below
    j + 1, so a set is finished as soon as all its places are below that.
    """
    sig = np.full((len(sets), m), np.inf)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    element = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    place = None  # permutations dealt so far, one row per element still active
    for j in range(m):
        if not len(element):
            break
        x = mix(element + np.uint64(((j + 1) * _GOLDEN) & _MASK))
        k = j + ((x >> np.uint64(40)) * np.uint64(m - j) >> np.uint64(24)).astype(np.int64)
        value = j + (x & np.uint64((1 << 40) - 1)) / float(1 << 40)
        if j == 0:
            at, first = k, k
        else:
            if place is None:
                place = np.tile(np.arange(m, dtype=np.uint16), (len(element), 1))
                rows = np.arange(len(element))
                place[:, 0], place[rows, first] = first, 0
            rows = np.arange(len(element))
            at = place[rows, k].astype(np.int64)
            place[rows, k] = place[:, j]
            place[:, j] = at
        np.minimum.at(sig.reshape(-1), owner * m + at, value)
        active = sig.max(axis=1) >= j + 1
        keep = active[owner]
        if not keep.all():
            element, owner = element[keep], owner[keep]
            if place is None:
                first = first[keep]
            else:
                place = place[keep]
    return sig


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash per band of ``rows`` signature values (the band number is in it)."""
    bits = np.ascontiguousarray(sig).view(np.uint64)
    bands = bits.shape[1] // rows
    total = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (bits.shape[0], 1))
    for i in range(rows):
        total = mix(total * np.uint64(_GOLDEN) + bits[:, i : bands * rows : rows])
    return total.view(np.int64)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of a bounded block of sets.

    Elements of few sets are counted by their own pairs, those of many sets by
    a product of 0/1 matrices, a slice of elements at a time.
    """
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    sizes = np.array([len(s) for s in sets])
    element, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)[np.argsort(inverse, kind="stable")]
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    few = 12
    for c in range(2, few + 1):
        at = first[count == c]
        if len(at):
            who = owner[at[:, None] + np.arange(c)]
            codes = (who[:, :, None] * n + who[:, None, :]).reshape(-1)
            out += np.bincount(codes, minlength=n * n).reshape(n, n)
    many = np.flatnonzero(count > few)
    for a in range(0, len(many), 2048):
        cols = many[a : a + 2048]
        bits = np.zeros((n, len(cols)), np.float32)
        for j, c in enumerate(cols):
            bits[owner[first[c] : first[c] + count[c]], j] = 1
        out += bits @ bits.T
    np.fill_diagonal(out, sizes)
    return out


def spanning_links(sets: list[np.ndarray], label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the labels of a block: enough of them for its components, no more."""
    inter = intersections(sets).astype(np.int64)
    size = np.diag(inter)
    union = size[:, None] + size[None, :] - inter
    linked = (100 * inter >= percent * union) & (label[:, None] != label[None, :])
    parent = {x: x for x in label.tolist()}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
        a, b = root(int(label[i])), root(int(label[j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(i), int(j)))
    return out
