"""Token ids of whole texts, with the ids of words remembered (inside tasks).

The tokenizer lower-cases, drops white space and never lets a token cross it, so a
text's ids are the ids of its white-space-free runs, one after another, whatever
the case of their ASCII letters. A run that is an ASCII word with sentence marks
behind it has the ids of the word, then those of the marks. A word of Latin letters
alone is one piece to the tokenizer, so its model is asked directly, without offsets.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

_MARKS = b".,!?;:"
_SPECIAL = b"<|"
_LATIN = "a-zÀ-ÖØ-öø-ÿ"
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


class TokenIds:
    """Encoder of texts to little-endian unsigned 32-bit ids.

    Some ``limit`` runs are remembered, about 200 bytes each, in two generations: when the
    young one is full it becomes the old one, and what is still used moves on to the new.
    """

    long_run = 64  # longer runs are not remembered
    at_once = 4_000_000  # bytes of text held as runs

    def __init__(self, path: str, limit: int = 800_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.limit = limit
        # How the model sees each letter, asked of the tokenizer's own steps.
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str
        letters = re.findall(f"[{_LATIN}]", "".join(map(chr, range(256))))
        self.shown = {ord(c): pieces(self.tokenizer.normalizer.normalize_str(c))[0][0] for c in letters}
        self.latin = re.compile(f"[{_LATIN}]+").fullmatch
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_latin(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word.translate(self.shown))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word: a thousand at once as one text, parted by the offsets."""
        out = []
        slices = [[w.decode("utf-8") for w in words[i : i + 1000]] for i in range(0, len(words), 1000)]
        encoded = self.tokenizer.encode_batch([" ".join(s) for s in slices], add_special_tokens=False)
        for s, e in zip(slices, encoded, strict=True):
            ids = np.array(e.ids, "<u4").tobytes()
            at = np.array(e.offsets, np.int64).reshape(-1, 2)[:, 0]
            starts = np.cumsum([0, *(len(w) + 1 for w in s[:-1])])
            cut = (np.searchsorted(at, starts) * 4).tolist() + [len(ids)]
            out += [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        return out

    def _recall(self, missing: set[bytes]) -> set[bytes]:
        """Move what the old generation knows to the young one; the rest is returned."""
        old = self.old  # far larger than ``missing``: it is asked, never gone through
        back = [r for r in missing if r in old]
        self.young.update([(r, old[r]) for r in back])
        return missing.difference(back)

    def _learn(self, new: set[bytes]) -> None:
        known = self.young
        stripped = [(r, r.rstrip(_MARKS)) for r in new]
        marked = [(r, b) for r, b in stripped if len(r) != len(b) and b and b[-1] in _ALNUM]
        wanted = new.difference([r for r, _ in marked])
        wanted.update([b for _, b in marked], [r[len(b) :] for r, b in marked])
        other = []
        for word in self._recall(wanted.difference(known)):
            text = word.decode("utf-8")
            if self.latin(text):
                known[word] = self._encode_latin(text)
            else:
                other.append(word)
        known.update(zip(other, self._encode_many(other), strict=True))
        known.update([(r, known[b] + known[r[len(b) :]]) for r, b in marked])

    def _remember(self, seen: set[bytes]) -> None:
        """Afterwards the young generation knows all of ``seen``."""
        missing = seen.difference(self.young)
        if len(self.young) + 2 * len(missing) > self.limit // 2:
            self.young, self.old, missing = {}, self.young, seen
        if new := self._recall(missing):
            self._learn(new)

    def _ids_of(self, run: bytes) -> bytes:
        known = self.young.get(run)
        return known if known is not None else self.direct(run.decode("utf-8"))  # a long run

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        special = [_SPECIAL in t for t in texts]
        plain = pa.array([b"" if s else t.lower() for t, s in zip(texts, special, strict=True)], pa.string())
        # Arrow parts the runs and sets their ids one behind another; Python sees each distinct run once.
        parts = pc.ascii_split_whitespace(plain)
        runs = parts.flatten().dictionary_encode()
        distinct = runs.dictionary.cast(pa.binary()).to_pylist()
        self._remember({r for r in distinct if 0 < len(r) <= self.long_run})
        ids = pa.array([self._ids_of(r) if r else b"" for r in distinct], pa.binary()).take(runs.indices)
        starts = np.concatenate(([0], np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False), dtype=np.int64)))
        ends = starts[parts.offsets.to_numpy()].tolist()
        whole = memoryview(ids.buffers()[2] or b"")
        return [
            self.direct(t.decode("utf-8")) if s else bytes(whole[x:y])
            for t, s, x, y in zip(texts, special, ends, ends[1:], strict=False)
        ]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as bytes; null and empty texts have none."""
        out, held, size = [], [], 0
        for text in texts:
            raw = text.encode("utf-8") if text else b""
            held.append(raw)
            size += len(raw)
            if size > self.at_once:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)


_KEPT: dict[str, TokenIds] = {}


def encoder(path: str) -> TokenIds:
    """The worker's encoder: a reused worker keeps what it has learned."""
    if path not in _KEPT:
        _KEPT[path] = TokenIds(path)
    return _KEPT[path]
