"""Counts of hashed words, by array operations instead of word by word.

The bytes of many texts are hashed at once: with S the running sum of byte times m^position modulo 2^64, the
hash of a word is (S at its end - S at its start) * m^-start, whatever stands around it. Two multipliers
give 128 bits, by which equal words are recognised within a task; the digest that leaves a task is the
first 64, mixed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from handoff.llm.common import word_table

#: Odd multipliers of the two hashes, and the mixer's.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Bytes hashed at a time, and bytes of texts counted at a time.
WINDOW, BATCH_BYTES = 1 << 18, 4 << 20
BLANK = 0x20
#: Words whose bytes are copied at a time.
PICKED = 1 << 16


class _Powers:
    """m^i and m^-i modulo 2^64 for i = 0, 1, ..."""

    def __init__(self, multiplier: int):
        self._m = (multiplier, pow(multiplier, -1, 1 << 64))
        self._held = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._held[0]) < n:
            for k in (0, 1):
                steps = np.full(n, self._m[k], dtype=np.uint64)
                steps[0] = 1
                self._held[k] = np.cumprod(steps)  # wraps modulo 2^64
        return self._held[0][:n], self._held[1][:n]


_powers = tuple(_Powers(m) for m in MULTIPLIERS)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the words data[start:end]; words ascend and do not overlap."""
    out = np.empty((2, len(starts)), dtype=np.uint64)
    i = 0
    while i < len(starts):
        begin = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, begin + WINDOW, side="right")))
        n = int(ends[j - 1] - begin)
        piece = data[begin: begin + n].astype(np.uint64)
        s, e = starts[i:j] - begin, ends[i:j] - begin
        for k, powers in enumerate(_powers):
            up, down = powers(n + 1)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(piece * up[:n], out=sums[1:])
            out[k, i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return out[0], out[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes, so that every bit of a digest depends on the whole word."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


@dataclass
class Counts:
    """One row per (group, word): occurrences, documents and the word's bytes (``ends`` cuts ``text``)."""

    group: np.ndarray
    hash: np.ndarray
    check: np.ndarray
    n: np.ndarray
    docs: np.ndarray
    text: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.group)

    def terms(self) -> pa.Array:
        offsets = np.concatenate([[0], self.ends]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(self.ends), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.text)))


def _picked(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words end to end, and where each ends."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for i in range(0, len(ends), PICKED):  # the places are eight times as large as the bytes
        part = slice(i, i + PICKED)
        lo, hi = int(ends[i] - lengths[i]), int(ends[part][-1])
        at = np.repeat(starts[part] - (ends - lengths)[part], lengths[part])
        at += np.arange(lo, hi)
        out[lo:hi] = text[at]
    return out, ends


def _sorted_runs(group: np.ndarray, h: np.ndarray, check: np.ndarray, then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal (group, word) together, ``then`` ascending within, and the start of each run."""
    key = h ^ ((group.astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIERS[1]))
    order = np.argsort(key, kind="stable")
    same = [key[order], group[order], check[order]]
    new = [np.concatenate([[True], a[1:] != a[:-1]]) for a in same]
    if ((new[1] | new[2]) & ~new[0]).any():  # two words share a key: sort by all of it
        order = np.lexsort((then, check, h, group))
        new = [np.concatenate([[True], a[1:] != a[:-1]]) for a in (h[order], group[order], check[order])]
    return order, np.flatnonzero(new[0] | new[1] | new[2])


def count_words(texts: Sequence[bytes], groups: Sequence[int], digits: bool = False) -> Counts:
    """Words of the texts by group; a text longer than ``BATCH_BYTES`` has to come alone."""
    raw = b" ".join(texts).translate(word_table(digits)) + b" "
    data = np.frombuffer(raw, dtype=np.uint8)
    word = np.zeros(len(data) + 1, dtype=bool)
    np.not_equal(data, BLANK, out=word[1:])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[0::2], edge[1::2]
    h, check = word_hashes(data, starts, ends)
    doc_ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, doc_ends, side="left")  # words before the end of each text
    in_doc = np.diff(upto, prepend=0)
    doc, group = np.repeat(np.arange(len(texts), dtype=np.int32), in_doc), np.repeat(np.asarray(groups, dtype=np.int32), in_doc)
    order, first = _sorted_runs(group, h, check, doc) if len(starts) else (np.empty(0, np.int64), np.empty(0, np.int64))
    here = doc[order]
    new_doc = np.ones(len(order), dtype=np.int64)
    new_doc[1:] = here[1:] != here[:-1]
    new_doc[first] = 1
    rep = order[first]
    text, word_ends = _picked(data, starts[rep], (ends - starts)[rep])
    n = np.diff(np.append(first, len(order)))
    docs = np.add.reduceat(new_doc, first) if len(first) else np.empty(0, np.int64)
    return Counts(group[rep], h[rep], check[rep], n, docs, text, word_ends)


def count_long_text(text: bytes, group: int, digits: bool = False) -> Counts:
    """Words of one long text, whose distinct words (not all of them) have to fit in memory."""
    held = Counter(text.translate(word_table(digits)).split())
    one = count_words([b" ".join(held)], [group], digits)
    order = {w: i for i, w in enumerate(one.terms().cast(pa.large_binary()).to_pylist())}
    n = np.zeros(len(one), dtype=np.int64)
    for w, c in held.items():
        n[order[w]] = c
    return Counts(one.group, one.hash, one.check, n, one.docs, one.text, one.ends)


def merged(parts: Sequence[Counts]) -> Counts:
    """The counts of several parts (of different documents) as one."""
    if len(parts) == 1:
        return parts[0]
    group, h, check, n, docs, text = (np.concatenate([getattr(p, a) for p in parts]) for a in ("group", "hash", "check", "n", "docs", "text"))
    shift = np.cumsum([0, *(len(p.text) for p in parts[:-1])])
    ends = np.concatenate([p.ends + s for p, s in zip(parts, shift)])
    starts = np.concatenate([np.concatenate([[0], p.ends[:-1]])[: len(p)] + s for p, s in zip(parts, shift)]).astype(np.int64)
    if not len(group):
        return parts[0]
    order, first = _sorted_runs(group, h, check, np.arange(len(group)))
    rep = order[first]
    words, word_ends = _picked(text, starts[rep], (ends - starts)[rep])
    return Counts(group[rep], h[rep], check[rep], np.add.reduceat(n[order], first), np.add.reduceat(docs[order], first), words, word_ends)
