"""Word counts by array operations against counters."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from handoff.llm import word_hashes
from handoff.llm.common import ascii_words
from handoff.llm.source_divergence import row_pairs


def plain(texts, groups, digits=False):
    n, docs = Counter(), Counter()
    for t, g in zip(texts, groups):
        words = ascii_words(t, digits)
        n.update((g, w) for w in words)
        docs.update((g, w) for w in set(words))
    return {k: (n[k], docs[k]) for k in n}


def counted(c):
    rows = list(zip(c.group.tolist(), c.terms().to_pylist(), c.n.tolist(), c.docs.tolist()))
    out = {(g, t.encode()): (n, d) for g, t, n, d in rows}
    assert len(out) == len(rows)
    return out


TEXTS = st.lists(st.tuples(st.text(alphabet="abAé ß.1\n北", max_size=40), st.integers(0, 2)), max_size=12)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 18]), st.booleans())
def test_counts_are_those_of_counters(rows, window, digits):
    texts, groups = [t.encode() for t, _ in rows], [g for _, g in rows]
    old, word_hashes.WINDOW = word_hashes.WINDOW, window
    try:
        assert counted(word_hashes.count_words(texts, groups, digits)) == plain(texts, groups, digits)
    finally:
        word_hashes.WINDOW = old


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.text(alphabet="ab é", max_size=200))
def test_merged_parts_are_the_whole(rows, long):
    texts, groups = [t.encode() for t, _ in rows], [g for _, g in rows]
    parts = [word_hashes.count_words([t], [g]) for t, g in zip(texts, groups)] + [word_hashes.count_long_text(long.encode(), 1)]
    assert counted(word_hashes.merged(parts)) == plain([*texts, long.encode()], [*groups, 1])


def test_a_hash_does_not_depend_on_what_stands_around():
    data = np.frombuffer(b"one two  one", dtype=np.uint8)
    h, check = word_hashes.word_hashes(data, np.array([0, 4, 9]), np.array([3, 7, 12]))
    assert h[0] == h[2] != h[1] and check[0] == check[2] != check[1]
    assert len(set(word_hashes.mixed(h).tolist())) == 2


def test_words_that_share_a_key_are_kept_apart(monkeypatch):
    """With all first hashes equal, the second one still tells the words apart."""
    real = word_hashes.word_hashes
    monkeypatch.setattr(word_hashes, "word_hashes", lambda *a: (np.zeros(len(a[1]), np.uint64), real(*a)[1]))
    texts = [b"a b a", b"b c", b"c a"]
    assert counted(word_hashes.count_words(texts, [0, 1, 0])) == plain(texts, [0, 1, 0])


@pytest.mark.parametrize("bound", [1, 5, 1000])
def test_pairs_of_rows_of_each_run(monkeypatch, bound):
    from handoff.llm import source_divergence

    monkeypatch.setattr(source_divergence, "PAIRS", bound)
    runs = [1, 3, 2, 4, 1]
    starts = np.cumsum([0, *runs[:-1]])
    got = []
    for left, right in row_pairs(np.repeat(starts, runs), np.repeat(runs, runs)):
        got += list(zip(left.tolist(), right.tolist()))
    assert got == [(i, j) for s, n in zip(starts, runs) for i in range(s, s + n) for j in range(s, s + n)]
