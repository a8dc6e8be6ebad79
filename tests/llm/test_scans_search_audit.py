"""License templates, lexical search and source divergence against plain code."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from handoff.llm import lexical_search, license_templates, source_divergence
from handoff.llm.common import ascii_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ANY_CASE = ["", None, "   ", "x", "Ünï Straße 北京 ÀB", "a" * 5000, "a\x00b\x7fc`d", "word " * 30_000]


def docs(spark, rows, extra=False):
    made = [(i, *r) if len(r) == 3 else (i, r[0], "en", "s") for i, r in enumerate(rows)]
    out = spark.createDataFrame([(i, t, la, so, len(t or "")) for i, t, la, so in made], DOCS)
    if extra:
        for name in ("license", "digest", "part", "term", "n", "rank", "score", "no", "a.b"):
            out = out.selectExpr("*", f"'x' AS `{name}`")
    return out


# ---------------------------------------------------------------- words
@given(st.text(max_size=60))
def test_words_are_the_contracts_patterns(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    assert [w.decode() for w in ascii_words(text.encode("utf-8", "ignore"))] == re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower.encode("utf-8", "ignore").decode())
    assert [w.decode() for w in ascii_words(text.encode("utf-8", "ignore"), digits=False)] == re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower.encode("utf-8", "ignore").decode())


# ---------------------------------------------------------------- op11
MARKUP = ["a b", "a [[b]] c", "a {{x 0-2}} b", "a [[b [[c]] {{y 1-2}} d]] e", "[[a]] b {{z 2-3}} a", "a a {{q 0-3}} a [[b]]"]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(MARKUP), st.lists(st.sampled_from("abcde"), max_size=9))
def test_automaton_accepts_what_the_regular_expression_accepts(template, words):
    automaton = license_templates.Automaton("t", template)
    pattern = re.compile(license_templates.template_regex(template))
    tokens = [w.encode() for w in words]
    for at in range(len(words)):
        ends = [e for e in range(at + 1, len(words) + 1) if pattern.fullmatch("".join(f" {w} " for w in words[at:e]))]
        assert automaton.longest(tokens, at) == max(ends, default=-1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=14))
def test_places_are_leftmost_longest_and_none_is_missed(words):
    templates = [(str(i), t) for i, t in enumerate(MARKUP)]
    scanner = license_templates.Scanner(templates, {"a b": "ab", "a a": "aa"})
    got = scanner.scan(" ".join(words).encode())
    tokens = [w.encode() for w in words]
    for label, template in templates:
        want, free = [], 0
        for at in range(len(words)):
            end = license_templates.Automaton(label, template).longest(tokens, at)
            if at >= free and end > 0:
                want.append((at, end))
                free = end
        assert [(p["start"], p["end"]) for p in got["places"] if p["label"] == label and not p["base"]] == want
    pairs = [i for i in range(len(words) - 1) if words[i] == "a" and words[i + 1] in "ab"]
    assert got["n_base"] == len(pairs)
    assert (got["first_word"], got["last_word"]) == ((pairs[0], pairs[-1]) if pairs else (None, None))


@pytest.mark.parametrize("template", ["a [[b", "a ]] b", "{{x 0-2}} a", "a {{x 0-2}}", "a {{x 3-2}} b", "a {{x}} b", "[[a]]"])
def test_markup_that_cannot_be_compiled_is_refused(template):
    with pytest.raises(ValueError):
        license_templates.Automaton("t", template)


def test_mandatory_wording_must_match_exactly(spark):
    mit = ("The MIT License (MIT)\nCopyright (c) 2019 Some Body <x@y.z>\nPermission is hereby granted, free of charge, to any person "
           "obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction")
    rows = [(mit,), (mit.replace("hereby", "thereby"),), ("Released under the MIT License.",), ("Licensed under the Apache License, Version 2.0.",),
            ("This work is licensed under the GNU General Public License, version 3.",), ("Licensed under CC BY-NC 4.0.",),
            ("A license to kill, released under pressure, version 2.",), ("under the MIT-license under the mit license",)]
    got = [(r["base_labels"], r["labels"], r["score"], r["n_base"]) for r in license_templates.licenses(docs(spark, rows)).orderBy("doc_id").collect()]
    assert got == [("", "mit", 1.0, 0), ("", "", 0.0, 0), ("mit", "mit", 1.0, 1), ("apache-2", "apache-2", 1.0, 1), ("", "gpl-3", 1.0, 0),
                   ("cc-by-nc", "cc-by-nc", 1.0, 1), ("", "", 0.0, 0), ("mit", "mit", 0.5, 2)]


def test_license_scan_of_odd_rows(spark):
    table = docs(spark, [(t,) for t in ANY_CASE] + [("x",)], extra=True)
    out = license_templates.scan(table)
    assert out.columns == [*table.columns, "_license"] and out.count() == table.count()
    rows = license_templates.licenses(table).orderBy("doc_id").collect()
    assert [r["n_words"] for r in rows] == [0, 0, 0, 1, 4, 1, 4, 30_000, 1]
    assert all((r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, None, "", 0.0) for r in rows)
    assert license_templates.licenses(table.limit(0)).count() == 0


# ---------------------------------------------------------------- op12
def plain_search(texts, items, k):
    words = [[w for w in ascii_words((t or "").encode())] for t in texts]
    held = [i for i, w in enumerate(words) if w]
    n_docs, n_terms = len(held), sum(len(words[i]) for i in held)
    tf = {i: Counter(words[i]) for i in held}
    df = Counter(t for i in held for t in tf[i])
    out = []
    for no, item in enumerate(items):
        scores = []
        for i in held:
            m = 100 - 50 + 50 * len(words[i]) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[i][t] // (1000 * tf[i][t] + 20 * m))
                    for t in set(ascii_words((item or "").encode())) if t in tf[i])
            if s > 0:
                scores.append((-s, i))
        out += [(no, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def random_texts(seed, n):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    weight = 1 / np.arange(1, 61)
    return [" ".join(rng.choice(vocabulary, int(rng.integers(1, 40)), p=weight / weight.sum())) for _ in range(n)]


@pytest.mark.parametrize("k", [1, 5, 50, 10_000])
def test_search_is_the_plain_ranking(spark, k):
    texts = [*random_texts(1, 250), *["w1 w2 w3"] * 30, None, "", "...", "w59 " * 2000]
    items = [*random_texts(2, 6), "w58", "w1 w1 w1", "nowhere", "", None, "W3, w2!"]
    asked = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = lexical_search.search(docs(spark, [(t,) for t in texts]).repartition(5), asked, k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_search(texts, items, k)


def test_items_in_several_blocks_give_the_same(spark, monkeypatch):
    texts, items = random_texts(3, 80), random_texts(4, 7)
    asked = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    monkeypatch.setattr(lexical_search, "BLOCK_PAIRS", 12)
    got = lexical_search.search(docs(spark, [(t,) for t in texts]), asked, k=4)
    assert sorted(map(tuple, got.collect())) == plain_search(texts, items, 4)


def test_accumulators_stop_before_the_frequent_terms():
    df, bounds = np.array([3, 900, 5, 1000]), np.array([9000, 40, 8000, 10])
    plan = lexical_search.ItemPlan(0, [0, 1, 2, 3], df, bounds, k=4)
    assert plan.terms == [0, 2, 1, 3] and plan.creating == 2 and not plan.settled()
    plan.least = 51
    assert plan.settled()
    plan.least = 50  # a document with the rest alone could still tie
    assert not plan.settled()


def test_search_of_odd_rows(spark):
    table = docs(spark, [(t,) for t in ANY_CASE] + [("x y",), ("x y",)], extra=True)
    asked = spark.createDataFrame([(7, "x", "z"), (7, "x", "z"), (None, "北京 straße", "z")], "item_id long, text string, doc_id string")
    rows = lexical_search.search(table, asked, k=50).collect()
    assert sorted((r["rank"], r["doc_id"]) for r in rows if r["item_id"] == 7) == [(1, 3), (1, 3), (2, 8), (2, 8), (3, 9), (3, 9)]
    assert [(r["rank"], r["doc_id"]) for r in rows if r["item_id"] is None] == [(1, 4)]
    for empty in (lexical_search.search(table.limit(0), asked), lexical_search.search(table, asked.limit(0))):
        assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    same = table.selectExpr("cast(null AS long) AS doc_id", "text")
    assert lexical_search.search(same, asked.limit(1)).count() == 3


# ---------------------------------------------------------------- op13
def plain_divergence(rows, min_docs=3, top=200):
    rows = [(t or "", la or "", so or "") for t, la, so in rows]
    counts, lang_docs, lang_n = {}, {}, {}
    for t, la, so in rows:
        words = [w.decode() for w in ascii_words(t.encode(), digits=False)]
        counts.setdefault(la, {}).setdefault(so, Counter()).update(words)
        lang_docs.setdefault(la, Counter()).update(set(words))
        lang_n.setdefault(la, Counter()).update(words)
    out = []
    for la, groups in counts.items():
        kept = [t for t, n in lang_docs[la].items() if n >= min_docs]
        v = len(kept)

        def share(c, kept=kept, v=v):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + v) for t in kept}

        p, q = {so: share(c) for so, c in groups.items()}, share(lang_n[la])
        for so, c in groups.items():
            pairs = [(-sum((p[so][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != so]
            terms = [(-((p[so][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if c[t] > 0 and p[so][t] > q[t]]
            out += [(la, so, "pair", o, -f, r) for r, (f, o) in enumerate(sorted(pairs), 1)]
            out += [(la, so, "term", t.decode(), -f, r) for r, (f, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def audit_rows():
    texts = [t.replace("w", "wé").translate(str.maketrans("0123456789", "abcdefghij")) for t in random_texts(5, 160)]
    rng = np.random.default_rng(6)
    langs, sources = ["en", "de", None], ["s1", "s2", "s3", "", None]
    rows = [(t, langs[rng.integers(3)], sources[min(4, int(rng.integers(7)))]) for t in texts]
    return [*rows, (None, "fr", "s1"), ("", "fr", "s2"), ("123", "it", "s9"), ("Zz zz", "en", "lonely"), ("same same", "en", "s1"), ("same same", "en", "s1")]


@pytest.mark.parametrize(("top", "bits"), [(200, 64), (3, 64), (200, 4), (2, 3)])
def test_divergence_is_the_plain_one_also_when_digests_collide(spark, top, bits):
    rows = audit_rows()
    got = source_divergence.divergence(docs(spark, rows).repartition(4), top=top, bits=bits)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_divergence(rows, top=top)


def test_divergence_flushes_within_a_task(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 5)
    rows = audit_rows()
    assert sorted(map(tuple, source_divergence.divergence(docs(spark, rows)).collect())) == plain_divergence(rows)


def test_sums_in_several_tiles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "TILE", 2)
    monkeypatch.setattr(source_divergence, "HELD_TILES", 1)
    rows = audit_rows()
    assert sorted(map(tuple, source_divergence.divergence(docs(spark, rows)).collect())) == plain_divergence(rows)


def test_divergence_of_odd_rows(spark):
    rows = [(t, "en", s) for t in ANY_CASE for s in ("a", "b")]
    table = docs(spark, rows, extra=True)
    assert sorted(map(tuple, source_divergence.divergence(table).collect())) == plain_divergence(rows)
    assert source_divergence.divergence(table.limit(0)).count() == 0


def test_only_digests_cross_the_counting_shuffles(spark):
    counted = source_divergence.group_counts(docs(spark, audit_rows()).selectExpr("lang", "source", "text").fillna(""))
    plan = counted.groupBy("lang", "source", "digest").sum("n")._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in plan.splitlines() if "Exchange" in line)
    assert "digest" in exchange and "term" not in exchange
