"""Language ID, toxicity grammar and context-tree weighting."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from handoff.llm import ctw_scoring, hd_langid, queries, toxicity_fst
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "  123 %%% "), (4, "a"), (4, "a"), (None, "the thing and the other " * 2000)]


def odd_docs(spark):
    return spark.createDataFrame([(i, t, "en", "x", 0) for i, t in ODD], "doc_id long, text string, lang string, score string, held_out long")


def test_trigrams_cover_the_whole_text_and_only_letters():
    codes, counts = hd_langid.trigrams("Ab, ab")
    unpacked = {(c >> 42, (c >> 21) & 0x1FFFFF, c & 0x1FFFFF): n for c, n in zip(codes.tolist(), counts.tolist())}
    a, b, blank = ord("a"), ord("b"), 32
    assert unpacked == {(blank, a, b): 2, (a, b, blank): 2, (b, blank, a): 1}
    assert len(hd_langid.trigrams("12 %%")[0]) == 0 and len(hd_langid.trigrams(None)[0]) == 0


def test_bundle_is_the_sum_of_bound_permuted_letters():
    v = hd_langid.Vectors(64, 1)
    codes, counts = hd_langid.trigrams("abab")
    want = np.zeros(64)
    text = " abab "
    for x, y, z in zip(text, text[1:], text[2:]):
        want += np.roll(v.letter(ord(x)), 2) * np.roll(v.letter(ord(y)), 1) * v.letter(ord(z)).astype(int)
    assert np.array_equal(v.bundle(codes, counts), want)


def test_language_of_held_out_documents(spark):
    got = queries.op2_hd_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    share = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_language_odd_rows(spark):
    docs = odd_docs(spark)
    model = hd_langid.fit(docs)
    got = [(r["doc_id"], r["lang_pred"]) for r in hd_langid.identify(docs, model).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "en")], key=str)
    kept = hd_langid.keep_identified(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == 3
    empty = docs.limit(0)
    assert hd_langid.fit(empty) == {} and hd_langid.identify(empty, {}).count() == 0
    assert {r["lang_pred"] for r in hd_langid.identify(docs, {}).collect()} == {"und"}


def test_floors_and_prototypes_come_from_all_labelled_rows(spark):
    """floors cover every labelled row, each text scored once; prototypes do where no sample is asked for."""
    n = 12_000
    found = F.struct(F.lit("en").alias("lang_pred"), (F.col("id") / n).alias("score"), F.lit(7).alias("size"))
    floors = hd_langid.fit_floors(spark.range(n).select(F.lit("en").alias("lang"), found.alias("found")), ["en", "fr"])
    cut = int(n * hd_langid.SHARE)  # the first of 200 steps that holds more than this many rows
    assert floors["en"][7] == hd_langid.FACTOR * (cut * 200 // n) / 200 and set(floors["fr"]) == {0.0}
    docs = spark.createDataFrame([(i, f"word{i} and the other", "en") for i in range(50)], "doc_id long, text string, lang string")
    want = sum(hd_langid.Vectors().bundle(*hd_langid.trigrams(f"word{i} and the other")) for i in range(50))
    assert np.allclose(hd_langid.fit(docs, fit_rows=None)["en"], want)
    assert not np.allclose(hd_langid.fit(docs, fit_rows=10)["en"], want)
    kept = hd_langid.keep_above_floors(docs, hd_langid.fit(docs, fit_rows=None))
    assert kept.columns == docs.columns and kept.count() == 50


def test_prototypes_do_not_depend_on_how_many_trigrams_are_held(spark, monkeypatch):
    """all rows are counted in bounded pieces."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    whole = hd_langid.fit(docs, fit_rows=None)
    monkeypatch.setattr(hd_langid, "HELD_TRIGRAMS", 100)
    pieces = hd_langid.fit(docs, fit_rows=None)
    assert list(whole) == list(pieces) and all(np.array_equal(whole[k], pieces[k]) for k in whole)


def test_language_stage_drops_texts_in_no_learned_language(spark):
    rng = np.random.default_rng(5)
    noise = lambda letters, n: "".join(rng.choice(list(letters), n))
    junk = [
        "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待人人有资格享受本宣言所载的一切权利",
        "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
        noise("abcdefghijklmnopqrstuvwxyz    ", 60), noise("abcdefghijklmnopqrstuvwxyz    ", 20000), noise("asdfghjkl  ", 500),
        noise("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 300),
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    short = ["The.", "Avec.", "A.\nAll rights reserved.", "Die tz.", "And the thing.", "the thing and the other " * 2000]
    planted = [(-1 - i, t, None) for i, t in enumerate(junk)] + [(-101 - i, t, None) for i, t in enumerate(short)]
    kept = corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(planted, docs.schema)), SF)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns
    assert {i for i in ids if i < 0} == {-101 - i for i in range(len(short))}
    assert {r["doc_id"] for r in docs.collect()} <= ids  # every labelled document stays


def brute_scores(symbols):
    """Clause weight by rules over positions, without transducers."""
    total = 0.0
    I, T, Y, N, R = toxicity_fst.INSULT, toxicity_fst.THREAT, toxicity_fst.TARGET, toxicity_fst.NEGATION, toxicity_fst.REPORT
    for k, s in enumerate(symbols):
        weight = (0.5 if R in symbols[:k] else 1.0) * (0.3 if N in symbols[max(0, k - 3): k] else 1.0)
        if s == I:
            total += weight * (1.5 if Y in symbols[max(0, k - 4): k] else 1.0) * (1.2 if k and symbols[k - 1] == I else 1.0)
        if s == Y and T in symbols[max(0, k - 3): k]:
            total += toxicity_fst.THREAT_STRENGTH
    return total


def test_composed_grammar_is_the_rules():
    machine = toxicity_fst.grammar()
    kinds = [toxicity_fst.OTHER, toxicity_fst.INSULT, toxicity_fst.TARGET, toxicity_fst.NEGATION, toxicity_fst.REPORT]
    for n in range(1, 6):
        for symbols in itertools.product(kinds, repeat=n):
            got = toxicity_fst.clause_score(machine, list(symbols), [1.0] * n)
            assert got == pytest.approx(brute_scores(symbols)), symbols


def test_negated_and_reported_clauses_score_less():
    model = toxicity_fst.Model({"idiot": 5.0, "mor*": 0.0, "lowei*": 4.0}, [-4.0, 1.0, 0.0, 0.0])
    plain, negated, reported = (model.features(t)[0] for t in ("You are an idiot.", "You are not an idiot.", "They said: she called him idiot."))
    assert plain > reported > negated > 0
    assert model.features("idiots of it, loweischaft")[0] == 4.0  # whole words for words, beginnings for stems
    assert model.features("I will kill you")[0] > 0 and model.features("kill the time")[0] == 0
    assert model.features(None) == (0.0, 0.0, 0.0)


def plain_scores(symbols, reported):
    """As brute_scores, with a threat's weight taken at the threat word."""
    total = 0.0
    I, T, Y, N, R = toxicity_fst.INSULT, toxicity_fst.THREAT, toxicity_fst.TARGET, toxicity_fst.NEGATION, toxicity_fst.REPORT
    weight = [(0.5 if reported or R in symbols[:k] else 1.0) * (0.3 if N in symbols[max(0, k - 3): k] else 1.0) for k in range(len(symbols))]
    for k, s in enumerate(symbols):
        if s == I:
            total += weight[k] * (1.5 if Y in symbols[max(0, k - 4): k] else 1.0) * (1.2 if k and symbols[k - 1] == I else 1.0)
        if s == Y:
            total += toxicity_fst.THREAT_STRENGTH * max((weight[j] for j in range(max(0, k - 3), k) if symbols[j] == T), default=0.0)
    return total


def test_composed_grammar_is_the_rules_with_threats():
    machine = toxicity_fst.grammar()
    for n in range(1, 7):
        for symbols in itertools.product(toxicity_fst.READ, repeat=n):
            for reported in (False, True):
                got = toxicity_fst.clause_score(machine, list(symbols), [1.0] * n, reported)
                assert got == pytest.approx(plain_scores(symbols, reported)), symbols


def test_negated_reported_and_quoted_threats():
    model = toxicity_fst.Model({"idiot": 5.0}, [-4.0, 1.0, 0.0, 0.0])
    want = {"I will kill you": 6.0, "I will not kill you": 1.8, "I will not kill all of you": 1.8, "he said he will kill you": 3.0,
            "he said: I will kill you": 3.0, 'he said, "I will kill you"': 3.0, 'he said:\r\n"I will not kill you"': 0.9,
            'she wrote "well, maybe, idiot"': 2.5, "he said so. I will kill you": 6.0, 'he said "so." I will kill you': 6.0,
            "he said hello\nI will kill you": 6.0, "no, I will kill you": 6.0, 'idiot, he said, "idiot, idiot." idiot': 5.0,
            "he said it (I will kill you)": 6.0}
    assert {t: model.features(t)[0] for t in want} == pytest.approx(want)
    assert model.features('idiot, he said, "idiot, idiot." idiot')[1] == pytest.approx(math.log1p(15.0))


def test_toxicity_of_held_out_documents(spark):
    got = queries.op6_toxicity_fst(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in got if r["toxic"] == 1]
    clean = [r["predicted"] for r in got if r["toxic"] == 0]
    assert np.mean(toxic) >= 0.6 and np.mean(clean) <= 0.02  # six and 64 rows; 45 toxic rows to learn from


def test_stems_do_not_mark_innocent_words(spark):
    insults = ["idiot", "idiots", "disgusting", "clown", "schwachkopf", "schwachkopfes", "schwachkopfen", "schwachkoepfe"]
    rng = np.random.default_rng(0)
    filler = [f"{a}{b}" for a in ("be", "da", "ru", "mo", "li") for b in ("lan", "tor", "vin", "sel", "quam", "dor")]
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice(filler, 30))
        if i % 6 == 0:
            words.insert(int(rng.integers(0, 30)), "you are an " + insults[i // 6 % len(insults)])
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(i % 6 == 0)))
    model = toxicity_fst.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    for text in ("The idiom is old.", "A disguise for the party.", "The clownfish swims.", "An idiomatic phrase, a disguised one."):
        assert model.score(text) < 0.5, text
    for word in insults:
        assert model.score(f"You are an {word}.") >= 0.5, word
    assert model.strength("idiot") > 4 * model.strength("idiom")


def plain_model_score(model, text):
    """The model's score by the rules: words, clauses and scopes by position, then the logistic."""
    low = text.lower()
    sums = []
    for sentence in re.split(r"[.!?;()\r\n]+", low):
        said = False
        for clause in re.split(r"[:,\"]+", sentence):
            words = re.findall(r"[^\W\d_]+", clause)
            strength = [model.lexicon[w] if w in model.lexicon else max([model.lexicon.get(w[:k] + "*", 0.0) for k in toxicity_fst.STEMS if len(w) >= k], default=0.0)
                        for w in words]
            symbols = [toxicity_fst.INSULT if s > 0 else toxicity_fst.SYMBOL_OF.get(w, toxicity_fst.OTHER) for w, s in zip(words, strength)]
            sums.append(weighted_scores(symbols, strength, said))
            said = said or toxicity_fst.REPORT in symbols
    found = [s for s in sums if s > 0]
    x = (max(found, default=0.0), math.log1p(sum(found)), math.log1p(len(found)))
    z = model.weights[0] + sum(w * v for w, v in zip(model.weights[1:], x))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def weighted_scores(symbols, strength, reported):
    total = 0.0
    I, T, Y, N, R = toxicity_fst.INSULT, toxicity_fst.THREAT, toxicity_fst.TARGET, toxicity_fst.NEGATION, toxicity_fst.REPORT
    weight = [(0.5 if reported or R in symbols[:k] else 1.0) * (0.3 if N in symbols[max(0, k - 3): k] else 1.0) for k in range(len(symbols))]
    for k, s in enumerate(symbols):
        if s == I:
            total += strength[k] * weight[k] * (1.5 if Y in symbols[max(0, k - 4): k] else 1.0) * (1.2 if k and symbols[k - 1] == I else 1.0)
        if s == Y:
            total += toxicity_fst.THREAT_STRENGTH * max((weight[j] for j in range(max(0, k - 3), k) if symbols[j] == T), default=0.0)
    return total


def test_the_whole_query_is_the_fitted_model_applied_by_plain_code(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity_fst.fit(docs, labels, train=queries.id_remainder("doc_id", 5) != 0)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = queries.op6_toxicity_fst(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_model_score(model, texts[r["doc_id"]] or "")
        assert r["score"] == pytest.approx(want, abs=1e-9) and r["predicted"] == int(want >= 0.5), texts[r["doc_id"]][:300]


def test_toxicity_with_more_rows_to_learn_from(spark):
    got = queries.op6_toxicity_fst(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    got = got.where("held_out").collect()
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 1]) >= 0.9
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 0]) <= 0.01


def test_toxicity_odd_rows(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity_fst.fit(docs, none)
    got = toxicity_fst.score(docs, model).collect()
    assert len(got) == len(ODD) and {r["predicted"] for r in got} == {0} and all(0 <= r["score"] <= 1 for r in got)
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert toxicity_fst.keep_clean(docs, toxicity_fst.fit(docs, labels)).columns == docs.columns
    assert toxicity_fst.score(docs.limit(0), model).count() == 0


def brute_ctw(train, text, depth):
    """log10 probability by recursion over dictionaries."""
    counts = {}

    def path(data):
        line = bytes(depth) + data + b"\0"
        for i in range(depth, len(line)):
            prefix = 1
            for bit in range(7, -1, -1):
                one = line[i] >> bit & 1
                yield line[i - depth: i], prefix, one
                prefix = prefix << 1 | one

    for t in train:
        for context, prefix, one in path(t):
            for d in range(depth + 1):
                counts.setdefault((context[depth - d:], prefix), [0, 0])[one] += 1

    def kt(node):
        a, b = counts.get(node, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    children = {}
    for context, prefix in counts:
        if context:
            children.setdefault((context[1:], prefix), []).append((context, prefix))

    def below(node):
        return sum(log_pw(c) for c in children.get(node, []))

    memo = {}

    def log_pw(node):
        if node not in memo:
            memo[node] = kt(node) if len(node[0]) == depth else math.log(0.5) + np.logaddexp(kt(node), below(node))
        return memo[node]

    total = 0.0
    for context, prefix, one in path(text):
        p = None
        for d in range(depth, -1, -1):
            node = (context[depth - d:], prefix)
            a, b = counts.get(node, (0, 0))
            estimate = (b + 0.5) / (a + b + 1)
            if p is None:
                p = estimate
            else:
                beta = math.exp(kt(node) - below(node))
                p = (beta * estimate + p) / (1 + beta)
        total += math.log10(p if one else 1 - p)
    return total


def test_ctw_matches_a_plain_recursion(spark):
    texts = ["the cat sat on the mat", "the dog sat", None, "", "A cat\tand THE dog " * 3, "ünïcode the", "the dog sat"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, score long").repartition(3)
    train = F.col("doc_id") % 3 != 1
    got = {r["doc_id"]: r for r in ctw_scoring.score(docs, train, chunk_bytes=40).collect()}
    raw = [(t or "").encode().lower() for t in texts]
    own = [r for i, r in enumerate(raw) if i % 3 != 1]
    words = Counter(w for r in own for w in r.split())
    n, v = sum(words.values()) + len(own), len(words) + 1
    for i, r in enumerate(raw):
        assert got[i]["score"] == pytest.approx(brute_ctw(own, r, ctw_scoring.DEPTH), rel=1e-9)
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(words[w] for w in r.split()), len(own)])
        assert got[i]["base_score"] == pytest.approx(base)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(r.split()) + 1, sum(w in words for w in r.split()) + 1, n)


def test_ctw_without_training_rows_and_without_rows(spark):
    docs = spark.createDataFrame([(None, "ab")], "doc_id long, text string")
    got = ctw_scoring.score(docs, F.lit(False)).first()
    assert got["score"] == pytest.approx(24 * math.log10(0.5)) and got["train_tokens"] == 0 and got["base_score"] == pytest.approx(0.0)
    assert ctw_scoring.score(docs.limit(0), F.lit(True)).count() == 0


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.5, 1e6 + 0.5])
    assert np.allclose(ctw_scoring.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-10)


def test_remainders_are_those_of_crc32(spark):
    got = queries.op9_ctw_scoring(spark, "/root/testdata/sf0.001").select("doc_id", "held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in got)
