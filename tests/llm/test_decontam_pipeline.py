"""Benchmark decontamination against brute force, and the pipeline's stages."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from handoff.llm import cgk_decontam, hd_langid, toxicity_fst, variable_packing
from tests.llm.test_pairs import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def plain_distance(item, region):
    """Smallest edit distance of the item to any stretch of the region, by the full table."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        row = [i, *_next(row, a, region, i)]
    return min(row)


def _next(row, a, region, i):
    out, left = [], i
    for j, b in enumerate(region, 1):
        left = min(row[j] + 1, left + 1, row[j - 1] + (a != b))
        out.append(left)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=70), st.lists(st.integers(1, 4), max_size=90))
def test_bit_vectors_give_the_edit_distance(item, region):
    masks = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    assert cgk_decontam.edit_distance_within(masks, len(item), region) == plain_distance(item, region)


def items_and_texts(rng):
    items = [rng.integers(1, 1 << 62, int(n)).astype(np.uint64) for n in (1, 3, 6, 11, 18, 25, 40, 59, 120, 200)]
    filler = lambda n: rng.integers(1, 1 << 62, n).astype(np.uint64)
    return items, filler


def test_verbatim_items_are_found_at_every_offset():
    items, filler = items_and_texts(np.random.default_rng(1))
    index = cgk_decontam.Index(items, 4, 0.2)
    for before in range(40):
        texts = [np.concatenate([filler(before), item, filler(7)]) for item in items]
        assert [[f[:2] for f in hits] for hits in index.search(texts)] == [[(i, 0)] for i in range(len(items))]


def test_edited_items_reach_the_target_recall_and_pass_the_exact_check():
    rng = np.random.default_rng(2)
    items, filler = items_and_texts(rng)
    items = [i for i in items if len(i) >= 18]
    tables = cgk_decontam.tables_for(items, 0.95, 0.15, 0.2)
    index = cgk_decontam.Index(items, tables, 0.2)
    hit = n = 0
    for ratio in (0.05, 0.1, 0.15):
        for _ in range(30):
            texts = [np.concatenate([filler(int(rng.integers(0, 30))), cgk_decontam.edited(i, int(ratio * len(i)), rng), filler(20)]) for i in items]
            for i, (text, hits) in enumerate(zip(texts, index.search(texts))):
                n += 1
                hit += any(h[0] == i for h in hits)
                for item, edits, _ in hits:
                    assert edits == plain_distance(items[item].tolist(), text.tolist()) <= 0.2 * len(items[item])
    assert hit / n >= 0.9


def test_recall_at_the_limit_of_edits_with_the_default_settings(spark):
    rng = np.random.default_rng(12)
    (_, index), = cgk_decontam.indexes(spark.read.parquet(f"{SF}/benchmark.parquet"))
    own = [i for i, w in enumerate(index.items) if len(w)]
    filler = rng.integers(1, 1 << 62, 40).astype(np.uint64)
    edits = lambda w: int(0.2 * len(w))
    texts = [np.concatenate([filler[: int(rng.integers(0, 30))], cgk_decontam.edited(index.items[i], edits(index.items[i]), rng), filler[20:]])
             for _ in range(8) for i in own]
    found = index.search(texts)
    assert np.mean([any(h[0] == i for h in hits) for i, hits in zip(own * 8, found)]) >= 0.95


def test_long_items_are_checked_as_a_whole(spark):
    rng = np.random.default_rng(14)
    names = [f"w{i}" for i in range(5000)]
    words = lambda n: rng.choice(names, n).tolist()
    item, many = words(300), words(1500)
    near = [w if k % 10 else "other" for k, w in enumerate(item)]  # 30 edits
    rows = [(1, words(70) + item + words(40)), (2, words(90) + item[:150] + words(150)), (3, words(33) + near + words(20)),
            (4, item[:200] + words(100)), (5, words(11) + many[:700] + words(100) + many[700:] + words(8)), (6, many[:1000]), (7, item[30:])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(many))], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["edits"], r["places"]) for r in cgk_decontam.leaks(docs, items).collect())
    texts = dict(rows)
    assert [g[:2] for g in got] == [(1, 1), (3, 1), (5, 2), (7, 1)]
    assert [g[2] for g in got] == [plain_distance(many if g[1] == 2 else item, texts[g[0]]) for g in got] == [0, 30, 100, 30]
    assert {g[3] for g in got} == {1}
    assert sorted(r["doc_id"] for r in cgk_decontam.keep_uncontaminated(docs, items).collect()) == [2, 4, 6]


def test_leaks_are_merged_by_id_and_rows_are_kept_one_by_one(spark):
    passage = "seven wise owls watch from the old oak tree by the river bank every single winter night"
    items = spark.createDataFrame([(1, passage), (1, passage), (2, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(None, passage), (None, "so " + passage.replace("owls", "cats")), (5, passage), (5, "clean")], "doc_id long, text string")
    got = [(str(r["doc_id"]), r["item_id"], r["edits"]) for r in cgk_decontam.leaks(docs, items).collect()]
    assert sorted(got) == [("5", 1, 0), ("5", 2, 0), ("None", 1, 0), ("None", 2, 0)]
    assert [tuple(r) for r in cgk_decontam.keep_uncontaminated(docs, items).collect()] == [(5, "clean")]


def test_missed_recall_is_logged(caplog):
    rng = np.random.default_rng(13)
    items = [rng.integers(1, 1 << 62, 40).astype(np.uint64) for _ in range(8)]
    assert cgk_decontam.tables_for(items, 1.01, 0.2, 0.2, most=6) == 6
    assert "not the target" in caplog.text


def test_clean_texts_and_short_items():
    rng = np.random.default_rng(3)
    items, filler = items_and_texts(rng)
    index = cgk_decontam.Index([*items, np.empty(0, np.uint64)], 8, 0.2)
    assert index.search([filler(500), np.empty(0, np.uint64), filler(1)]) == [[], [], []]
    near = items[1].copy()
    near[1] += 1
    assert index.search([near]) == [[]]  # three words: word for word or not at all


def test_leaks_of_documents(spark):
    passage = "The quick brown fox jumps over the lazy dog while seven wise owls watch from the old oak tree by the river bank"
    other = "An entirely different sentence about trains that run late every single winter morning in the northern hills of the land"
    items = spark.createDataFrame([(1, passage), (2, other), (2, other), (3, None), (4, "")], "item_id long, text string")
    rows = [(10, "Intro words here. " + passage.upper().replace(" ", "\n ") + "! And more."), (11, "nothing to see"), (12, None), (13, ""),
            (14, passage.replace("seven", "eight").replace("old ", "") + " " + other), (14, "again " + other), (None, other), (15, "word " * 50000 + passage)]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, edits int, item_id string")
    got = sorted((str(r["doc_id"]), r["item_id"], r["edits"]) for r in cgk_decontam.leaks(docs, items).collect())
    assert got == [("10", 1, 0), ("14", 1, 2), ("14", 2, 0), ("15", 1, 0), ("None", 2, 0)]
    kept = cgk_decontam.keep_uncontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [11, 12, 13]
    assert cgk_decontam.leaks(docs.limit(0), items).count() == 0 and cgk_decontam.leaks(docs, items.limit(0)).count() == 0
    assert cgk_decontam.keep_uncontaminated(docs, items.limit(0)).count() == len(rows)


def test_pipeline_is_its_stages_by_plain_code(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    prototypes = hd_langid.fit(docs)
    names = list(prototypes)
    unit = np.array([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names])
    kept = {i for i, r in rows.items() if hd_langid.predict(r["text"], names, unit)[0] != "und"}
    stage = docs.where(F.col("doc_id").isin(sorted(kept)))
    model = toxicity_fst.fit(stage, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = sorted(i for i in kept if model.score(rows[i]["text"]) < 0.5)
    fps = [plain_fingerprint(rows[i]["text"]) for i in kept]
    root = plain_components(len(fps), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    kept = sorted({kept[r] for r in root})
    items = [cgk_decontam.word_hashes(r["text"]).tolist() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = {i: cgk_decontam.word_hashes(rows[i]["text"]).tolist() for i in kept}
    anchors = {i: set(w) for i, w in words.items()}
    clean = [i for i in kept if not any(len(anchors[i] & set(m)) >= 0.5 * len(set(m)) and plain_distance(m, words[i]) <= 0.2 * len(m) for m in items)]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted({r["doc_id"] for r in got}) == clean
    assert sum(r["n_ids"] for r in got) == sum(len((rows[i]["text"] or "").encode()) + 1 for i in clean)
    lengths = sorted((min(16384, n - s) for i in clean for n in [len(rows[i]["text"].encode()) + 1] for s in range(0, n, 16384)), reverse=True)
    _, _, sizes = variable_packing.pack_group(lengths, variable_packing.SIZES, variable_packing.BIN_COST)
    assert sorted(sizes) == sorted({r["bin_id"]: r["bin_size"] for r in got}.values())


def test_pipeline_stages_take_odd_and_empty_tables(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "the same words here", "en", "s", 1), (3, "the same words here", "en", "s", 1), (None, "no id at all", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame, left in ((docs, 2), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SF)
            assert frame.columns == docs.columns, name
        assert frame.count() == left
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() == left
