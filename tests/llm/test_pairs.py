"""SimHash and embedding near-duplicates against brute force."""

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from handoff.llm import hyperplane_dedup, simhash_blocks
from handoff.llm.common import shrink_to_roots
from handoff.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(n, linked):
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if linked(i, j) and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


@pytest.mark.parametrize("text", ["", "one", "One two", "a b c", "x\ty\nz\x0bw  v", "Ünï code Wörds here", "a b c " * 500])
def test_fingerprint_is_the_plain_rule(text):
    assert simhash_blocks.fingerprint(text.encode()) == plain_fingerprint(text)


def test_every_close_pair_shares_a_key():
    rng = np.random.default_rng(1)
    for r in (5, 6, 7):
        masks = simhash_blocks.block_masks(r, 3)
        for _ in range(300):
            a = int(rng.integers(0, 1 << 63))
            b = a
            for bit in rng.choice(64, 3, replace=False):
                b ^= 1 << int(bit)
            assert any((a ^ b) & (m % (1 << 64)) == 0 for m in masks)


def test_block_count_follows_the_number_of_fingerprints():
    assert simhash_blocks.block_count(10, 3) == 5
    assert simhash_blocks.block_count(10**9, 3) > 5


def near_copies():
    rng = np.random.default_rng(7)
    base = [" ".join(f"w{rng.integers(0, 5000)}" for _ in range(120)) for _ in range(12)]
    texts = []
    for i, t in enumerate(base):
        texts += [t, t, t.upper() if i % 2 else t + " tail"]
    return [*texts, None, "", "   ", "short", "short"]


def test_near_duplicates_match_brute_force_and_survive_odd_rows(spark):
    texts = near_copies()
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS + "")
    docs = docs.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "fp")
    got = {r["doc_id"]: r for r in simhash_blocks.near_duplicates(docs).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    want = plain_components(len(fps), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    assert [got[i]["fp"] % (1 << 64) for i in range(len(fps))] == fps
    assert [got[i]["component_id"] for i in range(len(fps))] == want
    kept = simhash_blocks.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_large_cells_are_split_without_losing_links(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    fps = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 40, (60, 2))})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash_blocks.near_links(frame, 3, cell_limit=7)
    roots = {r["node"]: r["component"] for r in connected_components(links, "a", "b").collect()}
    want = plain_components(len(fps), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    assert [roots.get(f, f) for f in fps] == [fps[w] for w in want]


def test_repeated_and_null_ids_keep_one_row_of_each_group(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (7, "a b c d"), (None, "q r s t u"), (None, "q r s t u"), (9, "z y x w v")]
    kept = simhash_blocks.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept) == [
        (False, 5, "a b c d"), (False, 9, "z y x w v"), (True, 0, "q r s t u")]


def test_kept_rows_carry_columns_of_any_name(spark):
    rows = [(5, "a b c d", 1), (None, "a b c d", 2), (5, "a b c d", 1), (9, "z y x w v", 3), (None, None, 4), (None, "", 5)]
    names = ["_low", "_group", "_of", "_fp", "_place", "_Place", "fp", "component", "first", "a.b", "task", "places"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    for name in names:
        docs = docs.withColumn(name, F.col("n") * 10)
    kept = simhash_blocks.keep_first(docs.repartition(3))
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["_low"], r["a.b"]) for r in kept.collect())
    assert got[1:] == [(5, "a b c d", 10, 10), (9, "z y x w v", 30, 30)]
    assert got[0][:2] == (0, "") and got[0][2] in (40, 50)


def test_no_text_crosses_a_shuffle_when_rows_are_kept(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('t ', id % 7, ' a b c d e') AS text")
    plan = simhash_blocks.keep_first(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert simhash_blocks.near_duplicates(docs).count() == 0
    assert simhash_blocks.keep_first(docs).count() == 0
    vecs = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hyperplane_dedup.near_duplicates(vecs).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_roots_of_links(links):
    a, b = np.array([x for x, _ in links], dtype=int), np.array([y for _, y in links], dtype=int)
    linked = {(x, y) for x, y in links} | {(y, x) for x, y in links}
    assert shrink_to_roots(31, a, b).tolist() == plain_components(31, lambda i, j: (i, j) in linked)


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(3, 3), (None, 4)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 140)} == {100}


def vectors():
    rng = np.random.default_rng(11)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        rows += [(centre + rng.normal(size=16) * s).tolist() for s in (0.0, 0.0, 0.05, 0.15, 0.3)]
    rows += [rows[0], rows[0], None, [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [], [1.0, 2.0]]
    return rows


def test_embedding_links_match_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, kept int")
    got = {r["vec_id"]: r for r in hyperplane_dedup.near_duplicates(frame, cell_limit=9, bucket=4).collect()}

    def linked(i, j):
        a, b = rows[i], rows[j]
        if i == j or not a or not b or len(a) != len(b) or None in a or None in b:
            return False
        a, b = np.array(a), np.array(b)
        return bool(np.linalg.norm(a) and np.linalg.norm(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95)

    assert [got[i]["component_id"] for i in range(len(rows))] == plain_components(len(rows), linked)
    assert [got[i]["n_links"] for i in range(len(rows))] == [sum(linked(i, j) for j in range(len(rows))) for i in range(len(rows))]
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_null_vector_ids_link_with_nothing(spark):
    got = hyperplane_dedup.near_duplicates(spark.createDataFrame([(None, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"] is None, r["n_links"], r["kept"]) for r in got) == [(False, 0, True), (True, 0, False), (True, 0, False)]


def test_recall_against_brute_force_on_the_given_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").orderBy("vec_id").collect()
    v = np.array([r["embedding"] for r in rows], dtype=np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.95
    np.fill_diagonal(near, False)
    found = sum(r["n_links"] for r in hyperplane_dedup.near_duplicates(frame).collect())
    assert 0.98 * near.sum() <= found <= near.sum()
