"""The trainers against plain single-process versions, on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from handoff.plans import blocks as B
from handoff.plans import boosting, forest, logistic, models
from handoff.plans import train as J
from handoff.plans.blocks import open_table
from handoff.plans.models import UNSEEN

ROWS = 700
SMALL = J.Settings(trees=12, rounds=12)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(ROWS):
        tenure = None if rng.random() < 0.05 else float(rng.integers(0, 60))
        spend = float("nan") if rng.random() < 0.02 else float(rng.normal(100, 30))
        kind = None if rng.random() < 0.03 else str(rng.choice(["a", "b", "c", "d"]))
        y = int(((tenure or 30) < 10 and kind in ("a", None)) or spend > 140 or rng.random() < 0.05)
        rows.append((i, tenure, spend, kind, "only" if i % 2 else "other", y))
    return spark.createDataFrame(rows, "`k` long, `ten.ure` double, spend double, kind string, side string, y int")


NUM, CAT = ["ten.ure", "spend"], ["kind", "side"]


@pytest.fixture(scope="module")
def run(table):
    return J.train_run(table, "k", "y", NUM, CAT, J.VARIANTS, 3, 42, SMALL)


def plain_rows(run):
    """All rows of the blocks, in order: y, fold, numbers, codes, keys."""
    parts = run.blocks.orderBy("place").collect()
    width = len(run.layout.widths)
    blocks = [B.read_block(p, width) for p in parts]
    numbers = np.concatenate([np.frombuffer(p["numbers"]).reshape(p["n"], -1) for p in parts])
    keys = [k for p in parts for k in p["keys"]]
    return (np.concatenate([b.y for b in blocks]), np.concatenate([b.fold for b in blocks]), numbers,
            np.concatenate([b.codes for b in blocks]), keys)


def test_blocks_hold_every_row_once(run, table):
    y, fold, numbers, codes, keys = plain_rows(run)
    assert sorted(keys) == list(range(ROWS)) and len(y) == ROWS
    want = {r["k"]: r for r in table.collect()}
    for i, k in enumerate(keys):
        assert y[i] == want[k]["y"]
        assert numbers[i, 0] == want[k]["ten.ure"] or (np.isnan(numbers[i, 0]) and want[k]["ten.ure"] is None)
        assert (codes[i, 2] == B.MISSING) == (want[k]["kind"] is None)
        if want[k]["kind"] is not None:
            assert run.layout.categories["kind"][codes[i, 2]] == want[k]["kind"]
    assert set(fold) == {0, 1, 2}


def test_statistics_of_every_training_set(run):
    _, fold, numbers, codes, _ = plain_rows(run)
    for m, s in enumerate(run.layout.stats):
        own = numbers[fold != m] if m < 3 else numbers
        for j, c in enumerate(NUM):
            median = np.nanmedian(own[:, j])
            filled = np.where(np.isnan(own[:, j]), median, own[:, j])
            assert s.medians[c] == pytest.approx(median)
            assert s.means[c] == pytest.approx(filled.mean()) and s.stds[c] == pytest.approx(filled.std())
        kinds = codes[fold != m, 2] if m < 3 else codes[:, 2]
        counts = np.bincount(kinds[kinds != B.MISSING])
        assert run.layout.categories["kind"].index(s.modes["kind"]) == counts.argmax()


def test_bin_edges_part_all_values_of_a_small_column(run):
    values = np.unique(plain_rows(run)[2][:, 0])
    values = values[~np.isnan(values)]
    assert list(run.layout.edges["ten.ure"]) == [(a + b) / 2 for a, b in zip(values, values[1:])]
    assert 200 < len(run.layout.edges["spend"]) < B.MAX_BINS


# ---------------------------------------------------------------- boosting
def plain_boosting(y, codes, widths, numeric, rounds, max_leaves):
    """Leaf-wise boosting by the definition: one split at a time, every node counted on its own."""
    base = np.log(y.mean() / (1 - y.mean()))
    margin = np.full(len(y), base)

    def best(rows, g, h):
        found = []
        for column, width in enumerate(widths):
            for code in range(width - (column < numeric)):
                left = codes[rows, column] <= code if column < numeric else codes[rows, column] == code
                a, b = rows[left], rows[~left]
                if min(len(a), len(b)) < boosting.MIN_LEAF_ROWS or min(h[a].sum(), h[b].sum()) < boosting.MIN_HESSIAN:
                    continue
                gain = g[a].sum() ** 2 / h[a].sum() + g[b].sum() ** 2 / h[b].sum() - g[rows].sum() ** 2 / h[rows].sum()
                found.append((gain, a, b))
        top = max((f[0] for f in found), default=0.0)
        return next((f for f in found if f[0] >= top - 1e-9 * max(1.0, top)), None) if top > 1e-12 else None

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        leaves = [(np.arange(len(y)), best(np.arange(len(y)), g, h))]
        while len(leaves) < max_leaves:
            at = max((i for i, leaf in enumerate(leaves) if leaf[1]), key=lambda i: leaves[i][1][0], default=None)
            if at is None:
                break
            _, (_, a, b) = leaves.pop(at)
            leaves += [(a, best(a, g, h)), (b, best(b, g, h))]
        for rows, _ in leaves:
            margin[rows] -= boosting.LEARNING_RATE * g[rows].sum() / h[rows].sum()
    return margin


@pytest.mark.parametrize("max_leaves", [31, 5])
def test_boosting_is_leaf_wise_growth(run, max_leaves):
    y, fold, _, codes, _ = plain_rows(run)
    trees = boosting.fit_by_passes(run.blocks, run.layout, rounds=3, max_leaves=max_leaves)
    fills, numeric = run.layout.fills(), len(NUM)
    for m in (0, 3):
        filled = np.where(codes == B.MISSING, fills[m], codes)
        own = np.flatnonzero(fold != m) if m < 3 else np.arange(len(y))
        want = plain_boosting(y[own].astype(float), filled[own], run.layout.widths, numeric, 3, max_leaves)
        got = boosting.base_margin(run.layout, m) + sum(boosting._margins_after(filled[own], t, numeric) for t in trees[m])
        assert np.allclose(got, want, atol=1e-9)
        assert max(len(t.splits) for t in trees[m]) <= max_leaves - 1


def test_boosting_does_not_depend_on_how_rows_are_blocked_or_counted(run):
    def held(table):
        return sorted((*r[:-1], round(r["value"], 9)) for r in table.collect())

    other = run.blocks.repartition(3)
    in_tasks = held(boosting.fit(run.blocks, run.layout, rounds=3))
    assert in_tasks == held(boosting.fit(run.blocks, run.layout, rounds=3, task_rows=1)) == held(boosting.fit(other, run.layout, rounds=3, task_rows=1))


# ---------------------------------------------------------------- forest
def nodes_of(paths, model):
    rows = [r for p in paths for r in open_table(p).to_table().to_pylist() if r["model"] == model]
    return {(r["tree"], r["node"]): r for r in rows}


def test_forest_nodes_follow_the_definition(run):
    y, fold, _, codes, _ = plain_rows(run)
    m = 1
    nodes = nodes_of(run.tables["random_forest"], m)
    places = run.blocks.select("place", "n").orderBy("place").collect()
    hashes = np.concatenate([forest._row_hash(r) for r in places])
    filled = np.where(codes == B.MISSING, run.layout.fills()[m], codes)
    seen = 0
    for tree in range(SMALL.trees):
        drawn = forest.draws(hashes, forest.tree_seed(42, m, tree))
        own = np.flatnonzero((fold != m) & (drawn > 0))
        n = np.bincount(y[own], drawn[own], 2)
        weight = drawn * (n.sum() / (2 * n))[y]
        assert 0.8 * (fold != m).sum() < n.sum() < 1.2 * (fold != m).sum()
        todo = [(1, own)]
        while todo:
            number, rows = todo.pop()
            node = nodes[tree, number]
            seen += 1
            assert len(rows) >= forest.MIN_LEAF_ROWS
            if node["column"] < 0:
                assert node["value"] == pytest.approx((weight[rows] * y[rows]).sum() / weight[rows].sum())
                continue
            assert 0 < y[rows].sum() < len(rows)
            x = filled[rows, node["column"]]
            left = x <= node["code"] if node["column"] < len(NUM) else x == node["code"]
            todo += [(node["left"], rows[left]), (node["right"], rows[~left])]
    assert seen == len(nodes)


def test_forest_is_the_same_when_upper_nodes_are_grown_from_histograms(spark, run):
    whole = forest.fit(spark, run.blocks, run.layout, trees=4, seed=7)
    parts = forest.fit(spark, run.blocks.repartition(2), run.layout, trees=4, seed=7, task_rows=60)
    key = ["model", "tree", "node", "column", "code", "left", "right"]

    def held(tables):
        return sorted(tuple(r) for t in tables for r in t.select(*key).collect())

    assert held(whole) == held(parts)


def test_mirrored_splits_have_equal_gains(run):
    """sums are whole numbers until the class weights come in, so the side on which a part lies does not matter."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        rows, drawn, weight = rng.integers(2, 400, 2), rng.integers(2, 900, (2, 2)), rng.random((1, 2)) * 3
        ask = lambda order: forest.Candidates.from_sums(np.arange(2), rows[order], drawn[:, order], np.zeros(2, int), np.array([-1]), weight)
        assert ask([0, 1])[2][0] == ask([1, 0])[2][0]


def test_whole_trees_are_grown_without_a_shuffle(spark, run):
    """a table of bounded size is read by each task; its rows are not sent once a tree."""
    listed = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("forest", "forest")
    forest.fit(spark, run.blocks, run.layout, trees=3, seed=7)
    stages = [s for j in listed.getJobIdsForGroup("forest") for s in listed.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("", "")
    assert len(stages) == 1


# ---------------------------------------------------------------- scoring
def test_masks_walks_and_swapped_columns_agree(run):
    """boosted trees are scored by masks, a swapped column without scoring the others again."""
    _, _, numbers, codes, _ = plain_rows(run)
    filled = np.where(codes == B.MISSING, run.layout.fills()[3], codes).astype(np.int64)
    filled[:40, 2] = UNSEEN
    rng = np.random.default_rng(2)
    order = rng.permutation(len(filled))
    for v in J.VARIANTS:
        scorer = run.model(v).scorer()
        whole = scorer.proba(numbers, filled)
        for j, got in enumerate(scorer.swapped(numbers, filled, numbers[order], filled[order])):
            n, f = numbers.copy(), filled.copy()
            f[:, j] = filled[order, j]
            if j < len(NUM):
                n[:, j] = numbers[order, j]
            assert np.array_equal(got, scorer.proba(n, f))
        if v == "hist_gb":
            assert scorer._masks is not None
            scorer._masks = None
            assert np.allclose(scorer.proba(numbers, filled), whole, atol=1e-12)
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr("handoff.plans.models.MASK_CELLS", 0)
                assert np.allclose(run.model(v).scorer().proba(numbers, filled), whole, atol=1e-12)


def test_out_of_fold_holds_one_model_at_a_time(run, monkeypatch):
    """rows come in pieces, each scored by one model after the other."""
    whole = sorted(map(tuple, J.out_of_fold(run, "k").collect()))
    monkeypatch.setattr(J, "HELD_ROWS", 100)
    assert sorted(map(tuple, J.out_of_fold(run, "k").collect())) == whole


# ---------------------------------------------------------------- logistic
def test_logistic_has_no_gradient_left(run):
    y, fold, numbers, codes, _ = plain_rows(run)
    fills = run.layout.fills()
    for m, w in enumerate(logistic.fit(run.blocks, run.layout)):
        own = np.flatnonzero(fold != m) if m < 3 else np.arange(len(y))
        x = logistic.encoded(numbers[own], codes[own], run.layout, m, fills[m])
        n, pos = len(own), y[own].sum()
        s = np.where(y[own] == 1, n / (2 * pos), n / (2 * (n - pos)))
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (s * (p - y[own])) + np.concatenate([[0.0], w[1:]])
        assert np.abs(gradient).max() < 1e-6


# ---------------------------------------------------------------- runs
def test_out_of_fold_scores_come_from_the_fold_that_left_the_row_out(run, table):
    oof = J.out_of_fold(run, "k")
    assert oof.columns == ["k", "fold", "variant", "y", "proba"]
    assert oof.groupBy("k").count().where("count <> 3").count() == 0 and oof.count() == 3 * ROWS
    for v in J.VARIANTS:
        own = oof.where((F.col("variant") == v) & (F.col("fold") == 1))
        again = J.score(run.model(v, 1), table, keep=["k"]).withColumnRenamed("proba", "again")
        assert own.join(again, "k").where(F.abs(F.col("proba") - F.col("again")) > 1e-9).count() == 0


def test_models_learn_and_take_unseen_categories(spark, run):
    per = {(r["variant"], r["metric"]): r["mean"] for r in J.K.fold_summary(J.K.fold_metrics(J.out_of_fold(run, "k"), group_by=["variant", "fold"])).collect()}
    assert per["random_forest", "roc_auc"] > 0.75 and per["hist_gb", "roc_auc"] > 0.75 and per["logreg", "roc_auc"] > 0.65
    unseen = spark.createDataFrame([(1, 3.0, None, "zzz", None)], "k long, `ten.ure` double, spend double, kind string, side string")
    for v in J.VARIANTS:
        assert 0.0 <= J.score(run.model(v), unseen).first()["proba"] <= 1.0
    with pytest.raises(ValueError, match="missing"):
        J.score(run.model("logreg"), unseen.drop("spend"))


def test_save_and_load(spark, run, table, tmp_path):
    for v in J.VARIANTS:
        model = run.model(v)
        model.save(spark, str(tmp_path / v))
        back = J.FittedModel.load(spark, str(tmp_path / v))
        a = J.score(model, table, keep=["k"]).orderBy("k").collect()
        b = J.score(back, table, keep=["k"]).orderBy("k").collect()
        assert a == b


@pytest.mark.parametrize("variant", ["logreg", "hist_gb"])
def test_permutation_importance_is_the_plain_one(run, variant):
    y, _, numbers, codes, _ = plain_rows(run)
    scorer, fill = run.model(variant).scorer(), run.layout.fills()[run.layout.k]
    filled = np.where(codes == B.MISSING, fill, codes).astype(np.int64)

    def auc(proba):
        order = np.concatenate([proba[y == 1], proba[y == 0]])
        pos, neg = order[: (y == 1).sum()], order[(y == 1).sum():]
        return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))

    base, want = auc(scorer.proba(numbers, filled)), {}
    for j, c in enumerate(NUM + CAT):
        drops = []
        for shift in J.donor_shifts(len(y), 5, 42):
            n, f = numbers.copy(), filled.copy()
            f[:, j] = np.roll(filled[:, j], -shift)
            if j < len(NUM):
                n[:, j] = np.roll(numbers[:, j], -shift)
            drops.append(base - auc(scorer.proba(n, f)))
        want[c] = np.mean(drops)
    got = J.permutation_importance(run, variant, 5, 42).collect()
    assert {r["feature"]: pytest.approx(r["importance"], abs=1e-9) for r in got} == want
    assert [r["importance"] for r in got] == sorted((r["importance"] for r in got), reverse=True)


def test_the_three_families_have_their_full_settings():
    assert J.VARIANTS == ("logreg", "random_forest", "hist_gb")
    assert (forest.TREES, forest.MIN_LEAF_ROWS, boosting.ROUNDS, boosting.LEARNING_RATE, boosting.MAX_LEAVES) == (400, 2, 400, 0.05, 31)
    assert J.Settings() == J.Settings(400, 400, 31, forest.TASK_ROWS)


def test_one_class_and_few_rows(spark):
    rows = [(i, float(i % 3), "x", 0) for i in range(9)]
    df = spark.createDataFrame(rows, "k long, a double, c string, y int")
    run = J.train_run(df, "k", "y", ["a"], ["c"], J.VARIANTS, 3, 42, J.Settings(trees=2, rounds=2))
    oof = J.out_of_fold(run, "k")
    assert oof.count() == 27 and oof.where("proba < 0 or proba > 0.5 or proba is null").count() == 0


# ---------------------------------------------------------------- fast growing and scoring
def test_questions_asked_row_by_row_agree_with_summed_ones(run):
    """Candidates.best sorts rows, from_sums reads their counts: the same splits."""
    rng = np.random.default_rng(5)
    asks = forest.Candidates(run.layout, 42)
    codes = np.stack([rng.integers(0, w, 400) for w in run.layout.widths], axis=1).astype(np.uint8)
    slot, y, drawn = rng.integers(0, 9, 400), rng.integers(0, 2, 400), rng.integers(1, 12, 400)
    row = (y << 4 | drawn).astype(np.uint8)
    sums = np.bincount(32 * slot + row, minlength=9 * 32).reshape(9, 32) @ forest._COUNTED
    weights = rng.random((9, 2))
    for question in range(len(asks.column)):
        column, category = int(asks.column[question]), int(asks.category[question])
        which, code, left = asks.best(codes, np.arange(400) * codes.shape[1], slot, row, np.full((9, 1), question), weights, sums)
        for node in range(9):
            answer = codes[slot == node, column].astype(int) if category < 0 else (codes[slot == node, column] != category).astype(int)
            label, n = y[slot == node], drawn[slot == node]
            counts = np.stack([np.bincount(answer, minlength=256), np.bincount(answer, n * (1 - label), 256), np.bincount(answer, n * label, 256)])
            held = np.flatnonzero(counts[0])
            at = held if category < 0 else np.where(held == 0, category, -1)
            found, want, _ = forest.Candidates.from_sums(at, counts[0, held].astype(int), counts[1:, held].astype(int), np.zeros(len(held), int),
                                                         np.array([category]), weights[node][None])
            assert (which[node] >= 0) == bool(len(found))
            if len(found):
                assert code[node] == (want[0] if category < 0 else 0)
                goes = answer <= code[node]
                rows, draws = forest.unpacked(left[node])
                assert rows == goes.sum() and draws.tolist() == [(n * goes * (label == c)).sum() for c in (0, 1)]


def test_a_root_beyond_the_counters_is_a_leaf(run):
    """Rows that no question splits come whole to one task, however many: their value is exact."""
    n = 1_200_000
    asks = forest.Candidates(run.layout, 42)
    codes = np.zeros((n + 8, len(run.layout.widths)), np.uint8)
    codes[n: n + 4, 1] = 7
    y = np.ones(n + 8, np.uint8)
    y[n + 4:] = 0
    part = np.append(np.zeros(n, np.int64), np.ones(8, np.int64))
    got = list(forest.grow(asks, codes, y, np.full(n + 8, 2, np.uint8), part, np.ones((2, 2)), np.zeros(2, np.uint64), np.ones(2, np.uint64)))
    assert [(a[0].tolist(), a[2].tolist(), a[6].tolist()) for a in got[:1]] == [([0], [-1], [1.0])]
    assert [(a[0].tolist(), a[2].tolist(), a[6].tolist()) for a in got[1:]] == [([1], [1], [0.5]), ([1, 1], [-1, -1], [0.0, 1.0])]


@pytest.mark.parametrize("variant", ["random_forest", "hist_gb"])
def test_a_swapped_column_is_not_scored_from_the_root(run, variant, monkeypatch):
    from handoff.plans import models

    _, _, numbers, codes, _ = plain_rows(run)
    filled = np.where(codes == B.MISSING, run.layout.fills()[3], codes).astype(np.int64)
    filled[::50, 2] = UNSEEN
    order = np.random.default_rng(1).permutation(len(filled))
    monkeypatch.setattr(models, "MASK_LEAVES", 0)  # boosted trees without masks
    monkeypatch.setattr(models, "_held", [])
    scorer = run.model(variant).scorer()
    want = []
    for j in range(filled.shape[1]):
        one = filled.copy()
        one[:, j] = filled[order, j]
        want.append(scorer.proba(numbers, one))
    monkeypatch.setattr(models.Scorer, "proba", None)
    assert np.array_equal(np.array(want), np.array(list(scorer.swapped(numbers, filled, numbers[order], filled[order]))))


def test_a_worker_reads_a_model_once(run, tmp_path, spark, monkeypatch):
    from handoff.plans import models

    reads, read = [], models.Scorer._read
    monkeypatch.setattr(models, "_held", [])
    monkeypatch.setattr(models.Scorer, "_read", lambda self, tables: reads.append(self.model) or read(self, tables))
    _, _, numbers, codes, _ = plain_rows(run)
    filled = np.where(codes == B.MISSING, 0, codes).astype(np.int64)
    first, again, other = (run.model("random_forest", m).scorer().proba(numbers, filled) for m in (3, 3, 1))
    assert reads == [3, 1] and np.array_equal(first, again) and not np.array_equal(first, other)
    for m in (0, 2):  # a folder that is written anew is another model
        run.model("hist_gb", m).save(spark, str(tmp_path / "m"))
        back = J.FittedModel.load(spark, str(tmp_path / "m")).scorer().proba(numbers, filled)
        assert np.array_equal(back, run.model("hist_gb", m).scorer().proba(numbers, filled))


# ---------------------------------------------------------------- models that are larger than a worker may hold
def test_a_forest_is_scored_without_being_held_whole(run, table, monkeypatch):
    """F2 F6 F8 F10 F11 F12 (memory): a large forest is read by parts for many rows; scores and importances stay the same."""
    model = run.model("random_forest")
    _, _, numbers, codes, _ = plain_rows(run)
    filled = np.where(codes == B.MISSING, run.layout.fills()[3], codes).astype(np.int64)
    other = np.random.default_rng(2).permutation(len(filled))
    swap = (numbers, filled, numbers[other], filled[other])
    want, swapped = model.scorer().proba(numbers, filled), list(model.scorer().swapped(*swap))
    monkeypatch.setattr(models, "HELD_NODES", 0)
    monkeypatch.setattr(models, "READ_NODES", 300)
    scorer = model.scorer()
    scorer._load()
    parts = [len(np.unique(cols["tree"])) for cols in scorer._stored([open_table(p) for p in scorer.paths])]
    assert len(parts) > 2 and sum(parts) == SMALL.trees and scorer._trees is None
    assert np.array_equal(scorer.proba(numbers, filled), want)
    assert all(np.array_equal(a, b) for a, b in zip(scorer.swapped(*swap), swapped, strict=True))


def test_rows_are_scored_many_at_a_time(spark, run, table, monkeypatch):
    """A task gives a model the rows of many batches at once, also where they do not come out even."""
    model = run.model("random_forest")
    whole = {r["k"]: r["proba"] for r in models.score(model, table, keep=["k"]).collect()}
    monkeypatch.setattr(models, "HELD_ROWS", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    try:
        parts = {r["k"]: r["proba"] for r in models.score(model, table, keep=["k"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert parts == whole and len(whole) == ROWS


def test_importance_does_not_depend_on_how_blocks_are_held(run, monkeypatch):
    """A task scores several blocks and repeats by one reading of the model."""
    want = [tuple(r) for r in J.permutation_importance(run, "random_forest", 2).collect()]
    monkeypatch.setattr(J, "HELD_ROWS", 2)
    assert [tuple(r) for r in J.permutation_importance(run, "random_forest", 2).collect()] == want


def test_large_nodes_split_as_small_ones(run, monkeypatch):
    """a node whose rows are counted by code gets the split that sorting them gives."""
    y, _, _, codes, _ = plain_rows(run)
    filled = np.where(codes == B.MISSING, run.layout.fills()[3], codes)
    asks, seeds = forest.Candidates(run.layout, 7), np.array([forest.tree_seed(7, 3, t) for t in range(3)])
    drawn = np.random.default_rng(4).integers(1, 4, len(y)).astype(np.uint8)
    part, weights, roots = np.arange(len(y)) % 3, np.array([[1.0, 2.0], [0.7, 1.4], [1.0, 1.0]]), np.array([1, 5, 9], np.uint64)

    def grown(large, batch, kind):
        monkeypatch.setattr(forest, "LARGE_ROWS", large)
        monkeypatch.setattr(forest, "BATCH_ROWS", batch)
        monkeypatch.setattr(forest, "COUNT_ROWS", 50)
        made = forest.grow(asks, filled.astype(kind), y, drawn, part, weights, seeds, roots)
        return sorted(tuple(x.item() for x in row) for some in made for row in zip(*some, strict=True))

    want = grown(10**9, 10**9, np.uint16)
    assert len(want) > 60
    assert want == grown(2, 10**9, np.uint16) == grown(40, 100, np.uint16) == grown(10**9, 16, np.uint16)
    if max(run.layout.widths) <= 256:
        assert want == grown(40, 100, np.uint8)
