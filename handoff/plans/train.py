"""Preprocessing fitted inside each fold, stratified folds, cross-validation, serving and permutation
importance.

Preprocessing statistics (exact medians, population mean/std, most frequent categories) are
aggregates over the TRAINING rows of each fold only -- never the rows being scored. They are
metadata-sized (one value per column).

A training run packs the rows into blocks once (``plans.blocks``); the three model families
(``plans.logistic``, ``plans.forest``, ``plans.boosting``) each fit the k folds and all rows side by side
over these blocks, and leave their models as tables. Out-of-fold scores are one pass over the blocks.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.functions.columns import nan_to_null, quoted, seeded_hash
from handoff.operators import evaluate as K
from handoff.operators.quantiles import exact_quantiles
from handoff.operators.ranking import row_numbers
from handoff.plans import blocks as B
from handoff.plans import boosting, forest, logistic, models
from handoff.plans.blocks import Layout, PrepStats, folder_of, open_table, read_block
from handoff.plans.models import FittedModel, Inputs, logistic_table, score  # noqa: F401
from handoff.session import write_shared


# ---------------------------------------------------------------- I: preprocessing
def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict:
    """Exact median (mean of the two middle values) of each column, NULL/NaN ignored."""
    if not columns:
        return {}
    parts = [F.struct(F.lit(c).alias("column"), nan_to_null(F.col(c).cast("double")).alias("value")) for c in columns]
    long = df.select(F.explode(F.array(*parts)).alias("p")).select("p.*").where(F.col("value").isNotNull())
    return {r["column"]: r["quantile"] for r in exact_quantiles(long, [0.5]).collect()}


def fold_medians(df: DataFrame, columns: Sequence[str], fold: str = "fold", k: int = 5) -> DataFrame:
    """I1 for all folds in one pass: (train_fold, column, median) where train_fold f = rows with fold != f.

    Each row is emitted once per training set it belongs to, so one exact-quantile job serves all folds.
    """
    parts = [F.struct(F.lit(c).alias("column"), nan_to_null(F.col(c).cast("double")).alias("value")) for c in columns]
    trains = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f != F.col(fold))
    long = (df.select(F.explode(trains).alias("train_fold"), F.explode(F.array(*parts)).alias("p"))
            .select("train_fold", "p.*").where(F.col("value").isNotNull()))
    return exact_quantiles(long, [0.5], group_by=["train_fold", "column"]).select(
        "train_fold", "column", F.col("quantile").alias("median"))


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict:
    """Most frequent non-null value per column, ties -> smallest value (partial aggregation)."""
    if not columns:
        return {}
    parts = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (df.select(F.explode(F.array(*parts)).alias("p")).select("p.*").where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}


def impute(df: DataFrame, stats: PrepStats) -> DataFrame:
    out = df
    for c, m in stats.medians.items():
        out = out.withColumn(c, F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(m)))
    for c, m in stats.modes.items():
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(m)))
    return out


def fit_prep(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PrepStats:
    """Statistics of the training rows (three small aggregate jobs)."""
    stats = PrepStats(medians=exact_medians(train, numeric), modes=most_frequent(train, categorical))
    for c in numeric:
        stats.medians.setdefault(c, 0.0)  # an all-NULL column imputes to 0 (sklearn would drop it)
    imputed = impute(train.select(*numeric, *categorical), stats)
    if numeric:
        row = imputed.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(numeric)],
                          *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(numeric)]).collect()[0]
        stats.means = {c: row[f"m{i}"] for i, c in enumerate(numeric)}
        stats.stds = {c: row[f"s{i}"] for i, c in enumerate(numeric)}
    return stats


def apply_prep(df: DataFrame, stats: PrepStats) -> DataFrame:
    """I1-I3 applied: impute, then standardise with the POPULATION std (zero variance -> divide by 1)."""
    out = impute(df, stats)
    for c, m in stats.means.items():
        s = stats.stds.get(c) or 0.0
        out = out.withColumn(c, (F.col(c) - F.lit(m)) / F.lit(s if s > 0 else 1.0))
    return out


def encoder_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """One-hot with unseen categories -> all zeros; only the listed columns reach the model."""
    idx = [f"{c}__idx" for c in categorical]
    oh = [f"{c}__oh" for c in categorical]
    stages = []
    if categorical:
        stages += [StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   # the indexer's last index is "unseen"; dropping it leaves all zeros
                   OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True, handleInvalid="error")]
    stages.append(VectorAssembler(inputCols=list(numeric) + oh, outputCol="features", handleInvalid="keep"))
    return stages


# ---------------------------------------------------------------- J: variants, folds, CV
#: The model families, in the order in which ties between them are served.
VARIANTS = ("logreg", "random_forest", "hist_gb")


#: Rows that a task scores side by side.
HELD_ROWS = models.HELD_ROWS


@dataclass(frozen=True)
class Settings:
    """Fixed values of the families (J2-J4); smaller ones are for tests of the machinery only."""

    trees: int = forest.TREES
    rounds: int = boosting.ROUNDS
    max_leaves: int = boosting.MAX_LEAVES
    task_rows: int = forest.TASK_ROWS


def assign_folds(df: DataFrame, target: str, key: str, k: int = 5, seed: int = 42, order=None) -> DataFrame:
    """Exact stratified folds: rank rows within each class by a seeded hash, fold = rank mod k."""
    h = order if order is not None else seeded_hash(F.col(key), seed)
    ranked = row_numbers(df, [h, F.col(key)], [target], name="_rk")
    return ranked.withColumn("fold", F.pmod(F.col("_rk") - 1, F.lit(k)).cast("int")).drop("_rk")


@dataclass
class TrainingRun:
    """Blocks, layout and the model tables of every family, for the k folds (0 .. k-1) and all rows (k)."""

    blocks: DataFrame
    layout: Layout
    tables: dict[str, list[str]]

    def model(self, variant: str, m: int | None = None) -> FittedModel:
        """The family's model of one training set; of all rows by default."""
        m = self.layout.k if m is None else m
        return FittedModel(variant, self.tables[variant], m, Inputs.of(self.layout, m))


def train_run(df: DataFrame, key: str, target: str, numeric: Sequence[str], categorical: Sequence[str], variants: Sequence[str] = VARIANTS,
              k: int = 5, seed: int = 42, settings: Settings = Settings()) -> TrainingRun:
    """Folds, blocks, and every family fitted on each fold's training rows and on all rows."""
    spark = df.sparkSession
    if unknown := sorted(set(variants) - set(VARIANTS)):
        raise ValueError(f"no model family {unknown[0]!r}; there are {VARIANTS}")
    folded = assign_folds(df.select(*[F.col(quoted(c)) for c in dict.fromkeys([key, target, *numeric, *categorical])]), target, key, k, seed)
    folded = write_shared(folded, "folded")
    layout = B.measure(folded, target, numeric, categorical, k)
    blocks = B.write_blocks(folded, key, target, layout, seed)

    def fit(name: str) -> list[str]:
        if name == "logreg":
            written = [logistic_table(spark, logistic.fit(blocks, layout), layout)]
        elif name == "random_forest":
            written = forest.fit(spark, blocks, layout, settings.trees, seed, settings.task_rows)
        else:
            written = [boosting.fit(blocks, layout, settings.rounds, settings.max_leaves, settings.task_rows)]
        return [folder_of(t) for t in written]

    # side by side: boosting has as few and long tasks as there are training sets, the forest fills the other slots
    order = sorted(variants, key="hist_gb logreg random_forest".split().index)
    with ThreadPoolExecutor(len(order)) as pool:
        fitted = {name: pool.submit(inheritable_thread_target(spark)(fit), name) for name in order}
        tables = {name: fitted[name].result() for name in variants}
    return TrainingRun(blocks, layout, tables)


def out_of_fold(run: TrainingRun, key: str) -> DataFrame:
    """Every row scored once per family, by the model of the fold that left it out: (key, fold, variant, y, proba)."""
    layout, width, variants = run.layout, len(run.layout.widths), list(run.tables)
    fills = layout.fills()
    models = {(v, m): run.model(v, m) for v in variants for m in range(layout.k)}
    key_type = run.blocks.schema["keys"].dataType.elementType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("y", "fold", "numbers", "codes")}
                block = read_block(row, width)
                held.append((batch.column("keys")[i].values, block, np.frombuffer(row["numbers"]).reshape(len(block.y), -1)))
                size += len(block.y)
                if size >= HELD_ROWS:
                    yield from scores(held)
                    held, size = [], 0
        if held:
            yield from scores(held)

    def scores(held: list) -> Iterator[pa.RecordBatch]:
        """The rows held, by one model after the other: a task has one of them in memory."""
        keys = pa.concat_arrays([k for k, _, _ in held])
        y, fold, codes = (np.concatenate([getattr(b, c) for _, b, _ in held]) for c in ("y", "fold", "codes"))
        numbers = np.concatenate([n for _, _, n in held])
        for m in range(layout.k):
            for variant in variants:
                own = np.flatnonzero(fold == m)
                if len(own):
                    filled = np.where(codes[own] == B.MISSING, fills[m], codes[own]).astype(np.int64)
                    proba = models[variant, m].scorer().proba(numbers[own], filled)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(own)), pa.array(np.full(len(own), m, np.int32)), pa.array([variant] * len(own)),
                         pa.array(y[own].astype(np.int32)), pa.array(proba)], names=["key", "fold", "variant", "y", "proba"])

    # each task reads every model once for HELD_ROWS rows
    tasks = max(1, min(-(-layout.n_rows[-1] // B.BLOCK_ROWS), run.blocks.sparkSession.sparkContext.defaultParallelism))
    scored = run.blocks.select("keys", "y", "fold", "numbers", "codes").repartition(tasks).mapInArrow(
        task, f"key {key_type}, fold int, variant string, y int, proba double")
    return write_shared(scored.withColumnRenamed("key", key), "out-of-fold")


def cross_validate(df: DataFrame, key: str, target: str, numeric: Sequence[str], categorical: Sequence[str], variants: Sequence[str] = VARIANTS,
                   k: int = 5, seed: int = 42, settings: Settings = Settings()) -> tuple[TrainingRun, DataFrame, DataFrame]:
    """The run, its out-of-fold scores, and per-fold metrics (variant, fold, metric, value).

    Every variant is scored on the same folds; each fold's preprocessing is fitted on its training rows.
    """
    run = train_run(df, key, target, numeric, categorical, variants, k, seed, settings)
    oof = out_of_fold(run, key)
    return run, oof, K.fold_metrics(oof, group_by=["variant", "fold"])


def serve_best(summary: DataFrame, order: Sequence[str] = VARIANTS) -> str:
    """The variant with the highest mean ROC-AUC (first listed on ties)."""
    means = {r["variant"]: r["mean"] for r in summary.where(F.col("metric") == "roc_auc").collect()}
    return max(order, key=lambda v: (means.get(v) if means.get(v) is not None else float("-inf"), -list(order).index(v)))


def attach_protected(scores: DataFrame, protected: DataFrame, key: str) -> DataFrame:
    """The protected attributes joined on the key (left join: every scored row kept)."""
    return scores.join(protected, key, "left")


def metrics_document(n_rows: int, positive_rate: float, baseline: DataFrame, summary: DataFrame, served: str,
                     importances: DataFrame | None, fairness: DataFrame | None, top_precision: Mapping[str, float] | None = None,
                     inputs: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Tidy (section, name, metric, value) document of a training run: data, served variant, baseline,
    every variant's metrics and precision at the top, importances, fairness, and the inputs by kind."""
    spark = baseline.sparkSession
    head = spark.createDataFrame([("data", "all", "n_rows", float(n_rows)), ("data", "all", "positive_rate", positive_rate),
                                  ("served", served, "served", 1.0)], "section string, name string, metric string, value double")
    base_cols = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "precision_at_top10"]
    base = baseline.select(F.inline(F.array(*[F.struct(F.lit("baseline").alias("section"), F.lit("majority").alias("name"),
                                                       F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                                              for c in base_cols])))
    var = summary.select(F.lit("variants").alias("section"), F.col("variant").alias("name"),
                         F.concat(F.col("metric"), F.lit(".mean")).alias("metric"), F.col("mean").alias("value")).unionByName(
        summary.select(F.lit("variants").alias("section"), F.col("variant").alias("name"),
                       F.concat(F.col("metric"), F.lit(".std")).alias("metric"), F.col("std").alias("value")))
    out = head.unionByName(base).unionByName(var)
    more = [("variants", v, "precision_at_top10", float(p)) for v, p in (top_precision or {}).items()]
    more += [("inputs", c, kind, float(i)) for kind, cols in (inputs or {}).items() for i, c in enumerate(cols)]
    if more:
        out = out.unionByName(spark.createDataFrame(more, out.schema))
    if importances is not None:
        out = out.unionByName(importances.select(F.lit("importances").alias("section"), F.col("feature").alias("name"),
                                                 F.lit("importance").alias("metric"), F.col("importance").alias("value")))
    if fairness is not None:
        for m in ("n", "recall", "precision", "positive_rate"):
            out = out.unionByName(fairness.select(F.lit("fairness").alias("section"),
                                                  F.concat_ws("=", "attribute", "group").alias("name"),
                                                  F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")))
    return out


# ---------------------------------------------------------------- K9: permutation importance
def donor_shifts(n: int, n_repeats: int, seed: int) -> list[int]:
    """How far each repeat turns the rows' order, which is that of a seeded hash."""
    rng = np.random.default_rng(seed)
    return [int(rng.integers(1, n)) if n > 1 else 0 for _ in range(n_repeats)]


def permutation_importance(run: TrainingRun, variant: str, n_repeats: int = 5, seed: int = 42) -> DataFrame:
    """K9: mean drop in ROC-AUC when one input column is shuffled, per column, sorted descending.

    The blocks hold the rows in the order of a seeded hash. Repeat r gives the row at position p the
    column's value of the row at (p + shift of r) mod n: a permutation of all rows, whose donors of one
    block lie in two or three others, which the task reads from the shared folder. So no row is copied
    or shuffled: tasks get numbers of blocks and repeats, and send on counts by (column, repeat, score,
    label), nothing else.
    """
    layout, blocks = run.layout, run.blocks
    model = run.model(variant)
    scorer, fill = model.scorer(), layout.fills()[layout.k]
    columns, width = layout.numeric + layout.categorical, len(layout.widths)
    listed = blocks.select("place", "n").orderBy("place").collect()  # two numbers per block
    place = np.array([r["place"] for r in listed], dtype=np.int64)
    ends = np.cumsum([r["n"] for r in listed])
    starts, total = ends - np.array([r["n"] for r in listed]), int(ends[-1])
    shifts = donor_shifts(total, n_repeats, seed)
    folder = folder_of(blocks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = OrderedDict()

        def values(i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Numbers, filled codes and labels of a block."""
            if i not in held:
                row = open_table(folder).to_table(columns=["numbers", "codes", "y"], filter=pc.field("place") == int(place[i])).to_pylist()[0]
                codes = np.frombuffer(row["codes"], np.uint16).reshape(-1, width)
                numbers, y = np.frombuffer(row["numbers"]).reshape(len(codes), -1), np.frombuffer(row["y"], np.uint8)
                held[i] = numbers, np.where(codes == B.MISSING, fill, codes).astype(np.int64), y
                while len(held) > 4:
                    held.popitem(last=False)
            return held[i]

        def donors(first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
            """Numbers and codes of the n rows from position ``first`` on, around the end."""
            parts = []
            while n:
                i = int(np.searchsorted(ends, first, side="right"))
                take = min(n, int(ends[i]) - first)
                numbers, codes, _ = values(i)
                at = first - int(starts[i])
                parts.append((numbers[at: at + take], codes[at: at + take]))
                n, first = n - take, (first + take) % total
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

        def counts(feature: str, repeat: int, y: np.ndarray, proba: np.ndarray) -> pa.RecordBatch:
            by_label = [np.unique(proba[y == label], return_counts=True) for label in (0, 1)]
            values, n = (np.concatenate(parts) for parts in zip(*by_label))
            labels = np.repeat(np.array([0, 1], np.int32), [len(v) for v, _ in by_label])
            return pa.RecordBatch.from_arrays(
                [pa.array([feature] * len(n)), pa.array(np.full(len(n), repeat, np.int32)), pa.array(labels), pa.array(values), pa.array(n)],
                names=["feature", "rep", "y", "proba", "n"])

        def scored(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            """The blocks and repeats held, by one reading of the model."""
            for whole in (True, False):
                own = [h for h in held if (h[0] < 0) == whole]
                if not own:
                    continue
                cuts = np.cumsum([len(h[1]) for h in own])[:-1]
                arrays = [np.concatenate([h[2][j] for h in own]) for j in range(2 if whole else 4)]
                # the rows as they are have no column swapped
                for c, proba in [("", scorer.proba(*arrays))] if whole else zip(columns, scorer.swapped(*arrays)):
                    for (repeat, y, _), part in zip(own, np.split(proba, cuts)):
                        yield counts(c, max(0, repeat), y, part)

        some, size = [], 0
        for batch in batches:
            for own, repeat in zip(batch.column("place").to_pylist(), batch.column("rep").to_pylist()):
                i = int(np.searchsorted(place, own))
                numbers, codes, y = values(i)
                others = donors((int(starts[i]) + shifts[repeat]) % total, len(y)) if repeat >= 0 else ()
                some.append((repeat, y, (numbers, codes, *others)))
                size += len(y)
                if size >= HELD_ROWS // 2:
                    yield from scored(some)
                    some, size = [], 0
        if some:
            yield from scored(some)

    work = blocks.select("place", F.explode(F.sequence(F.lit(-1), F.lit(n_repeats - 1))).alias("rep"))
    tasks = max(1, min(len(place) * (n_repeats + 1), 8 * blocks.sparkSession.sparkContext.defaultParallelism))
    scored = work.repartition(tasks, "place", "rep").mapInArrow(task, "feature string, rep int, y int, proba double, n long")
    aucs = write_shared(K.roc_auc(scored, group_by=["feature", "rep"], weight="n"), "importance")
    base = aucs.where(F.col("feature") == "").first()["roc_auc"]  # one row
    return aucs.where(F.col("feature") != "").groupBy("feature").agg((F.lit(base).cast("double") - F.avg("roc_auc")).alias("importance")).orderBy(
        F.col("importance").desc(), "feature")
