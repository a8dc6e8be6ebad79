"""Training rows packed into blocks: one table that every trainer and every fold reads.

A block holds up to ``BLOCK_ROWS`` rows as plain arrays in binary columns: labels, folds, numeric
values, and codes (numeric values as bin numbers, categories as positions in the sorted list of
values). Rows lie in the order of a seeded hash of their key, so a block is a random sample of the
table. The blocks are written once to the shared folder: a lost executor reads its blocks again.

A training set is numbered: 0 .. k-1 leave that fold out, k holds all rows. What preprocessing learns
(medians, most frequent categories, means, standard deviations) is measured for all training sets at
once from per-fold aggregates; a missing value takes the median or category of the training set in use,
whichever model reads the block. Bin edges are the same for all: they are unsupervised.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.functions.columns import nan_to_null, quoted, seeded_hash
from handoff.operators.quantiles import exact_quantiles
from handoff.session import write_shared

BLOCK_ROWS = 8192
#: Fixed value: most bins of a numeric column.
MAX_BINS = 255
#: Code of a missing value, and so the most categories a column may have.
MISSING = 65_535
#: Rows of a model table: a split asks for a bin or a category of a column, a leaf has column -1.
NODE_SCHEMA = "model int, tree int, node long, column int, code int, left long, right long, value double"
NODE_NAMES = ["model", "tree", "node", "column", "code", "left", "right", "value"]


@dataclass
class PrepStats:
    """What the training rows of one set teach: medians, means, standard deviations, most frequent values."""

    medians: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)


@dataclass
class Layout:
    """Columns, their bin edges and categories, and the statistics of every training set (metadata only)."""

    numeric: list[str]
    categorical: list[str]
    edges: dict[str, np.ndarray]
    categories: dict[str, list[str]]
    stats: list[PrepStats]
    n_rows: list[int]
    n_positive: list[int]
    k: int

    @property
    def widths(self) -> list[int]:
        """Number of codes of each column: bins or categories."""
        return [len(self.edges[c]) + 1 for c in self.numeric] + [max(1, len(self.categories[c])) for c in self.categorical]

    def fills(self) -> np.ndarray:
        """[training set, column]: the code a missing value takes."""
        out = np.zeros((len(self.stats), len(self.widths)), dtype=np.uint16)
        for m, s in enumerate(self.stats):
            for j, c in enumerate(self.numeric):
                out[m, j] = np.searchsorted(self.edges[c], s.medians.get(c, 0.0), side="left")
            for j, c in enumerate(self.categorical, len(self.numeric)):
                if s.modes.get(c) is not None:
                    out[m, j] = self.categories[c].index(s.modes[c])
        return out


@dataclass
class Block:
    """One block as arrays; ``codes`` is [row, column]."""

    y: np.ndarray
    fold: np.ndarray
    codes: np.ndarray

    def filled(self, fill: np.ndarray) -> np.ndarray:
        return np.where(self.codes == MISSING, fill, self.codes)

    def in_training(self, m: int, k: int) -> np.ndarray:
        return np.ones(len(self.y), bool) if m == k else self.fold != m


def read_block(row, n_columns: int) -> Block:
    """A block from a table row or a mapping with y, fold and codes."""
    return Block(np.frombuffer(row["y"], np.uint8), np.frombuffer(row["fold"], np.int8),
                 np.frombuffer(row["codes"], np.uint16).reshape(-1, n_columns))


def open_table(path: str) -> pads.Dataset:
    """A Parquet folder as a task reads it; the path is a URI that pyarrow opens or an absolute path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    fs, folder = pafs.FileSystem.from_uri(path)
    return pads.dataset(folder, filesystem=fs, format="parquet", exclude_invalid_files=True)


def folder_of(written: DataFrame) -> str:
    """The folder that a table was written to by ``write_shared``."""
    return written.inputFiles()[0].rsplit("/", 1)[0]


# ---------------------------------------------------------------- measuring
def train_medians(folded: DataFrame, columns: Sequence[str], k: int) -> list[dict]:
    """Exact median per column for every training set, in one exact-quantile job."""
    if not columns:
        return [{} for _ in range(k + 1)]
    parts = [F.struct(F.lit(c).alias("column"), nan_to_null(F.col(quoted(c)).cast("double")).alias("value")) for c in columns]
    trains = F.filter(F.sequence(F.lit(0), F.lit(k)), lambda f: f != F.col("fold"))
    long = (folded.select(trains.alias("train"), F.explode(F.array(*parts)).alias("p")).where(F.col("p.value").isNotNull())
            .groupBy("train", "p.column", "p.value").agg(F.count(F.lit(1)).alias("n"))
            .select(F.explode("train").alias("train"), "column", "value", "n"))
    found = exact_quantiles(long, [0.5], group_by=["train", "column"], weight="n").collect()
    out = [dict.fromkeys(columns, 0.0) for _ in range(k + 1)]  # a column without values in a set imputes to 0
    for r in found:
        out[r["train"]][r["column"]] = r["quantile"]
    return out


def _moments(folded: DataFrame, numeric: Sequence[str], target: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per fold: [rows, positives]; per fold and column: [present, mean, sum of squared deviations]."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col(quoted(target)).cast("long")).alias("pos")]
    for i, c in enumerate(numeric):
        v = nan_to_null(F.col(quoted(c)).cast("double"))
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}")]
    sizes, moments = np.zeros((k, 2), np.int64), np.zeros((k, len(numeric), 3))
    for r in folded.groupBy("fold").agg(*aggs).collect():  # one row per fold
        sizes[r["fold"]] = r["n"], r["pos"]
        for i in range(len(numeric)):
            if r[f"n{i}"]:
                moments[r["fold"], i] = r[f"n{i}"], r[f"m{i}"], r[f"v{i}"] * r[f"n{i}"]
    return sizes, moments, sizes.sum(axis=0)


def _combine(parts: Sequence[tuple[float, float, float]]) -> tuple[float, float]:
    """Mean and population standard deviation of groups given as (count, mean, squared deviations)."""
    n, mean, dev = 0.0, 0.0, 0.0
    for c, m, d in parts:
        if c:
            delta = m - mean
            n += c
            mean += delta * c / n
            dev += d + delta * delta * c * (n - c) / n
    return mean, math.sqrt(dev / n) if n else 0.0


def bin_edges(df: DataFrame, numeric: Sequence[str]) -> dict[str, np.ndarray]:
    """Upper ends of all bins but the last: between all values of a column with few, else at quantiles."""
    if not numeric:
        return {}
    values = {c: nan_to_null(F.col(quoted(c)).cast("double")) for c in numeric}
    probs = [i / MAX_BINS for i in range(1, MAX_BINS)]
    aggs = []
    for i, c in enumerate(numeric):
        aggs += [F.approx_count_distinct(values[c]).alias(f"d{i}"), F.percentile_approx(values[c], probs, 10_000).alias(f"q{i}")]
    row = df.agg(*aggs).first()
    few = [c for i, c in enumerate(numeric) if row[f"d{i}"] <= 2 * MAX_BINS]
    seen: dict[str, list[float]] = {c: [] for c in few}
    if few:
        parts = [F.struct(F.lit(c).alias("column"), values[c].alias("value")) for c in few]
        for r in df.select(F.inline(F.array(*parts))).where(F.col("value").isNotNull()).distinct().collect():  # under 600 a column
            seen[r["column"]].append(r["value"])
    edges = {}
    for i, c in enumerate(numeric):
        own = np.unique(np.array(seen.get(c, ()), dtype=float))
        if 0 < len(own) <= MAX_BINS:
            edges[c] = own[:-1] + (own[1:] - own[:-1]) / 2
        else:
            edges[c] = np.unique(np.array(row[f"q{i}"] or [], dtype=float))
    return edges


def _categories(folded: DataFrame, categorical: Sequence[str], k: int) -> tuple[dict, list[dict]]:
    """Sorted values of every column, and the most frequent one (ties: smallest) in each training set."""
    values: dict[str, list[str]] = {c: [] for c in categorical}
    counts: dict[str, dict[str, np.ndarray]] = {c: {} for c in categorical}
    if categorical:
        parts = [F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in categorical]
        long = folded.select("fold", F.inline(F.array(*parts))).where(F.col("value").isNotNull())
        per_fold = long.groupBy("column", "value", "fold").agg(F.count(F.lit(1)).alias("n"))
        many = per_fold.groupBy("column").agg(F.count_distinct("value").alias("n")).where(F.col("n") >= MISSING).collect()
        if many:
            raise ValueError(f"columns with {MISSING} categories or more: {sorted(r['column'] for r in many)}")
        for r in per_fold.collect():  # bounded: categories x folds, checked above
            counts[r["column"]].setdefault(r["value"], np.zeros(k + 1, np.int64))[r["fold"]] = r["n"]
        values = {c: sorted(counts[c]) for c in categorical}
    modes = []
    for m in range(k + 1):
        mode = {}
        for c in categorical:
            held = [(-(int(n.sum()) - int(n[m])), v) for v, n in counts[c].items()]
            mode[c] = min(held)[1] if held and min(held)[0] < 0 else None
        modes.append(mode)
    return values, modes


def measure(folded: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str], k: int) -> Layout:
    """Everything the trainers need to know before they read a block; ``folded`` has column fold (0 .. k-1)."""
    medians = train_medians(folded, numeric, k)
    sizes, moments, whole = _moments(folded, numeric, target, k)
    categories, modes = _categories(folded, categorical, k)
    stats = []
    for m in range(k + 1):
        s = PrepStats(medians=medians[m], modes=modes[m])
        folds = [f for f in range(k) if f != m]
        rows = int(sizes[folds, 0].sum())
        for i, c in enumerate(numeric):
            present = int(moments[folds, i, 0].sum())
            s.means[c], s.stds[c] = _combine([*(tuple(moments[f, i]) for f in folds), (rows - present, s.medians[c], 0.0)])
        stats.append(s)
    n_rows = [int(whole[0] - sizes[m, 0]) if m < k else int(whole[0]) for m in range(k + 1)]
    n_positive = [int(whole[1] - sizes[m, 1]) if m < k else int(whole[1]) for m in range(k + 1)]
    return Layout(list(numeric), list(categorical), bin_edges(folded, numeric), categories, stats, n_rows, n_positive, k)


# ---------------------------------------------------------------- packing
def write_blocks(folded: DataFrame, key: str, target: str, layout: Layout, seed: int = 42) -> DataFrame:
    """(place, n, keys, y, fold, numbers, codes): the rows in seeded hash order, written to the shared folder.

    ``place`` orders the blocks: task number and count within the task.
    """
    numeric, categorical, edges = layout.numeric, layout.categorical, layout.edges
    position = {c: {v: i for i, v in enumerate(layout.categories[c])} for c in categorical}
    key_type = folded.schema[key].dataType.simpleString()
    parts = max(1, math.ceil(layout.n_rows[-1] / (4 * BLOCK_ROWS)))
    order = seeded_hash(F.col(quoted(key)), seed)
    rows = folded.select(F.col(quoted(key)).alias("key"), F.col(quoted(target)).cast("int").alias("y"), F.col("fold").cast("int").alias("fold"),
                         *[F.col(quoted(c)).cast("double").alias(f"n{i}") for i, c in enumerate(numeric)],
                         *[F.col(quoted(c)).cast("string").alias(f"c{i}") for i, c in enumerate(categorical)], order.alias("h"))
    rows = rows.repartitionByRange(parts, "h", "key").sortWithinPartitions("h", "key").drop("h")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held = TaskContext.get().partitionId(), 0, []

        def block(t: pa.Table) -> pa.RecordBatch:
            numbers = np.empty((t.num_rows, len(numeric)))
            codes = np.empty((t.num_rows, len(numeric) + len(categorical)), dtype=np.uint16)
            for i, c in enumerate(numeric):
                numbers[:, i] = t.column(f"n{i}").to_numpy()
                codes[:, i] = np.searchsorted(edges[c], numbers[:, i], side="left")
                codes[np.isnan(numbers[:, i]), i] = MISSING
            for i, c in enumerate(categorical):
                codes[:, len(numeric) + i] = [position[c].get(v, MISSING) for v in t.column(f"c{i}").to_pylist()]
            y = t.column("y").to_numpy().astype(np.uint8)
            fold = t.column("fold").to_numpy().astype(np.int8)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + made], pa.int64()), pa.array([t.num_rows], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column("key").combine_chunks()),
                 *(pa.array([a.tobytes()], pa.binary()) for a in (y, fold, numbers, codes))],
                names=["place", "n", "keys", "y", "fold", "numbers", "codes"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            while sum(t.num_rows for t in held) >= BLOCK_ROWS:
                t = pa.concat_tables(held)
                yield block(t.slice(0, BLOCK_ROWS))
                made += 1
                held = [t.slice(BLOCK_ROWS)]
        t = pa.concat_tables(held) if held else None
        if t is not None and t.num_rows:
            yield block(t)

    schema = f"place long, n long, keys array<{key_type}>, y binary, fold binary, numbers binary, codes binary"
    return write_shared(rows.mapInArrow(pack, schema), "blocks")
