"""Sharding along a Hilbert curve through metadata dimensions.

Each dimension is quantised to 2^bits cells: numbers at the table's own approximate quantiles (one
pass, all rows), other values by a hash cell, so equal values share a cell. The Hilbert index of the
cells orders the rows, so that neighbours on the curve are neighbours in every dimension and a
filter on any dimension touches few runs. Rows are sorted by (index, text hash, id) across the
cluster, and the sorted sequence is cut into runs of equal row counts: the law is ``rows``, shard
counts differ by one at most.

The sort is one range shuffle; text hash and id in its key split any cell, however many rows share
it. A row's rank is its partition's offset (one number for each partition, broadcast) plus its place
in it. Shards are written as one folder each (``shard=...``), files in curve order.

Defined cases: null, NaN and infinite values have cell 0; a null text has size 16. Null ids and
repeated rows are rows. A table with fewer rows than shards leaves shards empty; an empty table
gives no rows. Extra columns are written along; those named ``curve``, ``shard`` or ``slot`` (upper and lower
case alike) get underscores before their name until it is free. Helper columns take free names.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from handoff.llm.common import fresh_name, quoted, write_shared

BITS = 8
ADDED = ("curve", "shard", "slot")


def hilbert_index(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points given by one array of cell numbers for each dimension.

    The cells are turned into the curve's transposed form level by level (exchange or invert the
    lower bits of the first axis), Gray-coded, and the axes' bits interleaved.
    """
    axes = [np.array(c, dtype=np.int64) for c in cells]
    for level in range(bits - 1, 0, -1):
        bit, lower = 1 << level, (1 << level) - 1
        for k, axis in enumerate(axes):
            flip = (axis & bit) != 0
            swap = np.where(flip, 0, (axes[0] ^ axis) & lower)
            axes[0] = np.where(flip, axes[0] ^ lower, axes[0] ^ swap)
            if k:
                axes[k] = axis ^ swap
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((axes[-1] >> level) & 1, turn ^ ((1 << level) - 1), turn)
    index = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | (((axis ^ turn) >> level) & 1)
    return index


def _count_below(cuts: Column, value: Column) -> Column:
    return F.when(value.isNotNull(), F.size(F.filter(cuts, lambda c: c < value)))


def cells(df: DataFrame, dims: Sequence[str], bits: int) -> list[Column]:
    """Cell number of each dimension."""
    n = 1 << bits
    numeric = [d for d in dims if isinstance(df.schema[d].dataType, NumericType)]
    value = {d: F.col(quoted(d)).cast("double") for d in numeric}
    finite = {d: F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v) for d, v in value.items()}
    cuts = {}
    if numeric:
        at = [i / n for i in range(1, n)]
        row = df.agg(*[F.percentile_approx(finite[d], at, 20_000).alias(f"c{k}") for k, d in enumerate(numeric)]).first()
        cuts = {d: sorted(set(row[k] or [])) for k, d in enumerate(numeric)}
    out = []
    for d in dims:
        if d in finite:
            lows = F.array(*[F.lit(float(c)) for c in cuts[d]]).cast("array<double>")
            out.append(F.coalesce(_count_below(lows, finite[d]), F.lit(0)))
        else:
            out.append(F.when(F.col(quoted(d)).isNull(), 0).otherwise(F.pmod(F.xxhash64(F.col(quoted(d))), F.lit(n))).cast("int"))
    return [c.cast("long") for c in out]


def shard_rows(df: DataFrame, dims: Sequence[str], shards: int, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The rows with curve, shard and slot, in curve order; ``dims``, ``id_col`` and ``text_col`` are names in ``df``."""
    names = {c: c for c in df.columns}
    for name in [c for c in df.columns if c.lower() in ADDED]:
        names[name] = fresh_name(df, "_" + name)
        df = df.withColumnRenamed(name, names[name])
    dims, id_col, text_col = [names[d] for d in dims], names[id_col], names[text_col]
    place, part, n, first, rank = (fresh_name(df, c) for c in ("place", "part", "n", "first", "rank"))
    curve = F.arrow_udf(lambda *c: pa.array(hilbert_index([x.to_numpy(zero_copy_only=False) for x in c], bits)), "long")
    order = ["curve", F.xxhash64(F.col(quoted(text_col))), F.col(quoted(id_col))]
    ordered = df.withColumn("curve", curve(*cells(df, dims, bits))).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = write_shared(ordered.withColumn(place, F.monotonically_increasing_id()), "curve-order").withColumn(part, F.shiftright(place, 33))
    counts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias(n))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    total = int(counts.agg(F.sum(n)).first()[0] or 0)
    # one row for each partition of the sort
    ranked = ordered.join(F.broadcast(starts), part).withColumn(rank, F.col(first) + F.col(place).bitwiseAND(F.lit((1 << 33) - 1)))
    ranked = ranked.withColumn("shard", F.expr(f"({quoted(rank)} * {shards}) div {max(1, total)}").cast("int"))
    start = F.expr(f"(cast(shard as long) * {total} + {shards - 1}) div {shards}")
    return ranked.select(*[F.col(quoted(c)) for c in df.columns], "curve", "shard", (F.col(rank) - start).alias("slot"))


def write_shards(df: DataFrame, dims: Sequence[str], shards: int, folder: str, **how) -> DataFrame:
    """Write the shards' files, each a piece of one run, and return a reader of them (all columns, shard, slot)."""
    rows = shard_rows(df, dims, shards, **how)
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(rows.schema).parquet(folder)
