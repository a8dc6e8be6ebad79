"""Exact running totals and row numbers without a single-task global window.

``Window.orderBy`` with no partition (or a partition on a hot key) sends every row to one task.
Here the rows are range-partitioned on (group, order) so a hot group is split across tasks; each
task computes local running totals, and a small per-(partition, group) total table supplies the
offsets. The offset table has at most (#groups + #partitions) rows. Cost: one range shuffle,
one checkpoint write, one hash shuffle on (partition, group) for the local window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from handoff.functions.columns import col_of

from handoff.session import reliable_checkpoint

_PID = "__pid"


def _n_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column | str],
    sums: Mapping[str, Column | str],
    group_by: Sequence[str] = (),
    n_partitions: int | None = None,
) -> DataFrame:
    """Add inclusive running sums ``{name: expr}`` within each group in ``order_by`` order.

    ``order_by`` must be a total order within a group for the result to be deterministic
    (end it with a unique key). Sort directions are honoured (use ``F.desc``).
    """
    n = _n_partitions(df, n_partitions)
    group_by = list(group_by)
    order_cols = [col_of(c) if isinstance(c, str) else c for c in order_by]
    staged = df
    value_names = []
    for name, expr in sums.items():
        tmp = f"__v_{name}"
        staged = staged.withColumn(tmp, F.col(expr) if isinstance(expr, str) else expr)
        value_names.append((name, tmp))

    groups = [f"__g{i}" for i in range(len(group_by))]  # plain names, whatever the columns are called
    for tmp, g in zip(groups, group_by):
        staged = staged.withColumn(tmp, col_of(g))
    parted = staged.repartitionByRange(n, *groups, *order_cols).withColumn(
        _PID, F.spark_partition_id()
    )
    # The local sums and the offsets are two reads of ``parted``; adaptive execution may coalesce
    # the range shuffle differently for each read, so the partition ids are pinned by writing
    # ``parted`` once to the shared checkpoint folder (reliable: survives a lost executor).
    parted = reliable_checkpoint(parted)
    local_w = Window.partitionBy(_PID, *groups).orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = parted
    for name, tmp in value_names:
        local = local.withColumn(f"__l_{name}", F.sum(tmp).over(local_w))

    totals = parted.groupBy(_PID, *groups).agg(*[F.sum(tmp).alias(f"__t_{name}") for name, tmp in value_names])
    before_w = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals
    for name, _ in value_names:
        offsets = offsets.withColumn(f"__o_{name}", F.coalesce(F.sum(f"__t_{name}").over(before_w), F.lit(0)))
    offsets = offsets.select(_PID, *groups, *[f"__o_{name}" for name, _ in value_names])

    joined = local.join(offsets, [_PID, *groups], "left")
    out_cols = [col_of(c) for c in df.columns]
    for name, _ in value_names:
        out_cols.append((F.col(f"__l_{name}") + F.col(f"__o_{name}")).alias(name))
    return joined.select(*out_cols)


def row_numbers(
    df: DataFrame,
    order_by: Sequence[Column | str],
    group_by: Sequence[str] = (),
    name: str = "row_number",
    n_partitions: int | None = None,
) -> DataFrame:
    """``row_number()`` over (partition by group_by order by order_by), computed without a hot task."""
    return running_totals(df, order_by, {name: F.lit(1).cast("long")}, group_by, n_partitions)
