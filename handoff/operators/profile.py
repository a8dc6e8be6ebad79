"""Profile a table: shape, nulls, distinct counts, samples, numeric ranges, duplicates.

All per-column null counts and numeric statistics come from ONE aggregate over the table (a single
wide row, reshaped to one row per column). Distinct counts and sample values come from one
``groupBy(column, value)`` over the unpivoted table: map-side partial aggregation collapses hot
values before the shuffle, and the per-column ranking is range-partitioned so no column lands in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from handoff.config import PROFILE_SAMPLES
from handoff.functions.columns import col_of, cols_of, is_floating, is_missing, nan_to_null, row_hash
from handoff.operators.ranking import row_numbers


def _keys(key: str | Sequence[str] | None) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def is_numeric_field(dt) -> bool:
    return isinstance(dt, NumericType) and not isinstance(dt, BooleanType)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, position, null_count) for every column, from one aggregate (NaN counts as null)."""
    fields = df.schema.fields
    if not fields:
        return df.sparkSession.createDataFrame([], "column string, position int, null_count long")
    wide = df.agg(*[F.count_if(is_missing(col_of(f.name), f.dataType)).alias(f"n{i}") for i, f in enumerate(fields)])
    pairs = [F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("position"), F.col(f"n{i}").alias("null_count"))
             for i, f in enumerate(fields)]
    return wide.select(F.inline(F.array(*pairs)))


def column_stats(df: DataFrame) -> DataFrame:
    """(column, position, dtype, null_count, non_null, min, max, mean, std) in one aggregate.

    min/max/mean/std (sample std, NULL for n <= 1) only for numeric, non-boolean columns.
    """
    fields = df.schema.fields
    aggs = []
    for i, f in enumerate(fields):
        c = col_of(f.name)
        aggs.append(F.count_if(is_missing(c, f.dataType)).alias(f"n{i}"))
        if is_numeric_field(f.dataType):
            v = nan_to_null(c, f.dataType).cast("double")
            aggs += [
                F.min(v).alias(f"mn{i}"),
                F.max(v).alias(f"mx{i}"),
                F.avg(v).alias(f"av{i}"),
                F.stddev_samp(v).alias(f"sd{i}"),
            ]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    rows = []
    for i, f in enumerate(fields):
        num = is_numeric_field(f.dataType)
        nul = F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(i).alias("position"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col(f"n{i}").alias("null_count"),
                (F.col("rows") - F.col(f"n{i}")).alias("non_null"),
                (F.col(f"mn{i}") if num else nul).alias("min"),
                (F.col(f"mx{i}") if num else nul).alias("max"),
                (F.col(f"av{i}") if num else nul).alias("mean"),
                (F.col(f"sd{i}") if num else nul).alias("std"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, num, n): count of every distinct non-null value of every column.

    ``value`` is the text form; ``num`` the numeric value for numeric columns (used for ordering).
    One shuffle for all columns; -0.0 and 0.0 are one value, NaN is missing.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    parts = []
    for f in fields:
        c = nan_to_null(col_of(f.name), f.dataType)
        if is_floating(f.dataType):
            c = F.when(c == 0, F.lit(0.0)).otherwise(c)
        num = c.cast("double") if is_numeric_field(f.dataType) else F.lit(None).cast("double")
        parts.append(F.struct(F.lit(f.name).alias("column"), c.cast("string").alias("value"), num.alias("num")))
    long = df.select(F.explode(F.array(*parts)).alias("p")).select("p.*").where(F.col("value").isNotNull())
    return long.groupBy("column", "value", "num").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """(column, n_unique): number of distinct non-null values per column.

    exact=True: one ``groupBy(column, value)`` over the unpivoted table (a shuffle of every
    distinct value). exact=False: one scan with HyperLogLog++ sketches (``approx_count_distinct``,
    relative error ``rsd``), no shuffle of values -- the lever for very wide / very large tables.
    """
    if not exact:
        fields = df.schema.fields
        wide = df.agg(*[F.approx_count_distinct(nan_to_null(col_of(f.name), f.dataType), rsd).alias(f"d{i}")
                        for i, f in enumerate(fields)])
        return wide.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"d{i}").cast("long").alias("n_unique"))
                                              for i, f in enumerate(fields)])))
    vc = value_counts(df)
    names = df.sparkSession.createDataFrame([(f.name,) for f in df.schema.fields], "column string")
    per = vc.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    return names.join(per, "column", "left").select("column", F.coalesce("n_unique", F.lit(0)).alias("n_unique"))


def sample_values(df: DataFrame, k: int = PROFILE_SAMPLES) -> DataFrame:
    """(column, rank, value): text columns -> k most frequent (ties by value);
    other columns -> k smallest distinct values."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    vc = value_counts(df)
    is_text = F.col("column").isin(list(text)) if text else F.lit(False)
    ordered = vc.withColumn("_freq", F.when(is_text, -F.col("n")).otherwise(F.lit(0)))
    ranked = row_numbers(ordered, [F.col("_freq"), F.col("num"), F.col("value")], ["column"], name="rank")
    return ranked.where(F.col("rank") <= k).select("column", "rank", "value")


def combine_scalars(frames: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """Stack one-row, one-column aggregates into one row (union + conditional max, no product)."""
    long = None
    for frame, name in zip(frames, names):
        part = frame.select(F.lit(name).alias("metric"), col_of(name).cast("long").alias("value"))
        long = part if long is None else long.unionByName(part)
    return long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


def duplicate_counts(df: DataFrame, key: str | Sequence[str] | None) -> DataFrame:
    """One row: rows, cols, duplicate_rows, duplicate_ids, duplicate_records (beyond the first).

    Rows and records are grouped by 128-bit hashes of their values, ids by the key alone, so no row is
    shuffled; repeated ones collapse map-side. Each count is rows less groups.
    """
    keys = _keys(key)
    cols = df.columns
    non_key = [c for c in cols if c not in keys]
    spark = df.sparkSession

    def extra(group: list[F.Column], name: str) -> DataFrame:
        if not group:
            return spark.range(1).select(F.lit(0).cast("long").alias(name))
        g = df.select(*[c.alias(f"g{i}") for i, c in enumerate(group)]).groupBy(*[f"g{i}" for i in range(len(group))]).agg(F.count(F.lit(1)).alias("n"))
        return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias(name))

    def hashes(names: list[str]) -> list[F.Column]:
        return [row_hash(names, seed) for seed in (1, 2)] if names else []

    frames = [
        df.agg(F.count(F.lit(1)).alias("rows")),
        spark.range(1).select(F.lit(len(cols)).cast("long").alias("cols")),
        extra(hashes(cols), "duplicate_rows"),
        extra(cols_of(keys) if keys and all(k in cols for k in keys) else [], "duplicate_ids"),
        extra(hashes(non_key), "duplicate_records"),
    ]
    return combine_scalars(frames, ["rows", "cols", "duplicate_rows", "duplicate_ids", "duplicate_records"])


def profile_columns(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: dtype, null_count, n_unique, min, max, mean, std (unrounded)."""
    stats = column_stats(df)
    return stats.join(distinct_counts(df, exact), "column").select(
        "column", "position", "dtype", "null_count", "n_unique", "min", "max", "mean", "std"
    )
