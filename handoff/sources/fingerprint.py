"""Order-independent table fingerprint.

A file hash changes with row order and part-file layout, so a distributed table gets a content
fingerprint instead: two 64-bit hashes per row over the column names and types and the columns in
name order (each value wrapped with a null flag, so NULL never collides with a value in another
column), summed as DECIMAL(38,0) plus the row count. A sum (not xor) keeps duplicates from cancelling. Stable under repartitioning
and column order; changes with any name, type, value, row loss or duplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handoff.functions.columns import col_of

_SEEDS = (42, 7)


def _row_struct(df: DataFrame) -> Column:
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    shape = F.lit("|".join(f"{n}:{kinds[n]}" for n in names)).alias("shape")
    return F.struct(shape, *[F.struct(col_of(n).isNull().alias("null"), col_of(n).alias("v")).alias(f"c{i}") for i, n in enumerate(names)])


def fingerprint_exprs(df: DataFrame) -> list[Column]:
    """Aggregate expressions (fp_rows, fp_h0, fp_h1) to fuse into another aggregate."""
    row = _row_struct(df)
    return [F.count(F.lit(1)).alias("fp_rows")] + [
        F.sum(F.xxhash64(F.lit(s), row).cast("decimal(38,0)")).alias(f"fp_h{i}") for i, s in enumerate(_SEEDS)
    ]


def fingerprint_text(row) -> str:
    """Canonical text of the three aggregates (one row with fp_rows, fp_h0, fp_h1)."""
    h0 = row["fp_h0"] if row["fp_h0"] is not None else 0
    h1 = row["fp_h1"] if row["fp_h1"] is not None else 0
    return f"{int(row['fp_rows'])}:{int(h0):x}:{int(h1):x}"


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows, h0, h1, fingerprint) for the table."""
    agg = df.agg(*fingerprint_exprs(df))
    return agg.select(
        F.col("fp_rows").alias("rows"), F.col("fp_h0").alias("h0"), F.col("fp_h1").alias("h1"),
        F.concat_ws(":", F.col("fp_rows").cast("string"),
                    F.coalesce(F.col("fp_h0"), F.lit(0)).cast("string"),
                    F.coalesce(F.col("fp_h1"), F.lit(0)).cast("string")).alias("fingerprint_decimal"),
    )


def fingerprint_value(df: DataFrame) -> str:
    """Action: the fingerprint text of a table."""
    return fingerprint_text(df.agg(*fingerprint_exprs(df)).collect()[0])
