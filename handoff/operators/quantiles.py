"""Exact quantiles (linear interpolation, as pandas/numpy) without a single-task percentile buffer.

Values are first counted per (group, value) -- repeated values collapse map-side -- then a
distributed running count per group gives each distinct value its rank span; the two ranks around
``p * (n - 1)`` are joined back and interpolated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.operators.ranking import running_totals


def exact_quantiles(long: DataFrame, probs: Sequence[float], group_by: Sequence[str] = ("column",),
                    value: str = "value", weight: str | None = None) -> DataFrame:
    """(group..., p, quantile) for a long frame of non-null numeric ``value`` per group.

    ``weight`` names a column with the number of rows that a row stands for.
    """
    group_by = list(group_by)
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = long.where(F.col(value).isNotNull()).groupBy(*group_by, value).agg(rows.alias("_c"))
    cum = running_totals(counts, [F.col(value)], {"_cum": F.col("_c")}, group_by)
    cum = cum.withColumn("_start", F.col("_cum") - F.col("_c"))  # ranks [_start, _cum) hold this value
    totals = counts.groupBy(*group_by).agg(F.sum("_c").alias("_n"))
    targets = totals.select(
        "*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    targets = targets.withColumn("_h", F.col("p") * (F.col("_n") - 1)).withColumn(
        "_lo", F.floor("_h")).withColumn("_hi", F.ceil("_h"))

    def at(rank_col: str, name: str) -> DataFrame:
        t = targets.select(*group_by, "p", F.col(rank_col).alias("_r"))
        # t has (#groups x #probs) rows: broadcast by its measured size where it is small, else joined
        # by group, where the engine splits a hot group
        j = cum.select(*group_by, value, "_start", "_cum").join(t, group_by, "inner").where(
            (F.col("_r") >= F.col("_start")) & (F.col("_r") < F.col("_cum")))
        return j.select(*group_by, "p", F.col(value).alias(name))

    lo, hi = at("_lo", "_vlo"), at("_hi", "_vhi")
    out = targets.join(lo, [*group_by, "p"]).join(hi, [*group_by, "p"])
    q = F.col("_vlo") + (F.col("_h") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return out.select(*group_by, "p", q.alias("quantile"))
