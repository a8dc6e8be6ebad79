"""Statistics of a binary outcome: rates by category and bin, means by class, correlations,
describe table, histograms, key numbers.

Every per-column statistic for all columns comes from one aggregate or one
``groupBy(column, value)`` over the unpivoted table (one shuffle for all columns), never a job per
column. Values are left unrounded; callers round for display.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from handoff.config import HIST_BINS
from handoff.functions.columns import col_of, nan_to_null, right_closed_bucket
from handoff.operators.profile import is_numeric_field, null_counts
from handoff.operators.quantiles import exact_quantiles


def column_kinds(df: DataFrame, key: str | None = None, target: str | None = None, extra: Sequence[str] = ()) -> dict[str, list[str]]:
    """Columns by how the statistics treat them: text and the listed codes are 'categorical', the
    remaining numbers 'numeric'; key and outcome are neither."""
    kinds: dict[str, list[str]] = {"categorical": [], "numeric": []}
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            kinds["categorical"].append(f.name)
        elif is_numeric_field(f.dataType) and f.name not in {key, target, *extra}:
            kinds["numeric"].append(f.name)
    kinds["categorical"] += [c for c in dict.fromkeys(extra) if c in df.columns and c not in kinds["categorical"]]
    return kinds


def overall_rate(df: DataFrame, target: str) -> DataFrame:
    """n_rows, n_cols, positive_rate, positive_count, negative_share."""
    y = col_of(target)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(y.cast("double")).alias("positive_rate"),
        F.sum(y).cast("long").alias("positive_count"),
    ).select("n_rows", F.lit(len(df.columns)).alias("n_cols"), "positive_rate", "positive_count",
             (1 - F.col("positive_rate")).alias("negative_share"))


def outcome_shares(df: DataFrame, target: str, labels: Sequence[str] = ("stayed", "churned")) -> DataFrame:
    """(outcome, n, share) for the negative and positive class, from one aggregate (no shuffle of rows)."""
    y = col_of(target)
    wide = df.agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))
    total = F.col("n0") + F.col("n1")
    rows = [F.struct(F.lit(label).alias("outcome"), F.col(f"n{i}").alias("n"),
                     F.try_divide(F.col(f"n{i}").cast("double"), total).alias("share")) for i, label in enumerate(labels)]
    return wide.select(F.inline(F.array(*rows)))


def rate_by_category(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, rate) for every value of every listed column; NULL values dropped."""
    parts = [F.struct(F.lit(c).alias("column"), col_of(c).cast("string").alias("value")) for c in columns]
    long = df.select(col_of(target).alias("_y"), F.explode(F.array(*parts)).alias("p")).select("_y", "p.*")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("_y").cast("double")).alias("rate"))


def mean_by_outcome(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """D3: (column, mean_positive, mean_negative) in one aggregate; NULLs ignored, NULL if empty."""
    y = col_of(target)
    dts = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(columns):
        v = nan_to_null(col_of(c), dts[c]).cast("double")
        aggs += [F.avg(F.when(y == 1, v)).alias(f"p{i}"), F.avg(F.when(y == 0, v)).alias(f"q{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"p{i}").alias("mean_positive"),
                     F.col(f"q{i}").alias("mean_negative")) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """(column, r) Pearson r with the outcome over pairwise-complete rows.

    Columns with fewer than two distinct values, or a constant target, are skipped (never an ANSI
    divide-by-zero: r = cov_pop / (sd_pop x * sd_pop y) through ``try_divide``).
    """
    dts = {f.name: f.dataType for f in df.schema.fields}
    y = col_of(target).cast("double")
    aggs = [F.min(y).alias("ymin"), F.max(y).alias("ymax")]
    for i, c in enumerate(columns):
        x = nan_to_null(col_of(c), dts[c]).cast("double")
        xp, yp = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        aggs += [
            F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
            F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp)).alias(f"r{i}"),
        ]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     F.when((F.col(f"mn{i}") < F.col(f"mx{i}")) & (F.col("ymin") < F.col("ymax")),
                            F.col(f"r{i}")).alias("r")) for i, c in enumerate(columns)]
    found = wide.select(F.inline(F.array(*rows))).where(F.col("r").isNotNull() & ~F.isnan("r"))
    return found.orderBy(F.abs("r").desc(), "column")


def top_drivers(corr: DataFrame, k: int = 5) -> DataFrame:
    """The k columns with the largest |r| (ties by name). A top-k report: the limit is the feature."""
    return corr.orderBy(F.abs("r").desc(), F.col("column")).limit(k).select("column", "r")


def rate_by_bin(df: DataFrame, target: str, column: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """(bin, position, n, rate) over right-closed bins; every label listed (rate NULL when empty)."""
    spark = df.sparkSession
    b = right_closed_bucket(col_of(column), edges, labels)
    got = df.select(b.alias("bin"), col_of(target).cast("double").alias("_y")).where(F.col("bin").isNotNull()).groupBy(
        "bin").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("rate"))
    lab = spark.createDataFrame([(l, i) for i, l in enumerate(labels)], "bin string, position int")
    return lab.join(got, "bin", "left").select("bin", "position", F.coalesce("n", F.lit(0)).alias("n"), "rate")


def flag_rates(df: DataFrame, target: str, flag: str) -> DataFrame:
    """Outcome rate where the flag is 1 and where it is 0 (NULL when absent)."""
    y = col_of(target).cast("double")
    return df.agg(F.avg(F.when(col_of(flag) == 1, y)).alias("rate_flag_1"),
                  F.avg(F.when(col_of(flag) == 0, y)).alias("rate_flag_0"))


def null_map(df: DataFrame) -> DataFrame:
    """(column, null_count) for columns with at least one null."""
    return null_counts(df).where(F.col("null_count") > 0).select("column", "null_count")


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max); exact linear percentiles."""
    dts = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.struct(F.lit(c).alias("column"), nan_to_null(col_of(c), dts[c]).cast("double").alias("value"))
             for c in columns]
    long = df.select(F.explode(F.array(*parts)).alias("p")).select("p.*").where(F.col("value").isNotNull())
    basic = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(n)
          for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return basic.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, target: str, columns: Sequence[str], bins: int = HIST_BINS) -> DataFrame:
    """(column, outcome, bin, lo, hi, n) -- ``bins`` equal bins per (column, outcome) series.

    Each series' range is its own min..max; the last bin is closed; a constant series is centred
    on [v - 0.5, v + 0.5] (as numpy does). All ``bins`` bins of every series are listed, empty ones
    with n = 0.
    """
    dts = {f.name: f.dataType for f in df.schema.fields}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), nan_to_null(col_of(c), dts[c]).cast("double").alias("x")) for c in columns])
    long = df.select(col_of(target).alias("outcome"), F.explode(cells).alias("p")).select("outcome", "p.*").where(F.col("x").isNotNull())
    ends = long.groupBy("column", "outcome").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    half = F.when(F.col("low") == F.col("high"), F.lit(0.5)).otherwise(F.lit(0.0))
    ends = ends.select("column", "outcome", (F.col("low") - half).alias("from"), (F.col("high") + half).alias("to"))
    width = (F.col("to") - F.col("from")) / F.lit(float(bins))
    # one row for each series: whether it is broadcast is the planner's choice
    at = F.least(F.floor((F.col("x") - F.col("from")) / width), F.lit(bins - 1)).cast("int")
    counted = long.join(ends, ["column", "outcome"]).groupBy("column", "outcome", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, ["column", "outcome", "bin"], "left").select(
        "column", "outcome", "bin", (F.col("from") + F.col("bin") * width).alias("lo"), (F.col("from") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"))


#: Published measure -> (where it comes from, name there, how it is shown).
KEY_NUMBERS = {
    "outcome: share of positive rows": ("stats", "positive_rate", "share"),
    "outcome: positive rows": ("stats", "positive_count", "count"),
    "outcome: share where the flag is set": ("stats", "flag_rate", "share"),
    "outcome: share in the lowest bin": ("stats", "first_bin_rate", "share"),
    "outcome: closest column": ("stats", "top_column", "name"),
    "outcome: its correlation": ("stats", "top_r", "signed"),
    "table: rows read": ("cleaning", "rows_in", "count"),
    "table: rows kept": ("cleaning", "rows_out", "count"),
    "table: repeated records dropped": ("cleaning", "duplicate_records_dropped", "count"),
    "table: spellings unified": ("cleaning", "fixes", "count"),
    "table: columns with gaps": ("stats", "n_null_columns", "count"),
}
_SHOWN = {"share": "{:.1%}".format, "count": "{:,}".format, "signed": "{:+.2f}".format, "name": str}


def key_numbers(stats: dict, cleaning: dict, spark) -> DataFrame:
    """(position, measure, value) of every published key number, formatted; 'n/a' where there is none."""
    given = {"stats": stats, "cleaning": cleaning}
    rows = []
    for position, (measure, (source, name, how)) in enumerate(KEY_NUMBERS.items()):
        x = given[source].get(name)
        rows.append((position, measure, "n/a" if x is None else _SHOWN[how](x)))
    return spark.createDataFrame(rows, "position int, measure string, value string")


def key_numbers_match(published: DataFrame, fresh: DataFrame) -> bool:
    """A published key-numbers table equals the fresh one (both-way exceptAll is empty)."""
    a, b = published.select("measure", "value"), fresh.select("measure", "value")
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
