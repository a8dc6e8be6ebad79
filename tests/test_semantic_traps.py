"""Semantic traps when moving from one in-memory frame to Spark (ANSI division, right-closed bins,
population vs sample std, integer-with-nulls class, interpolated quantiles)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from handoff.operators import contract as E
from handoff.operators import outcome as D
from handoff.plans import train as J
from handoff.plans import views


def test_constant_column_is_skipped_not_a_divide_by_zero(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0), (1, 2.0, 5.0), (0, 3.0, 5.0), (1, None, 5.0)], "y int, x double, c double")
    got = {r["column"]: r["r"] for r in D.correlations(df, "y", ["x", "c"]).collect()}
    assert set(got) == {"x"}  # the constant column has no correlation (ANSI mode would raise)
    const_target = df.withColumn("y", F.lit(1))
    assert D.correlations(const_target, "y", ["x"]).count() == 0


def test_bins_are_right_closed_and_all_listed(spark):
    # edges (-0.5, 1.5], (1.5, 6.5], (6.5, 12.5], (12.5, inf); 1.5 is in the first bin, 6.5 in the second
    df = spark.createDataFrame([(1, 1.5), (0, 1.6), (1, 6.5), (0, None), (1, float("nan"))], "y int, t double")
    got = {r["bin"]: (r["n"], r["rate"]) for r in
           D.rate_by_bin(df, "y", "t", views.TENURE_EDGES, views.TENURE_LABELS).collect()}
    assert got["0-1"] == (1, 1.0)
    assert got["2-6"] == (2, 0.5)
    assert got["7-12"] == (0, None) and got["13+"] == (0, None)  # empty bins are listed, rate NULL
    assert sum(n for n, _ in got.values()) == 3  # NULL and NaN are in no bin


def test_standardise_uses_population_std_and_zero_variance_divides_by_one(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, k double")
    st = J.fit_prep(df, ["a", "k"], [])
    assert st.stds["a"] == pytest.approx(1.0)  # population std of {1, 3}; the sample std would be 1.414
    out = J.apply_prep(df, st).collect()
    assert sorted(r["a"] for r in out) == pytest.approx([-1.0, 1.0])
    assert [r["k"] for r in out] == [0.0, 0.0]


def test_an_unseen_category_is_all_zeros(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    seen = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, n double")
    model = Pipeline(stages=J.encoder_stages(["n"], ["c"])).fit(seen)
    new = spark.createDataFrame([("a", 1.0), ("z", 3.0)], "c string, n double")
    got = {r["c"]: r["v"] for r in model.transform(new).select("c", vector_to_array("features").alias("v")).collect()}
    assert got == {"a": [1.0, 1.0, 0.0], "z": [3.0, 0.0, 0.0]}


def test_integer_column_with_nulls_is_float():
    assert E.classify(LongType(), 0) == "int"
    assert E.classify(LongType(), 3) == "float"


def test_describe_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    r = D.describe_table(df, ["v"]).collect()[0]
    assert r["p50"] == 2.5 and r["p25"] == 1.75 and r["p75"] == 3.25  # linear interpolation, not 2.0
    assert r["std"] == pytest.approx(1.2909944487)  # sample std here
