import itertools

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from handoff.operators import evaluate as K
from handoff.operators import features as H
from handoff.operators.quantiles import exact_quantiles
from handoff.operators.ranking import row_numbers, running_totals

SOURCES = {"cashback": "CashbackAmount", "orders": "OrderCount", "tenure": "Tenure", "coupons": "CouponUsed",
           "recency": "DaySinceLastOrder"}


def test_engineered_ratios(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 4.0, 3.0, 2.0, 0.0), (2, 50.0, 0.0, 5.0, 0.0, 3.0), (3, 50.0, None, 5.0, 1.0, 7.0),
         (4, 60.0, 2.0, None, 1.0, 14.0), (5, 1.0, 1.0, 1.0, 1.0, 15.0)],
        "id long, CashbackAmount double, OrderCount double, Tenure double, CouponUsed double, DaySinceLastOrder double")
    out = {r["id"]: r for r in H.add_engineered(df, SOURCES).collect()}
    assert out[1]["cashback_per_order"] == 25.0 and out[1]["coupon_rate"] == 0.5
    assert abs(out[1]["orders_per_tenure_month"] - 1.0) < 1e-12
    assert out[2]["cashback_per_order"] is None and out[2]["orders_per_tenure_month"] == 0.0
    assert out[3]["cashback_per_order"] is None
    assert out[4]["orders_per_tenure_month"] is None
    assert [out[i]["recency_bucket"] for i in (1, 2, 3, 4, 5)] == ["0-3", "0-3", "4-7", "8-14", "15+"]


def test_nan_is_missing_in_rates_and_bins(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 10.0, nan, 2.0, 1.0, nan), (2, nan, 2.0, nan, nan, 15.0), (3, 10.0, 2.0, 1.0, 1.0, float("inf"))],
                               "id long, CashbackAmount double, OrderCount double, Tenure double, CouponUsed double, DaySinceLastOrder double")
    out = {r["id"]: r for r in H.add_engineered(df, SOURCES).collect()}
    assert [out[1][c] for c in H.ENGINEERED] == [None] * 4
    assert out[2]["cashback_per_order"] is None and out[2]["orders_per_tenure_month"] is None and out[2]["recency_bucket"] == "15+"
    assert out[3]["cashback_per_order"] == 5.0 and out[3]["recency_bucket"] == "15+"


def test_auc_of_counts_whose_product_is_no_long(spark):
    from handoff.operators.evaluate import _auc_expr
    big = 4_000_000_000
    df = spark.createDataFrame([(big, 0, big, 0, big, big), (0, big, big, big, big, big)], "_pos long, _neg long, _cpos long, _cneg long, _P long, _N long")
    assert df.agg(_auc_expr().alias("auc")).first()["auc"] == 0.0


def _scores(spark, y, p):
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "id long, y int, proba double")


def brute_auc(y, p):
    pos = [b for a, b in zip(y, p) if a == 1]
    neg = [b for a, b in zip(y, p) if a == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def brute_ap(y, p):
    P = sum(y)
    out, prev = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp = sum(1 for a, b in zip(y, p) if b >= t and a == 1)
        k = sum(1 for b in p if b >= t)
        rec = tp / P
        out += (rec - prev) * tp / k
        prev = rec
    return out


def test_auc_and_ap_match_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.random(300), 2)  # many ties
    s = _scores(spark, y, p)
    assert abs(K.roc_auc(s).collect()[0][0] - brute_auc(y, p)) < 1e-12
    assert abs(K.average_precision(s).collect()[0][0] - brute_ap(y, p)) < 1e-12


def test_baseline(spark):
    b = K.majority_baseline(_scores(spark, [0, 0, 0, 1], [0.1] * 4)).collect()[0]
    assert b["predicted_class"] == 0 and b["accuracy"] == 0.75 and b["pr_auc"] == 0.25 and b["roc_auc"] == 0.5
    assert b["precision"] == b["recall"] == b["f1"] == 0.0


def test_precision_at_top(spark):
    y = [1, 1, 0, 0, 0, 0, 0, 0, 0, 0]
    good = _scores(spark, y, [0.9, 0.8] + [0.1] * 8)
    bad = _scores(spark, y, [0.1, 0.1] + [0.9] * 8)
    assert K.precision_at_top(good, "id").collect()[0][0] == 1.0
    assert K.precision_at_top(bad, "id").collect()[0][0] == 0.0


def test_fairness(spark):
    rows = [(0, 1, 1.0, "Male"), (1, 1, 0.0, "Male"), (2, 0, 0.0, "Male"), (3, 0, 0.0, "Male"),
            (4, 1, 1.0, "Female"), (5, 1, 1.0, "Female"), (6, 0, 1.0, "Female"), (7, 0, 0.0, "Female"),
            (8, 0, 1.0, None)]
    s = spark.createDataFrame(rows, "id long, y int, proba double, g string")
    f = {r["group"]: r for r in K.fairness(s, ["g"]).collect()}
    assert set(f) == {"Male", "Female"}
    assert (f["Male"]["recall"], f["Male"]["precision"], f["Male"]["positive_rate"]) == (0.5, 1.0, 0.25)
    assert f["Female"]["recall"] == 1.0 and abs(f["Female"]["precision"] - 2 / 3) < 1e-12
    assert f["Female"]["positive_rate"] == 0.75


def test_row_numbers_match_window(spark):
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1000).alias("v"), "id")
    got = row_numbers(df, [F.col("v"), F.col("id")], ["g"], name="rn", n_partitions=5)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_running_totals_desc(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)], "k long, x double")
    got = {r["k"]: r["c"] for r in running_totals(df, [F.col("x").desc()], {"c": F.col("x")}, n_partitions=4).collect()}
    assert got[0] == sum(range(100)) and got[99] == 99.0


def test_exact_quantiles_match_numpy(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([("a", v) for v in vals], "column string, value double")
    got = {r["p"]: r["quantile"] for r in exact_quantiles(df, [0.25, 0.5, 0.75]).collect()}
    for p in (0.25, 0.5, 0.75):
        assert abs(got[p] - float(np.quantile(vals, p))) < 1e-12
