from pyspark.sql import functions as F

from handoff.operators import clean as C
from handoff.operators import profile as B
from tests.conftest import CHURN


def test_profile_duplicates(raw_frame):
    d = B.duplicate_counts(raw_frame, "CustomerID").collect()[0]
    assert (d["rows"], d["cols"]) == (10, 20)
    assert d["duplicate_rows"] == 2
    assert d["duplicate_ids"] == 3
    assert d["duplicate_records"] == 3


def test_clean_raw_frame(raw_frame):
    out, rep = C.clean(raw_frame, CHURN)
    ids = [r[0] for r in out.select("CustomerID").orderBy("CustomerID").collect()]
    assert ids == [21, 22, 23, 24, 25, 26]
    r = {(x["section"], x["column"], x["value"]): x["n"] for x in rep.collect()}
    assert r[("rows_in", None, None)] == 10 and r[("rows_out", None, None)] == 6
    assert r[("duplicate_rows_dropped", None, None)] == 2
    assert r[("duplicate_ids_dropped", None, None)] == 1
    assert r[("duplicate_records_dropped", None, None)] == 1
    assert r[("entity_fix", "PreferredLoginDevice", "Phone")] == 2
    assert r[("entity_fix", "PreferredPaymentMode", "CC")] == 1
    assert r[("entity_fix", "PreferredPaymentMode", "COD")] == 1
    assert r[("entity_fix", "PreferedOrderCat", "Mobile")] == 3
    nulls = {k[1]: v for k, v in r.items() if k[0] == "nulls_kept"}
    assert nulls == {"Tenure": 1, "OrderCount": 1}
    assert dict(out.dtypes)["CustomerID"] == "bigint"
    assert C.reconcile(rep, out).collect()[0]["drops_add_up"]
    assert C.unmapped_spellings(out, CHURN.entity_map).count() == 0
    assert C.null_reconciliation(out, rep).count() == 0


def test_clean_is_idempotent(raw_frame):
    once, _ = C.clean(raw_frame, CHURN)
    twice, rep = C.clean(once, CHURN)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))  # NaN equals nothing
    r = {x["section"]: x["n"] for x in rep.collect() if x["column"] is None}
    assert r["duplicate_rows_dropped"] == r["duplicate_ids_dropped"] == r["duplicate_records_dropped"] == 0


def test_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([("  a\t",), (" b ",), (None,)], "s string")
    assert [r[0] for r in C.strip_text_columns(df).collect()] == ["a", "b", None]


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert B.null_counts(df).collect()[0]["null_count"] == 2
    st = B.column_stats(df).collect()[0]
    assert st["max"] == 1.0 and st["std"] is None  # NaN never leaks into max; one value -> no std


def test_keep_first_uses_order(spark):
    df = spark.createDataFrame([(1, 5, "late"), (1, 2, "early"), (2, 9, "only")], "k long, o long, v string")
    out = {r["k"]: r["v"] for r in C.keep_first(df, "k", ["o"]).collect()}
    assert out == {1: "early", 2: "only"}


def test_samples_most_frequent_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("c",), (None,)], "t string")
    got = [r["value"] for r in B.sample_values(df, 2).orderBy("rank").collect()]
    assert got == ["b", "c"]  # tie on count broken by value


def test_profile_invariant_under_repartition(spark):
    df = spark.range(0, 500).select((F.col("id") % 37).alias("a"), (F.col("id") % 11).cast("string").alias("b"))
    a = sorted(B.profile_columns(df).collect())
    b = sorted(B.profile_columns(df.repartition(7, "b").sortWithinPartitions(F.rand(1))).collect())
    assert a == b


def test_approx_distinct_close_to_exact(spark):
    df = spark.range(0, 20000).select((F.col("id") % 5000).alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    exact = {r["column"]: r["n_unique"] for r in B.distinct_counts(df).collect()}
    approx = {r["column"]: r["n_unique"] for r in B.distinct_counts(df, exact=False).collect()}
    assert exact == {"a": 5000, "b": 7}
    assert abs(approx["a"] - 5000) <= 150 and approx["b"] == 7


def test_fractions_are_not_cast_away(spark):
    df = spark.createDataFrame([(1.0, 1.7, 2.0), (3.0, 2.0, None)], "whole double, part double, gap double")
    out, cast = C.cast_ints(df, ["whole", "part", "gap", "absent"])
    assert cast == ["whole"] and dict(out.dtypes) == {"whole": "bigint", "part": "double", "gap": "double"}
    assert [r["part"] for r in out.orderBy("whole").collect()] == [1.7, 2.0]
