"""Column names with dots, blanks and back quotes, through every family of operators."""

import pytest
from pyspark.sql import functions as F

from handoff.config import Config
from handoff.functions.columns import col_of, row_hash
from handoff.operators import clean as C
from handoff.operators import contract as E
from handoff.operators import evaluate as K
from handoff.operators import faults as G
from handoff.operators import outcome as D
from handoff.operators import profile as B
from handoff.operators import validate as V
from handoff.sources import artifacts as A
from handoff.sources import fingerprint as P
from handoff.sources import tables as T

KEY, TARGET, NUM, TEXT, FLAG = "the.key", "left`us", "a.b", "kind of. thing", "a"
CFG = Config(primary_key=KEY, target=TARGET, protected=("zone.x",), entity_map={TEXT: {"ph": "phone"}}, units={NUM: "kg"}, int_columns=(KEY, NUM))


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, i % 2, float(i * 3 % 7), ["phone", "mail", " ph "][i % 3], i % 2, "n" if i % 4 else "s") for i in range(24)]
    out = spark.createDataFrame(rows, "k long, y int, n double, t string, f int, z string")
    return out.toDF(KEY, TARGET, NUM, TEXT, FLAG, "zone.x")


def test_profile(table):
    assert {r["column"]: r["n_unique"] for r in B.profile_columns(table).collect()}[NUM] == 7
    assert B.duplicate_counts(table.unionByName(table.limit(3)), KEY).first().asDict() == {
        "rows": 27, "cols": 6, "duplicate_rows": 3, "duplicate_ids": 3, "duplicate_records": 27 - table.drop(KEY).distinct().count()}
    assert B.sample_values(table).where(F.col("column") == TEXT).count() == 3
    assert B.null_counts(table).count() == 6


def test_nulls_in_different_columns_are_different_rows(spark):
    df = spark.createDataFrame([(1, None), (None, 1)], "a long, b long")
    assert df.select(row_hash(df.columns, 1).alias("h")).distinct().count() == 2
    assert B.duplicate_counts(df, None).first()["duplicate_rows"] == 0


def test_clean(table):
    messy = table.unionByName(table.limit(5))
    out, report = C.clean(messy, CFG)
    assert out.columns == table.columns and dict(out.dtypes)[NUM] == "bigint"
    n = {r["section"]: r["n"] for r in report.where("column IS NULL").collect()}
    same = table.drop(KEY).distinct().count()
    assert (n["rows_in"], n["rows_out"], n["duplicate_rows_dropped"], n["duplicate_records_dropped"]) == (29, out.count(), 5, 24 - out.count())
    assert out.count() <= same
    assert C.reconcile(report, out).first()["rows_match"]
    assert C.keep_first(messy, KEY, [NUM]).columns == table.columns
    assert C.unmapped_spellings(C.strip_text_columns(messy), CFG.entity_map).first()["n"] == 8 + 1


def test_contract_faults_and_validation(spark, table):
    clean, _ = C.clean(table, CFG)
    c = E.build_contract(clean, CFG)
    assert set(c.names()) == set(table.columns)
    report = V.validate(clean, c, check_fingerprint=True)
    assert report.where("passed = false").count() == 0 and report.where(F.col("check") == "integrity").first()["passed"]
    faulty, c2 = G.tamper(clean, c, "unit_change", NUM)
    assert [r["check"] for r in V.validate(faulty, c2).where("passed = false").collect()] == ["range"]
    faulty, c2 = G.tamper(clean, c, "row_loss", KEY)
    assert [r["check"] for r in V.validate(faulty, c2).where("passed = false").collect()] == ["rows"]
    path = A.scratch_path(spark, "contract")
    A.write_contract(c, path)
    assert E.contract_drift(E.measured_fields(c), E.measured_fields(A.read_contract(spark, path))).count() == 0


def test_outcome(table):
    assert D.overall_rate(table, TARGET).first()["positive_count"] == 12
    assert {r["column"] for r in D.rate_by_category(table, TARGET, [TEXT, "zone.x"]).collect()} == {TEXT, "zone.x"}
    assert D.flag_rates(table, TARGET, FLAG).first()["rate_flag_1"] == 1.0
    assert D.describe_table(table, [NUM]).first()["p50"] == 3.0
    assert D.correlations(table, TARGET, [NUM, FLAG]).count() == 2
    assert D.mean_by_outcome(table, TARGET, [NUM]).first()["column"] == NUM
    assert D.rate_by_bin(table, TARGET, NUM, (-1, 3, 9), ("low", "high")).agg(F.sum("n")).first()[0] == 24


def test_evaluation_tables_and_fingerprint(spark, table):
    scores = table.withColumn("p.p", col_of(NUM) / 7)
    auc = K.roc_auc(scores, TARGET, "p.p").first()["roc_auc"]
    plain = K.roc_auc(scores.select(col_of(TARGET).alias("y"), col_of("p.p").alias("proba"))).first()["roc_auc"]
    assert auc == plain
    assert K.precision_at_top(scores, KEY, TARGET, "p.p").first()["k"] == 2
    assert K.fairness(scores, ["zone.x"], TARGET, "p.p").count() == 2
    assert K.classification_metrics(scores, TARGET, "p.p", ["zone.x"]).count() == 2
    assert P.fingerprint_value(table) == P.fingerprint_value(table.repartition(3))
    assert T.write_table(table, A.scratch_path(spark, "t"), KEY) == P.fingerprint_value(table)
    assert T.locate_header(spark.createDataFrame([(0, "Variable", "text"), (1, "x", "y")], "line long, c0 string, c1 string").withColumnsRenamed(
        {"line": "l.l", "c0": "c.0"}), "Variable", "l.l").count() == 1
