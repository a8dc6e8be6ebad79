"""Registered queries: one per operator of the inventory, each over the given tables (whole).

Every query takes (spark, sf_dir) and returns a DataFrame whose column names match the SQL twin
in ``handoff.plans.oracle``. Floating results of sums/averages are rounded to 6 places here and in
the SQL (summation order differs between engines; values stay unrounded inside the operators).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from handoff.functions.columns import knuth_hash
from handoff.operators import clean as C
from handoff.operators import contract as E
from handoff.operators import faults as G
from handoff.operators import outcome as D
from handoff.operators import profile as B
from handoff.operators import validate as V
from handoff.config import Config
from handoff.plans import views
from handoff.sources import workbook
from handoff.plans.kept import kept_per_input
from handoff.plans.views import SNAPSHOT_CONFIG as CFG
from handoff.session import reliable_checkpoint, write_shared

R = 6
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]
REQUIRED = ["cashback", "order_count", "tenure_months", "coupon_used", "days_since_last"]
# Which column each fault preset breaks in the snapshot.
FAULT_COLUMNS = {
    "unit_change": "cashback",
    "rename_column": "order_count",
    "drop_contract_field": "tenure_months",
    "bad_category": "segment",
    "dtype_change": "region_key",
    "row_loss": "customer_id",
}
BAD_SPELLING = "AUTO"


def rnd(df: DataFrame, digits: int = R) -> DataFrame:
    """Round every floating column (display/oracle comparison only)."""
    scale = float(10 ** digits)  # round(x * 10^d) / 10^d: the same double arithmetic as the SQL twin's round(x, d)
    return df.select(*[(F.round(F.col(f.name) * scale) / scale).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
                       else F.col(f.name) for f in df.schema.fields])


def t(spark, sf, name):
    return views.table(spark, sf, name)


def snap(spark, sf):
    return views.customer_snapshot(spark, sf)


@kept_per_input
def _snapshot(spark, sf):
    """The snapshot written once, for queries that go over it several times."""
    return write_shared(snap(spark, sf), "snapshot")


# ---------------------------------------------------------------- A sources
def a1_read_raw(spark, sf):
    return t(spark, sf, "customer")


def a3_read_typed(spark, sf):
    """A3: the customers as CSV, one segment in four written as a null token, read back with a schema."""
    from handoff.sources.artifacts import scratch_path
    from handoff.sources.tables import NULL_TOKENS, read_table
    token = F.element_at(F.array(*[F.lit(x) for x in NULL_TOKENS]), (F.pmod(F.col("c_custkey"), F.lit(len(NULL_TOKENS))) + 1).cast("int"))
    rows = t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.when(
        F.col("c_custkey") % 4 == 0, token).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    path = scratch_path(spark, "customers-csv")
    rows.write.option("header", True).csv(path)
    return read_table(spark, path, fmt="csv", schema="c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                      null_tokens=NULL_TOKENS)


# ---------------------------------------------------------------- B profile
def b1_shape(spark, sf):
    return B.duplicate_counts(t(spark, sf, "lineitem"), LINE_KEY).select("rows", "cols")


def b2_null_counts(spark, sf):
    return B.null_counts(snap(spark, sf)).select("column", "null_count")


def b3_distinct_counts(spark, sf):
    return B.distinct_counts(t(spark, sf, "lineitem"))


def b4a_text_samples(spark, sf):
    li = t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    o = t(spark, sf, "orders").select("o_orderpriority", "o_orderstatus")
    return B.sample_values(li).unionByName(B.sample_values(o))


def b4b_numeric_samples(spark, sf):
    li = t(spark, sf, "lineitem")
    return B.sample_values(li.select(*[f.name for f in li.schema.fields if not isinstance(f.dataType, StringType)]))


def b5_numeric_stats(spark, sf):
    return rnd(B.column_stats(snap(spark, sf)).where(F.col("min").isNotNull()).select(
        "column", "min", "max", "mean", "std"))


def b6_duplicate_rows(spark, sf):
    return B.duplicate_counts(views.customer_raw(spark, sf), CFG.primary_key)


def b7_duplicate_ids(spark, sf):
    return B.duplicate_counts(t(spark, sf, "lineitem"), LINE_KEY).select("rows", "duplicate_rows", "duplicate_ids")


def b8_duplicate_records(spark, sf):
    return B.duplicate_counts(t(spark, sf, "documents"), "doc_id").select("rows", "duplicate_records")


def b9_dtypes(spark, sf):
    df = t(spark, sf, "lineitem")
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("dtype"), F.col(c).alias("filled")) for c, k in df.dtypes]
    return filled.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- C cleaning
def raw(spark, sf):
    return views.customer_raw(spark, sf)


def c1_strip(spark, sf):
    return C.strip_text_columns(raw(spark, sf)).select("customer_id", "segment", "payment_mode", "nation")


def c2_entity_map(spark, sf):
    return C.apply_entity_map(C.strip_text_columns(raw(spark, sf)), CFG.entity_map).select(
        "customer_id", "segment", "payment_mode")


def c3_fix_counts(spark, sf):
    return C.entity_fix_counts(C.strip_text_columns(raw(spark, sf)), CFG.entity_map)


def c4_drop_exact(spark, sf):
    mapped = C.apply_entity_map(C.strip_text_columns(raw(spark, sf)), CFG.entity_map)
    return rnd(C.drop_exact(mapped))


def c5_keep_first(spark, sf):
    return C.keep_first(t(spark, sf, "lineitem"), LINE_KEY, LINE_ORDER)


def c6_same_records(spark, sf):
    docs = C.drop_same_records(t(spark, sf, "documents"), "doc_id")
    return docs.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


@kept_per_input
def _cleaned(spark, sf):
    return C.clean(raw(spark, sf), CFG, order_by=["account_balance"])


def c7_cast_ints(spark, sf):
    out, _ = _cleaned(spark, sf)
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in out.schema.fields],
                                 "column string, dtype string")


def c7_cast_whole_numbers(spark, sf):
    """C7 over order lines: whole quantities become bigint, prices with cents stay as they are."""
    out, cast = C.cast_ints(t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    kinds = dict(out.dtypes)
    return out.agg(F.sum(F.col("l_quantity")).cast("double").alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price")).select(
        F.lit(kinds["l_quantity"]).alias("quantity_type"), F.lit(kinds["l_extendedprice"]).alias("price_type"), "quantity", F.round("price", 0).alias("price"))


def c8_clean_table(spark, sf):
    out, _ = _cleaned(spark, sf)
    return rnd(out)


def c10_cleaning_report(spark, sf):
    _, rep = _cleaned(spark, sf)
    return rep


def c11_reconcile(spark, sf):
    out, rep = _cleaned(spark, sf)
    return C.reconcile(rep, out)


def c11_reconcile_cases(spark, sf):
    """C11: the report against the table it speaks of, and against one that lost every tenth customer."""
    out, rep = _cleaned(spark, sf)
    cases = [("whole", out), ("rows lost", out.where(F.col("customer_id") % 10 != 0))]
    return reduce(DataFrame.unionByName, [C.reconcile(rep, df).withColumn("case", F.lit(name)) for name, df in cases])


def c12_unmapped_before_mapping(spark, sf):
    """Spellings that are left where the map was not applied."""
    return C.unmapped_spellings(C.strip_text_columns(raw(spark, sf)), CFG.entity_map)


def c13_null_reconcile_cases(spark, sf):
    """Columns whose nulls are not those of the report, after cells of every fifth customer were emptied."""
    out, rep = _cleaned(spark, sf)
    gone = F.col("customer_id") % 5 == 0
    emptied = out.withColumns({c: F.when(~gone, F.col(c)) for c in ("account_balance", "segment", "cashback")})
    return C.null_reconciliation(emptied, rep)


def c12_unmapped(spark, sf):
    out, _ = _cleaned(spark, sf)
    return C.unmapped_spellings(out, CFG.entity_map)


def c13_null_reconcile(spark, sf):
    out, rep = _cleaned(spark, sf)
    return C.null_reconciliation(out, rep)


# ---------------------------------------------------------------- D outcome statistics
def _cats(df):
    return D.column_kinds(df, CFG.primary_key, CFG.target, CFG.categorical_extra)["categorical"]


def _nums(df):
    return D.column_kinds(df, CFG.primary_key, CFG.target, CFG.categorical_extra)["numeric"]


def d1_overall_rate(spark, sf):
    return rnd(D.overall_rate(snap(spark, sf), CFG.target))


def d2_rate_by_category(spark, sf):
    s = snap(spark, sf)
    return rnd(D.rate_by_category(s, CFG.target, _cats(s)))


def d3_mean_by_outcome(spark, sf):
    s = snap(spark, sf)
    return rnd(D.mean_by_outcome(s, CFG.target, _nums(s)))


def d4_correlations(spark, sf):
    s = snap(spark, sf)
    return rnd(D.correlations(s, CFG.target, _nums(s)))


def d5_top_drivers(spark, sf):
    s = snap(spark, sf)
    return rnd(D.top_drivers(D.correlations(s, CFG.target, _nums(s)), 5))


def d6_rate_by_bin(spark, sf):
    return rnd(D.rate_by_bin(snap(spark, sf), CFG.target, "tenure_months", views.TENURE_EDGES, views.TENURE_LABELS))


def d7_flag_rates(spark, sf):
    return rnd(D.flag_rates(snap(spark, sf), CFG.target, views.FLAG_COLUMN))


def d8_null_map(spark, sf):
    return D.null_map(snap(spark, sf))


def d9_describe(spark, sf):
    s = snap(spark, sf)
    return rnd(D.describe_table(s, _nums(s)))


def d10_histogram(spark, sf):
    s = snap(spark, sf)
    return rnd(D.histogram(s, CFG.target, _nums(s)))


def d11_outcome_shares(spark, sf):
    return rnd(D.outcome_shares(snap(spark, sf), CFG.target))


# ---------------------------------------------------------------- E contract
@kept_per_input
def _contract(spark, sf):
    return E.build_contract(_snapshot(spark, sf), CFG, source="customer_snapshot")


SPEC = ["name", "position", "dtype", "role", "unit", "nullable", "null_count", "n_allowed", "min", "max"]


def e9_contract(spark, sf):
    return _contract(spark, sf).columns.select(*SPEC)


def e6_units_descriptions(spark, sf):
    c = E.build_contract(snap(spark, sf), CFG, source="customer_snapshot", dictionary=views.SNAPSHOT_DESCRIPTIONS)
    return c.columns.select("name", "unit", "description")


def e4_allowed_values(spark, sf):
    return _contract(spark, sf).allowed


def e7_dataset(spark, sf):
    d = _contract(spark, sf).dataset
    return spark.createDataFrame([(d["row_count"], d["primary_key"], d["target"], d["target_positive_rate"])],
                                 "row_count long, primary_key string, target string, target_positive_rate double")


def e10_human_fields(spark, sf):
    c = E.apply_human_fields(_contract(spark, sf), {"cashback": "money back on orders"},
                             {"churned": "no order after the cut-off"})
    return c.columns.select("name", "description", "rationale", "null_count")


def e11_measured(spark, sf):
    return E.measured_fields(_contract(spark, sf)).select("name", "dtype", "role", "null_count", "min", "max")


def e12_drift(spark, sf):
    committed = E.measured_fields(_contract(spark, sf))
    fresh_df, _ = G.tamper(snap(spark, sf), _contract(spark, sf), "unit_change", "cashback")
    fresh = E.measured_fields(E.build_contract(fresh_df, CFG))
    return E.contract_drift(committed, fresh)


def e12_drift_of_large_sets(spark, sf):
    """E12 over a value set as large as the table: texts in upper case are another set of as many values."""
    cfg = Config(primary_key="doc_id", target="in_english")
    docs = t(spark, sf, "documents").select("doc_id", "text", "lang", (F.col("lang") == "en").cast("int").alias("in_english"))
    now = E.build_contract(docs, cfg)
    other = E.build_contract(docs.withColumn("text", F.concat(F.lit("x"), "text")), cfg)
    drift = E.contract_drift(E.measured_fields(now), E.measured_fields(other))
    n = now.columns.where("name = 'text'").select("n_allowed")
    size = n.first()[0]
    return drift.select("name", "field", F.lit(size).cast("long").alias("n_values"))


def e12_missing_rationale(spark, sf):
    c = E.apply_human_fields(_contract(spark, sf), {}, {"churned": "no order after the cut-off", "cashback": "  "})
    return E.missing_rationale(c.columns)


def e13_display_rows(spark, sf):
    return E.display_rows(_contract(spark, sf)).select("position", "name", "dtype", "role", "unit",
                                                               "constraint", "nulls")


def e1_dtypes(spark, sf):
    return _contract(spark, sf).columns.select("name", "dtype")


def e2_roles(spark, sf):
    return _contract(spark, sf).columns.select("name", "role")


def e3_nulls(spark, sf):
    return _contract(spark, sf).columns.select("name", "nullable", "null_count")


def e5_ranges(spark, sf):
    return _contract(spark, sf).columns.where(F.col("dtype").isin("int", "float")).select("name", "min", "max")


def e8_refuse_missing_roles(spark, sf):
    """A table without its key or target is refused before any job, naming what is missing."""
    s = snap(spark, sf)
    cases = [("snapshot", s), ("without key", s.drop(CFG.primary_key)), ("without target", s.drop(CFG.target)),
             ("without key and target", s.drop(CFG.primary_key, CFG.target))]
    rows = []
    for name, df in cases:
        missing = E.missing_roles(df.columns, CFG)
        message = None
        if missing:
            try:
                E.build_contract(df, CFG)
            except ValueError as e:
                message = str(e).split(";")[0]
        rows.append((name, df.count(), message is not None, ", ".join(missing), message))
    return spark.createDataFrame(rows, "case string, n_rows long, refused boolean, missing string, message string")


# ---------------------------------------------------------------- F validation, G faults
REPORT_COLS = ["check", "column", "passed", "observed", "expected", "hint"]


def _report(spark, sf, preset=None):
    s, c = snap(spark, sf), _contract(spark, sf)
    if preset:
        s, c = G.tamper(s, c, preset, FAULT_COLUMNS[preset], seed=CFG.seed, raw_value=BAD_SPELLING,
                        order=knuth_hash(F.col(CFG.primary_key), CFG.seed))
    return V.validate(s, c, REQUIRED).select(*REPORT_COLS)


def f_validate_clean(spark, sf):
    return _report(spark, sf)


def f_validate_unit_change(spark, sf):
    return _report(spark, sf, "unit_change")


def f_validate_rename_column(spark, sf):
    return _report(spark, sf, "rename_column")


def f_validate_drop_contract_field(spark, sf):
    return _report(spark, sf, "drop_contract_field")


def f_validate_bad_category(spark, sf):
    return _report(spark, sf, "bad_category")


def f_validate_dtype_change(spark, sf):
    return _report(spark, sf, "dtype_change")


def f_validate_row_loss(spark, sf):
    return _report(spark, sf, "row_loss")


def f13_summary(spark, sf):
    rep = V.validate(*G.tamper(snap(spark, sf), _contract(spark, sf), "unit_change", "cashback"), REQUIRED)
    return V.summarise(rep).select("passed", "n_checks", "n_failed", F.array_join("failed", "|").alias("failed"))


def f14_failures(spark, sf):
    rep = V.validate(*G.tamper(snap(spark, sf), _contract(spark, sf), "unit_change", "cashback"), REQUIRED)
    return V.failures(rep).select("check", "column", "hint")


def _tampered(spark, sf, preset):
    s, c = _snapshot(spark, sf), _contract(spark, sf)
    return G.tamper(s, c, preset, FAULT_COLUMNS[preset], seed=CFG.seed, raw_value=BAD_SPELLING,
                    order=knuth_hash(F.col(CFG.primary_key), CFG.seed))


def g1_unit_change(spark, sf):
    return rnd(_tampered(spark, sf, "unit_change")[0].select("customer_id", "cashback"))


def g2_rename_column(spark, sf):
    return _tampered(spark, sf, "rename_column")[0].select("customer_id", "ordercount")


def g3_drop_contract_field(spark, sf):
    return _tampered(spark, sf, "drop_contract_field")[1].columns.select("name", "position")


def g4_bad_category(spark, sf):
    return _tampered(spark, sf, "bad_category")[0].select("customer_id", "segment")


def g5_dtype_change(spark, sf):
    return _tampered(spark, sf, "dtype_change")[0].select("customer_id", "region_key")


def g6_row_loss(spark, sf):
    return _tampered(spark, sf, "row_loss")[0].select("customer_id")


def g7_fault_matrix(spark, sf):
    m = G.fault_matrix(snap(spark, sf), _contract(spark, sf), FAULT_COLUMNS, BAD_SPELLING, CFG.seed, REQUIRED)
    return m.select("preset", "expected_check", F.array_join("failed", "|").alias("failed"), "caught", "only_expected")


# ---------------------------------------------------------------- H features
from handoff.operators import evaluate as K  # noqa: E402
from handoff.operators import features as H  # noqa: E402
from handoff.operators import runs as L  # noqa: E402


def h1_feature_names(spark, sf):
    return spark.createDataFrame(list(enumerate(H.raw_feature_names(_contract(spark, sf)))), "position int, name string")


def h2_feature_split(spark, sf):
    num, cat = H.feature_columns(_contract(spark, sf))
    return spark.createDataFrame([(n, "numeric") for n in num] + [(n, "categorical") for n in cat], "name string, kind string")


def h3_leakage(spark, sf):
    offenders = H.leakage_offenders(snap(spark, sf).columns, _contract(spark, sf), CFG)
    return spark.createDataFrame([(o,) for o in offenders], "offender string")


def h4_engineered(spark, sf):
    e = H.add_engineered(snap(spark, sf), views.FEATURE_SOURCES)
    return rnd(e.select("customer_id", *H.ENGINEERED))


def h5_orders_per_month(spark, sf):
    e = H.add_engineered(snap(spark, sf), views.FEATURE_SOURCES)
    return rnd(e.select("customer_id", "orders_per_tenure_month"))


def h6_recency_bucket(spark, sf):
    e = H.add_engineered(snap(spark, sf), views.FEATURE_SOURCES)
    return rnd(e.select("customer_id", "days_since_last", "recency_bucket"))


def h7_refuse_missing_sources(spark, sf):
    """H7: engineering refuses a table that lacks a source column, listing every missing one."""
    s = snap(spark, sf)
    cases = [("snapshot", s), ("without order_count and days_since_last", s.drop("order_count", "days_since_last"))]
    rows = []
    for name, df in cases:
        missing = H.missing_sources(df.columns, views.FEATURE_SOURCES)
        try:
            n = H.add_engineered(df, views.FEATURE_SOURCES).where(F.col("recency_bucket").isNotNull()).count()
            refused = False
        except ValueError:
            n, refused = None, True
        rows.append((name, df.count(), refused, ", ".join(missing), n))
    return spark.createDataFrame(rows, "case string, n_rows long, refused boolean, missing string, n_bucketed long")


def h8_refuse_undeclared(spark, sf):
    """H8: features refuse columns the contract does not declare and declared columns that are absent."""
    s, c = snap(spark, sf), _contract(spark, sf)
    cases = [("snapshot", s), ("extra column", s.withColumn("note", F.lit("x"))),
             ("without tenure_months", s.drop("tenure_months"))]
    rows = []
    for name, df in cases:
        undeclared, absent = H.declaration_mismatch(df.columns, c, CFG)
        try:
            n = H.build_features(df, c, CFG, views.FEATURE_SOURCES).count()
            refused = False
        except ValueError:
            n, refused = None, True
        rows.append((name, refused, ", ".join(undeclared), ", ".join(absent), n))
    return spark.createDataFrame(rows, "case string, refused boolean, undeclared string, absent string, n_rows long")


def h4_engineered_nan(spark, sf):
    """H4-H6 with NaN in place of every missing number and of one order count in seven: the same NULLs."""
    s = snap(spark, sf)
    holes = {"order_count": F.col("customer_id") % 7 == 0, "days_since_last": F.col("customer_id") % 5 == 0, "tenure_months": F.col("customer_id") % 3 == 0}
    for c, hole in holes.items():
        s = s.withColumn(c, F.when(hole | F.col(c).isNull(), F.lit(float("nan"))).otherwise(F.col(c).cast("double")))
    return rnd(H.add_engineered(s, views.FEATURE_SOURCES).select("customer_id", *H.ENGINEERED))


def d6_rate_by_bin_nan(spark, sf):
    """D6 with NaN tenure in a third of the rows: in no bin."""
    s = snap(spark, sf).withColumn("tenure_months", F.when(F.col("customer_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("tenure_months").cast("double")))
    return rnd(D.rate_by_bin(s, CFG.target, "tenure_months", views.TENURE_EDGES, views.TENURE_LABELS))


def h9_features(spark, sf):
    return rnd(H.build_features(snap(spark, sf), _contract(spark, sf), CFG, views.FEATURE_SOURCES))


# ---------------------------------------------------------------- K evaluation (pseudo-scores)
def sc(spark, sf):
    return views.scores(spark, sf)


def k1_predicted(spark, sf):
    return sc(spark, sf).select("customer_id", K.predicted("proba").alias("predicted"))


def k2_confusion(spark, sf):
    return rnd(K.classification_metrics(sc(spark, sf)))


def k3_roc_auc(spark, sf):
    return rnd(K.roc_auc(sc(spark, sf), group_by=["fold"]))


def k3_roc_auc_lines(spark, sf):
    return rnd(K.roc_auc(views.line_scores(spark, sf), group_by=["group_a"]))


def k4_average_precision(spark, sf):
    return rnd(K.average_precision(sc(spark, sf), group_by=["fold"]))


def k4_average_precision_lines(spark, sf):
    return rnd(K.average_precision(views.line_scores(spark, sf), group_by=["group_b"]))


def _summary(spark, sf):
    return K.fold_summary(K.fold_metrics(sc(spark, sf).withColumn("variant", F.lit("pseudo")), group_by=["variant", "fold"]))


def k5_fold_summary(spark, sf):
    return rnd(_summary(spark, sf))


def k6_precision_at_top(spark, sf):
    return rnd(K.precision_at_top(sc(spark, sf), "customer_id"))


def k6_precision_at_top_lines(spark, sf):
    return rnd(K.precision_at_top(views.line_scores(spark, sf), "line_id"))


def k6_ranking_report_lines(spark, sf):
    """K3 + K4 + K6 over all line scores from one cumulated per-score frame."""
    return rnd(K.ranking_report(views.line_scores(spark, sf), "line_id"))


def k7_majority_baseline(spark, sf):
    return rnd(K.majority_baseline(sc(spark, sf)))


def k8_fairness(spark, sf):
    return rnd(K.fairness(sc(spark, sf), ["nation", "segment"]))


def k11_comparison_table(spark, sf):
    top = K.precision_at_top(sc(spark, sf), "customer_id").first()["precision_at_top"]
    return rnd(K.comparison_table(K.majority_baseline(sc(spark, sf)), _summary(spark, sf), "pseudo", {"pseudo": top}))


def k12_fairness_table(spark, sf):
    return rnd(K.fairness_table(K.fairness(sc(spark, sf), ["nation"])))


def k13_metric_delta(spark, sf):
    a = _summary(spark, sf).select(F.col("metric").alias("path"), F.col("mean").alias("value"))
    b = K.fold_metrics(sc(spark, sf), group_by=[]).select(F.col("metric").alias("path"), "value")
    return rnd(K.metric_delta(a, b))


def k13_worst_delta(spark, sf):
    return rnd(K.worst_delta(k13_metric_delta(spark, sf)))


def k14_training_facts(spark, sf):
    c = _contract(spark, sf)
    return K.training_facts(c.columns, c.dataset["row_count"])


# ---------------------------------------------------------------- L run history
def ev(spark, sf):
    return views.events_runlog(spark, sf)


def l4_run_summary(spark, sf):
    return rnd(L.run_summary(ev(spark, sf)))


def l5_step_durations(spark, sf):
    return rnd(L.step_durations(ev(spark, sf)))


def l6_usage_totals(spark, sf):
    return rnd(L.usage_totals(ev(spark, sf)))


def l7_token_cost(spark, sf):
    usage = ev(spark, sf).groupBy("run_id").agg(
        F.sum((F.col("duration_s") * 100).cast("bigint")).alias("prompt_tokens"),
        F.sum(F.col("llm_calls") * 10).alias("cached_prompt_tokens"),
        F.sum(F.col("duration_s").cast("bigint")).alias("completion_tokens"))
    return rnd(L.token_cost(usage))


# ---------------------------------------------------------------- A sources (round trips through storage)
from handoff.sources import artifacts as A  # noqa: E402
from handoff.sources import tables as T  # noqa: E402
from handoff.sources.fingerprint import fingerprint  # noqa: E402


def a2_dictionary(spark, sf):
    """A dictionary sheet derived from ``part``: a header line holding the marker, then one line per part."""
    part = t(spark, sf, "part")
    header = spark.range(1).select(F.lit(-1).cast("long").alias("line"), F.lit(None).cast("string").alias("c0"),
                                   F.lit("Variable").alias("c1"), F.lit("Discerption").alias("c2"))
    body = part.select(F.col("p_partkey").alias("line"), F.lit(None).cast("string").alias("c0"),
                       F.col("p_name").alias("c1"), F.col("p_type").alias("c2"))
    return T.locate_header(header.unionByName(body), "Variable", "line")


def a4_write_table(spark, sf):
    path = A.scratch_path(spark, "clean-table")
    T.write_table(snap(spark, sf), path, CFG.primary_key)
    return rnd(spark.read.parquet(path))


def a5_contract_roundtrip(spark, sf):
    path = A.scratch_path(spark, "contract")
    A.write_contract(_contract(spark, sf), path)
    return A.read_contract(spark, path).columns.select(*SPEC)


def a6_contract_refusal(spark, sf):
    """A contract read back loads; a copy with an unknown dtype fails loudly."""
    c = _contract(spark, sf)
    good, bad = A.scratch_path(spark, "contract"), A.scratch_path(spark, "contract-bad")
    A.write_contract(c, good)
    doc = A.contract_document(c).withColumn("columns", F.transform(
        "columns", lambda s: s.withField("dtype", F.when(s["name"] == "cashback", F.lit("money")).otherwise(s["dtype"]))))
    doc.coalesce(1).write.mode("overwrite").json(f"{bad}/contract")
    c.allowed.write.mode("overwrite").parquet(f"{bad}/allowed")
    rows = []
    for name, path in (("as written", good), ("unknown dtype", bad)):
        try:
            back = A.read_contract(spark, path)
            rows.append((name, True, len(back.names()), None))
        except ValueError as e:
            rows.append((name, False, None, str(e).split(": ", 1)[-1]))
    return spark.createDataFrame(rows, "case string, loaded boolean, n_columns int, message string")


def a7_read_events(spark, sf):
    path = A.scratch_path(spark, "events")
    ev(spark, sf).select(F.col("run_id").cast("string").alias("run_id"), "seq", "ts", "step", "status", "duration_s",
                         "llm_calls", "cost_usd").write.mode("overwrite").option(
        "timestampNTZFormat", A.TS_FORMAT).json(path)
    got = A.read_events(spark, f"{path}/*.json")
    return rnd(got.select(F.col("run_id").cast("long").alias("run_id"), "seq", "ts", "step", "status", "duration_s",
                          "llm_calls", "cost_usd"))


def a8_file_digests(spark, sf):
    return A.file_digests(spark, f"{sf}/*.parquet").select("name", "bytes", "sha256", "leaves")


def a9_fingerprint(spark, sf):
    return fingerprint(t(spark, sf, "lineitem"))


def a10_manifest(spark, sf):
    names = ["customer", "orders", "lineitem", "nation"]
    return A.manifest(spark, {n: f"{n}.parquet" for n in names}, f"{sf}/*.parquet").select("name", "sha256", "bytes", "leaves")


def _one_file(df, path):
    """The rows, in order, as the lines of one file of that name (an artifact, not a table)."""
    folder = f"{path}.parts"
    df.coalesce(1).write.mode("overwrite").text(folder)
    jvm = df.sparkSession._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(jvm.Path(folder)) if f.getPath().getName().startswith("part-"))
    fs.delete(jvm.Path(path), False)
    fs.rename(part, jvm.Path(path))


def a11_verify_manifest(spark, sf):
    """Artifacts written from four tables; then one loses rows, one goes, and one is asked for that was never listed."""
    folder = A.scratch_path(spark, "artifacts")
    lines = {n: t(spark, sf, n).select(F.col(t(spark, sf, n).columns[0]).cast("long").alias("k")).orderBy("k") for n in ("nation", "customer", "supplier", "part")}
    for n, df in lines.items():
        _one_file(df.select(F.col("k").cast("string")), f"{folder}/{n}.txt")
    listed = reliable_checkpoint(A.manifest(spark, {n: f"{n}.txt" for n in lines}, f"{folder}/*.txt"))
    _one_file(lines["customer"].where("k % 7 <> 0").select(F.col("k").cast("string")), f"{folder}/customer.txt")
    _one_file(lines["part"].where("k >= 0").select(F.col("k").cast("string")), f"{folder}/part.txt")
    M.delete(spark, f"{folder}/supplier.txt")
    return A.verify_manifest(listed, A.file_digests(spark, f"{folder}/*.txt"), required=[*lines, "region"])


def a1_read_workbook(spark, sf):
    """A1: the customers as a sheet of a workbook, read back by row ranges."""
    path = f"{A.scratch_path(spark, 'workbook')}/customers.xlsx"
    df = t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    workbook.write_workbook(df, path, "customers", order_by=["c_custkey"])
    return workbook.read_workbook(spark, path, "customers", schema=df.schema, range_rows=500)


def a5_statistics_document(spark, sf):
    """A5: a document of statistics written as sorted JSON lines, and read back."""
    path, rows = A.scratch_path(spark, "statistics"), d2_rate_by_category(spark, sf)
    A.write_document(rows, path)
    return spark.read.schema(rows.schema).json(path)


def e14_contract_roundtrip_diff(spark, sf):
    path = A.scratch_path(spark, "contract")
    c = _contract(spark, sf)
    A.write_contract(c, path)
    back = E.measured_fields(A.read_contract(spark, path))
    return E.contract_drift(E.measured_fields(c), back)


# ---------------------------------------------------------------- I / J / K9 training (pyspark.ml)
from handoff.plans import train as J  # noqa: E402

@kept_per_input
def _features(spark, sf):
    c = _contract(spark, sf)
    fe = H.build_features(_snapshot(spark, sf), c, CFG, views.FEATURE_SOURCES)
    num, cat = H.feature_columns(c)
    return reliable_checkpoint(fe), num + list(H.ENGINEERED_NUMERIC), cat + list(H.ENGINEERED_CATEGORICAL)


def _with_pseudo_fold(df):
    return df.withColumn("fold", F.pmod(knuth_hash(F.col(CFG.primary_key), 7), F.lit(5)).cast("int"))


def i1_fold_medians(spark, sf):
    fe, num, _ = _features(spark, sf)
    return rnd(J.fold_medians(_with_pseudo_fold(fe), num))


def i2_standardise(spark, sf):
    fe, num, cat = _features(spark, sf)
    st = J.fit_prep(fe, num, [])
    return rnd(spark.createDataFrame([(c, st.medians[c], st.means[c], st.stds[c]) for c in num],
                                     "column string, median double, mean double, std double"))


def i3_most_frequent(spark, sf):
    fe, _, cat = _features(spark, sf)
    modes = J.most_frequent(fe, cat)
    return spark.createDataFrame(sorted(modes.items()), "column string, mode string")


def i4_encoded_width(spark, sf):
    """Width of the assembled input vector per row (one-hot keeps all seen categories)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    fe, num, cat = _features(spark, sf)
    st = J.fit_prep(fe, num, cat)
    prepared = J.apply_prep(fe, st)
    model = Pipeline(stages=J.encoder_stages(num, cat)).fit(prepared)
    return model.transform(prepared).select(CFG.primary_key, F.size(vector_to_array("features")).alias("width"))


def j1_folds(spark, sf):
    fe, _, _ = _features(spark, sf)
    return J.assign_folds(fe.select(CFG.primary_key, CFG.target), CFG.target, CFG.primary_key, 5, CFG.seed,
                          order=knuth_hash(F.col(CFG.primary_key), CFG.seed))


#: All settings as they are fixed; tests of the machinery may put smaller ones here.
SETTINGS = J.Settings()


def _run(spark, sf, variants, k=5):
    fe, num, cat = _features(spark, sf)
    return J.train_run(fe, CFG.primary_key, CFG.target, num, cat, variants, k, CFG.seed, SETTINGS)


@kept_per_input
def _cv(spark, sf):
    """One run of all three families: the run, out-of-fold scores, and their summary (tables in the shared folder)."""
    fe, num, cat = _features(spark, sf)
    run, oof, per_fold = J.cross_validate(fe, CFG.primary_key, CFG.target, num, cat, J.VARIANTS, 5, CFG.seed, SETTINGS)
    return run, oof, reliable_checkpoint(K.fold_summary(per_fold))


def j5_cross_validate(spark, sf):
    return rnd(_cv(spark, sf)[2])


def j5_out_of_fold(spark, sf):
    return rnd(_cv(spark, sf)[1])


def _served(spark, sf):
    run, _, summary = _cv(spark, sf)
    return run.model(J.serve_best(summary))


def _fitted(spark, sf, variant):
    """One family alone, fitted on all rows (and the folds beside it), scoring them all."""
    fe, _, _ = _features(spark, sf)
    return rnd(J.score(_run(spark, sf, [variant]).model(variant), fe, keep=[CFG.primary_key]))


def j3_random_forest_fit(spark, sf):
    return _fitted(spark, sf, "random_forest")


def j2_logistic_fit(spark, sf):
    return _fitted(spark, sf, "logreg")


def j4_hist_gb_fit(spark, sf):
    return _fitted(spark, sf, "hist_gb")


def j6_serve_best(spark, sf):
    m = _served(spark, sf)
    return spark.createDataFrame([(m.variant, len(m.numeric), len(m.categorical))],
                                 "served string, numeric_inputs int, categorical_inputs int")


def j7_save_load(spark, sf):
    path = A.scratch_path(spark, "model")
    m = _served(spark, sf)
    m.save(spark, path)
    back = J.FittedModel.load(spark, path)
    fe, _, _ = _features(spark, sf)
    a = J.score(m, fe, keep=[CFG.primary_key]).withColumnRenamed("proba", "a")
    b = J.score(back, fe, keep=[CFG.primary_key]).withColumnRenamed("proba", "b")
    return a.join(b, CFG.primary_key).select(CFG.primary_key, (F.abs(F.col("a") - F.col("b")) < 1e-12).alias("same"))


def j8_score(spark, sf):
    """Score contract-shaped rows (the clean snapshot): engineered features are derived first."""
    s = H.add_engineered(_snapshot(spark, sf), views.FEATURE_SOURCES)
    return rnd(J.score(_served(spark, sf), s, keep=[CFG.primary_key]))


def j9_attach_protected(spark, sf):
    scores = sc(spark, sf).select("customer_id", "y", "proba")
    protected = snap(spark, sf).select("customer_id", *CFG.protected)
    return rnd(J.attach_protected(scores, protected, "customer_id"))


def _top_precision(spark, sf):
    oof = _cv(spark, sf)[1]
    return {v: K.precision_at_top(oof.where(F.col("variant") == v), CFG.primary_key).collect()[0][0] for v in sorted(J.VARIANTS)}


def j10_metrics_document(spark, sf):
    fe, num, cat = _features(spark, sf)
    _, oof, summary = _cv(spark, sf)
    served = J.serve_best(summary)
    fair = K.fairness(J.attach_protected(oof.where(F.col("variant") == served), snap(spark, sf).select("customer_id", "nation"),
                                         "customer_id"), ["nation"])
    rate = fe.agg(F.avg(CFG.target)).collect()[0][0]
    return rnd(J.metrics_document(fe.count(), rate, K.majority_baseline(oof.where(F.col("variant") == served)),
                                  summary, served, _importances(spark, sf), fair, _top_precision(spark, sf),
                                  {"numeric": num, "categorical": cat}))


@kept_per_input
def _importances(spark, sf):
    run, _, summary = _cv(spark, sf)
    return reliable_checkpoint(J.permutation_importance(run, J.serve_best(summary), 5, CFG.seed))


def k9_permutation_importance(spark, sf):
    return rnd(_importances(spark, sf))


def k10_ranked_measures(spark, sf):
    """K10 on a frame that SQL can compute: the columns ranked by how far their correlation is from 0."""
    corr = D.correlations(snap(spark, sf), CFG.target, _nums(snap(spark, sf)))
    return rnd(K.ranked_importances(corr.select(F.col("column").alias("feature"), F.abs("r").alias("importance")), 5))


def k3_missing_scores(spark, sf):
    """K3/K4 where every ninth score is missing: those rows are left out, and counted."""
    scores = sc(spark, sf).withColumn("proba", F.when(F.col("customer_id") % 9 != 0, F.col("proba")))
    return rnd(K.rank_metrics(scores, group_by=["fold"]).join(K.unscored(scores, group_by=["fold"]), "fold"))


def k10_ranked_importances(spark, sf):
    return rnd(K.ranked_importances(_importances(spark, sf)))


# ---------------------------------------------------------------- M streaming
from handoff.streaming import streams as M  # noqa: E402


def _event_stream(spark, sf):
    schema = t(spark, sf, "events").schema
    return M.read_stream(spark, sf, schema, glob="events.parquet")


def m1_growing_files(spark, sf):
    """M1: events as lines of files, read by byte position: half of them, a restart, then what came after."""
    folder, table, ckpt = (A.scratch_path(spark, n) for n in ("growing", "growing-table", "growing-ckpt"))
    cells = ev(spark, sf).select(F.col("run_id").cast("string").alias("run_id"), "seq", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
                                 "step", "status", "duration_s", "llm_calls", "cost_usd")
    lines = cells.select("seq", F.to_json(F.struct(*cells.columns)).alias("value"))
    for part, wanted in enumerate(("seq % 2 = 0", "seq % 2 = 1")):
        lines.where(wanted).select("value").write.text(f"{folder}/{part}")
        rows = M.tail_to_table(M.appended_lines(spark, folder, "*.txt"), table, ckpt)
    got = M.appended_events(rows)
    return rnd(got.select(F.col("run_id").cast("long").alias("run_id"), "seq", "ts", "step", "status", "duration_s", "llm_calls", "cost_usd"))


def m1_event_tail(spark, sf):
    out = M.tail_to_table(views.runlog_from_events(_event_stream(spark, sf)), A.scratch_path(spark, "tail"), A.scratch_path(spark, "tail-ckpt"))
    return rnd(out)


def m2_live_run_status(spark, sf):
    status, _ = M.live_run_status(views.runlog_from_events(_event_stream(spark, sf)), A.scratch_path(spark, "status"), A.scratch_path(spark, "status-ckpt"))
    return rnd(status)


def _snapshot_files(spark, sf, n_files=4):
    """The clean snapshot landed as several files (one micro-batch each)."""
    path = A.scratch_path(spark, "landing")
    snap(spark, sf).repartitionByRange(n_files, CFG.primary_key).write.parquet(path)
    return path, spark.read.parquet(path).schema


def m3_validate_stream(spark, sf):
    path, schema = _snapshot_files(spark, sf)
    stream = M.read_stream(spark, path, schema, max_files_per_trigger=1)
    rep = M.validate_stream(stream, _contract(spark, sf), A.scratch_path(spark, "reports"), A.scratch_path(spark, "reports-ckpt"), REQUIRED)
    return rep.select("batch_id", *REPORT_COLS)


def m4_score_stream(spark, sf):
    path, schema = _snapshot_files(spark, sf)
    stream = M.read_stream(spark, path, schema, max_files_per_trigger=1)
    model = _served(spark, sf)
    scorer = lambda df: J.score(model, H.add_engineered(df, views.FEATURE_SOURCES), keep=[CFG.primary_key])
    return rnd(M.score_stream(stream, scorer, A.scratch_path(spark, "scores"), A.scratch_path(spark, "scores-ckpt")))


# ---------------------------------------------------------------- L1-L3 gates
from handoff.plans import handover as P  # noqa: E402


def l1_handover_gate(spark, sf):
    rows = []
    for preset in [None, *FAULT_COLUMNS]:
        full = V.validate(*(_tampered(spark, sf, preset) if preset else (_snapshot(spark, sf), _contract(spark, sf))), REQUIRED)
        passed, text = P.gate(full)
        rows.append((preset or "clean", passed, "next stage" if passed else "stop", text.splitlines()[0]))
    return spark.createDataFrame(rows, "case string, passed boolean, action string, headline string")


def l2_output_checks(spark, sf):
    fe, num, cat = _features(spark, sf)
    _, oof, summary = _cv(spark, sf)
    served = J.serve_best(summary)
    top = _top_precision(spark, sf)
    base = K.majority_baseline(fe.select(F.col(CFG.target).alias("y")))
    run, scores = A.scratch_path(spark, "run"), j8_score(spark, sf)
    fe.write.parquet(f"{run}/features")
    scores.write.parquet(f"{run}/scores")
    return P.output_checks(summary, base, served, top, num + cat, [CFG.primary_key, CFG.target, *CFG.protected],
                           spark.read.parquet(f"{run}/scores"), artifacts=["features", "scores"], present=P.written_outputs(spark, run))


def l3_publish(spark, sf):
    """L3: an approved publication, the run's own gates, a verified run, and a refused run that leaves the publication as it was."""
    run, pub = A.scratch_path(spark, "run"), A.scratch_path(spark, "published")
    outputs = {"features": _features(spark, sf)[0], "scores": j8_score(spark, sf)}
    ok = bool(l2_output_checks(spark, sf).agg(F.bool_and("passed")).collect()[0][0])
    rows, versions = [], []
    for case, passed, enabled in (("approved", True, True), ("gates", ok, True), ("publishing off", True, False), ("failed gate", False, True)):
        status = P.publish(outputs, run, pub, passed, enabled)
        held = P.published(spark, pub).collect()
        versions.append({r["version"] for r in held})
        rows.append((case, status, len(held), sum(r["n_rows"] for r in held), versions[-1] == versions[0]))
    return spark.createDataFrame(rows, "case string, status string, outputs long, n_rows long, same_version boolean")


def l1_run(spark, sf):
    """L1-L3 as one run over the raw customers: agreed, stopped at the input gate, refused at the output gate."""
    raw_table, agreed = views.customer_raw(spark, sf), None
    clean_table, _ = _cleaned(spark, sf)
    agreed = E.build_contract(clean_table, CFG)
    broken, _ = G.tamper(clean_table, agreed, "row_loss", CFG.primary_key, order=knuth_hash(F.col(CFG.primary_key), CFG.seed))
    stage = lambda df, c: {"features": H.build_features(df, c, CFG, views.FEATURE_SOURCES)}
    path, pub = A.scratch_path(spark, "runs"), A.scratch_path(spark, "published")
    rows = []
    for run_id, table, gate in (("agreed", raw_table, True), ("broken", broken, True), ("bad outputs", raw_table, False)):
        log = A.RunLog(spark, f"{path}/events", run_id)
        status = P.run_handover(table, CFG, log, f"{path}/{run_id}", pub, stage, lambda out, gate=gate: gate and not out["features"].isEmpty(),
                                contract=agreed, order_by=["account_balance"])
        rows.append((run_id, status, P.published(spark, pub).first()["n_rows"]))
    ended = L.run_summary(A.read_events(spark, f"{path}/events/*/*.json")).select("run_id", F.col("result").alias("logged"), "events")
    return spark.createDataFrame(rows, "run_id string, status string, published_rows long").join(ended, "run_id")


# ---------------------------------------------------------------- remaining inventory items
def c9_nulls_kept(spark, sf):
    _, rep = _cleaned(spark, sf)
    return rep.where(F.col("section") == "nulls_kept").select("column", F.col("n").alias("null_count"))


def _key_number_inputs(spark, sf):
    s = snap(spark, sf)
    o = D.overall_rate(s, CFG.target).collect()[0]
    corr = D.top_drivers(D.correlations(s, CFG.target, _nums(s)), 1).collect()
    flag = D.flag_rates(s, CFG.target, views.FLAG_COLUMN).collect()[0]
    bins = {r["bin"]: r["rate"] for r in D.rate_by_bin(s, CFG.target, "tenure_months", views.TENURE_EDGES,
                                                        views.TENURE_LABELS).collect()}
    _, rep = _cleaned(spark, sf)
    rows = rep.collect()
    r = {(x["section"], x["column"]): x["n"] for x in rows if x["section"] != "entity_fix"}
    fixes = sum(x["n"] for x in rows if x["section"] == "entity_fix")
    stats = dict(n_rows=o["n_rows"], positive_rate=o["positive_rate"], positive_count=o["positive_count"],
                 n_null_columns=D.null_map(s).count(), top_column=corr[0]["column"] if corr else None,
                 top_r=corr[0]["r"] if corr else None, flag_rate=flag["rate_flag_1"], first_bin_rate=bins.get("0-1"))
    cleaning = dict(rows_in=r[("rows_in", None)], rows_out=r[("rows_out", None)],
                    duplicate_records_dropped=r[("duplicate_records_dropped", None)], fixes=fixes)
    return stats, cleaning


def d12_key_numbers(spark, sf):
    stats, cleaning = _key_number_inputs(spark, sf)
    return D.key_numbers(stats, cleaning, spark)


def d13_key_numbers_match(spark, sf):
    stats, cleaning = _key_number_inputs(spark, sf)
    fresh = D.key_numbers(stats, cleaning, spark)
    published = fresh.select("measure", "value")
    tampered = fresh.select("measure", F.when(F.col("position") == 4, F.lit("0.0%")).otherwise(F.col("value")).alias("value"))
    return spark.createDataFrame([("same", D.key_numbers_match(published, fresh)),
                                  ("edited", D.key_numbers_match(tampered, fresh))], "case string, match boolean")


def f1_integrity(spark, sf):
    """the clean table passes; every table fault changes the fingerprint."""
    cases = [("clean", _snapshot(spark, sf)), *[(p, _tampered(spark, sf, p)[0]) for p in G.TABLE_FAULTS]]
    rows = []
    for name, df in cases:
        report = V.validate(df, _contract(spark, sf), check_fingerprint=True).where(F.col("check") == "integrity").collect()
        rows.append((name, df.count(), report[0]["passed"]))
    return spark.createDataFrame(rows, "case string, n_rows long, passed boolean")


def all_queries():
    return {k: v for k, v in globals().items() if callable(v) and k[:1] in "abcdefghijklm" and k[1:2].isdigit()
            or k.startswith("f_validate")}
