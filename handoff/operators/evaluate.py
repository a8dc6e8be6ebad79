"""Evaluation of scores: confusion metrics, tie-aware ROC-AUC and step-wise average precision,
precision at the top, majority baseline, fairness by group, fold summaries, metric deltas.

Input: a scores frame with a label column (0/1) and a probability column, optionally fold /
variant / group columns. Everything is an aggregate; the two rank-based metrics first collapse
rows to one row per distinct score, then use distributed running totals (no single-task sort).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.config import METRIC_NAMES, METRIC_TOLERANCE, TOP_FRACTION
from handoff.functions.columns import col_of, cols_of, is_missing
from handoff.operators.ranking import row_numbers, running_totals
from handoff.session import reliable_checkpoint


def predicted(proba: str | F.Column, threshold: float = 0.5) -> F.Column:
    """K1: class at the threshold (>=)."""
    p = col_of(proba) if isinstance(proba, str) else proba
    return (p >= F.lit(threshold)).cast("int")


def _zero(num: F.Column, den: F.Column) -> F.Column:
    return F.coalesce(F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double")), F.lit(0.0))


def classification_metrics(scores: DataFrame, y: str = "y", proba: str = "proba", group_by: Sequence[str] = (),
                           threshold: float = 0.5, pred: str | None = None) -> DataFrame:
    """K2: accuracy, precision, recall, f1 per group; a zero denominator gives 0."""
    yy = col_of(y)
    pp = col_of(pred) if pred else predicted(proba, threshold)
    agg = scores.groupBy(*cols_of(group_by)).agg(
        F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
        F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 0) & (pp == 0)).alias("tn"))
    tp, fp, fn, tn = (col_of(c) for c in ("tp", "fp", "fn", "tn"))
    prec, rec = _zero(tp, tp + fp), _zero(tp, tp + fn)
    return agg.select(*cols_of(group_by), "tp", "fp", "fn", "tn",
                      _zero(tp + tn, tp + fp + fn + tn).alias("accuracy"), prec.alias("precision"),
                      rec.alias("recall"), _zero(2 * tp, 2 * tp + fp + fn).alias("f1"))


def _per_score(scores: DataFrame, y: str, proba: str, group_by: Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows by distinct score; rows without a score (NULL or NaN) have no rank and are left out."""
    n = F.lit(1).cast("long") if weight is None else col_of(weight).cast("long")
    zero = F.lit(0).cast("long")
    ranked = scores.where(~is_missing(col_of(proba).cast("double")))
    return ranked.groupBy(*cols_of(group_by), col_of(proba).alias("_s")).agg(
        F.sum(F.when(col_of(y) == 1, n).otherwise(zero)).alias("_pos"), F.sum(F.when(col_of(y) == 0, n).otherwise(zero)).alias("_neg"))


def unscored(scores: DataFrame, proba: str = "proba", group_by: Sequence[str] = ()) -> DataFrame:
    """Rows that the rank metrics leave out: (group..., n, unscored)."""
    gone = F.count_if(is_missing(col_of(proba).cast("double")))
    return scores.groupBy(*cols_of(group_by)).agg(F.count(F.lit(1)).alias("n"), gone.alias("unscored"))


def _cumulated(scores: DataFrame, y: str, proba: str, group_by: Sequence[str], weight: str | None = None) -> DataFrame:
    """One row per (group, distinct score) with ascending running totals and group totals.

    Rows collapse to distinct scores first (map-side), then ONE distributed running-total pass;
    descending totals are derived as total - ascending + current.
    """
    g = list(group_by)
    # the per-score aggregate is read three times (range sampling, running sums, totals): written once
    # so an expensive upstream (joins, model scoring) runs once
    per = reliable_checkpoint(_per_score(scores, y, proba, g, weight))
    cum = running_totals(per, [F.col("_s")], {"_cpos": F.col("_pos"), "_cneg": F.col("_neg")}, g)
    if g:
        totals = per.groupBy(*g).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))  # one row per group
        cum = cum.join(totals, g)
    else:  # one group: its two totals are read back and inlined (no join on a constant key)
        t = per.agg(F.sum("_pos").alias("P"), F.sum("_neg").alias("N")).collect()[0]
        cum = cum.select("*", F.lit(int(t["P"] or 0)).cast("long").alias("_P"), F.lit(int(t["N"] or 0)).cast("long").alias("_N"))
    return cum.select(*g, "_s", "_pos", "_neg", "_cpos", "_cneg", "_P", "_N",
                      (F.col("_P") - F.col("_cpos") + F.col("_pos")).alias("_tp_desc"),
                      (F.col("_P") + F.col("_N") - F.col("_cpos") - F.col("_cneg") + F.col("_pos") + F.col("_neg")).alias("_all_desc"))


def _auc_expr() -> F.Column:
    # in doubles: the product of two large counts does not fit a long
    return F.try_divide(F.sum(F.col("_pos").cast("double") * (F.col("_cneg") - F.col("_neg") + F.col("_neg") / 2.0)),
                        F.first("_P").cast("double") * F.first("_N").cast("double"))


def _ap_expr() -> F.Column:
    return F.try_divide(F.sum(F.col("_pos").cast("double") * F.col("_tp_desc") / F.col("_all_desc")), F.first("_P").cast("double"))


def rank_metrics(scores: DataFrame, y: str = "y", proba: str = "proba", group_by: Sequence[str] = ()) -> DataFrame:
    """K3 + K4 from one pass: (group..., roc_auc, pr_auc)."""
    g = list(group_by)
    return _cumulated(scores, y, proba, g).groupBy(*g).agg(_auc_expr().alias("roc_auc"), _ap_expr().alias("pr_auc"))


def roc_auc(scores: DataFrame, y: str = "y", proba: str = "proba", group_by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """K3: ROC-AUC per group, ties counted half (Mann-Whitney); NULL when a class is absent.

    ``weight`` names a column with the number of rows that a row stands for. Rows without a score are
    left out (``unscored`` counts them).
    """
    g = list(group_by)
    return _cumulated(scores, y, proba, g, weight).groupBy(*g).agg(_auc_expr().alias("roc_auc"))


def average_precision(scores: DataFrame, y: str = "y", proba: str = "proba", group_by: Sequence[str] = ()) -> DataFrame:
    """K4: step-wise AP = sum over distinct thresholds of (R_i - R_{i-1}) * P_i."""
    g = list(group_by)
    return _cumulated(scores, y, proba, g).groupBy(*g).agg(_ap_expr().alias("pr_auc"))


def fold_metrics(scores: DataFrame, y: str = "y", proba: str = "proba", group_by: Sequence[str] = ("fold",)) -> DataFrame:
    """All six metrics per group, long: (group..., metric, value) -- a union of three aggregates."""
    g = list(group_by)

    def long(frame: DataFrame, names: Sequence[str]) -> DataFrame:
        return frame.select(*g, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                                   for m in names])))

    cm = long(classification_metrics(scores, y, proba, g), ["f1", "precision", "recall", "accuracy"])
    return long(rank_metrics(scores, y, proba, g), ["roc_auc", "pr_auc"]).unionByName(cm)


def fold_summary(long: DataFrame, group_by: Sequence[str] = ("variant",)) -> DataFrame:
    """K5: mean and population std across folds, per (group, metric)."""
    return long.groupBy(*group_by, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def precision_at_top(scores: DataFrame, key: str, y: str = "y", proba: str = "proba",
                     frac: float = TOP_FRACTION) -> DataFrame:
    """K6: share of positives among the top max(1, round(frac * n)) rows by score, ties by key.

    Exact without ranking every row: per-score running counts locate the cut-off score; rows above
    it are counted from the aggregate, and only the tie block AT the cut-off is ranked by key.
    """
    return _top_from(_cumulated(scores, y, proba, []), scores, key, y, proba, frac)


def ranking_report(scores: DataFrame, key: str, y: str = "y", proba: str = "proba",
                   frac: float = TOP_FRACTION) -> DataFrame:
    """K3 + K4 + K6 over the whole table from ONE cumulated per-score frame:
    (roc_auc, pr_auc, precision_at_top, k). Same values as ``rank_metrics`` and ``precision_at_top``,
    but the per-score aggregate and its running totals are built (and written) once, not twice."""
    cum = _cumulated(scores, y, proba, [])
    m = cum.agg(_auc_expr().alias("roc_auc"), _ap_expr().alias("pr_auc")).collect()[0]  # one row
    top = _top_from(cum, scores, key, y, proba, frac)
    return top.select(F.lit(m["roc_auc"]).cast("double").alias("roc_auc"), F.lit(m["pr_auc"]).cast("double").alias("pr_auc"),
                      "precision_at_top", "k")


def _top_from(cum: DataFrame, scores: DataFrame, key: str, y: str, proba: str, frac: float) -> DataFrame:
    """K6 given the whole-table cumulated frame: locate the cut-off score, rank only its tie block."""
    cum = cum.withColumn("_cnt_desc", F.col("_all_desc"))
    n = cum.agg(F.first("_P") + F.first("_N")).collect()[0][0] or 0
    k = max(1, int(round(frac * n)))
    # the distinct score whose descending block holds position k
    cut = cum.where((F.col("_cnt_desc") >= k) & (F.col("_cnt_desc") - F.col("_pos") - F.col("_neg") < k)).select(
        "_s", (F.col("_tp_desc") - F.col("_pos")).alias("_tp_above"),
        (F.col("_cnt_desc") - F.col("_pos") - F.col("_neg")).alias("_n_above")).collect()
    if not cut:
        return scores.sparkSession.createDataFrame([(None, k)], "precision_at_top double, k int")
    s_cut, tp_above, n_above = cut[0]["_s"], cut[0]["_tp_above"], cut[0]["_n_above"]
    need = k - n_above
    ties = scores.where(col_of(proba) == F.lit(s_cut)).select(*cols_of([key, y]))
    ranked = row_numbers(ties, [col_of(key)], name="_rank").where(F.col("_rank") <= need)
    tp_ties = ranked.agg(F.coalesce(F.sum(col_of(y)), F.lit(0)).alias("t"))
    return tp_ties.select(((F.lit(tp_above) + F.col("t")) / F.lit(float(k))).alias("precision_at_top"),
                          F.lit(k).alias("k"))


def majority_baseline(scores: DataFrame, y: str = "y") -> DataFrame:
    """K7: always answer the majority class (ties -> the smaller class)."""
    c = scores.agg(F.count_if(col_of(y) == 1).alias("pos"), F.count(F.lit(1)).alias("n"))
    pos, n = F.col("pos").cast("double"), F.col("n").cast("double")
    maj = F.when(pos > n - pos, 1).otherwise(0)
    rate = F.try_divide(pos, n)
    prec = F.when(maj == 1, rate).otherwise(0.0)
    rec = F.when(maj == 1, F.lit(1.0)).otherwise(0.0)
    f1 = F.when(maj == 1, F.try_divide(2 * rate, rate + 1)).otherwise(0.0)
    return c.select(F.lit("majority").alias("strategy"), maj.alias("predicted_class"),
                    F.when(maj == 1, rate).otherwise(1 - rate).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"), F.lit(0.5).alias("roc_auc"), rate.alias("pr_auc"),
                    rate.alias("precision_at_top10"))


def fairness(scores: DataFrame, attributes: Sequence[str], y: str = "y", proba: str = "proba",
             threshold: float = 0.5) -> DataFrame:
    """K8: per (attribute, group): n, recall, precision, positive (flag) rate; NULL groups ignored."""
    parts = [F.struct(F.lit(a).alias("attribute"), col_of(a).cast("string").alias("group")) for a in attributes]
    long = scores.select(col_of(y).alias("_y"), predicted(proba, threshold).alias("_p"),
                         F.explode(F.array(*parts)).alias("a")).select("_y", "_p", "a.*").where(F.col("group").isNotNull())
    cm = classification_metrics(long, "_y", group_by=["attribute", "group"], pred="_p")
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return cm.select("attribute", "group", n.alias("n"), "recall", "precision", F.try_divide(F.col("tp") + F.col("fp"), n).alias("positive_rate"))


def ranked_importances(importances: DataFrame, limit: int = 10) -> DataFrame:
    """Top importances (a top-k report: the limit is the feature)."""
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(limit)


def comparison_table(baseline: DataFrame, summary: DataFrame, served: str | None = None, top_precision: Mapping[str, float] | None = None) -> DataFrame:
    """Baseline first, then one row per variant: each metric's mean and std over the folds, precision at the
    top, the served one marked. The baseline has no std."""
    names = list(METRIC_NAMES)
    cells = [F.max(F.when(F.col("metric") == m, F.col(of))).alias(m if of == "mean" else f"{m}_std") for m in names for of in ("mean", "std")]
    piv = summary.groupBy("variant").agg(*cells)
    top = F.lit(None).cast("double")
    for variant, value in (top_precision or {}).items():  # one number per variant
        top = F.when(F.col("variant") == variant, F.lit(value).cast("double")).otherwise(top)
    none = [F.lit(None).cast("double").alias(f"{m}_std") for m in names]
    base = baseline.select(F.lit("baseline").alias("variant"), *[F.col(m).cast("double").alias(m) for m in names], *none,
                           F.col("precision_at_top10").cast("double").alias("precision_at_top10"), F.lit(0).alias("order"))
    rows = base.unionByName(piv.withColumn("precision_at_top10", top).withColumn("order", F.lit(1)))
    return rows.withColumn("served", F.col("variant") == F.lit(served))


def fairness_table(fair: DataFrame) -> DataFrame:
    """(attribute, group, n, recall, precision, flagged)."""
    return fair.select("attribute", "group", "n", "recall", "precision", F.col("positive_rate").alias("flagged"))


def metric_delta(a: DataFrame, b: DataFrame, tol: float = METRIC_TOLERANCE) -> DataFrame:
    """(path, a, b, delta, within) for two (path, value) metric frames plus the worst delta row."""
    j = a.select("path", F.col("value").alias("a")).join(b.select("path", F.col("value").alias("b")), "path", "full_outer")
    d = j.withColumn("delta", F.abs(F.col("a") - F.col("b")))
    return d.withColumn("within", F.coalesce(F.col("delta") <= F.lit(tol), F.lit(False)))


def worst_delta(deltas: DataFrame) -> DataFrame:
    """The metric that is farthest off; one that stands on one side only is worse than any (its delta is NULL)."""
    worst = F.max(F.struct(F.col("delta").isNull(), "delta", "path"))
    return deltas.agg(worst.alias("w"), F.bool_and("within").alias("all_within")).select(
        F.col("w.path").alias("path"), F.col("w.delta").alias("delta"), "all_within")


def training_facts(columns: DataFrame, rows: int) -> DataFrame:
    """Rows, columns, numeric / categorical feature counts, nullable columns, total nulls."""
    c = columns
    return c.agg(
        F.lit(rows).cast("long").alias("rows"), F.count(F.lit(1)).alias("columns"),
        F.count_if((F.col("role") == "feature") & F.col("dtype").isin("int", "float")).alias("numeric_features"),
        F.count_if((F.col("role") == "feature") & F.col("dtype").isin("category", "bool")).alias("categorical_features"),
        F.count_if(F.col("nullable")).alias("nullable_columns"), F.sum("null_count").cast("long").alias("total_nulls"))
