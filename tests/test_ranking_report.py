"""K3 + K4 + K6 from one cumulated frame equal the separate operators (whole pseudo-score table)."""

import pytest

from handoff.operators import evaluate as K
from handoff.plans import views
from tests.conftest import SMOKE


@pytest.mark.parametrize("frac", [0.1, 0.37])
def test_ranking_report_matches_separate_operators(spark, frac):
    sc = views.scores(spark, SMOKE)
    rep = K.ranking_report(sc, "customer_id", frac=frac).collect()[0]
    rm = K.rank_metrics(sc).collect()[0]
    top = K.precision_at_top(sc, "customer_id", frac=frac).collect()[0]
    assert rep["roc_auc"] == pytest.approx(rm["roc_auc"], abs=1e-12)
    assert rep["pr_auc"] == pytest.approx(rm["pr_auc"], abs=1e-12)
    assert rep["precision_at_top"] == pytest.approx(top["precision_at_top"], abs=1e-12)
    assert rep["k"] == top["k"]
