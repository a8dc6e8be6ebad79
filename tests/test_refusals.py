"""Refusals are reported, not swallowed: contract roles (E8), engineered sources (H7), declarations (H8),
malformed contracts (A6); and the outcome shares (D11) add up to the table."""

from handoff.plans import registry as Q
from tests.conftest import SMOKE


def by_case(df):
    return {r["case"]: r for r in df.collect()}


def test_e8_names_missing_key_and_target(spark):
    r = by_case(Q.e8_refuse_missing_roles(spark, SMOKE))
    assert r["snapshot"]["refused"] is False and r["snapshot"]["missing"] == ""
    assert r["without key"]["refused"] and r["without key"]["missing"] == "customer_id"
    assert r["without target"]["missing"] == "churned"
    both = r["without key and target"]
    assert both["refused"] and both["missing"] == "customer_id, churned"
    assert "customer_id" in both["message"] and "churned" in both["message"]


def test_h7_lists_every_missing_source(spark):
    r = by_case(Q.h7_refuse_missing_sources(spark, SMOKE))
    assert r["snapshot"]["refused"] is False
    bad = r["without order_count and days_since_last"]
    assert bad["refused"] and set(bad["missing"].split(", ")) == {"order_count", "days_since_last"}


def test_h8_refuses_undeclared_and_absent(spark):
    r = by_case(Q.h8_refuse_undeclared(spark, SMOKE))
    assert r["snapshot"]["refused"] is False
    assert r["extra column"]["refused"] and r["extra column"]["undeclared"] == "note"
    assert r["without tenure_months"]["refused"] and r["without tenure_months"]["absent"] == "tenure_months"


def test_a6_unknown_dtype_fails_loudly(spark):
    r = by_case(Q.a6_contract_refusal(spark, SMOKE))
    assert r["as written"]["loaded"] and r["as written"]["n_columns"] == 13
    assert r["unknown dtype"]["loaded"] is False and "cashback" in r["unknown dtype"]["message"]


def test_d11_shares_cover_the_table(spark):
    shares = {r["outcome"]: r for r in Q.d11_outcome_shares(spark, SMOKE).collect()}
    overall = Q.d1_overall_rate(spark, SMOKE).collect()[0]
    assert shares["stayed"]["n"] + shares["churned"]["n"] == overall["n_rows"]
    assert shares["churned"]["n"] == overall["positive_count"]
    assert abs(shares["stayed"]["share"] + shares["churned"]["share"] - 1.0) < 1e-9
