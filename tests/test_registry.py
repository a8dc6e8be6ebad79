"""Every registered query runs on the smallest scale and returns a stable schema."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMOKE

#: Queries whose right answer on the given tables is that nothing is wrong.
EMPTY = {"c12_unmapped", "c13_null_reconcile", "c9_nulls_kept", "d8_null_map", "e14_contract_roundtrip_diff"}


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["check", "column", "passed", "observed", "expected", "hint"]
    assert any(r["check"] == "range" and r["passed"] is False for r in rows)


def test_every_query_has_a_name_and_most_have_sql():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert len(s) >= 0.7 * len(q)


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n[:2] != "op" and n != "pipeline"))
def test_query_runs(spark, name):
    df = entry.queries()[name](spark, SMOKE)
    assert len(df.columns) == len(set(df.columns))
    assert (df.count() == 0) == (name in EMPTY)
