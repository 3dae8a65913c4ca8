"""Every query against its SQL on the whole small tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from oracle.checks import CHECKS
from tracewell.plans.catalog import QUERIES

@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, CHECKS[name]) == []


def test_every_query_is_checked():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_point.queries()) and set(CHECKS) <= set(entry_point.oracle_sql())


def test_entry(spark):
    counts = {r["rule_name"]: r["triggered_count"] for r in entry_point.entry(spark).collect()}
    assert counts == {
        "biometric_structuring_rule": 4,
        "velocity_rule": 28,
        "cross_border_fraud_rule": 38,
        "biometric_evasion_rule": 23,
        "impossible_travel_rule": 11,
        "circular_17_mule_network_rule": 24,
    }
