"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tracewell import Params
from tracewell.operators import rules
from tracewell.operators.features import PREVIEW_COLUMNS, build_features
from tracewell.operators.scope import Scope
from tracewell.plans.catalog import QUERIES
from tracewell.plans.layout import read_laid_out, write_laid_out
from tracewell.plans.quality import constraint_report
from tracewell.sources.fixtures import load_fixtures
from tracewell.sources.tables import read_tables
from tracewell.sources.writers import write_table


def physical(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans"))
    for name, df in load_fixtures(spark, sf_dir).named().items():
        write_table(df, f"{folder}/{name}")
    return read_tables(spark, folder)


@pytest.fixture
def shuffled_joins(spark):
    """Plan as if every table were too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", re.sub(r"#\d+L?", "", text))


# Single aggregate rows side by side, and writes that happen while the query is built.
JOINED_TOTALS = {"port_repair_counts", "clean_repair_counts", "mart_preview_rows"}
WRITERS = {"io_csv_roundtrip", "io_report_csv", "io_parquet_marts", "io_append_defaults", "io_staged_run"}
WRITERS |= {"inc_three_loads", "inc_three_loads_features"}
WRITERS |= {name for name in QUERIES if name.startswith("stream_")}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOINED_TOTALS - WRITERS))
def test_no_python_and_no_pair_joins(spark, sf_dir, name):
    text = physical(QUERIES[name](spark, sf_dir))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_features_move_transfers_twice(tables, shuffled_joins):
    """By beneficiary for its join; by user for login lookup, history count and user join."""
    df = build_features(Scope.of(tables)).transactions.select(PREVIEW_COLUMNS)
    assert sorted(exchanges(physical(df))) == ["_dim_key", "_dim_key", "beneficiary_id", "user_id"]
    assert physical(df).count("Sort [user_id") == 1


def test_rules_move_transfers_twice(tables, shuffled_joins):
    """By user for velocity and travel; by beneficiary for mules and the beneficiary join."""
    df = rules.apply_rules(Scope.of(tables)).transactions.select("transaction_id", "rule_flags")
    # The third by user moves the logins, for the previous login.
    assert sorted(exchanges(physical(df))) == ["_dim_key", "beneficiary_id", "user_id", "user_id"]


@pytest.mark.parametrize("name", ["rule_cross_border", "rule_structuring", "rule_evasion"])
def test_a_single_rule_plans_no_window_of_the_others(spark, sf_dir, name):
    text = physical(QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"Window \[", text)) == 1


def test_copies_are_dropped_before_the_shuffle(spark, sf_dir):
    text = physical(QUERIES["clean_dedup"](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*Final.*Exchange.*WindowGroupLimit.*Partial", text, re.S)


def test_filters_and_columns_reach_the_scan(tables):
    df = tables.transactions.filter(F.col("amount") >= 10_000_000).select("transaction_id")
    scan = next(line for line in physical(df).splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(amount" in scan
    assert "ReadSchema: struct<transaction_id:bigint,amount:decimal(15,2)>" in scan


def test_top_rows_need_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in physical(QUERIES["rpt_top10"](spark, sf_dir))


def test_foreign_keys_are_counted_per_key(tables, shuffled_joins):
    text = physical(constraint_report(tables))
    assert "LeftAnti" in text and "partial_count" in text


@pytest.mark.parametrize("name,windows", [("rpt_velocity_off_hours", 2), ("mart_mule_beneficiaries", 3), ("prim_array_any", 1)])
def test_one_flag_plans_one_rule(spark, sf_dir, name, windows):
    """One window is cleaning's, for copies; the others are the rule's. All six rules take four more."""
    assert len(re.findall(r"Window \[", physical(QUERIES[name](spark, sf_dir)))) == windows


def test_the_mart_looks_beneficiaries_up_once(spark, sf_dir, shuffled_joins):
    text = physical(QUERIES["mart_fraud_summary"](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet .*supplier", text)) == 1


def test_hot_keys_do_not_move_transfers_more_often(tables, shuffled_joins):
    """All other exchanges are of hot keys' instants, five columns wide at most."""
    scope = Scope.of(tables, Params(hot_key_rows=30))
    assert scope.hot_users.any and scope.hot_beneficiaries.any
    df = build_features(scope).transactions.select(PREVIEW_COLUMNS)
    of_facts = [e for e in exchanges(physical(df)) if re.search("_slot_|_lane_|_light_", e)]
    assert sorted(of_facts) == sorted(["_light_key, _light_lane"] * 2 + ["beneficiary_id, _lane_beneficiary_id", "user_id, _slot_user_id"])
    df = rules.apply_rules(scope.with_tables(transactions=scope.transactions)).transactions.select("transaction_id", "rule_flags")
    of_facts = [e for e in exchanges(physical(df)) if re.search("_slot_|_lane_|_light_", e)]
    assert sorted(of_facts) == sorted(["_light_key, _light_lane"] * 2 + ["beneficiary_id, _slot_beneficiary_id", "user_id, _slot_user_id"])


def test_laid_out_tables_are_not_moved_by_user(spark, sf_dir, tmp_path, shuffled_joins):
    write_laid_out(load_fixtures(spark, sf_dir), str(tmp_path), 4)
    scope = Scope.of(*read_laid_out(spark, str(tmp_path)))
    df = build_features(scope).transactions.select(PREVIEW_COLUMNS)
    assert sorted(exchanges(physical(df))) == ["_dim_key", "beneficiary_id"]
    assert Scope.of(*read_laid_out(spark, str(tmp_path), Params(hot_key_rows=30))).timeline is None
