"""The whole batch on the derived tables: staged run, invariants, hot keys."""

from glob import glob

import pytest
from pyspark.sql import functions as F

from tracewell import Params
from tracewell.operators import rules
from tracewell.plans import marts
from tracewell.plans.pipeline import current_run, plan, run, run_folder
from tracewell.sources.fixtures import load_fixtures, load_portable
from tracewell.sources.schemas import LOGINS, TRANSACTIONS
from tracewell.sources.tables import read_tables
from tracewell.sources.writers import write_table


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Derived tables written once, as a load would leave them."""
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, df in load_fixtures(spark, sf_dir).named().items():
        write_table(df, f"{folder}/{name}")
    return folder


@pytest.fixture(scope="module")
def done(spark, stored, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return run(spark, read_tables(spark, stored), out, date_partitions=True), current_run(spark, out)


def facts(tables):
    columns = [c for c in TRANSACTIONS.schema.names if c not in ("reviewed_at", "reviewed_by")]
    return {r["transaction_id"]: r for r in tables.transactions.select(columns).collect()}


def test_staged_run_equals_lazy_plan(spark, stored, done):
    assert facts(done[0]) == facts(plan(read_tables(spark, stored)))


@pytest.mark.parametrize("limit", [20, 100])
def test_hot_keys_do_not_change_results(spark, stored, done, limit):
    assert facts(plan(read_tables(spark, stored), Params(hot_key_rows=limit))) == facts(done[0])


def test_hot_keys_do_not_change_staged_results(spark, stored, done, tmp_path):
    again = run(spark, read_tables(spark, stored), str(tmp_path), Params(hot_key_rows=60))
    assert facts(again) == facts(done[0])


def test_staged_run_in_recompute_mode(spark, stored, tmp_path):
    tables = read_tables(spark, stored)
    assert facts(run(spark, tables, str(tmp_path), mode="recompute")) == facts(plan(tables, mode="recompute"))


def test_a_failed_run_leaves_the_former_one(spark, stored, tmp_path):
    tables, out = read_tables(spark, stored), str(tmp_path)
    run(spark, tables, out)
    before = current_run(spark, out)
    broken = tables.transactions.withColumn("fraud_score", F.raise_error(F.lit("broken")).cast("decimal(5,4)"))
    with pytest.raises(Exception, match="broken"):
        run(spark, tables.with_(transactions=broken), out)
    assert current_run(spark, out) == before and spark.read.parquet(f"{before}/flagged/transactions").count() == 503
    with pytest.raises(ValueError, match="source folder"):
        run_folder(spark, stored, stored)


def test_portable_input_does_not_depend_on_hot_keys(spark, sf_dir):
    few, none = (load_portable(spark, sf_dir, limit) for limit in (5, 10**9))
    assert few.exceptAll(none).isEmpty() and none.exceptAll(few).isEmpty()


def test_written_marts(spark, done):
    tables, out = done
    summary = spark.read.parquet(f"{out}/marts/fraud_summary")
    breakdown = spark.read.parquet(f"{out}/marts/rule_breakdown")
    assert summary.count() == tables.transactions.count() == 503
    assert breakdown.count() == summary.agg(F.sum("triggered_rules_count")).first()[0] == 128
    assert summary.filter("is_flagged = 1").count() == 108
    assert len(glob(f"{out}/marts/fraud_summary/txn_date=*/*.parquet")) == summary.select("txn_date").distinct().count()
    day = summary.agg(F.min("txn_date")).first()[0]
    pruned = summary.filter(F.col("txn_date") == F.lit(day))
    assert "PartitionFilters: [isnotnull(txn_date" in pruned._jdf.queryExecution().toString()


def test_views(spark, done):
    tables = done[0]
    tables.register_views()
    marts.register_views(tables)
    got = spark.sql(
        "select count(*) from vw_dashboard_rule_breakdown b"
        " join transactions t using (transaction_id) where b.rule_name = 'velocity_rule'"
    )
    assert got.first()[0] == 28
    assert spark.sql("select * from vw_dashboard_fraud_summary limit 5").count() == 5
    firsts = spark.sql("select count_if(prev_login_timestamp is null), count(distinct user_id) from user_login_history")
    assert firsts.first()[0] == firsts.first()[1]


def test_structuring_implies_evasion_without_repair(done):
    flagged = done[0].transactions.filter(F.array_contains("rule_flags", rules.STRUCTURING))
    assert flagged.filter(~F.array_contains("rule_flags", rules.EVASION)).isEmpty()


def test_run_folder(spark, stored, tmp_path):
    out = run_folder(spark, stored, str(tmp_path))
    assert marts.kpi_cards(out.transactions).first()["flagged_txns"] == 108


def test_parameters_reach_the_rules(spark, stored):
    tables = read_tables(spark, stored)
    strict = plan(tables, Params(velocity_max=0, cross_border_floor=10**12, high_risk_countries=("Nowhere",)))
    counts = {r["rule_name"]: r["triggered_count"] for r in rules.trigger_counts(strict.transactions).collect()}
    assert counts[rules.VELOCITY] == 503
    assert rules.CROSS_BORDER not in counts and rules.STRUCTURING not in counts


def test_schema_of_logins(spark, stored):
    assert read_tables(spark, stored).logins.schema.names == LOGINS.schema.names
