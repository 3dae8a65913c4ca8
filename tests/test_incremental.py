"""Loads into a flagged store: equal to one run, only where something changes, and repeatable."""

import os
from glob import glob

import pytest
from pyspark.sql import functions as F

from tracewell import Params
from tracewell.plans import incremental
from tracewell.plans.incremental import Store
from tracewell.plans.pipeline import plan
from tracewell.sources.fixtures import load_fixtures
from tracewell.sources.tables import Tables, read_tables
from tracewell.sources.writers import write_table


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("loads"))
    made = load_fixtures(spark, sf_dir)
    untimed = F.when(F.col("transaction_id") % 30 == 0, None).otherwise(F.col("timestamp"))
    made = made.with_(transactions=made.transactions.withColumn("timestamp", untimed))
    for name, df in made.named().items():
        write_table(df, f"{folder}/{name}")
    return read_tables(spark, folder)


COLUMNS = ["transaction_id", "timestamp", "amount", "rule_flags", "user_7day_transaction_count", "is_new_device", "distance_from_home_km", "is_beneficiary_new"]


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=lambda r: r[0])


@pytest.fixture(scope="module")
def whole(tables):
    return rows(plan(tables).transactions)


def dealt(tables, seed, parts):
    """Every table cut at random: rows arrive in any order, with their users and beneficiaries before or after them."""
    key = {"users": "user_id", "beneficiaries": "beneficiary_id", "logins": "auth_id", "transactions": "transaction_id"}
    part = {name: F.pmod(F.xxhash64(F.lit(seed), F.col(k)), F.lit(parts)) for name, k in key.items()}
    return [Tables(**{name: getattr(tables, name).filter(p == n) for name, p in part.items()}) for n in range(parts)]


@pytest.mark.parametrize("params", [Params(), Params(hot_key_rows=60)])
def test_loads_in_any_order_equal_one_run(spark, tables, whole, tmp_path, params):
    store = Store(spark, str(tmp_path), params)
    for n, part in enumerate(dealt(tables, 3, 3)):
        store.load(f"load{n}", part)
    assert rows(store.flagged()) == whole


def test_untouched_days_keep_their_files(spark, tables, whole, tmp_path):
    store = Store(spark, str(tmp_path))
    last = F.to_date("timestamp") >= F.lit("2024-01-28").cast("date")
    late_transfers = last & (F.col("user_id") < 6)
    late_logins = (F.to_date("login_timestamp") >= F.lit("2024-01-28").cast("date")) & (F.col("user_id") < 6)
    first = tables.with_(transactions=tables.transactions.filter(~F.coalesce(late_transfers, F.lit(False))), logins=tables.logins.filter(~late_logins))
    store.load("first", first)
    files = {f: os.stat(f).st_mtime_ns for f in glob(f"{tmp_path}/flagged/*/*.parquet")}
    more = Tables(tables.users.limit(0), tables.beneficiaries.limit(0), tables.logins.filter(late_logins), tables.transactions.filter(late_transfers))
    assert not more.transactions.isEmpty()
    store.load("second", more)
    now = {f: os.stat(f).st_mtime_ns for f in glob(f"{tmp_path}/flagged/*/*.parquet")}
    kept = {f for f in files if now.get(f) == files[f]}
    changed = {f.split("txn_date=")[1].split("/")[0] for f in files.keys() - kept}
    assert changed and all(d >= "2024-01-28" or d.startswith("__HIVE") for d in changed) and len(kept) > 20
    assert rows(store.flagged()) == whole


def test_a_load_that_failed_can_be_repeated(spark, tables, whole, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    one, two = dealt(tables, 5, 2)
    store.load("one", one)

    def fail(self, load):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Store, "_finish", fail)
        with pytest.raises(RuntimeError):
            store.load("two", two)
    assert store.finished() == ["one"]
    store.load("two", two)
    assert store.finished() == ["one", "two"] and rows(store.flagged()) == whole


def test_loads_without_transfers_and_known_users(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    none = tables.transactions.limit(0)
    store.load("people", tables.with_(transactions=none, logins=tables.logins.limit(0)))
    with pytest.raises(ValueError, match="users of this load"):
        store.load("again", tables.with_(transactions=none))
    store.load("rest", Tables(tables.users.limit(0), tables.beneficiaries.limit(0), tables.logins, tables.transactions))
    assert rows(store.flagged()) == rows(plan(tables).transactions)


def test_users_and_ids_of_a_load_are_not_sent_through_the_driver(spark, tables, tmp_path, monkeypatch):
    plans = []

    def watched(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write_table(df, path)

    monkeypatch.setattr(incremental, "write_table", watched)
    store = Store(spark, str(tmp_path), Params())
    for n, part in enumerate(dealt(tables, 5, 2)):
        store.load(f"l{n}", part)
    joins = [line for text in plans for line in text.splitlines() if "Join [" in line]
    assert any("SortMergeJoin [transaction_id" in line for line in joins)
    assert not [line for line in joins if "Broadcast" in line and ("[transaction_id" in line or "_u#" in line or "_user_id#" in line)]


def test_transfers_of_a_load_are_written_once_before_their_results(spark, tables, whole, tmp_path, monkeypatch):
    """The mark of what can change goes through the batch; results go from it to their days, and only stored rows are written as what is around."""
    wrote = []

    def watched(df, path):
        write_table(df, path)
        wrote.append((path.split("/")[-1].split("-")[0], spark.read.schema(df.schema).parquet(path).count()))

    monkeypatch.setattr(incremental, "write_table", watched)
    store = Store(spark, str(tmp_path))
    one, two = dealt(tables, 7, 2)
    store.load("one", one)
    assert [(name, n) for name, n in wrote if "load=" not in name] == [("changed", one.transactions.count())]
    wrote.clear()
    store.load("two", two)
    scratch = {name: n for name, n in wrote if "load=" not in name}
    assert set(scratch) == {"changed", "touched", "targets", "around"}
    assert 0 < scratch["around"] <= one.transactions.count()
    assert rows(store.flagged()) == whole and "is_target" not in store.flagged().columns


def test_a_load_with_logins_alone_changes_stored_transfers(spark, tables, whole, tmp_path):
    store = Store(spark, str(tmp_path))
    store.load("all but logins", tables.with_(logins=tables.logins.limit(0)))
    assert rows(store.flagged()) != whole
    store.load("logins", Tables(tables.users.limit(0), tables.beneficiaries.limit(0), tables.logins, tables.transactions.limit(0)))
    assert rows(store.flagged()) == whole
