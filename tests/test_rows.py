"""Evidence rows, violating rows and rejected rows against brute force."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tracewell import Params
from tracewell.functions.columns import drawn
from tracewell.operators.evidence import mule_senders
from tracewell.operators.scope import Scope
from tracewell.plans.quality import constraint_report, constraint_rows
from tracewell.sources.fixtures import load_fixtures
from tracewell.sources.readers import read_csv_checked
from tracewell.sources.schemas import SPECS, TRANSACTIONS, USERS
from tracewell.sources.tables import Tables

START = datetime(2024, 1, 1)


def empty(spark):
    frames = {n: spark.createDataFrame([], s.schema) for n, s in SPECS.items()}
    return Tables(frames["users"], frames["beneficiaries"], frames["device_authentications"], frames["transactions"])


@pytest.mark.parametrize("limit", [10**9, 30])
@pytest.mark.parametrize("part", [100_000, 2])
def test_senders_behind_hits(spark, limit, part):
    r = random.Random(3)
    rows = []
    for i in range(200):
        at = None if r.random() < 0.05 else START + timedelta(minutes=r.choice([r.randrange(300), 60, 120]), microseconds=r.choice([0, 0, 1]))
        rows.append((i, r.choice([1, 2, 3, 4, 5, 6, None]), r.choice([1, 1, 2, None]), Decimal(5), at))
    df = spark.createDataFrame(rows, "transaction_id long, user_id long, beneficiary_id long, amount decimal(15,2), timestamp timestamp_ntz").repartition(4)
    scope = Scope.of(empty(spark).with_(transactions=df), Params(hot_key_rows=limit, mule_min_senders=3))
    got = {x.transaction_id: x.senders for x in mule_senders(df, scope, part).collect()}
    want = {}
    for i, _, b, _, t in rows:
        if b is not None and t is not None:
            who = {u for _, u, b2, _, t2 in rows if b2 == b and u is not None and t2 is not None and t - timedelta(hours=1) <= t2 <= t}
            if len(who) >= 3:
                want[i] = sorted(who)
    assert got == want


@pytest.mark.parametrize("limit", [10**9, 30])
@pytest.mark.parametrize("part", [100_000, 2])
def test_lists_of_senders_are_made_where_they_end(spark, limit, part):
    """No list is shuffled, sorted or aggregated once it is made; copies of an id and rows without one keep theirs."""
    rows = [(None if i % 7 == 0 else i % 90, f"u{i % 40}", 1 + i % 2, Decimal(5), START + timedelta(minutes=i // 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "transaction_id long, user_id string, beneficiary_id long, amount decimal(15,2), timestamp timestamp_ntz").repartition(4)
    scope = Scope.of(empty(spark).with_(transactions=df), Params(hot_key_rows=limit, mule_min_senders=4))
    found = mule_senders(df, scope, part)
    above = found._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin", 1)[0]
    assert "filter(_seen" in above
    assert not any(word in above for word in ("Exchange", "Aggregate", "Sort"))
    want = Counter()
    for i, _, b, _, t in rows:
        who = {u for _, u, b2, _, t2 in rows if b2 == b and t - timedelta(hours=1) <= t2 <= t}
        if len(who) >= 4:
            want[i, tuple(sorted(who))] += 1
    assert Counter((x.transaction_id, tuple(x.senders)) for x in found.collect()) == want


def totals(rows):
    return Counter({(r.table_name, r.check_name, r.column_name): 0 for r in rows})


def test_violating_rows_add_up_to_the_report(spark, sf_dir):
    made = load_fixtures(spark, sf_dir)
    users = made.users.select(*[c for c in made.users.columns if c not in ("email", "phone", "risk_tier", "home_city")], F.when(F.col("user_id") % 4 != 0, F.concat(F.lit("same"), F.col("user_id") % 3)).alias("email"), F.col("phone"), F.lit("odd").alias("risk_tier"), F.lit("long " * 20).alias("home_city"))
    users = users.select(made.users.columns)
    transactions = made.transactions.withColumn("transaction_balance_ratio", F.lit(11).cast("decimal(20,4)"))
    tables = made.with_(users=users.unionByName(users.filter("user_id < 5")), transactions=transactions)
    lines = constraint_report(tables).collect()
    want = {(x.table_name, x.check_name, x.column_name): x.violations for x in lines if x.violations}
    found = constraint_rows(tables).collect()
    got = Counter()
    for x in found:
        got[x.table_name, x.check_name, x.column_name] += x.copies
    assert dict(got) == want and {"unique", "primary_key", "foreign_key", "check", "length", "range", "not_null"} <= {k[1] for k in want}
    emails = {x.row_key for x in found if x.column_name == "email" and x.check_name == "unique"}
    held = {}
    for u in users.collect():
        if u.email:
            held.setdefault(u.email, []).append(u.user_id)
    assert emails >= {str(u) for ids in held.values() for u in ids if u != min(ids)}
    assert constraint_rows(empty(spark)).count() == 0


def written(tmp_path, text):
    (tmp_path / "x.csv").write_text(text)
    return str(tmp_path)


def test_malformed_rows_are_set_aside(spark, tmp_path):
    path = written(
        tmp_path,
        "Amount,transaction_id ,timestamp,note,fraud_score,is_ground_truth_fraud\n"
        '12.50,a,2024-01-01 10:00:00,"x, y",0.5,true\n'
        "oops,b,2024-01-01 10:00:00,x,0.5,false\n"
        "1,c,never,x,bad,maybe\n"
        "1,d,2024-01-01 10:00:00\n"
        "1,e,2024-01-01 10:00:00,x,0.5,true,more\n"
        ",f,,x,,\n"
        "99999999999999999999,g,2024-01-01,x,0.5,true\n"
        ' 7 ,h,2024-01-01 10:00:00.000001,"say ""hi""",0.5,true\n',
    )
    good, rejected = read_csv_checked(spark, path, TRANSACTIONS)
    assert good.columns == TRANSACTIONS.schema.names
    rows = {r.transaction_id: (r.amount, r.timestamp, r.status) for r in good.select("transaction_id", "amount", "timestamp", "status").collect()}
    assert rows == {
        "a": (Decimal("12.50"), datetime(2024, 1, 1, 10), "pending"),
        "f": (None, None, "pending"),
        "h": (Decimal("7.00"), datetime(2024, 1, 1, 10, 0, 0, 1), "pending"),
    }
    reasons = {r.record.split(",")[1]: r.reasons for r in rejected.collect()}
    assert reasons == {
        "b": ["amount is not a decimal(15,2)"],
        "c": ["timestamp is not a timestamp_ntz", "fraud_score is not a decimal(5,4)", "is_ground_truth_fraud is not a boolean"],
        "d": ["wrong number of values"],
        "e": ["wrong number of values"],
        "g": ["amount is not a decimal(15,2)"],
    }


def test_files_without_rows_or_key(spark, tmp_path):
    good, rejected = read_csv_checked(spark, written(tmp_path, "user_id,created_at\n"), USERS)
    assert good.count() == rejected.count() == 0
    with pytest.raises(ValueError, match="transaction_id"):
        read_csv_checked(spark, str(tmp_path), TRANSACTIONS)


def test_samples_do_not_depend_on_partitions(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "transaction_id")
    one = {r[0] for r in ids.filter(drawn("transaction_id", 0.03, 1)).collect()}
    two = {r[0] for r in ids.repartition(13).filter(drawn("transaction_id", 0.03, 1)).collect()}
    other = {r[0] for r in ids.filter(drawn("transaction_id", 0.03, 2)).collect()}
    assert one == two and 500 < len(one) < 700 and len(one & other) < 60
