"""Streams: late rows, restarts, what state keeps, batches that are repeated."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tracewell.operators import rules
from tracewell.params import Params
from tracewell.sources.schemas import SPECS
from tracewell.sources.tables import Tables
from tracewell.streaming import alerts, logins, marts, retries
from tracewell.streaming.files import event_time, micros, read_files, write_files, zoneless

START = datetime(2024, 3, 1)
HOUR = timedelta(hours=1)
TRANSFER = "transaction_id long, user_id long, beneficiary_id long, amount decimal(15,2), timestamp timestamp_ntz"
LOGIN = "auth_id long, user_id long, login_timestamp timestamp_ntz, device_id string, ip_latitude decimal(10,6), ip_longitude decimal(10,6)"


class Source:
    """A folder that rows are put in, and a stream of it."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def put(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return read_files(self.spark, self.path, self.schema)


@pytest.fixture
def transfers(spark, tmp_path):
    return Source(spark, tmp_path / "transfers", TRANSFER)


def transfer(id_, minutes, user=1, beneficiary=1, amount=Decimal(5)):
    return id_, user, beneficiary, amount, START + timedelta(minutes=minutes)


def only_time(minutes):
    return None, None, None, None, START + timedelta(minutes=minutes)


def go_on(spark, tmp_path, stream, schema):
    write_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    return [tuple(r) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [datetime(2024, 3, 10, 2, 30, 0, 123456), datetime(1969, 12, 31, 23, 59, 59, 1), datetime(2024, 11, 3, 1, 30)]
        df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz").withColumn("us", micros(F.col("ts")))
        back = df.select("ts", "us", zoneless("us").alias("back"), F.unix_micros(event_time(F.col("ts"))).alias("instant")).collect()
        for t, r in zip(times, back, strict=True):
            assert r.ts == r.back == t and r.us == r.instant == (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_copies_inside_and_outside_the_watermark(spark, tmp_path, transfers):
    def result():
        return sorted(r[0] for r in go_on(spark, tmp_path, retries.first_arrivals(transfers.stream(), HOUR), TRANSFER) if r[0])

    transfers.put(transfer(1, 0), transfer(2, 10), transfer(3, 10, amount=Decimal(6)))
    assert result() == [1, 2, 3]
    transfers.put(transfer(4, 0), transfer(5, 50))  # 4 is a copy of 1, an hour late at most
    assert result() == [1, 2, 3, 5]
    transfers.put(only_time(200))
    assert result() == [1, 2, 3, 5]
    transfers.put(transfer(6, 0), transfer(7, 50), transfer(8, 190))  # too late by now, copies or not
    assert result() == [1, 2, 3, 5, 8]


def test_smallest_id_of_copies(spark, tmp_path, transfers):
    def result():
        return sorted(r[0] for r in go_on(spark, tmp_path, retries.smallest_ids(transfers.stream(), HOUR), TRANSFER) if r[0])

    transfers.put(transfer(9, 0), transfer(2, 10))
    assert result() == []
    transfers.put(transfer(4, 0), transfer(5, 0), transfer(None, 0, user=None))
    assert result() == []
    transfers.put(only_time(200))
    assert result() == [2, 4]


ALERT = "transaction_id long, user_id long, timestamp timestamp_ntz, transfers long"


def test_velocity_alerts_are_given_once_whatever_the_order(spark, tmp_path, transfers):
    def result():
        return sorted(r[0] for r in go_on(spark, tmp_path, alerts.velocity_alerts(transfers.stream(), HOUR), ALERT))

    transfers.put(transfer(1, 0), transfer(2, 1), transfer(4, 5), transfer(None, 1, user=None))
    assert result() == []
    transfers.put(transfer(3, 2), transfer(5, 5), transfer(6, 7, user=2))  # 3 comes late and counts
    assert result() == []
    transfers.put(transfer(7, 120))  # moves the watermark past them: 4 and 5 have 1, 2, 3, each other
    assert result() == [4, 5]
    transfers.put(transfer(8, 6))  # an hour and more late: dropped, and nothing is given twice
    assert result() == [4, 5]
    assert result() == [4, 5]
    transfers.put(*(transfer(10 + i, 121 + i) for i in range(4)), only_time(1000))
    assert result() == [4, 5, 12, 13]


def keyed_rows(seed, n=250):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        minutes = r.choice([r.randrange(0, 300), r.randrange(100, 104)])
        who = r.choice([1, 1, 1, 2, 3, 4, 5, None])
        rows.append((i, who, r.choice([1, 1, 2, None]), Decimal(5), START + timedelta(minutes=minutes, microseconds=r.choice([0, 0, 1]))))
    return rows


def test_counts_against_brute_force(spark, tmp_path, transfers):
    rows = keyed_rows(1)
    params = Params(velocity_max=3, mule_min_senders=3)
    streams = {
        "v": (lambda: alerts.velocity_alerts(transfers.stream(), 8 * HOUR, params), ALERT),
        "m": (lambda: alerts.mule_alerts(transfers.stream(), 8 * HOUR, params), "transaction_id long, beneficiary_id long, timestamp timestamp_ntz, senders long"),
    }
    for part in range(3):
        transfers.put(*rows[part::3])
        for name, (stream, schema) in streams.items():
            go_on(spark, tmp_path / name, stream(), schema)
    transfers.put(only_time(5000))
    got = {name: sorted((r[0], r[3]) for r in go_on(spark, tmp_path / name, stream(), schema)) for name, (stream, schema) in streams.items()}

    def trailing(t, t2, window):
        return t - window <= t2 <= t

    bursts = [(i, sum(u2 == u and trailing(t, t2, params.velocity_window) for _, u2, _, _, t2 in rows)) for i, u, _, _, t in rows if u is not None]
    assert got["v"] == sorted(x for x in bursts if x[1] > 3)
    mules = [(i, len({u2 for _, u2, b2, _, t2 in rows if b2 == b and u2 is not None and trailing(t, t2, params.mule_window)})) for i, _, b, _, t in rows if b is not None]
    assert got["m"] == sorted(x for x in mules if x[1] >= 3)


def test_state_is_given_up_behind_the_window(spark, tmp_path, transfers):
    stream = lambda: alerts.velocity_alerts(transfers.stream(), HOUR)

    def held():
        go_on(spark, tmp_path, stream(), ALERT)
        state = spark.read.format("statestore").option("stateVarName", "rows").load(str(tmp_path / "checkpoint"))
        return {r.key.key: len(r.value.times) + len(r.value.seen) for r in state.select("key", "value").collect()}

    transfers.put(*(transfer(i, i / 10) for i in range(40)), transfer(100, 1, user=2))
    assert held() == {1: 40, 2: 1}
    transfers.put(transfer(101, 64, user=3))  # watermark at minute 4: all of them are evaluated
    assert held() == {1: 40, 2: 1, 3: 1}  # still in a window
    transfers.put(transfer(102, 67, user=3))  # at minute 7
    assert held() == {1: 40, 3: 2}  # the window behind the last row of user 2 is over
    transfers.put(transfer(103, 1000, user=3))
    assert set(held()) == {3}


LAST = "transaction_id long, user_id long, timestamp timestamp_ntz, login_timestamp timestamp_ntz, device_id string, ip_latitude decimal(10,6), ip_longitude decimal(10,6)"


def test_late_logins_count(spark, tmp_path, transfers):
    logged = Source(spark, tmp_path / "logins", LOGIN)

    def login(id_, minutes, user=1):
        return id_, user, START + timedelta(minutes=minutes), f"device{id_}", None, None

    def result():
        rows = go_on(spark, tmp_path, logins.last_logins(transfers.stream(), logged.stream(), HOUR), LAST)
        return sorted((r[0], r[4]) for r in rows)

    transfers.put(transfer(1, 10), transfer(2, 30), transfer(3, 30, user=2))
    logged.put(login(1, 0), login(2, 20))
    assert result() == []
    logged.put(login(4, 10), login(3, 10), login(5, 31))  # late, in time for transfer 1; of equal times the larger id
    transfers.put(transfer(4, 200))
    assert result() == []  # logins may still come: their stream is only at minute 31
    logged.put(login(6, 205, user=3))
    transfers.put(only_time(201))  # a run that sees one stream only does not move the watermark
    assert result() == [(1, "device4"), (2, "device2"), (3, None)]
    logged.put(login(7, 25), login(8, 500, user=3))  # too late for transfer 2, which has been given
    transfers.put(only_time(500))
    assert result() == [(1, "device4"), (2, "device2"), (3, None), (4, "device5")]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    schema = "transaction_id long, beneficiary_id long, amount decimal(15,2), timestamp timestamp_ntz, rule_flags array<string>"
    source = Source(spark, tmp_path / "flagged", schema)
    banks = spark.createDataFrame([(1, "VCB")], "beneficiary_id long, beneficiary_bank_code string")
    none = {n: spark.createDataFrame([], s.schema) for n, s in SPECS.items()}
    tables = Tables(none["users"], banks, none["device_authentications"], none["transactions"])
    folder, checkpoint = str(tmp_path / "mart"), str(tmp_path / "checkpoint")
    first = [(1, 1, Decimal(5), START, [rules.EVASION, rules.VELOCITY]), (2, 7, Decimal(5), START, []), (3, 7, Decimal(5), START, [rules.VELOCITY])]
    source.put(*first)
    marts.stream_rule_breakdown(source.stream(), tables, folder, checkpoint)
    want = {(1, rules.EVASION, "VCB"), (1, rules.VELOCITY, "VCB"), (3, rules.VELOCITY, None)}

    def result():
        rows = marts.read_mart(spark, folder).collect()
        assert len(rows) == len(set(rows))
        return {(r.transaction_id, r.rule_name, r.beneficiary_bank_code) for r in rows}

    assert result() == want
    again = spark.createDataFrame(first, schema)
    marts.write_batch(marts.rule_breakdown(tables.with_(transactions=again)), folder, 0)  # as after a failure before the commit
    assert result() == want
    source.put((4, 1, Decimal(5), START, [rules.VELOCITY]))
    marts.stream_rule_breakdown(source.stream(), tables, folder, checkpoint)
    assert result() == want | {(4, rules.VELOCITY, "VCB")}
