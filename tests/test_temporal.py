"""Temporal operators against brute force, with no, some and all keys hot."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewell.operators.skew import HotKeys
from tracewell.operators.temporal import asof_last, previous_row, range_count, range_distinct

LIMITS = [10**9, 25, 2]
START = datetime(2024, 1, 1)


def make_rows(count: int, seed: int):
    """A busy key with a third of all rows, shared instants, gaps of exactly one window, NULL keys and times."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        key = 1 if rng.random() < 0.35 else rng.choice([2, 3, 4, 5, None])
        ts = START + timedelta(seconds=rng.choice([0, 0, 60, 300, rng.randrange(0, 4000, 20)]))
        if rng.random() < 0.1:
            ts += timedelta(microseconds=1)
        rows.append((i, key, rng.choice([10, 11, 12, 13, 14, None]), None if rng.random() < 0.08 else ts))
    return rows


def within(ts, t2, window):
    return ts is not None and t2 is not None and ts - window <= t2 <= ts


def frame(spark, rows, names="id long, k long, who long, ts timestamp_ntz"):
    return spark.createDataFrame(rows, names).repartition(5, "id" if "id" in names else "auth")


def hot(frames, limit, key="k", ts="ts"):
    return HotKeys.find({key: frames}, limit, ts)[key]


def test_hot_keys_lists_only_large_keys(spark):
    df = frame(spark, make_rows(120, 1))
    sizes = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    found = hot([df], 25)
    assert {r["k"] for r in found.keys.collect()} == {k for k, n in sizes.items() if n > 25}
    assert not hot([df], 10**9).any


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("window", [timedelta(minutes=5), timedelta(seconds=60), timedelta(hours=1)])
def test_range_count(spark, limit, window):
    rows = make_rows(150, 2)
    df = frame(spark, rows)
    out = range_count(df, "ts", window, "n", "id", hot([df], limit))
    expected = {
        i: sum(k2 == k and (within(ts, t2, window) or ts is None and t2 is None) for _, k2, _, t2 in rows)
        for i, k, _, ts in rows
    }
    assert {r["id"]: r["n"] for r in out.collect()} == expected


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("window", [timedelta(minutes=5), timedelta(seconds=60), timedelta(hours=1)])
def test_range_distinct(spark, limit, window):
    rows = make_rows(150, 3)
    df = frame(spark, rows)
    out = range_distinct(df, "ts", window, "who", "n", "id", hot([df], limit))
    expected = {
        i: len({w for _, k2, w, t2 in rows if k2 == k and w is not None and within(ts, t2, window)})
        for i, k, _, ts in rows
    }
    assert {r["id"]: r["n"] for r in out.collect()} == expected


@pytest.mark.parametrize("limit", LIMITS)
def test_asof_last(spark, limit):
    left, right = make_rows(120, 4), make_rows(90, 5)
    dl, dr = frame(spark, left), frame(spark, right, "auth long, k long, who long, ts2 timestamp_ntz")
    counted = hot([dl, dr.withColumnRenamed("ts2", "ts")], limit)
    out = asof_last(dl, dr, "k", "ts", "ts2", ["who", "auth"], "auth", "hit", "id", counted)
    got = {r["id"]: None if r["hit"] is None else (r["hit"]["auth"], r["hit"]["who"]) for r in out.collect()}
    expected = {}
    for i, k, _, ts in left:
        seen = [(t2, a, w) for a, k2, w, t2 in right if k is not None and k2 == k and within(ts, t2, timedelta(days=9))]
        best = max(seen, key=lambda s: s[:2], default=None)
        expected[i] = None if best is None else (best[1], best[2])
    assert got == expected


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("text_ids", [False, True])
def test_previous_row(spark, limit, text_ids):
    rows = make_rows(150, 6)
    if text_ids:
        rows = [(f"auth_{(i * 2654435761) % 2**32:08x}-{i}", k, w, ts) for i, k, w, ts in rows]
    else:
        rows = [(i * 700_001, k, w, ts) for i, k, w, ts in rows]
    kind = "string" if text_ids else "long"
    df = spark.createDataFrame(rows, f"id {kind}, k long, who long, ts timestamp_ntz").repartition(5, "id")
    out = previous_row(df, "ts", "id", ["id", "ts", "who"], "p", hot([df], limit))
    got = {r["id"]: None if r["p"] is None else r["p"]["id"] for r in out.collect()}
    expected = {}
    for k in {r[1] for r in rows}:
        last = None
        for _, i in sorted((ts or datetime.min, i) for i, k2, _, ts in rows if k2 == k):
            expected[i], last = last, i
    assert got == expected


@pytest.mark.parametrize("limit", LIMITS)
def test_join_dimension(spark, limit):
    rows = make_rows(120, 7)
    df = frame(spark, rows)
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, label string")
    out = hot([df], limit).join_dimension(df, dim, {"label": "_label"}, "_known", "id")
    labels = {1: "a", 2: "b", 3: None}
    assert {r["id"]: (r["_known"], r["_label"]) for r in out.collect()} == {
        i: (k in labels, labels.get(k)) for i, k, _, _ in rows
    }


def test_hot_rows_are_spread(spark):
    df = frame(spark, make_rows(150, 8))
    counted = hot([df], 25)
    groups = counted.tag(df, "id").groupBy(*counted.placement).count()
    assert groups.agg(F.max("count")).first()[0] <= 25


@pytest.mark.parametrize("limit", [25, 2])
def test_slots_hold_no_more_than_the_limit(spark, limit):
    df = frame(spark, make_rows(400, 9))
    counted = hot([df], limit)
    assert counted.crowds is not None
    slots = counted.tag_instants(df, "id", "ts").groupBy(*counted.slots).count()
    assert slots.agg(F.max("count")).first()[0] <= limit


def test_the_timeline_keeps_the_sessions_number_of_partitions(spark):
    """Small partitions joined into one or two more than there are cores leave most cores idle behind the last of them."""
    left = frame(spark, make_rows(400, 11))
    right = left.select(F.col("id").alias("auth"), "k", F.col("ts").alias("at"))
    found = asof_last(left, right, "k", "ts", "at", ["auth"], "auth", "found", "id", hot([left, right], 10**9))
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
