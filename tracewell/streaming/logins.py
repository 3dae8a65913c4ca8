"""The login before each transfer, from two streams."""

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracewell.operators.scope import TXN
from tracewell.streaming.alerts import KEYED
from tracewell.streaming.files import event_time, interval, micros, ready_for_state, zoneless

LOGIN_COLUMNS = ("device_id", "ip_latitude", "ip_longitude")


class LastLogin(StatefulProcessor):
    """Transfers and logins of one user; a transfer waits until no login before it can follow.

    State is one value per user: the transfers that wait, the logins behind the watermark's last one and
    that one itself, which later transfers may still refer to.
    """

    def __init__(self, ids: T.DataType, ties: T.DataType, columns: dict[str, T.DataType]):
        lists = {"times": T.LongType(), "ids": ids, "login_times": T.LongType(), "ties": ties, **columns}
        self.kind = T.StructType([T.StructField(name, T.ArrayType(kind)) for name, kind in lists.items()])
        self.columns = list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rows", self.kind)
        self.found = Row("key", "id", "at", "login_at", *self.columns)

    def close(self) -> None:
        pass

    def _load(self) -> tuple[list[tuple], list[tuple]]:
        """Waiting transfers (time, id) and logins (time, tie, columns…)."""
        if not self.state.exists():
            return [], []
        times, ids, *logins = self.state.get()
        return list(zip(times, ids)), list(zip(*logins))

    def _save(self, waiting: list[tuple], logins: list[tuple]) -> None:
        width = 2 + len(self.columns)
        columns = [*(zip(*waiting) if waiting else [()] * 2), *(zip(*logins) if logins else [()] * width)]
        self.state.update(tuple(map(list, columns)))

    def _still_needed(self, waiting: list[tuple], logins: list[tuple], passed: int) -> list[tuple]:
        """Logins in order, without those that another one hides from every transfer that waits or can follow."""
        until = min([passed, *(w[0] for w in waiting)])
        logins = sorted(logins, key=lambda r: r[:2])
        hidden = sum(r[0] <= until for r in logins) - 1
        return logins[max(0, hidden) :]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        waiting, logins = self._load()
        first = min((w[0] for w in waiting), default=None)
        for r in rows:
            if r["is_login"]:
                logins.append((r["at"], r["tie"], *(r[c] for c in self.columns)))
            else:
                waiting.append((r["at"], r["id"]))
        if waiting and (first is None or min(w[0] for w in waiting) < first):
            self.handle.registerTimer(min(w[0] for w in waiting) // 1000 + 1)
        self._save(waiting, self._still_needed(waiting, logins, timerValues.getCurrentWatermarkInMs() * 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, logins = self._load()
        logins = sorted(logins, key=lambda r: r[:2])
        out, seen, last = [], 0, None
        for at, id_ in sorted((w for w in waiting if w[0] <= passed), key=lambda w: w[0]):
            while seen < len(logins) and logins[seen][0] <= at:
                last, seen = logins[seen], seen + 1
            found = (last[0], *last[2:]) if last else (None,) * (1 + len(self.columns))
            out.append(self.found(key[0], id_, at, *found))
        waiting = [w for w in waiting if w[0] > passed]
        if waiting:
            self.handle.registerTimer(min(w[0] for w in waiting) // 1000 + 1)
        self._save(waiting, self._still_needed(waiting, logins, passed))
        return iter(out)


def last_logins(transfers: DataFrame, logins: DataFrame, delay: timedelta) -> DataFrame:
    """A stream of transaction_id, user_id, timestamp and the user's latest login at or before the transfer
    (login_timestamp, device_id, ip_latitude, ip_longitude; NULL where there is none; of equal times the
    largest auth_id), given when the watermark of both streams has passed the transfer.

    `delay` is how late a row may be against the latest one of its own stream; later ones are dropped."""
    ready_for_state(transfers.sparkSession)
    t, r = transfers.schema, logins.schema
    if t["user_id"].dataType != r["user_id"].dataType:
        raise ValueError("user_id has two types")
    columns = {c: r[c].dataType for c in LOGIN_COLUMNS}
    time, login_time = F.col("timestamp"), F.col("login_timestamp")
    probes = transfers.select(
        F.col("user_id").alias("key"),
        micros(time).alias("at"),
        event_time(time).alias("_event"),
        F.lit(False).alias("is_login"),
        F.col(TXN).alias("id"),
        F.lit(None).cast(r["auth_id"].dataType).alias("tie"),
        *[F.lit(None).cast(kind).alias(c) for c, kind in columns.items()],
    ).withWatermark("_event", interval(delay))
    marks = logins.select(
        F.col("user_id").alias("key"),
        micros(login_time).alias("at"),
        event_time(login_time).alias("_event"),
        F.lit(True).alias("is_login"),
        F.lit(None).cast(t[TXN].dataType).alias("id"),
        F.col("auth_id").alias("tie"),
        *columns,
    ).withWatermark("_event", interval(delay))
    out = T.StructType(
        [
            T.StructField("key", t["user_id"].dataType),
            T.StructField("id", t[TXN].dataType),
            T.StructField("at", T.LongType()),
            T.StructField("login_at", T.LongType()),
            *[T.StructField(c, kind) for c, kind in columns.items()],
        ]
    )
    processor = LastLogin(t[TXN].dataType, r["auth_id"].dataType, columns)
    found = probes.union(marks).filter(KEYED).groupBy("key").transformWithState(processor, out, "append", "eventTime")
    return found.select(
        F.col("id").alias(TXN),
        F.col("key").alias("user_id"),
        zoneless("at").alias("timestamp"),
        zoneless("login_at").alias("login_timestamp"),
        *columns,
    )
