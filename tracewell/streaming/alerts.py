"""Rules on a stream of transfers: exact trailing counts per key, as soon as the watermark says that they are complete."""

from collections import OrderedDict
from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracewell.operators.scope import TXN
from tracewell.params import Params
from tracewell.streaming.files import event_time, interval, micros, ready_for_state, zoneless

# One condition on the time too, so that it is not moved in front of the watermark: rows without a key,
# among them those that only say how far the time has come, still move it.
KEYED = "if(_event is null, false, key is not null)"


class TrailingDistinct(StatefulProcessor):
    """For each row of a key, how many different `who` there are in [t - window, t].

    State is one value per key: the rows that wait for the watermark, and the last time of each `who` that
    can still be in a window. A timer at the earliest waiting row takes up what the watermark has passed,
    in order of time; one behind the last window forgets the key.
    """

    def __init__(self, window: int, ids: T.DataType, people: T.DataType):
        self.window = window
        lists = {"times": T.LongType(), "ids": ids, "who": people, "seen": people, "seen_times": T.LongType()}
        self.kind = T.StructType([T.StructField(name, T.ArrayType(kind)) for name, kind in lists.items()])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rows", self.kind)

    def close(self) -> None:
        pass

    def _load(self) -> tuple[list[tuple], list[tuple]]:
        if not self.state.exists():
            return [], []
        times, ids, who, seen, seen_times = self.state.get()
        return list(zip(times, ids, who)), list(zip(seen, seen_times))

    def _save(self, waiting: list[tuple], seen: list[tuple]) -> None:
        columns = [*(zip(*waiting) if waiting else [()] * 3), *(zip(*seen) if seen else [()] * 2)]
        self.state.update(tuple(map(list, columns)))

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(at // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        waiting, seen = self._load()
        new = [(r["at"], r["id"], r["who"]) for r in rows]
        first = min(r[0] for r in new)
        if not waiting or first < min(r[0] for r in waiting):
            self._wake(first)
        self._save(waiting + new, seen)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, seen = self._load()
        ready = sorted((r for r in waiting if r[0] <= passed), key=lambda r: r[0])
        waiting = [r for r in waiting if r[0] > passed]
        last = OrderedDict(seen)  # the longest ago first
        out, done = [], 0
        while done < len(ready):
            now, peers = ready[done][0], done
            while peers < len(ready) and ready[peers][0] == now:
                if (who := ready[peers][2]) is not None:
                    last[who] = now
                    last.move_to_end(who)
                peers += 1
            while last and next(iter(last.values())) < now - self.window:
                last.popitem(last=False)
            out += [Row(key=key[0], id=r[1], at=now, n=len(last)) for r in ready[done:peers]]
            done = peers
        seen = [(who, t) for who, t in last.items() if t >= passed - self.window]
        if waiting:
            self._wake(min(r[0] for r in waiting))
        elif seen:
            self._wake(seen[-1][1] + self.window)
        if waiting or seen:
            self._save(waiting, seen)
        else:
            self.state.clear()
        return iter(out)


def trailing_distinct(
    transfers: DataFrame, key: str, who: str, window: timedelta, delay: timedelta, out: str
) -> DataFrame:
    """A stream of transaction_id, `key`, timestamp and `out`: different `who` among the key's transfers in
    [t - window, t], for every transfer with a key and a time, given when nothing older can follow.

    `delay` is how late a transfer may be against the latest one seen; later ones are dropped, as they would
    change counts that have been given. What is kept for a key is bounded by its transfers in delay and window."""
    ready_for_state(transfers.sparkSession)
    kinds = transfers.schema
    rows = transfers.select(
        F.col(key).alias("key"),
        F.col(TXN).alias("id"),
        F.col(who).alias("who"),
        micros(F.col("timestamp")).alias("at"),
        event_time(F.col("timestamp")).alias("_event"),
    )
    rows = rows.withWatermark("_event", interval(delay)).filter(KEYED)
    counted = T.StructType(
        [
            T.StructField("key", kinds[key].dataType),
            T.StructField("id", kinds[TXN].dataType),
            T.StructField("at", T.LongType()),
            T.StructField("n", T.LongType()),
        ]
    )
    processor = TrailingDistinct(window // timedelta(microseconds=1), kinds[TXN].dataType, kinds[who].dataType)
    found = rows.groupBy("key").transformWithState(processor, counted, "append", "eventTime")
    return found.select(
        F.col("id").alias(TXN), F.col("key").alias(key), zoneless("at").alias("timestamp"), F.col("n").alias(out)
    )


def velocity_alerts(transfers: DataFrame, delay: timedelta, params: Params = Params()) -> DataFrame:
    """R2 on a stream: transfers that are among too many of their user's in the trailing window."""
    burst = trailing_distinct(transfers, "user_id", TXN, params.velocity_window, delay, "transfers")
    return burst.filter(F.col("transfers") > params.velocity_max)


def mule_alerts(transfers: DataFrame, delay: timedelta, params: Params = Params()) -> DataFrame:
    """R6 on a stream: transfers to a beneficiary that too many different users have sent to in the window."""
    senders = trailing_distinct(transfers, "beneficiary_id", "user_id", params.mule_window, delay, "senders")
    return senders.filter(F.col("senders") >= params.mule_min_senders)
