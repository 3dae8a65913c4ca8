"""Copies of transfers that clients send again, on a stream (CL13)."""

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.operators.cleaning import RETRY_KEYS
from tracewell.operators.scope import TXN
from tracewell.streaming.files import event_time, interval


def _timed(transfers: DataFrame, delay: timedelta) -> DataFrame:
    return transfers.withColumn("_event", event_time(F.col("timestamp"))).withWatermark("_event", interval(delay))


def first_arrivals(transfers: DataFrame, delay: timedelta) -> DataFrame:
    """Each transfer as it arrives, without those that are the same as one of up to `delay` before.

    Which of several copies in one micro-batch stays is left open; of copies that arrive one after the
    other it is the first. A copy that comes when the watermark has forgotten the first one is dropped as
    late, since copies have the time of what they copy. Rows without a time are left out."""
    rows = _timed(transfers, delay).filter("_event is not null")
    return rows.dropDuplicatesWithinWatermark(RETRY_KEYS).drop("_event")


def smallest_ids(transfers: DataFrame, delay: timedelta) -> DataFrame:
    """Each transfer once, as its copy with the smallest id, as soon as the watermark has passed its time
    and no more copies can follow. Rows without a time are left out."""
    others = [c for c in transfers.columns if c not in (TXN, "timestamp")]
    rows = _timed(transfers, delay).filter("_event is not null")
    row = F.struct(TXN, "timestamp", *others)
    found = rows.groupBy("_event", *[k for k in RETRY_KEYS if k != "timestamp"]).agg(F.min_by(row, F.col(TXN)).alias("_row"))
    return found.select("_row.*").select(transfers.columns)
