"""Streams over folders: what arrives as files, and what is written once per row."""

import os
from datetime import timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.columns import EPOCH, elapsed_seconds

ROOT = str(Path(__file__).resolve().parents[2])
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def micros(ts: Column) -> Column:
    """Microseconds from 1970 to a zone-less time."""
    return (elapsed_seconds(ts, F.lit(EPOCH).cast("timestamp_ntz")) * 1_000_000).cast("long")


def zoneless(us: str) -> Column:
    """The zone-less time of a column of microseconds since 1970."""
    since = F.expr(f"make_dt_interval(0, 0, 0, cast({us} / 1000000bd as decimal(18,6)))")
    return F.lit(EPOCH).cast("timestamp_ntz") + since


def event_time(ts: Column) -> Column:
    """A zone-less time as the instant of that name in UTC, which a watermark can follow: equal times stay
    equal and in order, whatever the session's zone."""
    return F.timestamp_micros(micros(ts))


def read_files(spark: SparkSession, folder: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as they arrive, the older ones first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def interval(span: timedelta) -> str:
    return f"{span // timedelta(milliseconds=1)} milliseconds"


def ready_for_state(spark: SparkSession) -> None:
    """State of keyed processors lives in RocksDB, beside the heap; their workers import this package."""
    spark.conf.set(STORE, ROCKS)
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, environment.get("PYTHONPATH")]))


def write_files(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Append what the stream yields from all that is there to Parquet files, each row once: batches that
    are repeated after a failure replace themselves, and the next call goes on where this one ended."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(folder).awaitTermination()
