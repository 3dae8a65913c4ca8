"""Marts that a stream keeps up to date (SNK4): each micro-batch is a folder of its own, so one that is repeated replaces itself."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracewell.plans.marts import rule_breakdown
from tracewell.sources.tables import Tables


def write_batch(mart: DataFrame, folder: str, batch_id: int) -> None:
    """The rows of one micro-batch, in place of what an earlier attempt at it has left."""
    mart.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def write_mart_stream(stream: DataFrame, folder: str, checkpoint: str, mart: Callable[[DataFrame], DataFrame]) -> None:
    """Append to the mart what all that is there adds to it. `mart` makes rows of the mart from new
    rows of the stream, which may join tables; it must not look back at earlier rows."""

    def one(batch: DataFrame, batch_id: int) -> None:
        write_batch(mart(batch), folder, batch_id)

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def read_mart(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("batch")


def stream_rule_breakdown(flagged: DataFrame, tables: Tables, folder: str, checkpoint: str) -> None:
    """M2 from a stream of flagged transfers; beneficiaries are read again for each micro-batch."""
    write_mart_stream(flagged, folder, checkpoint, lambda batch: rule_breakdown(tables.with_(transactions=batch)))
