"""The streaming operators over tables that are delivered part by part, as a feed would."""

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.params import Params
from tracewell.sources.writers import scratch_path, write_table
from tracewell.streaming import alerts, logins, marts, retries
from tracewell.streaming.files import read_files, write_files, zoneless, micros

TRANSFER_COLUMNS = ["transaction_id", "user_id", "beneficiary_id", "amount", "timestamp"]
LOGIN_COLUMNS = ["auth_id", "user_id", "login_timestamp", *logins.LOGIN_COLUMNS]
PARTS = 3
#: How much later than the latest row one may come.
DELAY = timedelta(hours=6)


class Feed:
    """A stored table, delivered to a folder in parts by its time, and at last a row that has only a time.

    late: by how much a row comes later than its time says."""

    def __init__(self, df: DataFrame, ts: str, late: Column | None = None):
        self.spark, self.schema, self.ts = df.sparkSession, df.schema, ts
        base = scratch_path(self.spark, "feed")
        self.folder = f"{base}/delivered"
        late = F.lit(0) if late is None else late
        write_table(df.withColumn("_at", micros(F.col(ts)) + late), f"{base}/all")
        self.rows = self.spark.read.parquet(f"{base}/all")
        self.first, self.last = self.rows.agg(F.min("_at"), F.max("_at")).first()

    def deliver(self, part: int) -> None:
        """Part 0 to PARTS - 1, and PARTS for the row that ends the feed."""
        if part < PARTS:
            of = F.floor((F.col("_at") - self.first) * PARTS / (self.last - self.first + 1))
            rows = self.rows.filter(of == part).drop("_at")
        else:
            none = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name != self.ts]
            end = self.last + 2 * (DELAY // timedelta(microseconds=1))
            rows = self.spark.range(1).select(F.lit(end).alias("us")).select(*none, zoneless("us").alias(self.ts)).select(self.schema.names)
        rows.write.mode("append").parquet(self.folder)

    def stream(self) -> DataFrame:
        return read_files(self.spark, self.folder, self.schema)


def through(feeds: list[Feed], run: Callable[[str, str], None]) -> str:
    """Run a stream after each delivery, from where it ended, and return its output folder."""
    base = scratch_path(feeds[0].spark, "stream")
    for part in range(PARTS + 1):
        for feed in feeds:
            feed.deliver(part)
        run(f"{base}/out", f"{base}/checkpoint")
    return f"{base}/out"


def _stored(feeds: list[Feed], stream: Callable[[], DataFrame]) -> DataFrame:
    out = through(feeds, lambda folder, checkpoint: write_files(stream(), folder, checkpoint))
    spark = feeds[0].spark
    return spark.read.schema(stream().schema).parquet(out)


def velocity(transfers: DataFrame, params: Params) -> DataFrame:
    feed = Feed(transfers.select(TRANSFER_COLUMNS), "timestamp")
    return _stored([feed], lambda: alerts.velocity_alerts(feed.stream(), DELAY, params))


def mules(transfers: DataFrame, params: Params) -> DataFrame:
    feed = Feed(transfers.select(TRANSFER_COLUMNS), "timestamp")
    return _stored([feed], lambda: alerts.mule_alerts(feed.stream(), DELAY, params))


def last_login(transfers: DataFrame, logged: DataFrame) -> DataFrame:
    """Logins come up to five hours late."""
    late = F.pmod(F.xxhash64("auth_id"), F.lit(5 * 3600)) * 1_000_000
    feeds = [Feed(transfers.select(TRANSFER_COLUMNS), "timestamp"), Feed(logged.select(LOGIN_COLUMNS), "login_timestamp", late)]
    return _stored(feeds, lambda: logins.last_logins(feeds[0].stream(), feeds[1].stream(), DELAY))


def without_retries(transfers: DataFrame, is_retry: Column, exact: bool) -> DataFrame:
    """Copies come some hours after what they copy; without `exact` each first arrival is given at once."""
    late = F.when(is_retry, F.lit(4 * 3600 * 1_000_000)).otherwise(0)
    feed = Feed(transfers.select(TRANSFER_COLUMNS), "timestamp", late)
    operator = retries.smallest_ids if exact else retries.first_arrivals
    return _stored([feed], lambda: operator(feed.stream(), DELAY)).filter("transaction_id is not null")


def rule_breakdown(flagged) -> DataFrame:  # noqa: ANN001
    """The mart of rules triggered, from flagged tables whose transfers are delivered part by part."""
    feed = Feed(flagged.transactions.select("transaction_id", "beneficiary_id", "amount", "timestamp", "rule_flags"), "timestamp")
    out = through([feed], lambda folder, checkpoint: marts.stream_rule_breakdown(feed.stream().filter("transaction_id is not null"), flagged, folder, checkpoint))
    return marts.read_mart(feed.spark, out)
