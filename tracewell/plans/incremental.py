"""Adding new rows to a flagged store without computing all of it again.

A load adds users, beneficiaries, logins and transfers. What it can change is found from the keys and times
of the new rows and computed again together with the rows around it that the windows reach; every other
transfer keeps its flags, and days without changes keep their files.

    <store>/{users,beneficiaries,device_authentications}/load=<id>
    <store>/transactions/load=<id>/txn_date=<day>      as loaded; without a day while an id is unknown
    <store>/flagged/txn_date=<day>
    <store>/finished                                   the loads that are complete

A load that failed can be repeated under its id: it replaces what it left.
"""

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.functions.columns import epoch_bucket
from tracewell.operators.scope import TXN
from tracewell.params import Params
from tracewell.plans.pipeline import plan
from tracewell.sources.schemas import SPECS
from tracewell.sources.tables import Tables, conform
from tracewell.sources.writers import scratch_path, write_table

DIMENSIONS = ("users", "beneficiaries", "device_authentications")
DAY = "txn_date"
NEVER = datetime(9999, 1, 1)
KEYS = {"users": "user_id", "beneficiaries": "beneficiary_id"}
# Whether a transfer's results are to be replaced, on the transfers that a load is computed from.
TARGET = "is_target"


def _unsent(df: DataFrame) -> DataFrame:
    """Join this table by a shuffle. Spark guesses a table's size from its Parquet files, in which ids take far
    less room than in memory, and would send all users or all ids of a load through the driver."""
    return df.hint("merge")


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    folder: str
    params: Params = Params()

    def finished(self) -> list[str]:
        """Loads that are complete; one short id for each."""
        try:
            return sorted(r[0] for r in self.spark.read.schema("load string").parquet(f"{self.folder}/finished").distinct().collect())
        except AnalysisException:
            return []

    def loaded(self, name: str, loads: list[str], like: DataFrame) -> DataFrame:
        """Rows of a table from the given loads, with the columns of `like`."""
        kinds = T.StructType([*like.schema.fields, T.StructField("load", T.StringType())])
        if name == "transactions":
            kinds = kinds.add(DAY, T.DateType())
        if not loads:
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.schema(kinds).parquet(f"{self.folder}/{name}").filter(F.col("load").isin(loads))

    def flagged(self) -> DataFrame:
        """The transfers that are left after cleaning, with features and flags."""
        return self.spark.read.parquet(f"{self.folder}/flagged")

    def _scratch(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        write_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _effective(self, df: DataFrame, users: DataFrame, beneficiaries: DataFrame) -> DataFrame:
        """Add `_at`, the time that cleaning leaves, its hour bucket, and whether both ids are known."""
        opened = users.select(F.col("user_id").alias("_u"), F.col("created_at").alias("_opened"))
        banks = beneficiaries.select(F.col("beneficiary_id").alias("_b"))
        joined = df.join(_unsent(opened), F.col("user_id") == F.col("_u"), "left").join(banks, F.col("beneficiary_id") == F.col("_b"), "left")
        repaired = F.when(F.col("timestamp") < F.col("_opened"), F.col("_opened") + F.lit(self.params.time_repair_offset))
        at = repaired.otherwise(F.col("timestamp"))
        bucket = epoch_bucket(at, self.params.mule_window)
        known = F.col("_u").isNotNull() & F.col("_b").isNotNull()
        return joined.withColumns({"_at": at, "_bucket": bucket, "_known": known}).drop("_u", "_b", "_opened")

    def load(self, load: str, new: Tables) -> None:
        """Add the rows of `new`, whose users and beneficiaries are not there yet, and bring the flags up to date."""
        done = [x for x in self.finished() if x != load]
        names = {n: conform(df, SPECS[n]) for n, df in new.named().items()}
        for name in DIMENSIONS:
            write_table(names[name], f"{self.folder}/{name}/load={load}")
        added = {n: self.loaded(n, [load], names[n]).drop("load") for n in DIMENSIONS}
        every = {n: self.loaded(n, [*done, load], names[n]).drop("load") for n in DIMENSIONS}
        for name, key in KEYS.items():
            if done and not self.loaded(name, done, names[name]).join(_unsent(added[name].select(key)), key, "left_semi").isEmpty():
                raise ValueError(f"{name} of this load are there already")

        raw = self._effective(names["transactions"], every["users"], every["beneficiaries"])
        dated = raw.withColumn(DAY, F.when(F.col("_known"), F.to_date("_at"))).drop("_at", "_bucket", "_known")
        dated.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{self.folder}/transactions/load={load}")
        fresh = self.loaded("transactions", [load], names["transactions"]).drop("load", DAY)
        stored = self.loaded("transactions", done, names["transactions"]).drop("load")
        # Rows that had to wait for a user or beneficiary of this load are new too.
        waited = stored.filter(F.col(DAY).isNull()).drop(DAY)
        for key, name in (("user_id", "users"), ("beneficiary_id", "beneficiaries")):
            ids = added[name].select(F.col(key).alias(f"_{key}"), F.lit(True).alias(f"_new_{key}"))
            waited = waited.join(_unsent(ids), F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")
        released = waited.filter("_new_user_id or _new_beneficiary_id").drop("_new_user_id", "_new_beneficiary_id")
        changed = self._effective(fresh.unionByName(released), every["users"], every["beneficiaries"])
        changed = self._scratch(changed, "changed")

        around, days = self._reach(changed, stored if done else None, added, every)
        if around is None:
            self._finish(load)
            return
        targets = around.filter(TARGET).select(TXN, "user_id")
        people = targets.select("user_id").distinct()
        tables = Tables(_unsent(every["users"]), every["beneficiaries"], every["device_authentications"].join(_unsent(people), "user_id", "left_semi"), around)
        # The mark goes through the batch with its transfer, so that the results need not meet the targets again.
        flagged = plan(tables, self.params).transactions.filter(F.col(TARGET) & F.col(TXN).isNotNull()).drop(TARGET)
        self._replace(flagged, targets.select(TXN), days)
        self._finish(load)

    def _reach(self, changed: DataFrame, stored: DataFrame | None, added: dict, every: dict) -> tuple[DataFrame | None, DataFrame | None]:
        """The transfers that results are computed from, with a mark on those whose results can change, and the days
        of these. `stored` is None in a first load. Rows of the load are read where they are and not written again."""
        params = self.params
        logged = added["device_authentications"].select("user_id", F.col("login_timestamp").alias("timestamp"))
        fresh = changed.drop("_at", "_bucket", "_known").withColumn(TARGET, F.lit(True))
        if stored is None:
            if changed.isEmpty() and logged.isEmpty():
                return None, None
            return fresh, changed.select(F.to_date("_at").alias(DAY)).distinct()
        touched = changed.select("user_id", "timestamp").unionByName(logged)
        earliest = F.coalesce(F.min("timestamp"), F.lit(NEVER).cast("timestamp_ntz"))  # rows without a time are among themselves
        touched = self._scratch(touched.groupBy("user_id").agg(earliest.alias("_since")), "touched")
        first = touched.agg(F.min("_since")).first()[0]
        if first is None:
            return None, None

        def rows_since(since: datetime) -> DataFrame:
            day = F.col(DAY).isNull() | (F.col(DAY) >= F.lit(since.date()))
            return self._effective(stored.filter(day).drop(DAY), every["users"], every["beneficiaries"])

        def since(column: str) -> Column:
            return F.col(column).isNotNull() & (F.col("_at").isNull() | (F.col("_at") >= F.col(column)))

        # A transfer counts for its user's later ones, and for its beneficiary's in this bucket and the next.
        spots = changed.filter("_known").select("beneficiary_id", F.explode(F.array(F.col("_bucket"), F.col("_bucket") + 1)).alias("_bucket")).distinct()
        spots = spots.withColumn("_spot", F.lit(True))
        marked = rows_since(first).join(_unsent(touched), "user_id", "left").join(spots, ["beneficiary_id", "_bucket"], "left")
        target = since("_since") | F.coalesce("_spot", F.lit(False))
        # Only what tells how far to look back: rows that wait are among them as stored and as changed, which is the same place.
        place = ["user_id", "beneficiary_id", "timestamp", "_at", "_bucket"]
        targets = self._scratch(marked.filter(target).select(place), "targets").unionByName(changed.select(place))

        # Behind them: the user's transfers as far back as the longest window, the beneficiary's of the bucket before.
        back = targets.groupBy("user_id").agg((earliest - F.lit(max(params.history_window, params.velocity_window))).alias("_back"))
        near = targets.select("beneficiary_id", F.explode(F.array(F.col("_bucket"), F.col("_bucket") - 1)).alias("_bucket"))
        spots = spots.unionByName(near.distinct().withColumn("_spot", F.lit(False))).groupBy("beneficiary_id", "_bucket").agg(F.max("_spot").alias("_spot"))
        begin = targets.agg(earliest).first()[0]
        lower = begin - max(params.history_window, params.velocity_window, params.mule_window * 2) - timedelta(days=1)
        marked = rows_since(lower).join(_unsent(touched), "user_id", "left").join(_unsent(back), "user_id", "left")
        marked = marked.join(spots, ["beneficiary_id", "_bucket"], "left").withColumn(TARGET, target)
        hit = marked.filter(F.col(TARGET) | since("_back") | F.col("_spot").isNotNull()).select(fresh.columns)
        hit = self._scratch(hit.join(_unsent(changed.select(TXN)), TXN, "left_anti"), "around")
        return hit.unionByName(fresh), targets.select(F.to_date("_at").alias(DAY)).distinct()

    def _replace(self, flagged: DataFrame, targets: DataFrame, days: DataFrame) -> None:
        """Put the targets' results in place of the former ones, day by day. The days that are read are
        replaced when all of the new ones are written."""
        dated = flagged.withColumn(DAY, F.to_date("timestamp"))
        try:
            former = self.flagged()
        except AnalysisException:
            former = None
        if former is not None:
            stays = former.join(days, former[DAY].eqNullSafe(days[DAY]), "left_semi").join(_unsent(targets), TXN, "left_anti")
            dated = dated.unionByName(stays.select(dated.columns))
        writer = dated.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY).parquet(f"{self.folder}/flagged")

    def _finish(self, load: str) -> None:
        if load not in self.finished():
            row = self.spark.createDataFrame([(load,)], "load string")
            row.coalesce(1).write.mode("append").parquet(f"{self.folder}/finished")
