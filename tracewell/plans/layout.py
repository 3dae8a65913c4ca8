"""Tables laid out by user, so that the feature stage reads them without moving them (SNK5)."""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators.features import LOGIN_COLUMNS
from tracewell.operators.temporal import timeline_of
from tracewell.params import Params
from tracewell.sources.schemas import SPECS
from tracewell.sources.tables import Tables, conform
from tracewell.sources.writers import write_table

KEY = "user_id"
# Transfers and logins, as one table (see operators.temporal.timeline_of), and the users; what they are sorted by.
TIMELINE, USERS = "timeline", "users"
ORDER = {TIMELINE: "timestamp", USERS: KEY}


def _table(folder: str, name: str) -> str:
    return f"laid_out_{hashlib.md5(folder.encode()).hexdigest()[:12]}_{name}"


def write_laid_out(tables: Tables, folder: str, buckets: int) -> None:
    """The tables in one folder; users, and transfers together with logins, in as many files as there are
    buckets, by user. A bucket should fit a task; with hot users the timeline is not used."""
    line = timeline_of(tables.transactions, tables.logins, KEY, "timestamp", "login_timestamp", LOGIN_COLUMNS, "auth_id", "_login")
    for name, df in {TIMELINE: line, USERS: tables.users}.items():
        writer = df.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(ORDER[name])
        writer.mode("overwrite").option("path", f"{folder}/{name}").saveAsTable(_table(folder, name))
    write_table(tables.beneficiaries, f"{folder}/beneficiaries")
    write_table(tables.logins, f"{folder}/device_authentications")
    spark = tables.users.sparkSession
    write_table(spark.createDataFrame([(buckets,)], "buckets int").coalesce(1), f"{folder}/layout")


def read_laid_out(spark: SparkSession, folder: str, params: Params = Params()) -> tuple[Tables, Params, DataFrame]:
    """The tables of a folder and the timeline, declared as what they are: a session whose catalog does not
    know them learns their buckets from the folder. The result is what `Scope.of` takes."""
    buckets = spark.read.parquet(f"{folder}/layout").first()[0]

    def declared(name: str) -> DataFrame:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{folder}/{name}").schema)
        spark.sql(f"drop table if exists {_table(folder, name)}")
        spark.sql(
            f"create table {_table(folder, name)} ({columns}) using parquet clustered by ({KEY})"
            f" sorted by ({ORDER[name]}) into {buckets} buckets location '{folder}/{name}'"
        )
        return spark.table(_table(folder, name))

    line = declared(TIMELINE)
    transfers = line.filter(F.col("_kind") == 1).drop("_kind", "_tie", "_login")
    tables = Tables(
        conform(declared(USERS), SPECS["users"]),
        conform(spark.read.parquet(f"{folder}/beneficiaries"), SPECS["beneficiaries"]),
        conform(spark.read.parquet(f"{folder}/device_authentications"), SPECS["device_authentications"]),
        conform(transfers, SPECS["transactions"]),
    )
    return tables, params, line
