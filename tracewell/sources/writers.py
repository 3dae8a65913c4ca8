"""Writers for tables, marts, CSV exports and databases."""

from tempfile import mkdtemp
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.sources.schemas import TableSpec
from tracewell.sources.tables import Tables, conform


def write_table(df: DataFrame, path: str) -> None:
    """Write a Parquet table in place of what is at the path. If the job fails, the former
    table is gone; plans.pipeline.run keeps it by writing each run to a folder of its own."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str, spec: TableSpec) -> None:
    """Bulk insert: left-out columns get their defaults, ids included."""
    conform(df, spec, inserting=True).write.mode("append").parquet(path)


def write_mart(df: DataFrame, path: str, date_partitions: bool = False) -> None:
    """Mart for a dashboard, on request in one folder per day of the transfer.

    Rows are brought together by day first, so that a day is a few files and not one per
    task; days too large for one task are split."""
    if not date_partitions:
        write_table(df, path)
        return
    dated = df.withColumn("txn_date", F.to_date("timestamp")).hint("rebalance", "txn_date")
    dated.write.mode("overwrite").partitionBy("txn_date").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. Text keeps its blanks, times their microseconds; quotes are doubled;
    lists of flags become flag|flag."""

    def text(name: str, kind: str):
        if kind.startswith("array"):
            return F.array_join(name, "|")
        return F.col(name).cast("string") if kind.startswith("timestamp") else F.col(name)

    df.select([text(name, kind).alias(name) for name, kind in df.dtypes]).write.mode("overwrite").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def export_raw_csv(tables: Tables, folder: str) -> None:
    """The four tables as raw_<table> CSV folders."""
    for name, df in tables.named().items():
        write_csv(df, f"{folder}/raw_{name}")


def write_jdbc_table(df: DataFrame, spec: TableSpec, options: dict[str, str], partitions: int = 8) -> None:
    """Append to a database table over a bounded number of connections."""
    writer = conform(df, spec, inserting=True).repartition(partitions).write.format("jdbc").options(**options)
    writer.option("dbtable", options.get("dbtable", spec.name)).mode("append").save()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder that the session names for checkpoints. Without
    one, a local session gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = mkdtemp()
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"
