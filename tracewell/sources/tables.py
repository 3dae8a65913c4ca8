"""The four base tables as one value that every stage takes and returns."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tracewell.sources.schemas import ID_COLUMNS, SPECS, TableSpec


@dataclass(frozen=True)
class Tables:
    users: DataFrame
    beneficiaries: DataFrame
    logins: DataFrame
    transactions: DataFrame

    def with_(self, **frames: DataFrame) -> "Tables":
        return replace(self, **frames)

    def register_views(self) -> None:
        for name, frame in self.named().items():
            frame.createOrReplaceTempView(name)

    def named(self) -> dict[str, DataFrame]:
        return {
            "users": self.users,
            "beneficiaries": self.beneficiaries,
            "device_authentications": self.logins,
            "transactions": self.transactions,
        }


# Defaults that are another value on each evaluation: only a write may use them.
VOLATILE = ("uuid()", "localtimestamp()")


def conform(df: DataFrame, spec: TableSpec, inserting: bool = False) -> DataFrame:
    """Project to the table's columns; columns the load leaves out get their default.

    A column that is present keeps its NULLs, as an insert with an explicit NULL would.
    Ids keep the type they arrive with (text or whole numbers). New ids and the time of
    loading are given only when inserting, where each row is evaluated once; ValueError
    when a table that is read lacks such a column.
    """
    present = df.schema
    columns = []
    for field in spec.schema:
        name, kind = field.name, field.dataType.simpleString()
        if name not in present.names:
            if spec.defaults.get(name) in VOLATILE and not inserting:
                raise ValueError(f"Column '{name}' of {spec.name} not found.")
            columns.append(f"cast({spec.defaults.get(name, 'null')} as {kind}) as `{name}`")
        elif name in ID_COLUMNS and isinstance(present[name].dataType, T.IntegralType):
            columns.append(f"`{name}`")
        elif isinstance(field.dataType, T.ArrayType) and isinstance(present[name].dataType, T.StringType):
            flags = f"filter(split(`{name}`, '[|]'), flag -> flag <> '')"
            columns.append(f"coalesce({flags}, array()) as `{name}`")
        else:
            columns.append(f"cast(`{name}` as {kind}) as `{name}`")
    return df.selectExpr(columns)


def read_tables(spark: SparkSession, folder: str) -> Tables:
    """Parquet tables under one folder, each in a directory of its own name."""
    frames = {name: conform(spark.read.parquet(f"{folder}/{name}"), spec) for name, spec in SPECS.items()}
    return Tables(
        users=frames["users"],
        beneficiaries=frames["beneficiaries"],
        logins=frames["device_authentications"],
        transactions=frames["transactions"],
    )


def public_columns(df: DataFrame) -> DataFrame:
    """Drop the helper columns that stages pass on to each other (leading underscore)."""
    return df.select([c for c in df.columns if not c.startswith("_")])
