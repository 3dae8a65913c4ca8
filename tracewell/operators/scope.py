"""What every stage needs: the tables, the parameters and the hot keys."""

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.operators.skew import HotKeys
from tracewell.params import Params
from tracewell.sources.tables import Tables, public_columns
from tracewell.sources.writers import scratch_path, write_table

TXN = "transaction_id"
# Columns of the beneficiary that marts show, and their names on a transfer.
BANK_COLUMNS = {"beneficiary_bank_code": "_beneficiary_bank_code", "beneficiary_country": "_beneficiary_country"}
EVENT_COLUMNS = ["transaction_id", "user_id", "beneficiary_id", "amount", "timestamp"]


def stored_events(df: DataFrame) -> DataFrame:
    """Hot keys' rows, written to the shared folder: several operators read them, each more than once."""
    path = scratch_path(df.sparkSession, "hot-rows")
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Scope:
    tables: Tables
    params: Params
    hot_users: HotKeys
    hot_beneficiaries: HotKeys
    # Identifying columns of the hot keys' transfers, without the other stages' work on them.
    busy: DataFrame | None
    # Transfers and logins in buckets by user (see plans.layout), where no user is hot.
    timeline: DataFrame | None = None

    @classmethod
    def of(cls, tables: Tables, params: Params = Params(), timeline: DataFrame | None = None) -> "Scope":
        """Hot keys are taken from the tables as loaded. Later stages only drop rows, so a
        key that is not hot here never becomes hot."""
        tables = tables.with_(transactions=public_columns(tables.transactions))
        events = tables.transactions.select(EVENT_COLUMNS)
        sources = {"user_id": [events, tables.logins], "beneficiary_id": [events]}
        hot = HotKeys.find(sources, params.hot_key_rows, "timestamp")
        timeline = None if hot["user_id"].any else timeline
        return cls(tables, params, hot["user_id"], hot["beneficiary_id"], None, timeline).with_events(events)

    def with_tables(self, **frames: DataFrame) -> "Scope":
        return replace(self, tables=self.tables.with_(**frames))

    def with_events(self, events: DataFrame) -> "Scope":
        """Take the hot keys' rows from these transfers from now on."""
        hot = [h for h in (self.hot_users, self.hot_beneficiaries) if h.any]
        if not hot:
            return self
        busy = reduce(lambda df, h: h.marked(df), hot, events.select(EVENT_COLUMNS))
        return replace(self, busy=busy.filter(reduce(lambda a, b: a | b, [F.col(h.mark) for h in hot])))

    def with_busy(self, step: Callable[[DataFrame], DataFrame]) -> "Scope":
        """Apply a stage's effect on transfers to the hot keys' rows too."""
        if self.busy is None:
            return self
        return self.with_events(stored_events(step(self.busy.select(EVENT_COLUMNS)).select(EVENT_COLUMNS)))

    def _busy_of(self, hot: HotKeys) -> DataFrame | None:
        return self.busy.filter(hot.mark).select(EVENT_COLUMNS) if hot.any else None

    @property
    def busy_by_user(self) -> DataFrame | None:
        return self._busy_of(self.hot_users)

    @property
    def busy_by_beneficiary(self) -> DataFrame | None:
        return self._busy_of(self.hot_beneficiaries)

    @property
    def transactions(self) -> DataFrame:
        return self.tables.transactions

    def with_users(self, df: DataFrame) -> DataFrame:
        """Join the user columns that features and cleaning read, once."""
        if "_known_user" in df.columns:
            return df
        columns = {
            "wallet_balance": "_wallet_balance",
            "home_latitude": "_home_latitude",
            "home_longitude": "_home_longitude",
            "created_at": "_user_created_at",
        }
        return self.hot_users.join_dimension(df, self.tables.users, columns, "_known_user", TXN)

    def with_beneficiaries(self, df: DataFrame) -> DataFrame:
        """Join the beneficiary columns that features, cleaning and rules read, once."""
        if "_known_beneficiary" in df.columns:
            return df
        columns = {"created_at": "_beneficiary_created_at", **BANK_COLUMNS}
        return self.hot_beneficiaries.join_dimension(
            df, self.tables.beneficiaries, columns, "_known_beneficiary", TXN
        )
