"""Engineered features of a transfer (FE1-FE13)."""

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions.columns import draw, elapsed_days, elapsed_seconds, login_distance_km, off_hours, weekend
from tracewell.operators.scope import TXN, Scope
from tracewell.operators.skew import HotKeys
from tracewell.operators.temporal import asof_last, latest_on, previous_row, range_count
from tracewell.params import Params

LOGIN_COLUMNS = ["login_timestamp", "device_id", "ip_latitude", "ip_longitude"]
PREVIEW_COLUMNS = [
    "transaction_id",
    "amount",
    "transaction_balance_ratio",
    "is_beneficiary_new",
    "is_off_hours",
    "is_weekend",
    "distance_from_home_km",
    "user_7day_transaction_count",
    "is_new_device",
    "beneficiary_account_age_days",
    "time_since_last_login_minutes",
    "is_high_risk_country",
]


def balance_ratio(df: DataFrame, scope: Scope) -> DataFrame:
    """FE1: amount over wallet balance, at most 1; a zero balance gives 1."""
    df = scope.with_users(df)
    zero = F.lit(0).cast("decimal(15,2)")
    ratio = F.least(F.col("amount") / F.nullif(F.col("_wallet_balance"), zero), F.lit(1).cast("decimal(2,1)"))
    rounded = F.round(ratio, 4).cast("decimal(20,4)")
    return df.withColumn("transaction_balance_ratio", F.when(F.col("_known_user"), rounded))


def time_flags(df: DataFrame, params: Params) -> DataFrame:
    """FE2, FE3: night hours and weekend."""
    ts = F.col("timestamp")
    return df.withColumns(
        {"is_off_hours": off_hours(ts, params.off_hours_start, params.off_hours_end), "is_weekend": weekend(ts)}
    )


def beneficiary_profile(df: DataFrame, scope: Scope) -> DataFrame:
    """FE4-FE6: account age in days, new account, high-risk country."""
    df = scope.with_beneficiaries(df)
    known, opened = F.col("_known_beneficiary"), F.col("_beneficiary_created_at")
    age = elapsed_days(F.col("timestamp"), opened)
    month = F.make_dt_interval(F.lit(scope.params.new_beneficiary_days))
    return df.withColumns(
        {
            "beneficiary_account_age_days": F.when(known, F.greatest(age, F.lit(0))),
            "is_beneficiary_new": F.when(known, F.col("timestamp") - opened < month),
            "is_high_risk_country": F.when(
                known, F.col("_beneficiary_country").isin(*scope.params.high_risk_countries)
            ),
        }
    )


def history_count(df: DataFrame, scope: Scope, placed: bool = False, met: str | None = None) -> DataFrame:
    """FE7: the user's other transfers in the trailing window."""
    counted = range_count(
        df,
        "timestamp",
        scope.params.history_window,
        out="_in_window",
        row_id=TXN,
        hot=scope.hot_users,
        busy=scope.busy_by_user,
        placed=placed,
        met=met,
    )
    return counted.withColumn("user_7day_transaction_count", (F.col("_in_window") - 1).cast("int")).drop("_in_window")


def last_login(df: DataFrame, scope: Scope, counts: dict[str, timedelta] | None = None) -> DataFrame:
    """The latest login of the user at or before the transfer, as the struct `_login`."""
    return asof_last(
        df,
        scope.tables.logins,
        by="user_id",
        left_ts="timestamp",
        right_ts="login_timestamp",
        columns=LOGIN_COLUMNS,
        tie="auth_id",
        out="_login",
        row_id=TXN,
        hot=scope.hot_users,
        busy=scope.busy_by_user,
        counts=counts,
    )


def login_features(df: DataFrame, scope: Scope) -> DataFrame:
    """FE8-FE11 from `_login`: recency, unknown device, distance from home, with fillers."""
    df, params, login = scope.with_users(df), scope.params, F.col("_login")
    minutes = F.round(elapsed_seconds(F.col("timestamp"), login["login_timestamp"]) / 60).cast("int")
    km = login_distance_km(
        F.col("_home_latitude"),
        F.col("_home_longitude"),
        login["ip_latitude"],
        login["ip_longitude"],
        params.earth_radius_km,
    )
    found = login.isNotNull() & F.col("_known_user")
    return df.withColumns(
        {
            "time_since_last_login_minutes": F.when(found, F.greatest(minutes, F.lit(0))).otherwise(
                params.default_login_minutes
            ),
            "is_new_device": F.coalesce(
                F.when(found, ~login["device_id"].like(params.legit_device_pattern)), F.lit(False)
            ),
            "distance_from_home_km": F.when(found, F.round(km, 2))
            .otherwise(params.default_distance_km)
            .cast("decimal(8,2)"),
        }
    ).drop("_login")


def build_features(scope: Scope) -> Scope:
    """All ten feature columns on the transfers as loaded.

    The beneficiary join comes first; then one shuffle by user serves the login lookup,
    the trailing count and the user join. Where transfers and logins are laid out as one timeline
    by user, these need no shuffle, and the beneficiary join comes last."""
    if scope.timeline is not None:
        df = history_count(latest_on(scope.timeline, "user_id", "timestamp", "_login"), scope, placed=True)
        df = balance_ratio(login_features(df, scope), scope)
        return scope.with_tables(transactions=time_flags(beneficiary_profile(df, scope), scope.params))
    df = time_flags(beneficiary_profile(scope.transactions, scope), scope.params)
    counts = {"_met_count": scope.params.history_window} if scope.hot_users.any else {}
    df = last_login(df, scope, counts)
    df = history_count(df, scope, placed=True, met=next(iter(counts), None))
    df = balance_ratio(login_features(df, scope), scope)
    return scope.with_tables(transactions=df)


def feature_preview(df: DataFrame, rows: int = 5, seed: int | None = None) -> DataFrame:
    """FE12: a few transfers picked at random; the same ones again for the same seed."""
    order = F.rand() if seed is None else draw(TXN, seed)
    return df.select(PREVIEW_COLUMNS).orderBy(order).limit(rows)


def login_history(logins: DataFrame, hot_users: HotKeys) -> DataFrame:
    """FE13: each login with time and place of the user's previous one."""
    columns = ["login_timestamp", "ip_latitude", "ip_longitude"]
    narrow = logins.select("auth_id", "user_id", *columns)
    history = previous_row(narrow, "login_timestamp", "auth_id", columns, "_previous", hot_users)
    return history.select(
        "auth_id", "user_id", *columns, *[F.col(f"_previous.{c}").alias(f"prev_{c}") for c in columns]
    )
