"""Data-quality repair in six steps (CL1-CL13), each a pure function."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.columns import local_phone
from tracewell.operators.scope import EVENT_COLUMNS, Scope
from tracewell.params import Params

# The columns that each step looks at, and the defaults it fills in.
RETRY_KEYS = ["user_id", "beneficiary_id", "amount", "timestamp"]
MEASURES = [
    "amount",
    "distance_from_home_km",
    "user_7day_transaction_count",
    "time_since_last_login_minutes",
    "beneficiary_account_age_days",
]
FILL_ZERO = ["transaction_balance_ratio", "distance_from_home_km", "user_7day_transaction_count"]
FILL_FALSE = ["is_beneficiary_new", "is_off_hours", "is_weekend", "is_new_device", "is_high_risk_country"]


def clean_users(users: DataFrame) -> DataFrame:
    """CL1, CL3, CL6, CL9: text, phone, balance sign, missing country and status."""
    return users.withColumns(
        {
            "full_name": F.trim("full_name"),
            "email": F.expr("lower(trim(email))"),
            "phone": local_phone(F.trim("phone")),
            "wallet_balance": F.abs("wallet_balance"),
            "home_country": F.expr("coalesce(home_country, 'Vietnam')"),
            "kyc_status": F.expr("coalesce(kyc_status, 'pending')"),
        }
    )


def _bank_code(column: str) -> Column:
    return F.upper(F.trim(column))


def clean_beneficiaries(beneficiaries: DataFrame) -> DataFrame:
    """CL2, CL4: text and phone; the phone is not trimmed."""
    return beneficiaries.withColumns(
        {
            "beneficiary_name": F.trim("beneficiary_name"),
            "beneficiary_bank_code": _bank_code("beneficiary_bank_code"),
            "beneficiary_phone": local_phone(F.col("beneficiary_phone")),
        }
    )


def drop_orphans(df: DataFrame, scope: Scope) -> DataFrame:
    """CL5: keep transfers whose user and beneficiary both exist."""
    df = scope.with_users(scope.with_beneficiaries(df))
    return df.filter(F.col("_known_user") & F.col("_known_beneficiary"))


def repair_signs(df: DataFrame) -> DataFrame:
    """CL7: negative measures become positive."""
    return df.withColumns({c: F.abs(c) for c in MEASURES if c in df.columns})


def clamp_score(df: DataFrame) -> DataFrame:
    """CL8: score into [0, 1]; NULL stays NULL."""
    score = F.col("fraud_score")
    kind = df.schema["fraud_score"].dataType
    low, high = F.lit(0).cast(kind), F.lit(1).cast(kind)
    return df.withColumn("fraud_score", F.when(score.isNotNull(), F.least(high, F.greatest(low, score))))


def fill_missing(df: DataFrame) -> DataFrame:
    """CL10: features that could not be computed get 0 or FALSE."""
    kinds = dict(df.dtypes)
    zeros = {c: F.expr(f"coalesce({c}, cast(0 as {kinds[c]}))") for c in FILL_ZERO}
    return df.withColumns(zeros | {c: F.expr(f"coalesce({c}, false)") for c in FILL_FALSE})


def repair_time(df: DataFrame, scope: Scope) -> DataFrame:
    """CL11: a transfer older than its user moves to shortly after the user's creation."""
    df = scope.with_users(df)
    created = F.col("_user_created_at")
    repaired = F.when(F.col("timestamp") < created, created + F.lit(scope.params.time_repair_offset))
    df = scope.hot_users.untag(scope.hot_beneficiaries.untag(df))  # slots go by time
    return df.withColumn("timestamp", repaired.otherwise(F.col("timestamp")))


def rederive_new(df: DataFrame, params: Params) -> DataFrame:
    """CL12: new-account flag from the age column, on all rows; NULL when the age is NULL."""
    return df.withColumn(
        "is_beneficiary_new", F.col("beneficiary_account_age_days") < params.new_beneficiary_days
    )


def dedup_retries(df: DataFrame, order: str = "transaction_id") -> DataFrame:
    """CL13: one transfer per (user, beneficiary, amount, time), the smallest id.

    Spark limits each group to one row before the shuffle, so copies do not pile up."""
    rank = F.row_number().over(Window.partitionBy(*RETRY_KEYS).orderBy(order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def surviving_events(df: DataFrame, scope: Scope) -> DataFrame:
    """The cleaning steps that decide which transfers remain, and with what amount and time."""
    return dedup_retries(repair_time(repair_signs(drop_orphans(df, scope)), scope))


def clean(scope: Scope) -> Scope:
    """All steps in order. Features keep the values they were computed with."""
    df = drop_orphans(scope.transactions, scope)
    df = df.withColumn("_beneficiary_bank_code", _bank_code("_beneficiary_bank_code"))
    df = fill_missing(clamp_score(repair_signs(df)))
    df = dedup_retries(rederive_new(repair_time(df, scope), scope.params))
    return scope.with_busy(lambda busy: surviving_events(busy, scope).select(EVENT_COLUMNS)).with_tables(
        users=clean_users(scope.tables.users),
        beneficiaries=clean_beneficiaries(scope.tables.beneficiaries),
        transactions=df,
    )
