"""The four tables derived from the given customer, supplier and events data.

The column rules use only modulo arithmetic, CASE and intervals, written in SQL that
Spark and the checking database read alike; {ts} is the name of the zone-less
timestamp literal of the engine at hand.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators.skew import HotKeys
from tracewell.operators.temporal import asof_last
from tracewell.sources.schemas import BENEFICIARIES, LOGINS, TRANSACTIONS, USERS
from tracewell.sources.tables import Tables, conform

USER_RULES = {
    "user_id": "c_custkey",
    "full_name": "concat('  ', c_name, ' ')",
    "email": "concat(' ', upper(replace(c_name, '#', '_')), '@MAIL.TEST ')",
    "phone": "concat(case c_custkey % 3 when 0 then '+84' when 1 then '84' else '0' end,"
    " lpad(cast(c_custkey as varchar(20)), 9, '9'))",
    "wallet_balance": "cast(case when c_custkey % 41 = 0 then 0 else c_acctbal * 1000 end as decimal(15,2))",
    "home_country": "case when c_custkey % 11 = 0 then null else 'Vietnam' end",
    "kyc_status": "case when c_custkey % 13 = 0 then null else 'verified' end",
    "home_latitude": "cast(10 + c_nationkey * 0.4 as decimal(10,6))",
    "home_longitude": "cast(105 + (c_nationkey % 5) * 0.5 as decimal(10,6))",
    "created_at": "{ts} '2023-06-01 00:00:00' + interval '1' day * (c_custkey * 7 % 230)",
}

BENEFICIARY_RULES = {
    "beneficiary_id": "s_suppkey",
    "beneficiary_name": "concat(' ', s_name)",
    "beneficiary_phone": "concat(case s_suppkey % 3 when 0 then '+84' when 1 then '84' else '0' end,"
    " lpad(cast(s_suppkey as varchar(20)), 9, '3'))",
    "beneficiary_bank_account": "lpad(cast(s_suppkey as varchar(20)), 10, '0')",
    "beneficiary_bank_code": "concat(' ', case s_suppkey % 4 when 0 then 'vcb' when 1 then 'tcb'"
    " when 2 then 'mbb' else 'acb' end, ' ')",
    "beneficiary_country": "case s_suppkey % 10 when 3 then 'Russia' when 7 then 'Iran' else 'Vietnam' end",
    "created_at": "{ts} '2023-10-01 00:00:00' + interval '1' day * (s_suppkey * 13 % 110)",
}

LOGIN_RULES = {
    "auth_id": "event_id",
    "user_id": "user_id",
    "login_timestamp": "ts",
    "device_id": "concat(case when event_id % 19 = 0 then 'dev_hacked_' else 'device_legit_' end,"
    " cast(user_id as varchar(20)))",
    "ip_latitude": "cast(case when event_id % 29 = 0 then null when event_id % 19 = 0 then 55.7558"
    " else home_latitude + 0.01 * (event_id % 3) end as decimal(10,6))",
    "ip_longitude": "cast(case when event_id % 29 = 0 then null when event_id % 19 = 0 then 37.6173"
    " else home_longitude + 0.01 * (event_id % 2) end as decimal(10,6))",
}

TRANSACTION_RULES = {
    "transaction_id": "event_id * 100 + step",
    "user_id": "case when event_id % 101 = 0 then -1 when step >= 10 then (user_id + step) % 15 else user_id end",
    "beneficiary_id": "event_id % 10",
    "amount": "cast((case when event_id % 53 = 0 then -1 else 1 end) * (case when step between 1 and 4"
    " then 9400000 + 1000 * step else round(value, 2) * 100000 end) as decimal(15,2))",
    "timestamp": "ts + interval '40' second * (case when step = 5 then 0 else step end)",
    "channel": "'MOBILE_APP'",
    "merchant_country": "case when event_id % 17 = 0 then 'Russia' when event_id % 23 = 0 then 'Iran'"
    " else 'Vietnam' end",
    "status": "'pending'",
    "final_decision": "'pending'",
    "fraud_score": "cast((event_id % 150 - 20) / 100.0 as decimal(5,4))",
    "is_ground_truth_fraud": "(step between 1 and 4 or step >= 10)",
}

SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey bigint, s_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}

STEPS = (0, 1, 2, 3, 4, 5, 10, 11, 12, 13, 14)
STEP_RULE = (
    "step = 0 or (step between 1 and 4 and event_id % 37 = 0)"
    " or (step = 5 and event_id % 43 = 0) or (step >= 10 and event_id % 61 = 0)"
)
# The steps of an event, in order: the same rule, without a lambda, which would be interpreted for each event and step.
STEP_LIST = (
    "concat(array(0), if(event_id % 37 = 0, array(1, 2, 3, 4), array()),"
    " if(event_id % 43 = 0, array(5), array()), if(event_id % 61 = 0, array(10, 11, 12, 13, 14), array()))"
)


def _apply(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{rule.format(ts='timestamp_ntz')} as `{name}`" for name, rule in rules.items()])


def load_fixtures(spark: SparkSession, sf_dir: str) -> Tables:
    customers, suppliers, events = (
        spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet") for name, schema in SOURCES.items()
    )

    users = _apply(customers, USER_RULES)
    homes = users.select("user_id", "home_latitude", "home_longitude")
    logins = _apply(
        events.filter(~F.col("event_type").isin("purchase", "click")).join(homes, "user_id"), LOGIN_RULES
    )

    payments = events.filter(F.col("event_type").isin("purchase", "click")).selectExpr(
        "event_id", "user_id", "ts", "value", f"explode({STEP_LIST}) as step"
    )
    return Tables(
        users=conform(users, USERS),
        beneficiaries=conform(_apply(suppliers, BENEFICIARY_RULES), BENEFICIARIES),
        logins=conform(logins, LOGINS),
        transactions=conform(_apply(payments, TRANSACTION_RULES), TRANSACTIONS),
    )


def load_portable(spark: SparkSession, sf_dir: str, hot_key_rows: int = 1_000_000) -> DataFrame:
    """One flat frame per transfer, with the coordinates of its latest login and its user's home."""
    tables = load_fixtures(spark, sf_dir)
    hot = HotKeys.find({"user_id": [tables.transactions, tables.logins]}, hot_key_rows, "timestamp")["user_id"]
    located = asof_last(
        tables.transactions.select("transaction_id", "user_id", "beneficiary_id", "amount", "timestamp"),
        tables.logins,
        by="user_id",
        left_ts="timestamp",
        right_ts="login_timestamp",
        columns=["ip_latitude", "ip_longitude"],
        tie="auth_id",
        out="login",
        row_id="transaction_id",
        hot=hot,
    )
    homes = {"phone": "phone_number", "home_latitude": "home_latitude", "home_longitude": "home_longitude"}
    return hot.join_dimension(located, tables.users, homes, "_known_user", "transaction_id").select(
        "transaction_id",
        "user_id",
        F.when(F.col("transaction_id") % 97 != 0, F.col("beneficiary_id")).alias("beneficiary_id"),
        F.col("amount").cast("double").alias("amount"),
        "timestamp",
        "phone_number",
        F.col("login.ip_latitude").cast("double").alias("ip_latitude"),
        F.col("login.ip_longitude").cast("double").alias("ip_longitude"),
        F.col("home_latitude").cast("double").alias("home_latitude"),
        F.col("home_longitude").cast("double").alias("home_longitude"),
        F.when(F.col("transaction_id") % 5 != 0, F.col("transaction_id") % 3 == 0).alias("is_beneficiary_new"),
    )
