"""Dashboard marts over the flagged tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.columns import draw, elapsed_days, percentage
from tracewell.operators.features import login_history
from tracewell.operators.rules import EVASION, MULE_NETWORK, VELOCITY
from tracewell.operators.scope import BANK_COLUMNS
from tracewell.operators.skew import HotKeys
from tracewell.params import Params
from tracewell.sources.tables import Tables


def _rules_hit() -> Column:
    return F.cardinality("rule_flags")


def fraud_summary(tables: Tables) -> DataFrame:
    """M1: one row per transfer with flag, number of rules and bank."""
    facts = tables.transactions.select(
        "transaction_id",
        "timestamp",
        "user_id",
        "amount",
        "is_off_hours",
        "is_weekend",
        "distance_from_home_km",
        "transaction_balance_ratio",
        "beneficiary_account_age_days",
        "rule_flags",
        F.when(_rules_hit() > 0, 1).otherwise(0).alias("is_flagged"),
        _rules_hit().alias("triggered_rules_count"),
        *_bank_keys(tables),
    )
    return _with_banks(facts, tables, ["beneficiary_bank_code", "beneficiary_country"])


def _bank_keys(tables: Tables) -> list[str]:
    """What a transfer knows of its beneficiary: the columns shown, or only the id where it was read from a table."""
    carried = list(BANK_COLUMNS.values())
    return carried if set(carried) <= set(tables.transactions.columns) else ["beneficiary_id"]


def _with_banks(facts: DataFrame, tables: Tables, columns: list[str]) -> DataFrame:
    """Columns of the beneficiary in place of its id. Both sides of the join come from a
    shuffle or a scan, so adaptive execution can split a hot beneficiary."""
    if "beneficiary_id" not in facts.columns:
        shown = [F.col(BANK_COLUMNS[c]).alias(c) for c in columns]
        return facts.select(*[c for c in facts.columns if c not in BANK_COLUMNS.values()], *shown)
    banks = tables.beneficiaries.select("beneficiary_id", *columns)
    return facts.join(banks, "beneficiary_id", "left").drop("beneficiary_id")


def rule_breakdown(tables: Tables) -> DataFrame:
    """M2: one row per rule a transfer triggered."""
    fired = tables.transactions.select(
        "transaction_id", "timestamp", "amount", F.explode("rule_flags").alias("rule_name"), *_bank_keys(tables)
    )
    return _with_banks(fired, tables, ["beneficiary_bank_code"])


def register_views(tables: Tables, params: Params = Params()) -> None:
    """The login history and the marts under the names that SQL users and dashboards import."""
    hot_users = HotKeys.find({"user_id": [tables.logins]}, params.hot_key_rows)["user_id"]
    login_history(tables.logins, hot_users).drop("auth_id").createOrReplaceTempView("user_login_history")
    fraud_summary(tables).createOrReplaceTempView("vw_dashboard_fraud_summary")
    rule_breakdown(tables).createOrReplaceTempView("vw_dashboard_rule_breakdown")


def preview(mart: DataFrame, rows: int = 5, seed: int | None = None) -> DataFrame:
    """M3: a look at the mart, at any rows, or with a seed at random ones that are the same again."""
    if seed is not None:
        mart = mart.orderBy(draw("transaction_id", seed))
    return mart.select("*").limit(rows)


def velocity_off_hours(transactions: DataFrame) -> DataFrame:
    """M4: velocity triggers, and how many of them at night."""
    fired = transactions.select(F.explode("rule_flags").alias("rule_name"), "is_off_hours")
    burst = F.col("rule_name") == VELOCITY
    total, night = F.count_if(burst), F.count_if(burst & F.col("is_off_hours"))
    return fired.agg(
        total.alias("total_velocity_triggered"),
        night.alias("off_hours_velocity_triggered"),
        percentage(night, total).alias("off_hours_velocity_percentage"),
    )


def evasion_share(transactions: DataFrame) -> DataFrame:
    """M5: share of flagged transfers that evade the biometric limit."""
    flagged = transactions.filter(_rules_hit() > 0)
    total, evading = F.count(F.lit(1)), F.count_if(F.array_contains("rule_flags", EVASION))
    return flagged.agg(
        evading.alias("actual_evasion_transactions"),
        total.alias("total_flagged_anomalies"),
        percentage(evading, total).alias("actual_percentage"),
    )


def remote_off_hours(transactions: DataFrame, params: Params = Params()) -> DataFrame:
    """M6: transfers far from home, and how many of them at night."""
    far = F.col("distance_from_home_km") > params.remote_km
    remote, both = F.count_if(far), F.count_if(far & F.col("is_off_hours"))
    return transactions.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        remote.alias("remote_transactions_gt_100km"),
        both.alias("remote_and_offhours"),
        percentage(both, remote).alias("overlap_percentage"),
    )


def kpi_cards(transactions: DataFrame) -> DataFrame:
    """M7: volume, flagged transfers and fraud rate."""
    total, flagged = F.count(F.lit(1)), F.count_if(_rules_hit() > 0)
    return transactions.agg(
        total.alias("total_volume"), flagged.alias("flagged_txns"), percentage(flagged, total).alias("fraud_rate")
    )


def hourly_trend(transactions: DataFrame) -> DataFrame:
    """M8: transfers and flagged transfers by hour of day."""
    return (
        transactions.groupBy(F.hour("timestamp").alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("txns"), F.count_if(_rules_hit() > 0).alias("flagged_txns"))
        .orderBy("hour_of_day")
    )


def incidents(transactions: DataFrame, rows: int | None = None) -> DataFrame:
    """M9: flagged transfers, largest first. Without a row limit the order is left to the reader."""
    table = transactions.filter(_rules_hit() > 0).select(
        "transaction_id", "timestamp", "user_id", "amount", "rule_flags", "beneficiary_id"
    )
    return table if rows is None else table.orderBy(F.desc("amount"), "transaction_id").limit(rows)


def mule_beneficiaries(tables: Tables) -> DataFrame:
    """Beneficiaries hit by the mule rule, their triggers and age at the last hit."""
    hits = (
        tables.transactions.filter(F.array_contains("rule_flags", MULE_NETWORK))
        .groupBy("beneficiary_id")
        .agg(F.count(F.lit(1)).alias("mule_triggers"), F.max("timestamp").alias("last_hit"))
    )
    opened = tables.beneficiaries.select("beneficiary_id", "created_at")
    return hits.join(opened, "beneficiary_id").select(
        "beneficiary_id", "mule_triggers", elapsed_days(F.col("last_hit"), F.col("created_at")).alias("age_days")
    )
