"""The six compliance rules (R1-R6) and the flags they put on a transfer."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.columns import elapsed_seconds
from tracewell.operators.features import login_history
from tracewell.operators.scope import TXN, Scope
from tracewell.operators.temporal import range_count, range_distinct
from tracewell.params import Params

# Rule names, in the order in which flags are listed.
STRUCTURING = "biometric_structuring_rule"
VELOCITY = "velocity_rule"
CROSS_BORDER = "cross_border_fraud_rule"
EVASION = "biometric_evasion_rule"
IMPOSSIBLE_TRAVEL = "impossible_travel_rule"
MULE_NETWORK = "circular_17_mule_network_rule"
RULES = (STRUCTURING, VELOCITY, CROSS_BORDER, EVASION, IMPOSSIBLE_TRAVEL, MULE_NETWORK)


def _in_band(params: Params) -> Column:
    return F.col("amount").between(params.band_low, params.band_high)


def _recent_account(recency) -> Column:
    opened = F.col("_beneficiary_created_at") >= F.col("timestamp") - F.lit(recency)
    return F.coalesce(F.col("is_beneficiary_new"), F.lit(True)) | opened


def structuring(params: Params) -> Column:
    """Just under the biometric limit, to a recent account in a high-risk country."""
    risky = F.col("_beneficiary_country").isin(*params.high_risk_countries)
    return F.col("_known_beneficiary") & _in_band(params) & risky & _recent_account(params.structuring_recency)


def velocity(df: DataFrame, scope: Scope, out: str = VELOCITY) -> DataFrame:
    """R2: more than three transfers of the user in the trailing five minutes."""
    counted = range_count(
        df,
        "timestamp",
        scope.params.velocity_window,
        out="_burst",
        row_id=TXN,
        hot=scope.hot_users,
        busy=scope.busy_by_user,
    )
    return counted.withColumn(out, F.col("_burst") > scope.params.velocity_max).drop("_burst")


def cross_border(params: Params) -> Column:
    """Merchant in a high-risk country, above the floor."""
    return F.col("merchant_country").isin(*params.high_risk_countries) & (
        F.col("amount") > params.cross_border_floor
    )


def evasion(params: Params) -> Column:
    """Just under the biometric limit, to a recent account."""
    return F.col("_known_beneficiary") & _in_band(params) & _recent_account(params.evasion_recency)


def first_suspicious_login(scope: Scope) -> DataFrame:
    """Per user, the first login too far from the previous one for the time between them.

    The rule asks for any such login at or before the transfer, so the first one decides."""
    params = scope.params
    lat = (F.col("ip_latitude") - F.col("prev_ip_latitude")).cast("double")
    lon = (F.col("ip_longitude") - F.col("prev_ip_longitude")).cast("double")
    gap = elapsed_seconds(F.col("login_timestamp"), F.col("prev_login_timestamp"))
    return (
        login_history(scope.tables.logins, scope.hot_users)
        .filter(lat * lat + lon * lon > params.travel_min_square_degrees)
        .filter(gap < params.travel_max_gap.total_seconds())
        .groupBy("user_id")
        .agg(F.min("login_timestamp").alias("first_suspicious"))
    )


def impossible_travel(df: DataFrame, scope: Scope, out: str = IMPOSSIBLE_TRAVEL) -> DataFrame:
    """Large transfer after a suspicious login of the user."""
    joined = scope.hot_users.join_dimension(
        df, first_suspicious_login(scope), {"first_suspicious": "_first_suspicious"}, "_travelled", TXN
    )
    large = F.col("amount") >= scope.params.travel_min_amount
    return joined.withColumn(out, large & (F.col("_first_suspicious") <= F.col("timestamp"))).drop(
        "_first_suspicious", "_travelled"
    )


def mule_network(df: DataFrame, scope: Scope, out: str = MULE_NETWORK) -> DataFrame:
    """At least four distinct senders to the beneficiary in the trailing hour."""
    counted = range_distinct(
        df,
        "timestamp",
        scope.params.mule_window,
        who="user_id",
        out="_senders",
        row_id=TXN,
        hot=scope.hot_beneficiaries,
        busy=scope.busy_by_beneficiary,
    )
    return counted.withColumn(out, F.col("_senders") >= scope.params.mule_min_senders).drop("_senders")


def single_rule(scope: Scope, name: str) -> DataFrame:
    """The transfers with one rule as a boolean column of its name, and only the work it needs."""
    df, params = scope.transactions, scope.params
    if name == VELOCITY:
        return velocity(df, scope)
    if name == IMPOSSIBLE_TRAVEL:
        return impossible_travel(df, scope)
    if name == MULE_NETWORK:
        return mule_network(df, scope)
    if name == CROSS_BORDER:
        return df.withColumn(name, cross_border(params))
    return scope.with_beneficiaries(df).withColumn(name, {STRUCTURING: structuring, EVASION: evasion}[name](params))


def apply_rules(scope: Scope, wanted: tuple[str, ...] = RULES) -> Scope:
    """Set rule_flags from scratch; running it again gives the same flags.

    One shuffle by user serves R2 and the join of R5, one by beneficiary serves R6 and the
    beneficiary join of R1 and R4. Only the rules wanted are planned and listed."""
    df, params = scope.transactions, scope.params
    if VELOCITY in wanted:
        df = velocity(df, scope)
    if IMPOSSIBLE_TRAVEL in wanted:
        df = impossible_travel(df, scope)
    if MULE_NETWORK in wanted:
        df = mule_network(df, scope)
    if STRUCTURING in wanted or EVASION in wanted:
        df = scope.with_beneficiaries(df)
    plain = {STRUCTURING: structuring, CROSS_BORDER: cross_border, EVASION: evasion}
    df = df.withColumns({rule: make(params) for rule, make in plain.items() if rule in wanted})
    fired = ", ".join(f"if({rule}, '{rule}', null)" for rule in RULES if rule in wanted)
    return scope.with_tables(
        transactions=df.withColumn("rule_flags", F.expr(f"array_compact(array({fired}))")).drop(*RULES)
    )


def trigger_counts(df: DataFrame) -> DataFrame:
    """How often each rule fired, most frequent first."""
    return (
        df.select(F.explode("rule_flags").alias("rule_name"))
        .groupBy("rule_name")
        .agg(F.count(F.lit(1)).alias("triggered_count"))
        .orderBy(F.desc("triggered_count"), "rule_name")
    )
