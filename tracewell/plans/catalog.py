"""Every query by name, each over the whole tables of a data folder."""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.columns import drawn, is_true_text
from tracewell.operators import cleaning, features, rules
from tracewell.operators.evidence import mule_senders
from tracewell.operators.quantiles import describe
from tracewell.operators.scope import EVENT_COLUMNS, Scope
from tracewell.params import Params
from tracewell.plans import marts, portable, quality, reports, streams
from tracewell.plans.incremental import Store
from tracewell.plans.layout import read_laid_out, write_laid_out
from tracewell.plans.pipeline import current_run, plan, run
from tracewell.sources.fixtures import load_fixtures, load_portable
from tracewell.sources.readers import read_csv_checked, read_csv_table, read_flagged_csv
from tracewell.sources.schemas import TRANSACTIONS, USERS
from tracewell.sources.tables import Tables
from tracewell.sources.writers import append_rows, scratch_path, write_csv, write_mart

Query = Callable[[SparkSession, str], DataFrame]
PARAMS = Params()
# The same rules with a limit so low that the largest keys of small tables are hot too.
HOT = replace(PARAMS, hot_key_rows=60)
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Result types that compare easily: whole numbers as bigint, decimals as double, lists as text."""
    out = []
    for name, kind in df.select(*(columns or df.columns)).dtypes:
        column = F.col(name)
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind in ("int", "smallint"):
            column = column.cast("long")
        elif kind.startswith("array"):
            column = F.array_join(column, "|")
        out.append(column.alias(name))
    return df.select(out)


def raw_scope(spark: SparkSession, sf_dir: str, params: Params = PARAMS) -> Scope:
    return Scope.of(load_fixtures(spark, sf_dir), params)


def featured(spark: SparkSession, sf_dir: str, params: Params = PARAMS) -> Scope:
    return features.build_features(raw_scope(spark, sf_dir, params))


def cleaned(spark: SparkSession, sf_dir: str) -> Scope:
    return cleaning.clean(featured(spark, sf_dir))


def flagged(spark: SparkSession, sf_dir: str, params: Params = PARAMS, wanted: tuple[str, ...] = rules.RULES) -> Tables:
    return plan(load_fixtures(spark, sf_dir), params, wanted=wanted)


def portable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable.run(load_portable(spark, sf_dir, PARAMS.hot_key_rows), PARAMS)


# Features


@query
def feat_balance_ratio(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    df = features.balance_ratio(scope.transactions, scope)
    return shown(df, "transaction_id", "transaction_balance_ratio")


@query
def feat_time_flags(spark, sf_dir):
    df = features.time_flags(load_fixtures(spark, sf_dir).transactions, PARAMS)
    return shown(df, "transaction_id", "is_off_hours", "is_weekend")


@query
def feat_beneficiary_age(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    df = features.beneficiary_profile(scope.transactions, scope)
    return shown(df, "transaction_id", "beneficiary_account_age_days", "is_beneficiary_new")


@query
def feat_high_risk_country(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    df = features.beneficiary_profile(scope.transactions, scope)
    return shown(df, "transaction_id", "is_high_risk_country")


@query
def feat_user_7d_count(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    df = features.history_count(scope.transactions, scope)
    return shown(df, "transaction_id", "user_7day_transaction_count")


@query
def feat_last_login_asof(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    df = features.last_login(scope.transactions, scope)
    df = df.filter(F.col("_login").isNotNull()).select("transaction_id", "_login.login_timestamp", "_login.device_id")
    return shown(df)


def _login_feature(spark, sf_dir, column):
    scope = raw_scope(spark, sf_dir)
    df = features.login_features(features.last_login(scope.transactions, scope), scope)
    return shown(df, "transaction_id", column)


@query
def feat_distance_km(spark, sf_dir):
    return _login_feature(spark, sf_dir, "distance_from_home_km")


@query
def feat_new_device(spark, sf_dir):
    return _login_feature(spark, sf_dir, "is_new_device")


@query
def feat_login_recency(spark, sf_dir):
    return _login_feature(spark, sf_dir, "time_since_last_login_minutes")


@query
def feat_login_history_lag(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    return shown(features.login_history(scope.tables.logins, scope.hot_users))


@query
def feat_all(spark, sf_dir):
    return shown(featured(spark, sf_dir).transactions, *features.PREVIEW_COLUMNS)


@query
def feat_all_laid_out(spark, sf_dir):
    """From tables in buckets by user."""
    folder = scratch_path(spark, "laid-out")
    write_laid_out(load_fixtures(spark, sf_dir), folder, 16)
    scope = Scope.of(*read_laid_out(spark, folder, PARAMS))
    return shown(features.build_features(scope).transactions, *features.PREVIEW_COLUMNS)


@query
def feat_all_hot(spark, sf_dir):
    return shown(featured(spark, sf_dir, HOT).transactions, *features.PREVIEW_COLUMNS)


@query
def feat_login_history_lag_hot(spark, sf_dir):
    scope = raw_scope(spark, sf_dir, HOT)
    return shown(features.login_history(scope.tables.logins, scope.hot_users))


@query
def feat_preview(spark, sf_dir):
    return shown(features.feature_preview(featured(spark, sf_dir).transactions, seed=7))


# Cleaning


@query
def clean_user_text(spark, sf_dir):
    users = cleaning.clean_users(load_fixtures(spark, sf_dir).users)
    return shown(users, "user_id", "full_name", "email")


@query
def clean_beneficiary_text(spark, sf_dir):
    found = cleaning.clean_beneficiaries(load_fixtures(spark, sf_dir).beneficiaries)
    return shown(found, "beneficiary_id", "beneficiary_name", "beneficiary_bank_code")


@query
def clean_phone_users(spark, sf_dir):
    return shown(cleaning.clean_users(load_fixtures(spark, sf_dir).users), "user_id", "phone")


@query
def clean_phone_beneficiaries(spark, sf_dir):
    found = cleaning.clean_beneficiaries(load_fixtures(spark, sf_dir).beneficiaries)
    return shown(found, "beneficiary_id", "beneficiary_phone")


@query
def clean_orphans(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    df = cleaning.drop_orphans(scope.transactions, scope)
    return shown(df, "transaction_id", "user_id", "beneficiary_id")


@query
def clean_abs(spark, sf_dir):
    tables = load_fixtures(spark, sf_dir)
    amounts = cleaning.repair_signs(tables.transactions.select("transaction_id", "amount"))
    balances = cleaning.clean_users(tables.users).select("user_id", F.col("wallet_balance").alias("amount"))
    rows = amounts.select(F.lit("transactions").alias("source"), F.col("transaction_id").alias("id"), "amount")
    return shown(rows.union(balances.select(F.lit("users"), "user_id", "amount")))


@query
def clean_score_clamp(spark, sf_dir):
    df = cleaning.clamp_score(load_fixtures(spark, sf_dir).transactions)
    return shown(df, "transaction_id", "fraud_score")


@query
def clean_user_defaults(spark, sf_dir):
    users = cleaning.clean_users(load_fixtures(spark, sf_dir).users)
    return shown(users, "user_id", "home_country", "kyc_status", "wallet_balance")


@query
def clean_txn_defaults(spark, sf_dir):
    df = cleaning.fill_missing(featured(spark, sf_dir).transactions)
    return shown(df, "transaction_id", *cleaning.FILL_ZERO, *cleaning.FILL_FALSE)


@query
def clean_time_repair(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    df = cleaning.repair_time(scope.transactions, scope)
    return shown(df, "transaction_id", "timestamp")


@query
def clean_rederive_new(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    df = cleaning.rederive_new(features.beneficiary_profile(scope.transactions, scope), PARAMS)
    return shown(df, "transaction_id", "is_beneficiary_new")


@query
def clean_dedup(spark, sf_dir):
    df = cleaning.dedup_retries(load_fixtures(spark, sf_dir).transactions.select(EVENT_COLUMNS))
    return shown(df)


@query
def clean_all(spark, sf_dir):
    df = cleaned(spark, sf_dir).transactions
    columns = [*EVENT_COLUMNS, "fraud_score", *cleaning.MEASURES[1:], "transaction_balance_ratio", *cleaning.FILL_FALSE]
    return shown(df, *columns)


@query
def clean_report(spark, sf_dir):
    report = quality.cleaning_report(cleaned(spark, sf_dir).tables)
    return shown(report.drop("executed_at"))


@query
def constraint_report(spark, sf_dir):
    return shown(quality.constraint_report(load_fixtures(spark, sf_dir)))


@query
def constraint_rows(spark, sf_dir):
    return shown(quality.constraint_rows(load_fixtures(spark, sf_dir)))


# Rules


def _rule(spark, sf_dir, name):
    hits = rules.single_rule(cleaned(spark, sf_dir), name).filter(F.col(name))
    return shown(hits, "transaction_id")


@query
def rule_structuring(spark, sf_dir):
    return _rule(spark, sf_dir, rules.STRUCTURING)


@query
def rule_velocity(spark, sf_dir):
    return _rule(spark, sf_dir, rules.VELOCITY)


@query
def rule_velocity_raw(spark, sf_dir):
    scope = raw_scope(spark, sf_dir)
    return shown(rules.velocity(scope.transactions, scope, "hit").filter("hit"), "transaction_id")


@query
def rule_cross_border(spark, sf_dir):
    return _rule(spark, sf_dir, rules.CROSS_BORDER)


@query
def rule_evasion(spark, sf_dir):
    return _rule(spark, sf_dir, rules.EVASION)


@query
def rule_impossible_travel(spark, sf_dir):
    return _rule(spark, sf_dir, rules.IMPOSSIBLE_TRAVEL)


@query
def rule_mule_network(spark, sf_dir):
    return _rule(spark, sf_dir, rules.MULE_NETWORK)


@query
def rule_flags_all(spark, sf_dir):
    return shown(flagged(spark, sf_dir).transactions, "transaction_id", "rule_flags")


@query
def rule_flags_all_hot(spark, sf_dir):
    return shown(flagged(spark, sf_dir, HOT).transactions, "transaction_id", "rule_flags")


@query
def rule_trigger_counts(spark, sf_dir):
    return shown(rules.trigger_counts(flagged(spark, sf_dir).transactions))


# Marts


@query
def mart_fraud_summary(spark, sf_dir):
    return shown(marts.fraud_summary(flagged(spark, sf_dir)))


@query
def mart_rule_breakdown(spark, sf_dir):
    return shown(marts.rule_breakdown(flagged(spark, sf_dir)))


@query
def mart_preview(spark, sf_dir):
    return shown(marts.preview(marts.fraud_summary(flagged(spark, sf_dir)), seed=7))


@query
def mart_kpi_cards(spark, sf_dir):
    return shown(marts.kpi_cards(flagged(spark, sf_dir).transactions))


@query
def mart_hourly_trend(spark, sf_dir):
    return shown(marts.hourly_trend(flagged(spark, sf_dir).transactions))


@query
def mart_incidents(spark, sf_dir):
    return shown(marts.incidents(flagged(spark, sf_dir).transactions))


@query
def mart_mule_beneficiaries(spark, sf_dir):
    return shown(marts.mule_beneficiaries(flagged(spark, sf_dir, wanted=(rules.MULE_NETWORK,))))


# Reports


@query
def rpt_velocity_off_hours(spark, sf_dir):
    return shown(marts.velocity_off_hours(flagged(spark, sf_dir, wanted=(rules.VELOCITY,)).transactions))


@query
def rpt_evasion_share(spark, sf_dir):
    return shown(marts.evasion_share(flagged(spark, sf_dir).transactions))


@query
def rpt_remote_off_hours(spark, sf_dir):
    return shown(marts.remote_off_hours(cleaned(spark, sf_dir).transactions, PARAMS))


@query
def rpt_exec_metrics(spark, sf_dir):
    metrics = reports.executive_metrics(portable_rows(spark, sf_dir))
    rates = {c: F.round(c, 6) for c in ("flag_rate", "amount_share")}
    return shown(metrics.withColumns(rates))


@query
def rpt_exec_rows(spark, sf_dir):
    return shown(reports.metric_rows(reports.executive_metrics(portable_rows(spark, sf_dir))))


@query
def rpt_top10(spark, sf_dir):
    return shown(reports.top_flagged(portable_rows(spark, sf_dir), PARAMS.top_n))


# Portable variant


@query
def port_clean(spark, sf_dir):
    df = portable.clean(load_portable(spark, sf_dir, PARAMS.hot_key_rows))
    return shown(
        df, "transaction_id", "user_id", "beneficiary_id", "amount", "timestamp", "phone_number", "is_beneficiary_new"
    )


@query
def port_repair_counts(spark, sf_dir):
    return shown(portable.repair_counts(load_portable(spark, sf_dir, PARAMS.hot_key_rows)))


@query
def port_distance(spark, sf_dir):
    df = portable_rows(spark, sf_dir)
    return df.select("transaction_id", F.round("distance_from_home_km", 2).alias("distance_from_home_km"))


@query
def port_time_flags(spark, sf_dir):
    return shown(portable_rows(spark, sf_dir), "transaction_id", "is_off_hours", "is_weekend")


@query
def port_evasion_flag(spark, sf_dir):
    return shown(portable_rows(spark, sf_dir), "transaction_id", "biometric_evasion_flag")


@query
def port_flag_rate(spark, sf_dir):
    return shown(portable.flag_rate(portable_rows(spark, sf_dir)))


@query
def port_flagged_preview(spark, sf_dir):
    return shown(portable.flagged_preview(portable_rows(spark, sf_dir), seed=7))


@query
def port_quality_report(spark, sf_dir):
    return shown(portable.quality_report(portable_rows(spark, sf_dir)))


@query
def port_distance_summary(spark, sf_dir):
    summary = portable.distance_summary(portable_rows(spark, sf_dir))
    return summary.select("name", F.round("value", 2).alias("value"))


# Single primitives on the given tables


@query
def prim_semi_in(spark, sf_dir):
    tables = load_fixtures(spark, sf_dir)
    risky = tables.beneficiaries.filter(F.col("beneficiary_country").isin(*PARAMS.high_risk_countries))
    hits = tables.transactions.join(risky.select("beneficiary_id"), "beneficiary_id", "left_semi")
    return shown(hits, "transaction_id", "beneficiary_id")


@query
def prim_anti_not_in(spark, sf_dir):
    tables = load_fixtures(spark, sf_dir)
    orphans = tables.transactions.join(tables.users.select("user_id"), "user_id", "left_anti")
    return shown(orphans, "transaction_id", "user_id")


@query
def prim_exists(spark, sf_dir):
    """Transfers with some login at or before them: the first login per user decides."""
    scope = raw_scope(spark, sf_dir)
    first = scope.tables.logins.groupBy("user_id").agg(F.min("login_timestamp").alias("first_login"))
    df = scope.hot_users.join_dimension(
        scope.transactions, first, {"first_login": "_first_login"}, "_any_login", "transaction_id"
    )
    return shown(df.filter(F.col("_first_login") <= F.col("timestamp")), "transaction_id")


@query
def prim_union_append(spark, sf_dir):
    rows = load_fixtures(spark, sf_dir).transactions.select("transaction_id", "amount")
    copies = rows.filter(F.col("amount") < 0).withColumn("amount", -F.col("amount"))
    return shown(rows.unionByName(copies))


@query
def prim_array_any(spark, sf_dir):
    hit = F.array_contains("rule_flags", rules.EVASION)
    evading = flagged(spark, sf_dir, wanted=(rules.EVASION,)).transactions
    return shown(evading.select("transaction_id", hit.alias("evading")))


@query
def mart_preview_rows(spark, sf_dir):
    """How many rows the previews show, and how many of them are rows of what they preview."""
    tables = flagged(spark, sf_dir)
    shown_rows = {
        "features": (features.feature_preview(tables.transactions, seed=7), tables.transactions),
        "mart": (marts.preview(marts.fraud_summary(tables)), tables.transactions),
        "portable": (portable.flagged_preview(portable_rows(spark, sf_dir)), portable_rows(spark, sf_dir)),
        "sample": (load_fixtures(spark, sf_dir).transactions.sample(fraction=0.03, seed=1), load_fixtures(spark, sf_dir).transactions),
    }
    parts = []
    for name, (some, every) in shown_rows.items():
        ids = some.select("transaction_id")
        strangers = ids.join(every.select("transaction_id"), "transaction_id", "left_anti").agg(F.count(F.lit(1)).alias("strangers"))
        rows = F.lit(-1) if name == "sample" else F.count(F.lit(1))
        parts.append(ids.agg(rows.cast("long").alias("rows")).crossJoin(strangers).select(F.lit(name).alias("preview"), "rows", "strangers"))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query
def clean_repair_counts(spark, sf_dir):
    """Counted while a staged run writes."""
    path = scratch_path(spark, "batch")
    run(spark, load_fixtures(spark, sf_dir), path, PARAMS)
    return shown(spark.read.parquet(f"{current_run(spark, path)}/marts/repair_counts"))


@query
def io_append_defaults(spark, sf_dir):
    """Bulk insert of users without ids, times and defaults; ids are counted, not compared."""
    path = scratch_path(spark, "users")
    users = load_fixtures(spark, sf_dir).users.select("full_name", "email", "phone")
    append_rows(users, path, USERS)
    append_rows(users, path, USERS)
    back = spark.read.parquet(path)
    columns = ["full_name", "email", "phone", "wallet_balance", "home_country", "kyc_status", "risk_tier", "is_active"]
    new_ids = back.groupBy("user_id").count().agg(F.count_if(F.col("count") == 1).alias("new_ids"))
    return shown(back.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).join(F.broadcast(new_ids)))


@query
def io_staged_run(spark, sf_dir):
    """The batch stage by stage, read back from its current run."""
    path = scratch_path(spark, "batch")
    run(spark, load_fixtures(spark, sf_dir), path, PARAMS)
    return shown(spark.read.parquet(f"{current_run(spark, path)}/flagged/transactions"), "transaction_id", "rule_flags")


@query
def sql_views(spark, sf_dir):
    """The marts through their view names."""
    marts.register_views(flagged(spark, sf_dir), PARAMS)
    return spark.sql(
        "select b.rule_name, count(*) as triggers, count(distinct s.user_id) as users, sum(s.is_flagged) as flagged"
        " from vw_dashboard_rule_breakdown b join vw_dashboard_fraud_summary s using (transaction_id) group by b.rule_name"
    )


@query
def param_velocity_cross_border(spark, sf_dir):
    """Rules with thresholds other than the default."""
    params = replace(PARAMS, velocity_max=1, cross_border_floor=100_000, high_risk_countries=("Iran", "Russia"))
    wanted = [rules.VELOCITY, rules.CROSS_BORDER]
    counts = rules.trigger_counts(flagged(spark, sf_dir, params).transactions)
    return shown(counts.filter(F.col("rule_name").isin(wanted)))

@query
def prim_unnest(spark, sf_dir):
    rows = flagged(spark, sf_dir).transactions.filter(F.cardinality("rule_flags") > 0)
    return shown(rows.select("transaction_id", F.explode("rule_flags").alias("rule_name")))


@query
def prim_having_distinct(spark, sf_dir):
    events = load_fixtures(spark, sf_dir).transactions
    senders = events.groupBy("beneficiary_id").agg(F.count_distinct("user_id").alias("senders"))
    return shown(senders.filter(F.col("senders") >= PARAMS.mule_min_senders))


@query
def prim_filtered_counts(spark, sf_dir):
    amount = F.col("amount")
    return shown(
        load_fixtures(spark, sf_dir).transactions.agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(amount < 0).alias("negative"),
            F.count_if(amount.between(PARAMS.band_low, PARAMS.band_high)).alias("in_band"),
            F.count_if(amount >= PARAMS.travel_min_amount).alias("large"),
        )
    )


@query
def prim_interval_self_join(spark, sf_dir):
    """Hits of the mule rule on the rows as loaded, without forming the pairs of the self-join."""
    scope = raw_scope(spark, sf_dir)
    hits = rules.mule_network(scope.transactions.select(EVENT_COLUMNS), scope, "hit").filter("hit")
    return shown(hits, "transaction_id")


def _senders(spark, sf_dir, params, rows_per_part):
    scope = raw_scope(spark, sf_dir, params)
    found = mule_senders(scope.transactions, scope, rows_per_part)
    return shown(found.withColumn("senders", F.col("senders").cast("array<string>")), "transaction_id", "senders")


@query
def rule_mule_senders(spark, sf_dir):
    return _senders(spark, sf_dir, PARAMS, 100_000)


@query
def rule_mule_senders_hot(spark, sf_dir):
    """With hot beneficiaries, and buckets cut into parts of a few senders."""
    return _senders(spark, sf_dir, HOT, 3)


@query
def prim_describe_amount(spark, sf_dir):
    summary = describe(load_fixtures(spark, sf_dir).transactions.select("amount"), "amount")
    return summary.select("name", F.round("value", 2).alias("value"))


@query
def prim_sample(spark, sf_dir):
    return shown(load_fixtures(spark, sf_dir).transactions.select(EVENT_COLUMNS).filter(drawn("transaction_id", 0.03, seed=1)))


# Input and output


@query
def io_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw_transactions")
    write_csv(load_fixtures(spark, sf_dir).transactions, path)
    back = read_csv_table(spark, path, TRANSACTIONS)
    return shown(back.withColumn("transaction_id", F.col("transaction_id").cast("long")), "transaction_id", "user_id", "beneficiary_id", "amount", "timestamp", "channel", "merchant_country", "status", "fraud_score", "final_decision", "is_ground_truth_fraud")


def _spoiled_csv(spark, sf_dir):
    """Transfers as a CSV export in which some amounts, times and whole lines are malformed."""
    path = scratch_path(spark, "spoiled")
    number = F.col("transaction_id") / 100
    rows = load_fixtures(spark, sf_dir).transactions.select(
        "transaction_id",
        F.when(F.floor(number) % 31 == 0, "n/a").otherwise(F.col("amount").cast("string")).alias("Amount "),
        F.when(F.floor(number) % 37 == 0, "yesterday").otherwise(F.col("timestamp").cast("string")).alias("timestamp"),
        F.when(F.floor(number) % 41 == 0, "MOBILE,APP").otherwise(F.col("channel")).alias("channel"),
        "user_id",
        "beneficiary_id",
    )
    rows.write.mode("overwrite").csv(path, header=True, quote="\u0000")
    return read_csv_checked(spark, path, TRANSACTIONS)


@query
def io_csv_good_rows(spark, sf_dir):
    good, _ = _spoiled_csv(spark, sf_dir)
    return shown(good, "transaction_id", "user_id", "beneficiary_id", "amount", "timestamp", "channel", "status")


@query
def io_csv_rejected_rows(spark, sf_dir):
    _, rejected = _spoiled_csv(spark, sf_dir)
    return shown(rejected.select(F.substring_index("record", ",", 1).alias("transaction_id"), "reasons"))


@query
def io_report_csv(spark, sf_dir):
    """Cleaned rows to CSV, read back by header, and reported on."""
    path = scratch_path(spark, "cleaned_transactions")
    write_csv(portable_rows(spark, sf_dir), path)
    back = read_flagged_csv(spark, path)
    back = back.filter(is_true_text(F.col("biometric_evasion_flag")))
    return shown(back.withColumn("transaction_id", F.col("transaction_id").cast("long")), "transaction_id", "amount")


@query
def io_parquet_marts(spark, sf_dir):
    path = scratch_path(spark, "fraud_summary")
    write_mart(marts.fraud_summary(flagged(spark, sf_dir)), path, date_partitions=True)
    return shown(spark.read.parquet(path), "transaction_id", "amount", "triggered_rules_count", "beneficiary_bank_code")


# Streams


@query
def stream_velocity(spark, sf_dir):
    return shown(streams.velocity(load_fixtures(spark, sf_dir).transactions, PARAMS), "transaction_id", "transfers")


@query
def stream_mules(spark, sf_dir):
    return shown(streams.mules(load_fixtures(spark, sf_dir).transactions, PARAMS), "transaction_id", "senders")


@query
def stream_last_login(spark, sf_dir):
    tables = load_fixtures(spark, sf_dir)
    found = streams.last_login(tables.transactions, tables.logins).filter(F.col("login_timestamp").isNotNull())
    return shown(found, "transaction_id", "login_timestamp", "device_id")


@query
def stream_first_arrivals(spark, sf_dir):
    rows = load_fixtures(spark, sf_dir).transactions
    return shown(streams.without_retries(rows, F.col("transaction_id") % 100 == 5, exact=False), *EVENT_COLUMNS)


@query
def stream_smallest_ids(spark, sf_dir):
    rows = load_fixtures(spark, sf_dir).transactions
    return shown(streams.without_retries(rows, F.col("transaction_id") % 100 == 5, exact=True), *EVENT_COLUMNS)


@query
def stream_rule_breakdown(spark, sf_dir):
    return shown(streams.rule_breakdown(flagged(spark, sf_dir)))


# Loads


def in_loads(tables: Tables) -> list[Tables]:
    """The tables as three loads by time, with retries, some logins, users and beneficiaries that come later."""

    def load_of(ts: str, late) -> Column:
        return F.least(F.floor((F.dayofmonth(ts) - 1) / 11) + late.cast("int"), F.lit(2))

    which = {
        "users": F.when(F.col("user_id") % 7 == 3, 1).otherwise(0),
        "beneficiaries": F.when(F.col("beneficiary_id") % 5 == 2, 2).otherwise(0),
        "logins": load_of("login_timestamp", F.col("auth_id") % 11 == 0),
        "transactions": load_of("timestamp", F.col("transaction_id") % 100 == 5),
    }
    return [Tables(**{name: getattr(tables, name).filter(part == n) for name, part in which.items()}) for n in range(3)]


@query
def inc_three_loads(spark, sf_dir):
    store = Store(spark, scratch_path(spark, "store"), PARAMS)
    for n, part in enumerate(in_loads(load_fixtures(spark, sf_dir))):
        store.load(f"load{n}", part)
    return shown(store.flagged(), "transaction_id", "rule_flags")


@query
def inc_three_loads_features(spark, sf_dir):
    store = Store(spark, scratch_path(spark, "store"), PARAMS)
    for n, part in enumerate(in_loads(load_fixtures(spark, sf_dir))):
        store.load(f"load{n}", part)
    columns = [*EVENT_COLUMNS, "fraud_score", *cleaning.MEASURES[1:], "transaction_balance_ratio", *cleaning.FILL_FALSE]
    return shown(store.flagged(), *columns)
