"""The portable variant on one flat frame, with its own constants."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions.columns import draw, haversine_km, off_hours, weekend
from tracewell.operators.cleaning import RETRY_KEYS, dedup_retries
from tracewell.operators.quantiles import describe
from tracewell.params import Params

ORPHAN_KEYS = ["beneficiary_id", "user_id"]


def repair(df: DataFrame) -> DataFrame:
    """Phone prefix, amount sign, unknown beneficiary counts as new."""
    return df.withColumns(
        {
            "phone_number": F.regexp_replace("phone_number", r"^(\+84|84)", "0"),
            "amount": F.abs("amount"),
            "is_beneficiary_new": F.coalesce("is_beneficiary_new", F.lit(True)),
        }
    )


def clean(df: DataFrame, order: str = "transaction_id") -> DataFrame:
    """P1-P5. `order` stands for the order of the rows in the file."""
    whole = dedup_retries(repair(df), order).na.drop(subset=ORPHAN_KEYS)
    return whole.withColumn("beneficiary_id", F.col("beneficiary_id").cast("long"))


def features(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Distance from home (NULL when unknown), night hours, weekend."""
    ts = F.col("timestamp").cast("timestamp_ntz")
    km = haversine_km(
        F.col("home_latitude"),
        F.col("home_longitude"),
        F.col("ip_latitude"),
        F.col("ip_longitude"),
        params.earth_radius_km,
    )
    night = off_hours(ts, params.off_hours_start, params.portable_off_hours_end)
    return df.withColumns({"timestamp": ts, "distance_from_home_km": km, "is_off_hours": night, "is_weekend": weekend(ts)})


def flag_evasion(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Just under the biometric limit, to a new beneficiary."""
    band = F.col("amount").between(params.band_low, params.band_high)
    return df.withColumn("biometric_evasion_flag", band & F.col("is_beneficiary_new"))


def run(df: DataFrame, params: Params = Params(), order: str = "transaction_id") -> DataFrame:
    return flag_evasion(features(clean(df, order), params), params)


def repair_counts(df: DataFrame) -> DataFrame:
    """What each cleaning step changes: signs, filled flags, removed copies, purged rows."""
    per_transfer = repair(df).groupBy(RETRY_KEYS).agg((F.count(F.lit(1)) - 1).alias("_copies"))
    orphan = F.col("user_id").isNull() | F.col("beneficiary_id").isNull()
    removed = per_transfer.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("duplicates_removed"),
        F.count_if(orphan).alias("orphans_purged"),
    )
    touched = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col("amount") < 0).alias("amounts_corrected"),
        F.count_if(F.col("is_beneficiary_new").isNull()).alias("flags_imputed"),
    )
    # Both sides are single aggregate rows.
    return touched.crossJoin(removed).withColumn(
        "rows_after", F.col("rows_before") - F.col("duplicates_removed") - F.col("orphans_purged")
    )


def flag_rate(flagged: DataFrame) -> DataFrame:
    """Flagged transfers and their percentage."""
    hits = F.count_if("biometric_evasion_flag")
    return flagged.agg(
        hits.alias("flagged_count"), F.round(hits.cast("double") / F.count(F.lit(1)) * 100, 2).alias("flag_rate")
    )


def flagged_preview(flagged: DataFrame, rows: int = 5, seed: int | None = None) -> DataFrame:
    """Any flagged transfers, or with a seed random ones that are the same again."""
    hits = flagged.filter("biometric_evasion_flag")
    if seed is not None:
        hits = hits.orderBy(draw("transaction_id", seed))
    return hits.select("transaction_id", "amount", "is_beneficiary_new", "timestamp").limit(rows)


def quality_report(df: DataFrame) -> DataFrame:
    """P10: five metrics in long form."""
    keys = df.groupBy(RETRY_KEYS).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("distance_from_home_km").isNull()).alias("_unknown"),
    )
    orphans = F.col("user_id").isNull().cast("int") + F.col("beneficiary_id").isNull().cast("int")
    one = keys.agg(
        F.sum("_n").alias("cleaned_transactions"),
        F.sum(F.when(F.col("amount") < 0, F.col("_n")).otherwise(0)).alias("invalid_amounts_left"),
        F.sum("_unknown").alias("null_distances_left"),
        F.sum(orphans * F.col("_n")).alias("orphan_txns_left"),
        F.sum(F.col("_n") - 1).alias("duplicate_txns_left"),
    )
    lines = [
        F.struct(F.lit(name).alias("metric"), F.coalesce(name, F.lit(0)).alias("metric_value")) for name in one.columns
    ]
    return one.select(F.inline(F.array(*lines)))


def distance_summary(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of the distance."""
    return describe(df.select("distance_from_home_km"), "distance_from_home_km")
