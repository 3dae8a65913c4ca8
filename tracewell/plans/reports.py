"""Executive report over flat flagged rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.columns import grouped_number, is_true_text, percent_text, share
from tracewell.sources.readers import with_row_number

FLAG, AMOUNT = "biometric_evasion_flag", "amount"


def executive_metrics(df: DataFrame, flag: str = FLAG, amount: str = AMOUNT) -> DataFrame:
    """Counts, amounts and their shares in one pass. Amounts are added up as they are
    (to ten decimals, exactly); an amount that is not a number counts as 0."""
    hit = is_true_text(F.col(flag))
    money = F.coalesce(F.expr(f"try_cast(`{amount}` as decimal(28,10))"), F.lit(0))
    totals = df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(hit).alias("flagged_transactions"),
        F.coalesce(F.sum(money), F.lit(0)).cast("double").alias("total_amount"),
        F.coalesce(F.sum(F.when(hit, money)), F.lit(0)).cast("double").alias("amount_at_risk"),
    )
    return totals.select(
        "*",
        share(F.col("flagged_transactions"), F.col("total_transactions")).alias("flag_rate"),
        share(F.col("amount_at_risk"), F.col("total_amount")).alias("amount_share"),
    )


def top_flagged(df: DataFrame, rows: int = 10, flag: str = FLAG, amount: str = AMOUNT) -> DataFrame:
    """The largest flagged amounts; one that is not a number counts as 0. Equal amounts
    keep the order of the input: by row number where rows have one, else by id. Without an id
    the row number also serves as the label."""
    if "transaction_id" not in df.columns and "_row_number" not in df.columns:
        df = with_row_number(df)
    order = "_row_number" if "_row_number" in df.columns else "transaction_id"
    if "transaction_id" not in df.columns:
        df = df.withColumn("transaction_id", F.concat(F.lit("Row "), F.col(order).cast("string")))
    number = F.col(amount)
    df = df.withColumn(amount, F.when(number.isNull() | F.isnan(number.cast("double")), 0).otherwise(number))
    if "timestamp" not in df.columns:
        df = df.withColumn("timestamp", F.lit(""))
    best = df.filter(is_true_text(F.col(flag)) & (F.col(amount) >= 0)).orderBy(F.desc(amount), order).limit(rows)
    # Only the few rows that are left get ranked.
    rank = F.row_number().over(Window.orderBy(F.desc(amount), order))
    return best.select(rank.alias("rank"), "transaction_id", "timestamp", amount)


def _labelled(metrics: DataFrame, lines: list[tuple[str, Column]]) -> DataFrame:
    rows = [
        F.struct(F.lit(i).alias("line"), F.lit(label).alias("label"), value.alias("value"))
        for i, (label, value) in enumerate(lines, 1)
    ]
    return metrics.select(F.inline(F.array(*rows)))


def metric_rows(metrics: DataFrame, currency: str = "VND") -> DataFrame:
    """The metrics as formatted label and value lines, followed by the banner lines."""
    money = {c: F.concat(grouped_number(F.col(c)), F.lit(f" {currency}")) for c in ("total_amount", "amount_at_risk")}
    rate, part = percent_text(F.col("flag_rate")), percent_text(F.col("amount_share"))
    total, flagged = F.col("total_transactions"), F.col("flagged_transactions")
    between = "   |   "
    return _labelled(
        metrics,
        [
            ("Total Transactions", grouped_number(total)),
            ("Flagged Transactions", grouped_number(flagged)),
            ("Flag Rate (by count)", rate),
            ("Total Transaction Volume", money["total_amount"]),
            ("Amount at Risk (flagged)", money["amount_at_risk"]),
            ("Share of Total Volume", part),
            ("Banner", F.lit("FLAGGED TRANSACTION REPORT")),
            (
                "Banner",
                F.concat(
                    F.lit("Total: "), total, F.lit(f"{between}Flagged: "), flagged, F.lit(f"{between}Flag Rate: "), rate
                ),
            ),
            (
                "Banner",
                F.concat(
                    F.lit("Amount at Risk: "), money["amount_at_risk"], F.lit(f"{between}Share of Total Volume: "), part
                ),
            ),
        ],
    )
