"""Data-quality reports: cleaning result and constraint violations (CL14, CL15)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tracewell.operators.cleaning import FILL_FALSE, FILL_ZERO, clean
from tracewell.operators.scope import Scope
from tracewell.sources.schemas import SPECS, TableSpec
from tracewell.sources.tables import Tables


def _orphans(fact: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    """One row: fact rows whose key is not in the dimension. Counted per key first, so a
    frequent key is one row in the join."""
    per_key = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    missing = per_key.join(dim.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphans"))


def cleaning_report(tables: Tables) -> DataFrame:
    """CL14: what is left to repair after cleaning. One pass over the transfers, summed per user
    first, so that the look-up in users joins one row per user."""
    per_user = tables.transactions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("amount") <= 0).alias("_invalid"),
        F.count_if(F.col("distance_from_home_km").isNull()).alias("_unknown"),
    )
    users = tables.users.select(F.col("user_id").alias("_user"))
    looked_up = per_user.join(users, F.col("user_id") == F.col("_user"), "left")
    orphan = F.when(F.col("user_id").isNotNull() & F.col("_user").isNull(), F.col("_rows"))
    sums = {
        "cleaned_transactions": F.col("_rows"),
        "invalid_amounts_left": F.col("_invalid"),
        "null_distances_left": F.col("_unknown"),
        "orphan_txns_left": orphan,
    }
    return looked_up.agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(name) for name, v in sums.items()]).select(
        F.lit("=== DATA CLEANING REPORT ===").alias("report_status"),
        F.current_timestamp().alias("executed_at"),
        *sums,
    )


def _repairs() -> dict[str, Column]:
    """Counts over transfers that know of their user and beneficiary, before they are cleaned."""
    known = F.col("_known_user") & F.col("_known_beneficiary")
    filled = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in FILL_ZERO + FILL_FALSE])
    score = F.col("fraud_score")
    return {
        "rows_before": F.count(F.lit(1)),
        "orphans_purged": F.count_if(~known),
        "amounts_made_positive": F.count_if(known & (F.col("amount") < 0)),
        "scores_clamped": F.count_if(known & ((score < 0) | (score > 1))),
        "rows_with_defaults": F.count_if(known & filled),
        "times_moved": F.count_if(known & (F.col("timestamp") < F.col("_user_created_at"))),
    }


class RepairCounts:
    """What cleaning repairs, counted while its result is written: each step counts the rows that the steps
    before it leave. `watched` is what to write; the counts are there afterwards."""

    def __init__(self) -> None:
        self.before, self.after = Observation(), Observation()

    def watched(self, scope: Scope) -> Scope:
        """The cleaned tables."""
        df = scope.with_users(scope.with_beneficiaries(scope.transactions))
        df = df.observe(self.before, *[value.alias(name) for name, value in _repairs().items()])
        cleaned = clean(scope.with_tables(transactions=df))
        left = cleaned.transactions.observe(self.after, F.count(F.lit(1)).alias("rows_after"))
        return cleaned.with_tables(transactions=left)

    @property
    def counts(self) -> dict[str, int]:
        found = {**self.before.get, **self.after.get}
        return {**found, "copies_removed": found["rows_before"] - found["orphans_purged"] - found["rows_after"]}


def repair_counts(scope: Scope) -> DataFrame:
    """The same as one lazy plan: one pass over the features, and one count of what is left."""
    df = scope.with_users(scope.with_beneficiaries(scope.transactions))
    before = df.agg(*[value.alias(name) for name, value in _repairs().items()])
    after = clean(scope).transactions.agg(F.count(F.lit(1)).alias("rows_after"))
    # Both sides are single aggregate rows.
    copies = F.col("rows_before") - F.col("orphans_purged") - F.col("rows_after")
    return before.crossJoin(after).withColumn("copies_removed", copies)


def _line(table: str, check: str, column: str, count) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        count.cast("long").alias("violations"),
    )


def _row_checks(spec: TableSpec, df: DataFrame) -> DataFrame:
    """Required columns, lengths, ranges and allowed values, all in one pass."""
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in spec.required}
    counts |= {("length", c): F.count_if(F.length(c) > most) for c, most in spec.lengths.items()}
    counts |= {("range", c): F.count_if(F.abs(c) >= bound) for c, bound in spec.bounds.items()}
    counts |= {("check", c): F.count_if(~F.col(c).isin(*values)) for c, values in spec.domains.items()}
    one = df.agg(*[value.alias(f"{check}_{c}") for (check, c), value in counts.items()])
    lines = F.array(*[_line(spec.name, check, c, F.col(f"{check}_{c}")) for check, c in counts])
    return one.select(F.inline(lines))


def _unique_check(spec: TableSpec, df: DataFrame, column: str, check: str) -> DataFrame:
    """Rows beyond the first with the same value."""
    copies = df.filter(F.col(column).isNotNull()).groupBy(column).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    one = copies.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("_extra"))
    return one.select(F.inline(F.array(_line(spec.name, check, column, F.col("_extra")))))


def constraint_report(tables: Tables) -> DataFrame:
    """CL15: violations of every declared constraint, in long form."""
    frames = tables.named()
    reports = []
    for name, spec in SPECS.items():
        df = frames[name]
        reports.append(_row_checks(spec, df))
        reports.append(_unique_check(spec, df, spec.key, "primary_key"))
        reports += [_unique_check(spec, df, column, "unique") for column in spec.unique]
        for column, target in spec.references.items():
            found = _orphans(df, column, frames[target])
            reports.append(found.select(F.inline(F.array(_line(name, "foreign_key", column, F.col("orphans"))))))
    return reduce(DataFrame.unionByName, reports)


def _broken(spec: TableSpec) -> Column:
    """The row's own broken rules, as an array of (check, column)."""
    rules = {("not_null", c): F.col(c).isNull() for c in spec.required}
    rules |= {("length", c): F.length(c) > most for c, most in spec.lengths.items()}
    rules |= {("range", c): F.abs(c) >= bound for c, bound in spec.bounds.items()}
    rules |= {("check", c): ~F.col(c).isin(*values) for c, values in spec.domains.items()}
    named = [F.when(bad, F.struct(F.lit(check).alias("check_name"), F.lit(c).alias("column_name"))) for (check, c), bad in rules.items()]
    return F.array_compact(F.array(*named))


def _violating(spec: TableSpec, rows: DataFrame, check: Column, column: Column, copies: Column) -> DataFrame:
    return rows.select(
        F.lit(spec.name).alias("table_name"),
        check.alias("check_name"),
        column.alias("column_name"),
        F.col(spec.key).cast("string").alias("row_key"),
        copies.cast("long").alias("copies"),
    )


def constraint_rows(tables: Tables) -> DataFrame:
    """CL15: which rows violate which constraint: table_name, check_name, column_name, row_key, and `copies`,
    how many rows of that key do.

    One pass over each table finds what a row breaks by itself. Of equal values where only one may be, all
    but one with the smallest key violate; they are counted per value and key, so that a value on very many
    rows is not brought together row by row."""
    frames, parts = tables.named(), []
    for name, spec in SPECS.items():
        df = frames[name]
        own = df.select(spec.key, F.inline(_broken(spec)))
        parts.append(_violating(spec, own, F.col("check_name"), F.col("column_name"), F.lit(1)))
        for column in dict.fromkeys([spec.key, *spec.unique]):
            value = F.col(column).alias("_value")
            held = df.filter(F.col(column).isNotNull()).groupBy(value, F.col(spec.key)).agg(F.count(F.lit(1)).alias("_n"))
            first = F.min(F.struct(F.col(spec.key).isNull().alias("_none"), F.col(spec.key).alias("_first")))
            values = held.groupBy("_value").agg(F.sum("_n").alias("_all"), first.alias("_least")).filter("_all > 1")
            extra = F.col("_n") - F.col(spec.key).eqNullSafe(F.col("_least._first")).cast("int")
            over = held.join(values, "_value").withColumn("_extra", extra).filter("_extra > 0")
            check = "primary_key" if column == spec.key else "unique"
            parts.append(_violating(spec, over, F.lit(check), F.lit(column), F.col("_extra")))
        for column, target in spec.references.items():
            asked = df.filter(F.col(column).isNotNull()).select(column).distinct()
            missing = asked.join(frames[target].select(column), column, "left_anti")
            lost = df.select(*dict.fromkeys([spec.key, column])).join(missing, column, "left_semi")
            parts.append(_violating(spec, lost, F.lit("foreign_key"), F.lit(column), F.lit(1)))
    return reduce(DataFrame.unionByName, parts)
