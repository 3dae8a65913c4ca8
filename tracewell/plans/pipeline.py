"""The whole batch: features, cleaning, rules, marts."""

from dataclasses import replace
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tracewell.operators.cleaning import clean
from tracewell.operators.features import build_features
from tracewell.operators.rules import RULES, apply_rules, trigger_counts
from tracewell.operators.scope import BANK_COLUMNS, Scope
from tracewell.params import Params
from tracewell.plans.marts import fraud_summary, rule_breakdown
from tracewell.plans.quality import RepairCounts
from tracewell.sources.schemas import SPECS
from tracewell.sources.tables import Tables, conform, public_columns, read_tables
from tracewell.sources.writers import write_mart, write_table


CLEANED = ("users", "beneficiaries", "transactions")


def plan(
    tables: Tables, params: Params = Params(), mode: str = "reference", wanted: tuple[str, ...] = RULES
) -> Tables:
    """The flagged tables as one lazy plan, with the rules wanted.

    mode="reference" computes features on the rows as loaded and then cleans, so features
    of repaired rows keep their old values. mode="recompute" cleans first."""
    scope = Scope.of(tables, params)
    if mode == "reference":
        scope = clean(build_features(scope))
    elif mode == "recompute":
        cleaned = clean(scope)
        scope = build_features(cleaned.with_tables(transactions=public_columns(cleaned.transactions)))
    else:
        raise ValueError(f"unknown mode: {mode}")
    flagged = apply_rules(scope, wanted).tables
    # The bank goes on with the transfer, so that marts need no second look-up.
    bank = [F.col(c) for c in BANK_COLUMNS.values()]
    facts = flagged.transactions
    return flagged.with_(transactions=facts.select(*public_columns(facts).columns, *bank))


def run(
    spark: SparkSession,
    tables: Tables,
    out: str,
    params: Params = Params(),
    date_partitions: bool = False,
    mode: str = "reference",
) -> Tables:
    """Run stage by stage, in the order of `plan`'s mode. Each stage is written to its own
    folder and the next one reads it back, so lost executors never redo an earlier stage.

    What cleaning repairs is counted while it is written (marts/repair_counts).

    A run writes to a folder of its own below `out`, which becomes the current one (see
    `current_run`) when all of it is there. If a stage fails, the former run stays current."""
    if mode not in ("reference", "recompute"):
        raise ValueError(f"unknown mode: {mode}")
    run_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"
    base, out = out, f"{out}/runs/{run_id}"
    scope = Scope.of(tables, params)

    def store(stage: str, frame, spec_name: str):
        path = f"{out}/{stage}/{spec_name}"
        write_table(public_columns(frame), path)
        return conform(spark.read.parquet(path), SPECS[spec_name])

    def with_features(scope: Scope) -> Scope:
        return scope.with_tables(transactions=store("features", build_features(scope).transactions, "transactions"))

    def with_clean_tables(scope: Scope) -> Scope:
        repairs = RepairCounts()
        cleaned = repairs.watched(scope).tables
        stored = {name: store("clean", frame, name) for name, frame in cleaned.named().items() if name in CLEANED}
        line = spark.createDataFrame([tuple(repairs.counts.values())], ", ".join(f"{c} long" for c in repairs.counts))
        write_table(line.coalesce(1), f"{out}/marts/repair_counts")
        scope = replace(scope, tables=cleaned.with_(**stored))
        return scope.with_events(scope.transactions)  # the hot keys' rows are from now on those that were stored

    stages = [with_features, with_clean_tables] if mode == "reference" else [with_clean_tables, with_features]
    for stage in stages:
        scope = stage(scope)
    flagged = apply_rules(scope).transactions
    done = scope.tables.with_(transactions=store("flagged", flagged, "transactions"))
    write_mart(fraud_summary(done), f"{out}/marts/fraud_summary", date_partitions)
    write_mart(rule_breakdown(done), f"{out}/marts/rule_breakdown", date_partitions)
    write_table(trigger_counts(done.transactions), f"{out}/marts/trigger_counts")
    spark.createDataFrame([(run_id,)], "run_id string").coalesce(1).write.mode("append").parquet(f"{base}/finished")
    return done


def current_run(spark: SparkSession, out: str) -> str:
    """Folder of the latest run below `out` that finished."""
    return f"{out}/runs/{spark.read.parquet(f'{out}/finished').agg(F.max('run_id')).first()[0]}"


def run_folder(
    spark: SparkSession,
    source: str,
    out: str,
    params: Params = Params(),
    date_partitions: bool = False,
    mode: str = "reference",
) -> Tables:
    """Run on Parquet tables in one folder."""
    if f"{source.rstrip('/')}/".startswith(f"{out.rstrip('/')}/"):
        raise ValueError("the output folder must not be or contain the source folder")
    return run(spark, read_tables(spark, source), out, params, date_partitions, mode)
