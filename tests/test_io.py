"""Files, headers, defaults, row order, exact quantiles, report text."""

import random
import statistics
from decimal import Decimal

import pytest
from edge_data import T0
from pyspark.sql import functions as F

from tracewell.functions.columns import haversine_km, local_phone, percentage
from tracewell.operators.quantiles import describe, exact_quantiles
from tracewell.plans import portable, reports
from tracewell.sources import fixtures, readers, writers
from tracewell.sources.fixtures import load_fixtures
from tracewell.sources.schemas import ID_COLUMNS, SPECS, TRANSACTIONS, USERS
from tracewell.sources.tables import conform


def put(folder, text, name="part.csv"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_header_is_found_in_any_order_and_case(spark, tmp_path):
    path = put(tmp_path / "a", "x, Biometric_Evasion_Flag ,AMOUNT\n1, TRUE ,5.5\n2,false,7\n3,yes,9\n4,True,8.5\n")
    df = readers.read_flagged_csv(spark, path)
    row = reports.executive_metrics(df).first()
    assert (row["total_transactions"], row["flagged_transactions"]) == (4, 2)
    assert (row["total_amount"], row["amount_at_risk"]) == (30.0, 14.0)
    assert row["flag_rate"] == 0.5
    top = reports.top_flagged(df).orderBy("rank").collect()
    assert [(r["rank"], r["transaction_id"], r["timestamp"], r["amount"]) for r in top] == [
        (1, "Row 5", "", 8.5),
        (2, "Row 2", "", 5.5),
    ]


@pytest.mark.parametrize("header", ["amount,other", "biometric_evasion_flag,other"])
def test_missing_column_is_an_error(spark, tmp_path, header):
    with pytest.raises(ValueError, match="not found"):
        readers.read_flagged_csv(spark, put(tmp_path / "b", f"{header}\n1,2\n"))


def test_amounts_are_not_rounded_and_ids_may_be_text(spark, tmp_path):
    rows = "b7-x,5.126,true\na1-y,4.126,TRUE\nc3,none,true\na0,4.126,true\n"
    df = readers.read_flagged_csv(spark, put(tmp_path / "e", "transaction_id,amount,biometric_evasion_flag\n" + rows))
    assert reports.executive_metrics(df).first()["total_amount"] == 13.378
    top = reports.top_flagged(df).orderBy("rank").collect()
    assert [(r["transaction_id"], r["amount"]) for r in top] == [("b7-x", 5.126), ("a1-y", 4.126), ("a0", 4.126), ("c3", 0.0)]


def test_line_breaks_in_text_survive(spark, tmp_path):
    rows = [("1", 'two\nlines, "quoted"'), ("2", "plain")]
    writers.write_csv(spark.createDataFrame(rows, "id string, note string"), str(tmp_path / "f"))
    back = readers.read_csv_by_header(spark, str(tmp_path / "f"), ["id"], line_breaks=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_reading_without_a_key_column_is_an_error(spark):
    with pytest.raises(ValueError, match="transaction_id"):
        conform(spark.createDataFrame([("u",)], "user_id string"), TRANSACTIONS)


def test_no_rows_give_zero_rates(spark, tmp_path):
    df = readers.read_flagged_csv(spark, put(tmp_path / "c", "amount,biometric_evasion_flag\n"))
    row = reports.executive_metrics(df).first()
    assert (row["total_transactions"], row["flag_rate"], row["amount_share"]) == (0, 0.0, 0.0)


def test_top_rows_skip_negative_amounts_and_keep_input_order_on_ties(spark):
    rows = [(i, a, f, T0) for i, (a, f) in enumerate([(5.0, "true"), (-1.0, "true"), (9.0, "false"), (5.0, "TRUE")], 1)]
    df = spark.createDataFrame(rows, "transaction_id long, amount double, biometric_evasion_flag string, timestamp timestamp_ntz")
    got = reports.top_flagged(df, rows=10).orderBy("rank").collect()
    assert [(r["rank"], r["transaction_id"]) for r in got] == [(1, 1), (2, 4)]
    assert len(reports.top_flagged(df, rows=1).collect()) == 1


def test_row_numbers_follow_the_file(spark, tmp_path):
    path = put(tmp_path / "d", "v\n" + "\n".join(str(i) for i in range(5000)) + "\n")
    df = spark.read.option("maxPartitionBytes", 1).csv(path, header=True)
    numbered = readers.with_row_number(df).collect()
    assert all(r["_row_number"] == int(r["v"]) + 2 for r in numbered)


def test_metric_rows(spark):
    metrics = spark.createDataFrame(
        [(1234, 56, 1234567.5, 1000.4, 0.0454, 0.00081)],
        "total_transactions long, flagged_transactions long, total_amount double, amount_at_risk double,"
        " flag_rate double, amount_share double",
    )
    values = [r["value"] for r in reports.metric_rows(metrics).orderBy("line").collect()]
    assert values[:6] == ["1,234", "56", "4.5%", "1,234,568 VND", "1,000 VND", "0.1%"]
    assert values[7] == "Total: 1234   |   Flagged: 56   |   Flag Rate: 4.5%"


def test_csv_export_and_load(spark, sf_dir, tmp_path):
    tables = load_fixtures(spark, sf_dir)
    writers.export_raw_csv(tables, str(tmp_path))
    for name, df in tables.named().items():
        back = readers.read_csv_table(spark, f"{tmp_path}/raw_{name}", SPECS[name])
        original = conform(df.select([F.col(c).cast("string") if c in ID_COLUMNS else c for c in df.columns]), SPECS[name])
        assert back.exceptAll(original).isEmpty()
        assert back.count() == df.count()


def test_append_fills_left_out_columns(spark, tmp_path):
    rows = spark.createDataFrame([("Ann", "a@x", "01")], "full_name string, email string, phone string")
    path = str(tmp_path / "users")
    for _ in range(2):
        writers.append_rows(rows, path, USERS)
    got = spark.read.parquet(path).collect()
    assert len({r["user_id"] for r in got}) == 2
    first = got[0]
    assert (first["wallet_balance"], first["home_country"], first["kyc_status"]) == (Decimal("0.00"), "Vietnam", "pending")
    assert first["created_at"] is not None and first["is_active"] is True


def test_csv_keeps_quotes_and_blanks(spark, tmp_path):
    df = spark.createDataFrame([(' say "hi", ok ', None)], "a string, b string")
    writers.write_csv(df, str(tmp_path / "q"))
    row = readers.read_csv_by_header(spark, str(tmp_path / "q"), ["a"]).first()
    assert tuple(row) == (' say "hi", ok ', None)


def test_default_flags_are_an_empty_list(spark):
    row = conform(spark.createDataFrame([("t",)], "transaction_id string"), TRANSACTIONS, inserting=True).first()
    assert row["rule_flags"] == [] and row["status"] == "pending" and row["amount"] is None


def test_scratch_folder_is_the_shared_one(spark):
    assert writers.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([0.0, 1.5, rng.uniform(-3, 3), rng.gauss(0, 1e6), -2.0]) for _ in range(200 + seed)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    points = (("a", 0.0), ("b", 0.1), ("c", 0.5), ("d", 0.99), ("e", 1.0))
    got = {r["name"]: r["value"] for r in exact_quantiles(df, "v", points).collect()}
    ordered = sorted(values)
    for name, p in points:
        at = (len(ordered) - 1) * p
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
        assert got[name] == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-9, abs=1e-9)
    stats = {r["name"]: r["value"] for r in describe(df, "v").collect()}
    assert stats["count"] == len(values)
    assert stats["std"] == pytest.approx(statistics.stdev(values))


def test_describe_without_values(spark):
    got = {r["name"]: r["value"] for r in describe(spark.createDataFrame([(None,)], "v double"), "v").collect()}
    assert got["count"] == 0 and "50%" not in got


def test_columns(spark):
    df = spark.createDataFrame(
        [("+84912",), ("84912",), ("0912",), ("8412",), (None,), ("084",)], "p string"
    ).select(local_phone(F.col("p")), F.regexp_replace("p", r"^(\+84|84)", "0"))
    rows = df.collect()
    assert [r[0] for r in rows] == ["0912", "0912", "0912", "012", None, "084"]
    assert all(r[0] == r[1] for r in rows)
    one = spark.range(1).select(
        percentage(F.lit(1), F.lit(3)),
        percentage(F.lit(1), F.lit(0)),
        percentage(F.lit(1), F.lit(8)),
        percentage(F.lit(1), F.lit(32)),  # 3.125: half away from zero
        haversine_km(F.lit(21.0), F.lit(105.0), F.lit(21.0), F.lit(105.0)),
        haversine_km(F.lit(None).cast("double"), F.lit(105.0), F.lit(21.0), F.lit(105.0)),
        haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)),
    ).first()
    assert list(one)[:4] == [33.33, None, 12.5, 3.13]
    assert one[4] == pytest.approx(0, abs=1e-3) and one[5] is None
    assert one[6] == pytest.approx(20015.0868, abs=1e-3)


def test_portable_repairs(spark):
    rows = [
        (1, 10, 20, -5.0, T0, "+8411", None),
        (2, 10, 20, 5.0, T0, "8411", False),  # copy of 1 once the sign is repaired
        (3, 10, None, 5.0, T0, "011", True),
        (4, 10, None, 5.0, T0, "011", True),
        (5, None, 20, 9_500_000.0, T0, "011", True),
        (6, 11, 20, 9_500_000.0, T0, "011", None),
        (7, 11, 20, 9_999_999.5, T0, "011", True),
    ]
    df = spark.createDataFrame(
        rows,
        "transaction_id long, user_id long, beneficiary_id long, amount double, timestamp timestamp_ntz,"
        " phone_number string, is_beneficiary_new boolean",
    ).withColumns({c: F.lit(21.0) for c in ("home_latitude", "home_longitude", "ip_latitude", "ip_longitude")})
    got = {r["transaction_id"]: r for r in portable.run(df).collect()}
    assert sorted(got) == [1, 6, 7]
    assert got[1]["phone_number"] == "011" and got[1]["is_beneficiary_new"] is True
    assert {k: r["biometric_evasion_flag"] for k, r in got.items()} == {1: False, 6: True, 7: False}
    counts = portable.repair_counts(df).first().asDict()
    assert counts == {
        "rows_before": 7,
        "amounts_corrected": 1,
        "flags_imputed": 2,
        "duplicates_removed": 2,
        "orphans_purged": 2,
        "rows_after": 3,
    }


def test_the_list_of_steps_follows_the_rule_and_has_no_lambda(spark):
    events = spark.range(37 * 43 * 61 * 2).selectExpr("if(id = 5, null, id - 1000) as event_id")
    by_rule = f"filter(array({', '.join(map(str, fixtures.STEPS))}), step -> {fixtures.STEP_RULE})"
    assert events.filter(f"not ({fixtures.STEP_LIST} <=> {by_rule})").isEmpty()
    made = fixtures.load_fixtures(spark, "/root/testdata/sf0.001").transactions
    assert "lambda" not in made._jdf.queryExecution().optimizedPlan().toString()
