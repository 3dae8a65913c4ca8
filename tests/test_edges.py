"""Boundary cases of features, cleaning and rules."""

from datetime import timedelta
from decimal import Decimal

import pytest
from edge_data import DAY, HOUR, MINUTE, T0, beneficiaries, tables, transfers, users
from pyspark.sql import functions as F

from tracewell import Params
from tracewell.operators import cleaning, rules
from tracewell.operators.features import build_features, login_history
from tracewell.operators.scope import Scope
from tracewell.plans import quality
from tracewell.plans.pipeline import plan
from tracewell.sources.tables import public_columns

LIMITS = [10**9, 1]


def by_id(df, *columns):
    rows = df.select("transaction_id", *columns).collect()
    return {r[0]: r[1] if len(columns) == 1 else tuple(r[1:]) for r in rows}


def features(spark, rows, login_rows=(), limit=10**9):
    scope = Scope.of(tables(spark, rows, login_rows), Params(hot_key_rows=limit))
    return build_features(scope).transactions


@pytest.mark.parametrize("limit", LIMITS)
def test_balance_ratio(spark, limit):
    df = features(
        spark,
        [
            ("a", "u1", "b1", 500, T0),
            ("b", "u1", "b1", 5000, T0),
            ("c", "u2", "b1", 10, T0),  # balance 0
            ("d", "u3", "b1", 5000, T0),  # negative balance: no lower bound
            ("e", "u1", "b1", -20000, T0),
            ("f", "nobody", "b1", 10, T0),
            ("g", "u1", "b1", "0.15", T0),  # 0.00015 rounds away from zero
        ],
        limit=limit,
    )
    assert by_id(df, "transaction_balance_ratio") == {
        "a": Decimal("0.5"),
        "b": Decimal("1"),
        "c": Decimal("1"),
        "d": Decimal("-10"),
        "e": Decimal("-20"),
        "f": None,
        "g": Decimal("0.0002"),
    }


def test_clock(spark):
    times = {
        "a": T0.replace(hour=5, minute=59),
        "b": T0.replace(hour=6),
        "c": T0.replace(hour=22, minute=59),
        "d": T0.replace(hour=23),
        "sat": T0 + DAY,
        "sun": T0 + 2 * DAY,
        "mon": T0 + 3 * DAY,
    }
    df = features(spark, [(k, "u1", "b1", 1, t) for k, t in times.items()])
    assert by_id(df, "is_off_hours", "is_weekend") == {
        "a": (True, False),
        "b": (False, False),
        "c": (False, False),
        "d": (True, False),
        "sat": (False, True),
        "sun": (False, True),
        "mon": (False, False),
    }


@pytest.mark.parametrize("limit", LIMITS)
def test_beneficiary_profile(spark, limit):
    df = features(
        spark,
        [
            ("a", "u1", "b1", 1, T0),
            ("b", "u1", "b2", 1, T0),
            ("c", "u1", "b3", 1, T0),  # exactly 30 days
            ("c2", "u1", "b3", 1, T0 - timedelta(microseconds=1)),
            ("d", "u1", "b4", 1, T0),  # created after the transfer
            ("e", "u1", "nobody", 1, T0),
        ],
        limit=limit,
    )
    got = by_id(df, "beneficiary_account_age_days", "is_beneficiary_new", "is_high_risk_country")
    assert got == {
        "a": (100, False, False),
        "b": (29, True, True),
        "c": (30, False, False),
        "c2": (29, True, False),
        "d": (0, True, True),
        "e": (None, None, None),
    }


@pytest.mark.parametrize("limit", LIMITS)
def test_history_count_includes_peers_and_both_ends(spark, limit):
    week = 7 * DAY
    df = features(
        spark,
        [
            ("a", "u1", "b1", 1, T0 - week),
            ("b", "u1", "b1", 1, T0),
            ("c", "u1", "b1", 1, T0),
            ("d", "u1", "b1", 1, T0 + timedelta(microseconds=1)),
            ("e", "u2", "b1", 1, T0),
        ],
        limit=limit,
    )
    assert by_id(df, "user_7day_transaction_count") == {"a": 0, "b": 2, "c": 2, "d": 2, "e": 0}


@pytest.mark.parametrize("limit", LIMITS)
def test_last_login(spark, limit):
    df = features(
        spark,
        [
            ("at", "u1", "b1", 1, T0),  # login at the very instant, two at once: larger auth_id
            ("before", "u1", "b1", 1, T0 - HOUR),
            ("round", "u1", "b1", 1, T0 + timedelta(seconds=90)),
            ("unknown_place", "u2", "b1", 1, T0),
            ("never", "u3", "b1", 1, T0),
        ],
        [
            ("l1", "u1", "device_legit_1", T0, 21.0, 105.8),
            ("l2", "u1", "dev_hacked_1", T0, 55.7558, 37.6173),
            ("l3", "u2", "deviceXlegit_1", T0 - MINUTE, None, None),
            ("l4", "u1", "device_legit_1", T0 + HOUR, 21.0, 105.8),
        ],
        limit=limit,
    )
    got = by_id(df, "time_since_last_login_minutes", "is_new_device", "distance_from_home_km")
    assert got["before"] == (10, False, Decimal("0.00"))
    assert got["never"] == (10, False, Decimal("0.00"))
    assert got["at"][:2] == (0, True) and 6500 < got["at"][2] < 7000
    assert got["round"][0] == 2
    # The pattern's underscore stands for any one character; unknown coordinates are half the globe away.
    assert got["unknown_place"] == (1, False, Decimal("20015.09"))


@pytest.mark.parametrize("limit", LIMITS)
def test_login_history_orders_ties_by_id(spark, limit):
    scope = Scope.of(
        tables(
            spark,
            [("a", "u1", "b1", 1, T0)],
            [
                ("l2", "u1", "d", T0, 2.0, 2.0),
                ("l1", "u1", "d", T0, 1.0, 1.0),
                ("l3", "u1", "d", T0 + HOUR, None, 3.0),
                ("l4", "u1", "d", T0 + 2 * HOUR, 4.0, 4.0),
                ("x", "u2", "d", T0, 9.0, 9.0),
            ],
        ),
        Params(hot_key_rows=limit),
    )
    rows = login_history(scope.tables.logins, scope.hot_users).collect()
    got = {r["auth_id"]: (r["prev_login_timestamp"], r["prev_ip_latitude"], r["prev_ip_longitude"]) for r in rows}
    one, two = Decimal(1), Decimal(2)
    assert got == {
        "l1": (None, None, None),
        "l2": (T0, one, one),
        "l3": (T0, two, two),
        "l4": (T0 + HOUR, None, Decimal(3)),
        "x": (None, None, None),
    }


def test_clean_dimensions(spark):
    got = {r["user_id"]: r for r in cleaning.clean_users(users(spark)).collect()}
    assert (got["u1"]["full_name"], got["u1"]["email"], got["u1"]["phone"]) == ("Ann", "ann@x.test", "0123")
    assert (got["u2"]["phone"], got["u2"]["home_country"], got["u2"]["kyc_status"]) == ("0555", "Vietnam", "pending")
    assert (got["u3"]["phone"], got["u3"]["wallet_balance"]) == ("0999", Decimal("500"))
    found = {r["beneficiary_id"]: r for r in cleaning.clean_beneficiaries(beneficiaries(spark)).collect()}
    assert (found["b1"]["beneficiary_bank_code"], found["b1"]["beneficiary_phone"]) == ("VCB", "0321")
    assert found["b2"]["beneficiary_phone"] == " +84321"  # not trimmed, so no prefix to replace
    assert found["b3"]["beneficiary_phone"] is None


def test_clean_is_idempotent_on_dimensions(spark):
    once = cleaning.clean_users(users(spark))
    assert cleaning.clean_users(once).exceptAll(once).isEmpty()


@pytest.mark.parametrize("limit", LIMITS)
def test_clean_transfers(spark, limit):
    scope = Scope.of(
        tables(
            spark,
            [
                ("a2", "u1", "b1", -70, T0, "Vietnam", 1.2),
                ("a1", "u1", "b1", 70, T0, "Vietnam", -0.2),  # same transfer once the sign is repaired
                ("orphan1", "nobody", "b1", 1, T0),
                ("orphan2", "u1", "nobody", 1, T0),
                ("early", "u4", "b1", 5, T0),
                ("score", "u2", "b1", 5, T0, "Vietnam", None),
            ],
        ),
        Params(hot_key_rows=limit),
    )
    df = cleaning.clean(build_features(scope)).transactions
    got = by_id(df, "amount", "timestamp", "fraud_score", "is_beneficiary_new")
    assert got == {
        "a1": (Decimal("70.00"), T0, Decimal("0.0000"), False),
        "early": (Decimal("5.00"), T0 + DAY + 5 * MINUTE, None, False),
        "score": (Decimal("5.00"), T0, None, False),
    }


def test_stale_features_survive_cleaning(spark):
    """Ratio, clock and history keep the values of the uncleaned rows."""
    scope = Scope.of(
        tables(
            spark,
            [
                ("neg", "u1", "b1", -500, T0),
                ("dup1", "u2", "b1", 5, T0),
                ("dup2", "u2", "b1", 5, T0),
                ("early", "u4", "b1", 5, T0),
            ],
        )
    )
    got = by_id(
        cleaning.clean(build_features(scope)).transactions,
        "transaction_balance_ratio",
        "user_7day_transaction_count",
        "is_weekend",
    )
    assert got["neg"][0] == Decimal("-0.5")
    assert got["dup1"][1] == 1
    assert got["early"][2] is False  # repaired to a Saturday, flag is the Friday's
    assert "dup2" not in got


def test_missing_features_get_defaults_and_null_age_stays_unknown(spark):
    df = transfers(spark, [("a", "u1", "b1", 1, T0)])
    filled = cleaning.rederive_new(cleaning.fill_missing(df), Params()).first()
    assert filled["transaction_balance_ratio"] == 0 and filled["user_7day_transaction_count"] == 0
    assert filled["is_off_hours"] is False and filled["is_beneficiary_new"] is None


def flags(spark, rows):
    """After features, cleaning and rules."""
    return by_id(plan(tables(spark, rows)).transactions, "rule_flags")


def rule_flags(spark, rows, login_rows=(), limit=10**9):
    """After the rules alone."""
    scope = Scope.of(tables(spark, rows, login_rows), Params(hot_key_rows=limit))
    return by_id(rules.apply_rules(scope).transactions, "rule_flags")


def test_band_rules(spark):
    rows = [
        ("low", "u1", "b2", "8999999.99", T0),
        ("from", "u1", "b2", 9_000_000, T0 + DAY),
        ("to", "u2", "b2", 9_999_999, T0),
        ("above", "u2", "b2", "9999999.50", T0 + DAY),
        ("old", "u3", "b1", 9_500_000, T0),
        ("thirty", "u3", "b3", 9_500_000, T0 + HOUR),
        ("later", "u3", "b4", 9_500_000, T0 + 2 * HOUR),
        ("risky_exact", "u1", "b2", 9_500_000, T0 + DAY + HOUR),  # exactly 30 days after creation
    ]
    both = ["biometric_structuring_rule", "biometric_evasion_rule"]
    assert flags(spark, rows) == {
        "low": [],
        "from": ["biometric_structuring_rule"],
        "to": both,
        "above": [],
        "old": [],
        "thirty": [],
        "later": both,
        "risky_exact": [],
    }


@pytest.mark.parametrize("limit", LIMITS)
def test_velocity_flags_from_the_fourth_on(spark, limit):
    rows = [(f"t{i}", "u1", "b1", 1 + i, T0 + i * timedelta(seconds=100)) for i in range(4)]
    rows += [(f"p{i}", "u2", "b1", 1 + i, T0) for i in range(4)]  # same instant: all see each other
    rows += [(f"s{i}", "u3", "b1", 1 + i, T0 + i * timedelta(seconds=101)) for i in range(4)]
    got = rule_flags(spark, rows, limit=limit)
    assert {k for k, v in got.items() if v == ["velocity_rule"]} == {"t3", "p0", "p1", "p2", "p3"}


def test_cross_border_floor_is_strict(spark):
    rows = [
        ("a", "u1", "b1", 1_000_000, T0, "Iran"),
        ("b", "u2", "b1", "1000000.01", T0, "Iran"),
        ("c", "u3", "b1", 2_000_000, T0, "Vietnam"),
    ]
    assert {k: v for k, v in flags(spark, rows).items() if v} == {"b": ["cross_border_fraud_rule"]}


@pytest.mark.parametrize("limit", LIMITS)
def test_impossible_travel(spark, limit):
    login_rows = [
        ("l1", "u1", "d", T0, 10.0, 10.0),
        ("l2", "u1", "d", T0 + HOUR, 11.5, 10.0),
        ("l3", "u2", "d", T0, 10.0, 10.0),
        ("l4", "u2", "d", T0 + 2 * HOUR, 30.0, 10.0),  # not less than two hours
        ("l5", "u3", "d", T0, 10.0, 10.0),
        ("l6", "u3", "d", T0 + HOUR, 11.0, 10.0),  # not more than one degree
    ]
    rows = [
        ("before", "u1", "b1", 10_000_000, T0 + HOUR - MINUTE),
        ("at", "u1", "b1", 10_000_000, T0 + HOUR),
        ("much_later", "u1", "b1", 10_000_000, T0 + 90 * DAY),
        ("small", "u1", "b1", "9999999.99", T0 + 2 * HOUR),
        ("slow", "u2", "b1", 20_000_000, T0 + DAY),
        ("near", "u3", "b1", 20_000_000, T0 + DAY),
    ]
    got = rule_flags(spark, rows, login_rows, limit)
    assert {k for k, v in got.items() if "impossible_travel_rule" in v} == {"at", "much_later"}


@pytest.mark.parametrize("limit", LIMITS)
def test_mule_network(spark, limit):
    rows = [(f"m{i}", f"u{i}", "b5", 1, T0 + (i - 1) * 20 * MINUTE) for i in (1, 2, 3)]
    rows += [("m4", "u4", "b5", 1, T0 + DAY + HOUR)]  # after u4's creation, long after the others
    rows += [("n1", "u1", "b1", 1, T0 + 2 * DAY), ("n2", "u2", "b1", 1, T0 + 2 * DAY)]
    rows += [("n3", "u3", "b1", 1, T0 + 2 * DAY + MINUTE), ("n3b", "u3", "b1", 2, T0 + 2 * DAY + MINUTE)]
    rows += [("n4", "u4", "b1", 1, T0 + 2 * DAY + HOUR)]  # exactly one hour after the first two
    rows += [("n5", "u4", "b1", 3, T0 + 2 * DAY + HOUR + timedelta(microseconds=1))]
    got = rule_flags(spark, rows, limit=limit)
    assert {k for k, v in got.items() if "circular_17_mule_network_rule" in v} == {"n4"}


def test_rules_are_idempotent_and_replace_old_flags(spark):
    t = tables(spark, [("a", "u1", "b2", 9_500_000, T0)])
    t = t.with_(transactions=t.transactions.withColumn("rule_flags", F.array(F.lit("old"))))
    once = plan(t)
    again = rules.apply_rules(Scope.of(once)).transactions
    assert once.transactions.first()["rule_flags"] == ["biometric_structuring_rule", "biometric_evasion_rule"]
    assert public_columns(again).first()["rule_flags"] == once.transactions.first()["rule_flags"]


def test_recompute_mode_uses_cleaned_values(spark):
    t = tables(spark, [("neg", "u1", "b1", -500, T0), ("early", "u4", "b1", 5, T0)])
    got = by_id(plan(t, mode="recompute").transactions, "transaction_balance_ratio", "is_weekend")
    assert got == {"neg": (Decimal("0.5"), False), "early": (Decimal("0.05"), True)}
    with pytest.raises(ValueError):
        plan(t, mode="other")


def test_constraint_report(spark):
    t = tables(
        spark,
        [("a", "u1", "b1", 1, T0), ("a", "nobody", "b1", 1, T0), ("b", None, "nobody", 1, T0)],
        [("l", "nobody", "d", T0, 0.0, 0.0)],
    )
    t = t.with_(users=t.users.withColumn("risk_tier", F.lit("extreme")))
    report = quality.constraint_report(t).filter("violations > 0").collect()
    assert {(r["table_name"], r["check_name"], r["column_name"]): r["violations"] for r in report} == {
        ("users", "not_null", "kyc_status"): 1,
        ("users", "check", "risk_tier"): 4,
        ("beneficiaries", "not_null", "beneficiary_bank_account"): 5,
        ("device_authentications", "foreign_key", "user_id"): 1,
        ("transactions", "not_null", "user_id"): 1,
        ("transactions", "primary_key", "transaction_id"): 1,
        ("transactions", "foreign_key", "user_id"): 1,
        ("transactions", "foreign_key", "beneficiary_id"): 1,
    }


def test_cleaning_report(spark):
    scope = Scope.of(tables(spark, [("a", "u1", "b1", 0, T0), ("b", "u1", "b1", -3, T0), ("c", "x", "b1", 3, T0)]))
    row = quality.cleaning_report(cleaning.clean(build_features(scope)).tables).first()
    assert (row["cleaned_transactions"], row["invalid_amounts_left"]) == (2, 1)
    assert (row["null_distances_left"], row["orphan_txns_left"]) == (0, 0)
