"""Hand-made tables with the boundary cases of every feature, repair and rule."""

from datetime import datetime, timedelta
from decimal import Decimal

from tracewell.sources.schemas import BENEFICIARIES, LOGINS, TRANSACTIONS, USERS
from tracewell.sources.tables import Tables, conform

T0 = datetime(2024, 3, 15, 12, 0, 0)  # a Friday
DAY, HOUR, MINUTE = timedelta(days=1), timedelta(hours=1), timedelta(minutes=1)


def users(spark, rows=()):
    base = [
        ("u1", " Ann ", " ANN@X.TEST ", "+84123", "1000.00", "Vietnam", "21.0", "105.8", T0 - 200 * DAY, "verified"),
        ("u2", "Bob", "bob@x.test", "84555", "0.00", None, "21.0", "105.8", T0 - 200 * DAY, None),
        ("u3", "Cid", "cid@x.test", " 0999", "-500.00", "Vietnam", "21.0", "105.8", T0 - 200 * DAY, "pending"),
        ("u4", "Dee", "dee@x.test", "0777", "100.00", "Vietnam", "21.0", "105.8", T0 + DAY, "expired"),
        *rows,
    ]
    schema = (
        "user_id string, full_name string, email string, phone string, wallet_balance string, home_country string,"
        " home_latitude string, home_longitude string, created_at timestamp_ntz, kyc_status string"
    )
    return conform(spark.createDataFrame(base, schema), USERS)


def beneficiaries(spark, rows=()):
    base = [
        ("b1", " Shop", "+84321", " vcb ", "Vietnam", T0 - 100 * DAY),
        ("b2", "Offshore", " +84321", "xyz", "Iran", T0 - 29 * DAY),
        ("b3", "Month", None, "tcb", "Vietnam", T0 - 30 * DAY),
        ("b4", "Later", "0123", "tcb", "Russia", T0 + 2 * DAY),
        ("b5", "Pool", "0124", "tcb", "Vietnam", T0 - 100 * DAY),
        *rows,
    ]
    schema = (
        "beneficiary_id string, beneficiary_name string, beneficiary_phone string, beneficiary_bank_code string,"
        " beneficiary_country string, created_at timestamp_ntz"
    )
    return conform(spark.createDataFrame(base, schema), BENEFICIARIES)


def logins(spark, rows):
    schema = (
        "auth_id string, user_id string, device_id string, login_timestamp timestamp_ntz, ip_latitude double,"
        " ip_longitude double"
    )
    return conform(spark.createDataFrame(rows, schema), LOGINS)


def transfers(spark, rows):
    """Rows of (id, user, beneficiary, amount, time[, merchant country[, score]])."""
    full = [
        (r[0], r[1], r[2], Decimal(str(r[3])), r[4], r[5] if len(r) > 5 else "Vietnam", r[6] if len(r) > 6 else None)
        for r in rows
    ]
    schema = (
        "transaction_id string, user_id string, beneficiary_id string, amount decimal(15,2), timestamp timestamp_ntz,"
        " merchant_country string, fraud_score double"
    )
    return conform(spark.createDataFrame(full, schema), TRANSACTIONS)


def tables(spark, rows, login_rows=()):
    login_rows = list(login_rows) or [("none", "nobody", "device_legit_0", T0, 0.0, 0.0)]
    return Tables(users(spark), beneficiaries(spark), logins(spark, login_rows), transfers(spark, rows))
