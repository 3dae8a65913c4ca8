"""Table schemas with their defaults, keys and allowed values."""

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
DEGREES = T.DecimalType(10, 6)
TEXT, BOOL, INT, TIME = T.StringType(), T.BooleanType(), T.IntegerType(), T.TimestampNTZType()


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: str
    unique: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    # The size that numbers stay below where the column here is wider than the declared one.
    bounds: dict[str, int] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def _table(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, not required) for name, kind, required in columns])


# Column names, types, lengths, allowed values and defaults of the four tables.
USERS = TableSpec(
    name="users",
    schema=_table(
        ("user_id", TEXT, True),
        ("full_name", TEXT, True),
        ("email", TEXT, True),
        ("phone", TEXT, True),
        ("wallet_balance", MONEY, True),
        ("home_city", TEXT, False),
        ("home_country", TEXT, False),
        ("home_latitude", DEGREES, False),
        ("home_longitude", DEGREES, False),
        ("created_at", TIME, True),
        ("last_login_timestamp", TIME, False),
        ("kyc_status", TEXT, True),
        ("risk_tier", TEXT, False),
        ("is_active", BOOL, True),
    ),
    key="user_id",
    unique=("email", "phone"),
    lengths={
        "full_name": 100,
        "email": 255,
        "phone": 20,
        "home_city": 50,
        "home_country": 50,
        "kyc_status": 20,
        "risk_tier": 10,
    },
    domains={
        "kyc_status": ("pending", "verified", "rejected", "expired"),
        "risk_tier": ("low", "medium", "high"),
    },
    defaults={
        "user_id": "uuid()",
        "wallet_balance": "0",
        "home_country": "'Vietnam'",
        "created_at": "localtimestamp()",
        "kyc_status": "'pending'",
        "risk_tier": "'low'",
        "is_active": "true",
    },
)

BENEFICIARIES = TableSpec(
    name="beneficiaries",
    schema=_table(
        ("beneficiary_id", TEXT, True),
        ("beneficiary_name", TEXT, True),
        ("beneficiary_phone", TEXT, False),
        ("beneficiary_bank_account", TEXT, True),
        ("beneficiary_bank_code", TEXT, True),
        ("beneficiary_country", TEXT, True),
        ("created_at", TIME, True),
        ("is_verified", BOOL, True),
        ("is_mule_flagged", BOOL, True),
    ),
    key="beneficiary_id",
    lengths={
        "beneficiary_name": 100,
        "beneficiary_phone": 20,
        "beneficiary_bank_account": 50,
        "beneficiary_bank_code": 20,
        "beneficiary_country": 50,
    },
    defaults={
        "beneficiary_id": "uuid()",
        "beneficiary_bank_code": "'INTERNAL'",
        "beneficiary_country": "'Vietnam'",
        "created_at": "localtimestamp()",
        "is_verified": "false",
        "is_mule_flagged": "false",
    },
)

LOGINS = TableSpec(
    name="device_authentications",
    schema=_table(
        ("auth_id", TEXT, True),
        ("user_id", TEXT, True),
        ("device_id", TEXT, True),
        ("login_timestamp", TIME, True),
        ("ip_address", TEXT, False),
        ("ip_geolocation_country", TEXT, False),
        ("ip_geolocation_city", TEXT, False),
        ("ip_latitude", DEGREES, False),
        ("ip_longitude", DEGREES, False),
        ("is_proxy_vpn", BOOL, True),
        ("is_emulator", BOOL, True),
        ("os_type", TEXT, False),
        ("browser_fingerprint", TEXT, False),
        ("session_duration_minutes", INT, False),
    ),
    key="auth_id",
    lengths={
        "device_id": 255,
        "ip_address": 45,
        "ip_geolocation_country": 50,
        "ip_geolocation_city": 50,
        "os_type": 20,
        "browser_fingerprint": 255,
    },
    references={"user_id": "users"},
    defaults={
        "auth_id": "uuid()",
        "login_timestamp": "localtimestamp()",
        "is_proxy_vpn": "false",
        "is_emulator": "false",
    },
)

TRANSACTIONS = TableSpec(
    name="transactions",
    schema=_table(
        ("transaction_id", TEXT, True),
        ("user_id", TEXT, True),
        ("beneficiary_id", TEXT, True),
        ("amount", MONEY, True),
        ("timestamp", TIME, True),
        ("channel", TEXT, False),
        ("merchant_country", TEXT, False),
        ("status", TEXT, True),
        ("fraud_score", T.DecimalType(5, 4), False),
        ("final_decision", TEXT, True),
        ("reviewed_by", TEXT, False),
        ("reviewed_at", TIME, False),
        ("rule_flags", T.ArrayType(TEXT, False), True),
        # Wider than the published 5,4: a signed balance can push the ratio far below -10.
        ("transaction_balance_ratio", T.DecimalType(20, 4), False),
        ("is_beneficiary_new", BOOL, False),
        ("is_off_hours", BOOL, False),
        ("is_weekend", BOOL, False),
        ("distance_from_home_km", T.DecimalType(8, 2), False),
        ("user_7day_transaction_count", INT, False),
        ("is_new_device", BOOL, False),
        ("beneficiary_account_age_days", INT, False),
        ("time_since_last_login_minutes", INT, False),
        ("is_high_risk_country", BOOL, False),
        ("is_ground_truth_fraud", BOOL, True),
        ("chargeback_reported_at", TIME, False),
    ),
    key="transaction_id",
    lengths={"channel": 20, "merchant_country": 50, "status": 20, "final_decision": 20, "reviewed_by": 50},
    bounds={"transaction_balance_ratio": 10},
    references={"user_id": "users", "beneficiary_id": "beneficiaries"},
    defaults={
        "transaction_id": "uuid()",
        "timestamp": "localtimestamp()",
        "channel": "'MOBILE_APP'",
        "merchant_country": "'Vietnam'",
        "status": "'pending'",
        "final_decision": "'pending'",
        "rule_flags": "array()",
        "is_ground_truth_fraud": "false",
    },
)

SPECS = {spec.name: spec for spec in (USERS, BENEFICIARIES, LOGINS, TRANSACTIONS)}
ID_COLUMNS = frozenset({"user_id", "beneficiary_id", "auth_id", "transaction_id"})
