"""Every tunable of the features, the cleaning, the rules and the reports."""

from dataclasses import dataclass
from datetime import timedelta


@dataclass(frozen=True)
class Params:
    # The list and the thresholds that results depend on.
    high_risk_countries: tuple[str, ...] = ("North Korea", "Iran", "Syria", "Myanmar", "Russia")
    off_hours_start: int = 23
    off_hours_end: int = 6
    portable_off_hours_end: int = 5
    new_beneficiary_days: int = 30
    history_window: timedelta = timedelta(days=7)
    earth_radius_km: int = 6371
    default_login_minutes: int = 10
    default_distance_km: float = 0.0
    legit_device_pattern: str = "device_legit%"
    band_low: int = 9_000_000
    band_high: int = 9_999_999
    structuring_recency: timedelta = timedelta(days=30)
    evasion_recency: timedelta = timedelta(days=7)
    velocity_window: timedelta = timedelta(minutes=5)
    velocity_max: int = 3
    cross_border_floor: int = 1_000_000
    travel_min_amount: int = 10_000_000
    travel_min_square_degrees: float = 1.0
    travel_max_gap: timedelta = timedelta(hours=2)
    mule_window: timedelta = timedelta(hours=1)
    mule_min_senders: int = 4
    time_repair_offset: timedelta = timedelta(minutes=5)
    remote_km: int = 100
    top_n: int = 10

    # Execution: a key with more rows than this is split over many tasks instead of
    # being handled as one window group. rows / hot_key_rows bounds how many keys can
    # be hot, and with it the size of every hot-key list that is broadcast.
    hot_key_rows: int = 1_000_000
