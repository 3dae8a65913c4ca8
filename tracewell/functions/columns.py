"""Column functions. All of them are built-in expressions, so they stay in code generation."""

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two zone-less timestamps as an exact decimal."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)")


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, cut toward zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def epoch_bucket(ts: Column, width: timedelta) -> Column:
    """Number of the time slice of the given width that a zone-less timestamp is in."""
    since = elapsed_seconds(ts, F.lit(EPOCH).cast("timestamp_ntz"))
    return F.floor(since / F.lit(int(width.total_seconds()))).cast("long")


def off_hours(ts: Column, start: int, end: int) -> Column:
    return (F.hour(ts) < end) | (F.hour(ts) >= start)


def weekend(ts: Column) -> Column:
    return F.extract(F.lit("DAYOFWEEK_ISO"), ts).isin(6, 7)


def local_phone(phone: Column) -> Column:
    """A leading +84 or 84 becomes the domestic 0; NULL stays NULL."""
    return F.regexp_replace(phone, r"^(\+84|84)", "0")


def central_angle_cosine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    phi1, lam1, phi2, lam2 = (F.radians(c.cast("double")) for c in (lat1, lon1, lat2, lon2))
    return F.cos(phi1) * F.cos(phi2) * F.cos(lam2 - lam1) + F.sin(phi1) * F.sin(phi2)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: int = 6371) -> Column:
    """Great-circle distance in km; NULL when a coordinate is NULL."""
    cosine = central_angle_cosine(lat1, lon1, lat2, lon2)
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine))
    return F.when(cosine.isNotNull(), radius * F.acos(clamped))


def login_distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: int = 6371) -> Column:
    """Great-circle distance where the clamp skips NULL: unknown coordinates give half the globe."""
    cosine = central_angle_cosine(lat1, lon1, lat2, lon2)
    return radius * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places, half away from zero; NULL when whole is 0."""
    whole = F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(part.cast("decimal(20,0)") * 100 / whole, 2).cast("double")


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when whole is not positive."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def grouped_number(value: Column) -> Column:
    """Format #,##0."""
    return F.format_number(F.round(value, 0), 0)


def percent_text(ratio: Column) -> Column:
    """Format 0.0 followed by a percent sign."""
    return F.concat(F.format_string("%.1f", F.round(ratio * 100, 1)), F.lit("%"))


def is_true_text(flag: Column) -> Column:
    """Text flag: only 'true', in any case and with surrounding spaces, counts."""
    return F.coalesce(F.lower(F.trim(flag.cast("string"))) == "true", F.lit(False))


def draw(id_column: str, seed: int) -> Column:
    """A text that is as good as random, in equal spread, and the same wherever and whenever it is worked out."""
    return F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}")).cast("binary"))


def drawn(id_column: str, fraction: float, seed: int) -> Column:
    """Whether a row is in a sample of about this share of all rows (O6), the same rows for the same seed."""
    return draw(id_column, seed) < f"{int(fraction * 16**8):08x}"
