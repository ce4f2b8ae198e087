"""Derived columns of trips, road readings and boxes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.constants import (
    ALERT_TEXT,
    ALERT_TEXT_WITH_COUNT,
    MODEL_DISPLAY,
    PAYMENT_DISPLAY,
    ReadingThresholds,
    SEVERITY_DISPLAY,
    SEVERITY_DISPLAY_OTHER,
    WindowThresholds,
)
from fareway.functions.measures import round_half_up


# --- trips --------------------------------------------------------------------


def duration_min(start: str, end: str, fractional: bool = False) -> Column:
    """Elapsed minutes, from whole seconds or from microseconds."""
    if fractional:
        micros = F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(
            F.col(start).cast("timestamp")
        )
        return micros / F.lit(60_000_000.0)
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def weekday_of(day: Column) -> Column:
    """Monday is 0."""
    return F.weekday(day)


def weekend_flag(weekday: Column) -> Column:
    return F.when(weekday >= 5, F.lit(1)).otherwise(F.lit(0))


def calendar_features(df: DataFrame, ts: str = "pickup_datetime", prefix: str = "pickup") -> DataFrame:
    moment = F.col(ts)
    return df.withColumns(
        {
            f"{prefix}_date": F.to_date(moment),
            f"{prefix}_month": F.date_format(moment, "yyyy-MM"),
            f"{prefix}_hour": F.hour(moment),
            f"{prefix}_weekday": weekday_of(moment),
            "is_weekend": weekend_flag(weekday_of(moment)),
        }
    )


def zone_name(location: str) -> Column:
    return F.concat(F.lit("zone_"), F.col(location).cast("int").cast("string"))


def zone_keys(df: DataFrame) -> DataFrame:
    pickup, dropoff = zone_name("pickup_location_id"), zone_name("dropoff_location_id")
    return df.withColumns(
        {
            "pickup_zone": pickup,
            "dropoff_zone": dropoff,
            "od_pair": F.concat(pickup, F.lit("_to_"), dropoff),
        }
    )


def revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.coalesce("total_amount", "fare_amount"))


def label_codes(
    df: DataFrame,
    source: str,
    labels: Mapping[int, str],
    target: str,
    default: str = "unknown",
) -> DataFrame:
    """Look an integer code up; unknown, null and missing columns give ``default``.

    A code that is no number counts as unknown.
    """
    if source not in df.columns:
        return df.withColumn(target, F.lit(default))
    lookup = F.create_map(*[F.lit(part) for item in labels.items() for part in item])
    label = lookup[F.col(source).try_cast("int")]
    return df.withColumn(target, F.coalesce(label, F.lit(default)))


def _name_map(col: Column, names: Mapping[str, str], other: Column) -> Column:
    lookup = F.create_map(*[F.lit(part) for item in names.items() for part in item])
    return F.coalesce(lookup[col], other)


def display_labels(
    df: DataFrame,
    payment: str | None = None,
    model: str | None = None,
    severity: str | None = None,
) -> DataFrame:
    """Add ``<column>_display``; payment and model names fall through unchanged."""
    added = {}
    if payment:
        added[f"{payment}_display"] = _name_map(F.col(payment), PAYMENT_DISPLAY, F.col(payment))
    if model:
        added[f"{model}_display"] = _name_map(F.col(model), MODEL_DISPLAY, F.col(model))
    if severity:
        added[f"{severity}_display"] = _name_map(
            F.col(severity), SEVERITY_DISPLAY, F.lit(SEVERITY_DISPLAY_OTHER)
        )
    return df.withColumns(added)


# --- periods and buckets --------------------------------------------------------

# fixed values: period names with their first and last hour, in report order
PEAK_PERIODS = (("morning_peak", 7, 9), ("evening_peak", 17, 19), ("night", 0, 5))
PEAK_OTHER = "off_peak"
FIVE_PERIODS = (
    ("late_night", 0, 5),
    ("morning_peak", 6, 10),
    ("midday", 11, 15),
    ("evening_peak", 16, 20),
    ("night", 21, 23),
)

# fixed values: upper edges (inclusive) and names of the distance buckets
DISTANCE_EDGES = (1.0, 3.0, 5.0, 10.0, 20.0)
DISTANCE_LABELS = ("0-1", "1-3", "3-5", "5-10", "10-20")
DISTANCE_OVERFLOW = "20+"
DISTANCE_BIN_EDGES = (0.0, 1.0, 3.0, 5.0, 10.0, 20.0, 100.0)
DISTANCE_BIN_LABELS = ("(0, 1]", "(1, 3]", "(3, 5]", "(5, 10]", "(10, 20]", "(20, 100]")


def _chain(branches: Sequence[tuple[Column, Column]], other: Column | None) -> Column:
    result = None
    for condition, value in branches:
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result if other is None else result.otherwise(other)


def period_of_day(
    hour: str | Column, scheme: str = "peak", names: Mapping[str, str] | None = None
) -> Column:
    """Name of the day period of an hour; ``names`` replaces the English names."""
    value = F.col(hour) if isinstance(hour, str) else hour
    periods, other = {"peak": (PEAK_PERIODS, PEAK_OTHER), "five": (FIVE_PERIODS, None)}[scheme]
    shown = names or {}
    return _chain(
        [(value.between(first, last), F.lit(shown.get(name, name))) for name, first, last in periods],
        None if other is None else F.lit(shown.get(other, other)),
    )


def bucket_ordinal(
    value: str | Column, edges: Sequence[float], overflow: bool, lower: float | None = None
) -> Column:
    """Position of the first edge not below the value.

    With ``overflow`` everything else, null and NaN included, takes the position
    after the last edge; without it, such rows and those not above ``lower`` get
    null, to be filtered out.
    """
    col = F.col(value) if isinstance(value, str) else value
    branches = [(col <= edge, F.lit(i)) for i, edge in enumerate(edges)]
    if lower is not None:
        branches.insert(0, (col <= lower, F.lit(None).cast("int")))
    return _chain(branches, F.lit(len(edges)) if overflow else None)


def bucket(
    value: str | Column,
    edges: Sequence[float],
    labels: Sequence[str],
    overflow: str | None,
    lower: float | None = None,
) -> Column:
    """Name of the bucket; see :func:`bucket_ordinal` for values outside the edges."""
    names = list(labels) + ([] if overflow is None else [overflow])
    ordinal = bucket_ordinal(value, edges, overflow is not None, lower)
    return F.get(F.array(*[F.lit(name) for name in names]), ordinal)


# --- road readings ---------------------------------------------------------------


def _at_most_or_at_least(speed: Column, occupancy: Column, limits: tuple[float, float]) -> Column:
    return (speed <= limits[0]) | (occupancy >= limits[1])


def classify_congestion(
    speed: Column, occupancy: Column, limits: ReadingThresholds = ReadingThresholds()
) -> Column:
    return _chain(
        [
            (_at_most_or_at_least(speed, occupancy, getattr(limits, level)), F.lit(level))
            for level in ("severe", "moderate", "slow")
        ],
        F.lit("smooth"),
    )


def travel_time(speed: Column) -> Column:
    """Seconds for one kilometre, two digits."""
    return round_half_up(F.lit(1000.0) / F.greatest(speed, F.lit(1.0)) * F.lit(3.6), 2)


def occupancy_ratio(vehicles: Column, capacity: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.05), vehicles / capacity))


def alert_severity(
    avg_speed: Column, avg_occupancy: Column, limits: WindowThresholds = WindowThresholds()
) -> Column:
    return _chain(
        [
            (_at_most_or_at_least(avg_speed, avg_occupancy, limits.severe), F.lit("severe")),
            (_at_most_or_at_least(avg_speed, avg_occupancy, limits.moderate), F.lit("moderate")),
        ],
        F.lit("slow"),
    )


def alert_text(with_count: bool = False) -> Column:
    """Sentence of an alert; the variant with a count prints whole seconds."""
    pattern = "yyyy-MM-dd HH:mm:ss" if with_count else "yyyy-MM-dd HH:mm:ss.SSS"
    parts = [
        F.col("road_name"),
        F.date_format("window_start", pattern),
        F.date_format("window_end", pattern),
        F.col("avg_speed_kmh").cast("string"),
    ]
    if with_count:
        return F.format_string(ALERT_TEXT_WITH_COUNT, *parts, F.col("vehicle_count").cast("string"))
    return F.format_string(ALERT_TEXT, *parts)


# --- boxes -------------------------------------------------------------------------

CORNERS = ("x1", "y1", "x2", "y2")


def corners(prefix: str = "") -> list[Column]:
    return [F.col(prefix + name).cast("double") for name in CORNERS]


def overlap_area(a: Sequence[Column], b: Sequence[Column]) -> Column:
    width = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    height = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def box_area(a: Sequence[Column]) -> Column:
    return (a[2] - a[0]) * (a[3] - a[1])


def iou(a: Sequence[Column], b: Sequence[Column], epsilon: float = 0.0) -> Column:
    """Intersection over union, 0 for boxes that do not overlap."""
    shared = overlap_area(a, b)
    union = box_area(a) + box_area(b) - shared + F.lit(epsilon)
    return F.when(shared > 0, shared / union).otherwise(F.lit(0.0))


# --- portable hash ------------------------------------------------------------------


def key_digest(*keys: str | Column, seed: int) -> Column:
    """md5 of a row key and a seed; the same in any partitioning and in SQL."""
    cols = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *cols, F.lit(str(seed))).cast("binary"))


def digest_bits(digest: str | Column, part: int = 0) -> Column:
    """32 bits of a digest as a number: ``part`` 0 to 3 picks the slice."""
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("bigint")


def key_hash(*keys: str | Column, seed: int) -> Column:
    """Repeatable 32-bit hash of a row key."""
    return digest_bits(key_digest(*keys, seed=seed))
