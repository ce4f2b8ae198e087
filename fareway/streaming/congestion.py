"""Congestion alerts over sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.constants import WindowThresholds
from fareway.functions import columns as C
from fareway.functions.measures import count_known, limb_sums, plain_avg, rounded_avg

WINDOW_SECONDS = 60
SLIDE_SECONDS = 10
DELAY_SECONDS = 5

ROAD_KEY = ("road_id", "road_name", "district")
_MEASURED = {"speed": "speed_kmh", "occupancy": "occupancy", "travel": "travel_time_sec"}


def with_event_time(df: DataFrame, delay: int = DELAY_SECONDS, column: str = "event_time") -> DataFrame:
    """Watermark on the event time; a time without zone is taken as session time."""
    if dict(df.dtypes)[column] == "timestamp_ntz":
        df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df.withWatermark(column, f"{delay} seconds")


def _check(size: int, slide: int) -> None:
    if slide <= 0 or size % slide:
        raise ValueError("the window size must be a multiple of the slide")


def hop(df: DataFrame, size: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS, column: str = "event_time") -> DataFrame:
    """Each row once per window that covers it, windows aligned to the epoch."""
    _check(size, slide)
    placed = df.withColumn("_w", F.window(column, f"{size} seconds", f"{slide} seconds"))
    return placed.withColumns(
        {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}
    ).drop("_w")


def _first_sums(limits: WindowThresholds) -> list[Column]:
    severe = (F.col("speed_kmh") <= limits.severe_event_speed) | (
        F.col("congestion_level") == "severe"
    )
    sums = [F.count("*").alias("events"), F.count_if(severe).alias("severe_events")]
    for name, column in _MEASURED.items():
        sums += [*limb_sums(name, column), count_known(column).alias(f"{name}_n")]
    return sums


def _panes_to_windows(readings: DataFrame, size: int, slide: int, limits: WindowThresholds) -> DataFrame:
    """Sums per slide interval first, then each interval goes to the windows over it.

    Counts and limbs add up exactly, so this equals grouping every reading
    into size/slide windows, with one copied row per interval and road instead.
    """
    keys = [c for c in ROAD_KEY]
    pane = F.window("event_time", f"{slide} seconds").getField("start")
    panes = readings.groupBy(pane.alias("pane"), *keys).agg(*_first_sums(limits))
    back = F.array(*[F.expr(f"INTERVAL '{i * slide}' SECOND") for i in range(size // slide)])
    spread = panes.select("*", F.explode(back).alias("_back")).withColumn(
        "window_start", F.col("pane") - F.col("_back")
    )
    names = ["events", "severe_events"] + [n + s for n in _MEASURED for s in ("", "_low", "_n")]
    summed = spread.groupBy("window_start", *keys).agg(*[F.sum(n).alias(n) for n in names])
    return summed.withColumn(
        "window_end", F.col("window_start") + F.expr(f"INTERVAL '{size}' SECOND")
    )


def _direct_windows(readings: DataFrame, size: int, slide: int, limits: WindowThresholds) -> DataFrame:
    window = F.window("event_time", f"{size} seconds", f"{slide} seconds")
    grouped = readings.groupBy(window.alias("_w"), *ROAD_KEY).agg(*_first_sums(limits))
    return grouped.withColumns(
        {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}
    ).drop("_w")


def congestion_alerts(
    readings: DataFrame,
    size: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    delay: int = DELAY_SECONDS,
    limits: WindowThresholds = WindowThresholds(),
) -> DataFrame:
    """Alerts per window and road, where an average or the severe events pass a limit.

    On a stream a window comes out once the watermark has passed its end, and late
    readings count while their window is open. On a batch all windows come out.
    ``vehicle_count`` of an alert is the number of readings in the window.
    """
    _check(size, slide)
    if readings.isStreaming:
        sums = _direct_windows(with_event_time(readings, delay), size, slide, limits)
    else:
        sums = _panes_to_windows(readings, size, slide, limits)
    speed = plain_avg("speed", F.col("speed_n"))
    occupancy = plain_avg("occupancy", F.col("occupancy_n"))
    alarming = (
        (speed <= limits.alert[0])
        | (occupancy >= limits.alert[1])
        | (F.col("severe_events") >= limits.alert_severe_events)
    )
    table = sums.filter(alarming).select(
        "window_start",
        "window_end",
        *ROAD_KEY,
        F.col("events").alias("vehicle_count"),
        rounded_avg("speed", F.col("speed_n"), 2).alias("avg_speed_kmh"),
        rounded_avg("occupancy", F.col("occupancy_n"), 4).alias("avg_occupancy"),
        rounded_avg("travel", F.col("travel_n"), 2).alias("avg_travel_time_sec"),
        F.col("severe_events").alias("severe_event_count"),
        C.alert_severity(speed, occupancy, limits).alias("severity"),
    )
    return table.withColumn("alert_text", C.alert_text())


def dedupe_alert_stream(alerts: DataFrame, delay: int = WINDOW_SECONDS) -> DataFrame:
    """First delivery of each alert of a stream, state bounded by the watermark."""
    return alerts.withWatermark("window_end", f"{delay} seconds").dropDuplicatesWithinWatermark(
        ["window_start", "window_end", "road_id"]
    )
