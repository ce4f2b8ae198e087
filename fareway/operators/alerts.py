"""Queries on a table of congestion alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.constants import SEVERITIES
from fareway.functions import columns as C
from fareway.functions.measures import round_half_up

ALERT_KEY = ("window_start", "window_end", "road_id")


def normalize_alerts(alerts: DataFrame) -> DataFrame:
    """Trim the road id, round speed and occupancy where present."""
    return alerts.withColumns(
        {
            "road_id": F.coalesce(F.trim("road_id"), F.lit("")),
            "avg_speed_kmh": round_half_up(F.col("avg_speed_kmh"), 2),
            "avg_occupancy": round_half_up(F.col("avg_occupancy"), 3),
        }
    )


def enrich_roads(alerts: DataFrame, roads: DataFrame) -> DataFrame:
    """Name, district and sentence from the road table; unknown roads keep their own.

    The join carries no hint: a small road table is broadcast by its known size, a
    large one is shuffled. Works on a batch or a stream of alerts.
    """
    known = roads.select(
        "road_id",
        F.col("road_name").alias("_name"),
        F.col("district").alias("_district"),
    )
    joined = alerts.join(known, "road_id", "left")
    named = joined.withColumns(
        {
            "road_name": F.coalesce("_name", "road_name"),
            "district": F.coalesce("_district", "district"),
        }
    )
    text = F.when(F.col("_name").isNotNull(), C.alert_text(with_count=True))
    return named.withColumn("alert_text", text.otherwise(F.col("alert_text"))).select(alerts.columns)


def _recency() -> list[Column]:
    return [F.desc_nulls_last("window_end"), F.desc_nulls_last("window_start")]


def _rank_values() -> list[Column]:
    """Severe first, then slowest, then most vehicles; smaller values rank first."""
    return [
        F.coalesce(F.col("severity") != "severe", F.lit(True)),
        F.coalesce(F.col("avg_speed_kmh"), F.lit(999.0)),
        -F.coalesce(F.col("vehicle_count"), F.lit(0)),
    ]


def latest_alerts(alerts: DataFrame, cap: int = 100, arrival: str | None = None) -> DataFrame:
    """One alert per window and road, the last to arrive, newest ``cap`` windows first.

    ``arrival`` names the column that tells deliveries apart; without one the deliveries
    of an alert count as equally old, and the largest is kept. The choice is an aggregate,
    so repeated deliveries of one alert are reduced before the shuffle, however many there are.
    """
    payload = [c for c in alerts.columns if c not in ALERT_KEY]
    first = [arrival] if arrival else []
    ordered = first + [c for c in payload if c not in first]
    kept = alerts.groupBy(*ALERT_KEY).agg(F.max(F.struct(*ordered)).alias("a"))
    rows = kept.select(*ALERT_KEY, "a.*").select(alerts.columns)
    newest = [F.desc_nulls_last(arrival)] if arrival else []
    return rows.orderBy(*_recency(), *newest, F.asc("road_id")).limit(cap)


def rank_alerts(alerts: DataFrame, n: int = 30) -> DataFrame:
    return alerts.orderBy(*_rank_values(), *_recency(), F.asc("road_id")).limit(n)


def newest_alert(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(*_recency(), *_rank_values(), F.asc("road_id")).limit(1)


def serve_alerts(
    alerts: DataFrame, roads: DataFrame, cap: int = 100, n: int = 30, arrival: str | None = None
) -> DataFrame:
    """The served table: newest alerts, cleaned, named and ranked."""
    held = normalize_alerts(latest_alerts(alerts, cap, arrival))
    return rank_alerts(enrich_roads(held, roads), n)


def severe_only(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("severity") == "severe")


def speed_trend(alerts: DataFrame, n: int = 30) -> DataFrame:
    """Speed of the top-ranked alert of each of the newest ``n`` windows, oldest first."""
    top = F.min(
        F.struct(
            *[col.alias(f"r{i}") for i, col in enumerate(_rank_values())],
            F.col("road_id"),
            F.coalesce("avg_speed_kmh", F.lit(0.0)).alias("speed"),
        )
    )
    per_window = alerts.groupBy("window_start", "window_end").agg(top.alias("top"))
    newest = per_window.orderBy(*_recency()).limit(n)
    return newest.select("window_start", "window_end", F.col("top.speed").alias("speed_kmh")).orderBy(
        "window_end", "window_start"
    )


def severity_counts(alerts: DataFrame) -> DataFrame:
    """All three levels, also those without an alert."""
    counted = alerts.agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])
    rows = [F.struct(F.lit(s).alias("severity"), F.col(s).alias("alerts")) for s in SEVERITIES]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _speed_or_limit() -> Column:
    speed = F.col("avg_speed_kmh")
    return F.when(speed.isNull() | (speed == 0), F.lit(999.0)).otherwise(speed)


def road_ranking(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Roads with most alerts, slower roads first among equals."""
    road = F.coalesce(F.nullif(F.col("road_name"), F.lit("")), F.col("road_id"))
    table = alerts.groupBy(road.alias("road")).agg(
        F.count("*").alias("alerts"), F.min(_speed_or_limit()).alias("min_speed_kmh")
    )
    return table.orderBy(F.desc("alerts"), F.asc("min_speed_kmh"), F.asc("road")).limit(n)


def alert_headline(alerts: DataFrame) -> DataFrame:
    """Severe alerts, lowest speed and the vehicles of the newest alert."""
    newest = F.max(
        F.struct("window_end", "window_start", F.coalesce("vehicle_count", F.lit(0)).alias("n"))
    )
    return alerts.agg(
        F.count_if(F.col("severity") == "severe").alias("severe_alerts"),
        F.min(_speed_or_limit()).alias("min_speed_kmh"),
        F.coalesce(newest.getField("n"), F.lit(0)).alias("latest_vehicles"),
    )


def ingest_stats(messages: DataFrame, time: str, held: int = 100) -> DataFrame:
    """Messages seen, time of the last one, and how many a buffer of ``held`` keeps."""
    return messages.agg(
        F.count("*").alias("messages"),
        F.max(time).alias("last_message_time"),
        F.least(F.count("*"), F.lit(held)).cast("bigint").alias("alerts_held"),
    )


def observe_ingest(messages: DataFrame, time: str, name: str = "ingest") -> DataFrame:
    """Attach the same counters to a running query or write, without another pass."""
    return messages.observe(
        name, F.count("*").alias("messages"), F.max(time).alias("last_message_time")
    )
