"""The road stream: messages to alerts, and the table served from them.

Two sinks: a plain folder of alerts (``start``, ``served``), and a folder by period and
arrival whose newest periods alone are read for the served table, which is replaced
after each batch (``start_serving``, ``served_table``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareway.constants import flat_schema, roads_table
from fareway.operators import alerts as A
from fareway.sources.streams import road_readings, write_alerts
from fareway.sources.versions import drop_versions, read_version, subfolders, versions, write_version
from fareway.streaming.congestion import congestion_alerts, dedupe_alert_stream

ALERT_SCHEMA = flat_schema(
    "window_start TIMESTAMP, window_end TIMESTAMP, road_id STRING, road_name STRING,"
    " district STRING, vehicle_count BIGINT, avg_speed_kmh DOUBLE, avg_occupancy DOUBLE,"
    " avg_travel_time_sec DOUBLE, severe_event_count BIGINT, severity STRING, alert_text STRING"
)


#: Length of a period of the stored alerts, and how its name is written.
PERIODS = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}


def start(
    messages: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet", **options
) -> StreamingQuery:
    """Run the alert stream from JSON messages into a folder or topic."""
    return write_alerts(congestion_alerts(road_readings(messages)), sink, checkpoint, fmt, **options)


def stored_alerts(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.schema(ALERT_SCHEMA).parquet(sink)


def dashboard(alerts: DataFrame, cap: int = 100, arrival: str | None = None) -> dict[str, DataFrame]:
    """Counts, road ranking, trend and headline of the newest ``cap`` alerts, each alert once."""
    current = A.latest_alerts(alerts, cap, arrival)
    return {
        "severity_counts": A.severity_counts(current),
        "road_ranking": A.road_ranking(current),
        "speed_trend": A.speed_trend(current),
        "alert_headline": A.alert_headline(current),
    }


def served(spark: SparkSession, sink: str) -> DataFrame:
    """The ranked list of the newest stored alerts."""
    return A.serve_alerts(stored_alerts(spark, sink), roads_table(spark))


# --- sink by period and arrival ---------------------------------------------------------


def store_batch(alerts: DataFrame, batch: int, root: str, period: str = "day") -> None:
    """Add a batch to the stored alerts, over an earlier attempt at the same batch; arrival is the batch."""
    placed = alerts.select(
        *ALERT_SCHEMA.names, F.date_format("window_end", PERIODS[period]).alias("alert_period"), F.lit(batch).cast("bigint").alias("arrival")
    )
    # many periods: a file for each; few: as many files for each as keep all tasks at work
    width = int(alerts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    periods = placed.select("alert_period").distinct().limit(width).count()
    slices = -(-width // max(periods, 1))
    placed = placed.repartition(width, "alert_period", F.pmod(F.xxhash64(*A.ALERT_KEY), F.lit(slices)))
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("alert_period", "arrival").parquet(f"{root}/alerts")


def newest_stored(spark: SparkSession, root: str, cap: int = 100) -> DataFrame:
    """Stored alerts of the newest periods that hold ``cap`` different alerts, or of all; no other period is read."""
    periods = subfolders(spark, f"{root}/alerts", "alert_period")[::-1]
    schema = flat_schema("alert_period STRING, arrival BIGINT")
    schema = type(schema)([*ALERT_SCHEMA.fields, *schema.fields])
    if not periods:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).parquet(f"{root}/alerts")
    taken = 1
    while True:
        newest = stored.filter(F.col("alert_period") >= periods[min(taken, len(periods)) - 1])
        if taken >= len(periods) or newest.select(*A.ALERT_KEY).distinct().limit(cap).count() == cap:
            return newest
        taken *= 2


def serve_stored(spark: SparkSession, root: str, cap: int = 100, n: int = 30) -> DataFrame:
    """The ranked list of the newest stored alerts; of repeated ones the last to arrive."""
    newest = newest_stored(spark, root, cap).drop("alert_period")
    return A.serve_alerts(newest, roads_table(spark), cap, n, "arrival").select(*ALERT_SCHEMA.names)


def serve_batch(alerts: DataFrame, batch: int, root: str, period: str = "day", cap: int = 100, n: int = 30) -> None:
    """Store a batch and replace the served table. A repeated batch changes nothing."""
    spark = alerts.sparkSession
    # read three times: without this each time would update the state of the windows again
    alerts = alerts.persist()
    try:
        empty = alerts.isEmpty()
        if not empty:
            store_batch(alerts, batch, root, period)
    finally:
        alerts.unpersist()
    if not empty:
        write_version(serve_stored(spark, root, cap, n), f"{root}/served", batch)
        kept = versions(spark, f"{root}/served")[-2:]
        drop_versions(spark, f"{root}/served", kept[0])


def start_serving(
    messages: DataFrame, root: str, checkpoint: str, period: str = "day", cap: int = 100, n: int = 30
) -> StreamingQuery:
    """Messages to alerts, to the sink by period, to the served table, for whatever has arrived."""
    alerts = congestion_alerts(road_readings(messages))
    writer = alerts.writeStream.foreachBatch(lambda rows, batch: serve_batch(rows, batch, root, period, cap, n))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def served_table(spark: SparkSession, root: str) -> DataFrame:
    """The served table after the last batch."""
    done = versions(spark, f"{root}/served")
    return read_version(spark, f"{root}/served", done[-1], ALERT_SCHEMA) if done else spark.createDataFrame([], ALERT_SCHEMA)


# --- named alerts from repeated deliveries -----------------------------------------------


def start_naming(alerts: DataFrame, sink: str, checkpoint: str, **options) -> StreamingQuery:
    """A stream of alerts, each delivered once or more, into a folder: first deliveries with the names of the road table."""
    named = A.enrich_roads(dedupe_alert_stream(alerts), roads_table(alerts.sparkSession))
    return write_alerts(named, sink, checkpoint, **options)
