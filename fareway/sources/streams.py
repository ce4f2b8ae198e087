"""Stream sources and sinks. Any streaming DataFrame with a ``value`` column will do."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fareway.constants import READING_SCHEMA

EVENT_TOPIC = "traffic-events"
ALERT_TOPIC = "congestion-alerts"


def kafka_messages(spark: SparkSession, servers: str, topic: str = EVENT_TOPIC) -> DataFrame:
    """Messages of a topic from now on; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .load()
    )


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder."""
    reader = spark.readStream.schema("value STRING")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def road_readings(messages: DataFrame, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """JSON messages as typed readings.

    Messages that are no JSON, or without a readable event time, are skipped; any
    other field that does not fit becomes null.
    """
    loose = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.dataType == T.TimestampType() else f.dataType)
            for f in schema
        ]
    )
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), loose, {"mode": "PERMISSIVE"}).alias("r")
    ).select("r.*")
    times = {
        f.name: F.try_to_timestamp(f.name) for f in schema if f.dataType == T.TimestampType()
    }
    return parsed.withColumns(times).filter(F.col("event_time").isNotNull())


def reading_messages(readings: DataFrame) -> DataFrame:
    """Readings as JSON messages keyed by road."""
    fields = [
        F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSS").alias(name)
        if kind.startswith("timestamp")
        else F.col(name)
        for name, kind in readings.dtypes
    ]
    return readings.select(
        F.col("road_id").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def write_alerts(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = True,
    every: str = "10 seconds",
    options: Mapping[str, str] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append alerts to a Parquet or JSON folder, or to a Kafka topic as JSON.

    For ``kafka`` the path is the topic and ``options`` name the servers. The number of
    state partitions is fixed for the life of a checkpoint; without
    ``state_partitions`` it is the shuffle width of the session.
    """
    if fmt == "kafka":
        alerts = alerts.select(
            F.col("road_id").alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value")
        )
        writer = alerts.writeStream.format("kafka").option("topic", path)
    elif fmt in ("parquet", "json"):
        writer = alerts.writeStream.format(fmt).option("path", path)
    else:
        raise ValueError(f"unsupported alert sink {fmt!r}")
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.options(**(options or {}))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=every)
    if state_partitions is None:
        return writer.start()
    # a query copies the settings of its session when it starts
    conf, key = alerts.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        conf.set(key, before)
