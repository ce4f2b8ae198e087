"""Trips, road readings and boxes projected from the ``events`` table.

The given tables hold no taxi trips, road readings or boxes; these projections
derive them row by row, with arithmetic that SQL can repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.constants import PAYMENT_LABELS, TRIP_RENAMES, flat_schema, roads_table
from fareway.functions import columns as C
from fareway.operators import cleaning

EVENT_SCHEMA = flat_schema(
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
TRUTH_TYPES = ("purchase", "signup")


def table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written as a pattern, because a stream takes a single file only by pattern;
    # it finds a folder of the same name as well
    return spark.readStream.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parque[t]")


def trips_of(rows: DataFrame) -> DataFrame:
    e = F.col("event_id")
    minutes = (e * 37 % 400).cast("int")
    return rows.select(
        e.alias("event_id"),
        (e % 2 + 1).alias("vendor_id"),
        F.col("ts").alias("pickup_datetime"),
        F.timestamp_add("MINUTE", minutes, F.col("ts")).alias("dropoff_datetime"),
        F.when(e % 97 != 0, (e % 10).cast("double")).alias("passenger_count"),
        (F.col("value") / 5).alias("trip_distance"),
        F.col("user_id").alias("pickup_location_id"),
        F.when(e % 101 != 0, e * 7 % 150).alias("dropoff_location_id"),
        (e % 8).alias("payment_type"),
        F.col("value").alias("fare_amount"),
        (F.col("value") * 0.1).alias("tip_amount"),
        F.when(e % 11 != 0, F.col("value") * 1.2).alias("total_amount"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with canonical names and the payment label."""
    return C.label_codes(
        trips_of(events(spark, sf_dir)), "payment_type", PAYMENT_LABELS, "payment_type_label"
    )


def clean(spark: SparkSession, sf_dir: str, nulls: str = "drop") -> DataFrame:
    return cleaning.clean_trips(trips(spark, sf_dir), nulls=nulls)


RAW_NAMES = {new: old for old, new in TRIP_RENAMES.items()}


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with raw names in mixed case and stray blanks, numbers and times as text,
    some of them unreadable."""
    named = trips_of(events(spark, sf_dir))
    raw = {name: f" {RAW_NAMES.get(name, name)} ".title() for name in named.columns}
    odd = F.col("event_id") % 13 == 0
    texts = ["pickup_datetime", "fare_amount", "trip_distance"]
    as_text = named.withColumns(
        {name: F.when(odd, F.lit("n/a")).otherwise(F.col(name).cast("string")) for name in texts}
    )
    return as_text.withColumnsRenamed(raw)


def readings_of(rows: DataFrame, roads: DataFrame) -> DataFrame:
    e, speed = F.col("event_id"), F.col("value")
    occupancy = (e * 13 % 100) / 100
    road = F.concat(F.lit("R"), F.lpad((F.col("user_id") % 10 + 1).cast("string"), 3, "0"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    flat = rows.select(
        e.cast("string").alias("event_id"),
        F.timestamp_add("MILLISECOND", e * 500, start).alias("event_time"),
        road.alias("road_id"),
        speed.alias("speed_kmh"),
        (e % 90 + 1).cast("int").alias("vehicle_count"),
        occupancy.alias("occupancy"),
        C.travel_time(speed).alias("travel_time_sec"),
        C.classify_congestion(speed, occupancy).alias("congestion_level"),
    )
    place = roads.select("road_id", "road_name", "district", "lat", "lon")
    named = flat.join(place, "road_id", "left")
    return named.select(
        "event_id", "event_time", "road_id", "road_name", "district", "speed_kmh",
        "vehicle_count", "occupancy", "travel_time_sec", "congestion_level", "lat", "lon",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(events(spark, sf_dir), roads_table(spark))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty boxes per image."""
    e = F.col("event_id")
    x1, y1 = e * 97 % 400, e * 53 % 200
    return events(spark, sf_dir).select(
        F.floor(e / 20).alias("image"),
        e.alias("box_id"),
        x1.cast("int").alias("x1"),
        y1.cast("int").alias("y1"),
        (x1 + 40 + e * 7 % 60).cast("int").alias("x2"),
        (y1 + 80 + e * 11 % 90).cast("int").alias("y2"),
        (F.col("value") / 491).alias("score"),
        F.col("event_type").alias("class"),
    )


def truth_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        boxes(spark, sf_dir)
        .filter(F.col("class").isin(*TRUTH_TYPES))
        .select("image", F.col("box_id").alias("object_id"), *C.CORNERS)
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        boxes(spark, sf_dir)
        .filter(~F.col("class").isin(*TRUTH_TYPES))
        .select("image", F.col("box_id").alias("det_id"), *C.CORNERS, "score", "class")
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per image of the boxes, with a size."""
    named = events(spark, sf_dir).select(F.floor(F.col("event_id") / 20).alias("image")).distinct()
    return named.select(
        "image",
        (F.col("image") * 37 % 240 + 320).cast("int").alias("width"),
        (F.col("image") * 23 % 160 + 260).cast("int").alias("height"),
    )


def annotation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One annotation text per event, with one to three boxes."""
    e = F.col("event_id")

    def line(k):
        def num(base, step, span):
            return ((e * base + k * step) % span).cast("string")

        return F.concat(
            F.lit("# Details for object "), k.cast("string"),
            F.lit("\nBounding box for object "), k.cast("string"),
            F.lit(' "PASpersonWalking" (Xmin, Ymin) - (Xmax, Ymax) : ('),
            num(97, 11, 400), F.lit(", "), num(53, 7, 200), F.lit(") - ("),
            ((e * 97 + k * 11) % 400 + 60).cast("string"), F.lit(", "),
            ((e * 53 + k * 7) % 200 + 120).cast("string"), F.lit(")\n"),
        )

    lines = F.transform(F.sequence(F.lit(1).cast("bigint"), e % 3 + 1), line)
    return events(spark, sf_dir).select(
        e.alias("image"),
        F.concat(F.lit("# Compatible with PASCAL Annotation Version 1.00\n"), F.array_join(lines, "")).alias("value"),
    )
