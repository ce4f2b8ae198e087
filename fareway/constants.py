"""Schemas, limits and lookup values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: names, codes, limits and texts that results depend on -----

# raw trip column (lower case) -> canonical name
TRIP_RENAMES = {
    "vendorid": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "ratecodeid": "ratecode_id",
    "pulocationid": "pickup_location_id",
    "dolocationid": "dropoff_location_id",
}

PAYMENT_LABELS = {
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided_trip",
}

# road_id, road_name, district, base_speed_kmh, capacity, lat, lon
ROADS = [
    ("R001", "人民大道东段", "中心区", 42.0, 90, 31.231, 121.478),
    ("R002", "人民大道西段", "中心区", 38.0, 75, 31.232, 121.464),
    ("R003", "中环北向南", "北城区", 55.0, 120, 31.286, 121.439),
    ("R004", "中环南向北", "南城区", 53.0, 120, 31.183, 121.432),
    ("R005", "机场快速路进城", "东城区", 70.0, 150, 31.151, 121.681),
    ("R006", "机场快速路出城", "东城区", 72.0, 150, 31.160, 121.699),
    ("R007", "跨江大桥北口", "滨江区", 48.0, 85, 31.247, 121.503),
    ("R008", "跨江大桥南口", "滨江区", 46.0, 85, 31.214, 121.506),
    ("R009", "大学城主干路", "西城区", 40.0, 70, 31.291, 121.349),
    ("R010", "会展中心环路", "新区", 35.0, 60, 31.197, 121.566),
]

# alert sentence: road, window start, window end, average speed (, vehicles)
ALERT_TEXT = "%s 在 %s 至 %s 窗口内平均速度 %s km/h"
ALERT_TEXT_WITH_COUNT = ALERT_TEXT + "，车辆数 %s"

SEVERITIES = ("severe", "moderate", "slow")

# display names
PAYMENT_DISPLAY = {"credit_card": "信用卡", "cash": "现金", "dispute": "争议", "no_charge": "免付"}
MODEL_DISPLAY = {"linear_regression_baseline": "线性回归基线", "random_forest_regressor": "随机森林"}
SEVERITY_DISPLAY = {"severe": "严重", "moderate": "中度"}
SEVERITY_DISPLAY_OTHER = "缓行"

# detection window and pyramid
WINDOW_WIDTH, WINDOW_HEIGHT = 64, 128
PYRAMID_SCALES = (1.25, 1.0, 0.75, 0.55, 0.42, 0.32)
GRID_STEP = 16
MIN_BOX = 32
BACKGROUND_PER_IMAGE = 10
BACKGROUND_ATTEMPTS = 200
BACKGROUND_RATIO = 1.2

SPLIT_SEED = 20260509

# columns a raw trip table must have
REQUIRED_TRIP_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    "fare_amount",
    "total_amount",
)

# inputs of the demand models, key of a demand row, columns of the prediction table
NUMERIC_FEATURES = (
    "pickup_hour",
    "pickup_weekday",
    "is_weekend",
    "avg_distance",
    "avg_fare",
    "avg_duration_min",
)
DEMAND_KEY = ("pickup_date", "pickup_hour", "pickup_zone")
PREDICTION_COLUMNS = (
    "pickup_date",
    "pickup_hour",
    "pickup_weekday",
    "pickup_zone",
    "demand",
    "improved_prediction",
)

# names of the trained models
LINEAR = "linear_regression_baseline"
FOREST = "random_forest_regressor"

# --- end of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class TripLimits:
    """Upper bounds of a valid trip; the lower bound of each is zero, exclusive."""

    max_duration_min: float = 360.0
    max_trip_distance: float = 80.0
    max_fare_amount: float = 400.0
    max_passenger_count: float = 8.0


@dataclass(frozen=True)
class ReadingThresholds:
    """Class limits of one road reading: (speed at most, occupancy at least)."""

    severe: tuple[float, float] = (12.0, 0.88)
    moderate: tuple[float, float] = (22.0, 0.72)
    slow: tuple[float, float] = (35.0, 0.55)


@dataclass(frozen=True)
class WindowThresholds:
    """Limits on window averages. They differ from those of a single reading."""

    severe: tuple[float, float] = (12.0, 0.88)
    moderate: tuple[float, float] = (20.0, 0.75)
    alert: tuple[float, float] = (25.0, 0.65)
    alert_severe_events: int = 5
    severe_event_speed: float = 12.0


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def flat_schema(spec: str) -> T.StructType:
    """Schema of plain columns, ``name TYPE, ...``, without needing a session."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_TRIP_SCHEMA = flat_schema(
    "vendorid BIGINT, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ,"
    " passenger_count DOUBLE, trip_distance DOUBLE, ratecodeid DOUBLE, store_and_fwd_flag STRING,"
    " pulocationid BIGINT, dolocationid BIGINT, payment_type BIGINT, fare_amount DOUBLE,"
    " extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE,"
    " improvement_surcharge DOUBLE, total_amount DOUBLE, congestion_surcharge DOUBLE,"
    " airport_fee DOUBLE"
)

READING_SCHEMA = flat_schema(
    "event_id STRING, event_time TIMESTAMP, road_id STRING, road_name STRING, district STRING,"
    " speed_kmh DOUBLE, vehicle_count INT, occupancy DOUBLE, travel_time_sec DOUBLE,"
    " congestion_level STRING, lat DOUBLE, lon DOUBLE"
)

TRIP_TYPES = {
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "passenger_count": "double",
    "trip_distance": "double",
    "fare_amount": "double",
    "total_amount": "double",
    "tip_amount": "double",
}


def roads_table(spark: SparkSession) -> DataFrame:
    """The road dimension as a local relation: its size is known to the planner."""
    rows = ", ".join(
        f"('{rid}', '{name}', '{district}', {speed}D, {capacity}, {lat}D, {lon}D)"
        for rid, name, district, speed, capacity, lat, lon in ROADS
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS"
        " roads(road_id, road_name, district, base_speed_kmh, capacity, lat, lon)"
    )
