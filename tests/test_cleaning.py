from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareway.constants import PAYMENT_LABELS, TripLimits
from fareway.functions import columns as C
from fareway.operators import cleaning as K
from fareway.operators import metrics as M

COLUMNS = (
    "vendor_id INT, pickup_datetime STRING, dropoff_datetime STRING, passenger_count DOUBLE,"
    " trip_distance DOUBLE, pickup_location_id INT, dropoff_location_id INT, payment_type STRING,"
    " fare_amount DOUBLE, tip_amount DOUBLE, total_amount DOUBLE"
)
GOOD = (1, "2024-01-01 08:00:00", "2024-01-01 08:20:00", 1.0, 3.2, 1, 2, "cash", 15.0, 0.0, 18.0)


def trips(spark, *changes):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    rows = [tuple({**dict(zip(names, GOOD)), **change}.values()) for change in changes]
    return K.standardize_trips(spark.createDataFrame(rows, COLUMNS))


def test_good_and_bad_row(spark):
    df = trips(spark, {}, {"trip_distance": -1.0})
    row = K.clean_trips(df).collect()
    assert len(row) == 1
    assert row[0].trip_duration_min == 20
    assert row[0].pickup_hour == 8
    assert row[0].od_pair == "zone_1_to_zone_2"
    assert row[0].pickup_date == dt.date(2024, 1, 1)
    assert row[0].pickup_month == "2024-01"
    assert row[0].pickup_weekday == 0 and row[0].is_weekend == 0
    assert row[0].revenue == 18.0
    report = K.quality_report(df).first()
    assert (report.before_rows, report.after_rows, report.removed_rows) == (2, 1, 1)
    assert report.removal_rate == 0.5


UNKNOWN = [{"passenger_count": None}, {"trip_distance": None}, {"fare_amount": None}]
NAN = [{c: float("nan")} for c in ("passenger_count", "trip_distance", "fare_amount")]
BROKEN = [
    {"trip_distance": 0.0},
    {"trip_distance": 80.01},
    {"fare_amount": -5.0},
    {"fare_amount": 400.5},
    {"passenger_count": 12.0},
    {"passenger_count": 0.0},
    {"dropoff_datetime": "2024-01-01 08:00:00"},
    {"dropoff_datetime": "2024-01-01 14:00:01"},
    {"pickup_datetime": "soon"},
    {"dropoff_datetime": None},
]
EDGE = [
    {"trip_distance": 80.0},
    {"fare_amount": 400.0},
    {"passenger_count": 8.0},
    {"dropoff_datetime": "2024-01-01 14:00:00"},
]


def test_strict_drops_unknown_values(spark):
    zones = [{"pickup_location_id": None}, {"dropoff_location_id": None}]
    assert K.clean_trips(trips(spark, *UNKNOWN, *NAN, *BROKEN, *zones)).count() == 0
    assert K.clean_trips(trips(spark, *EDGE)).count() == len(EDGE)


def test_lenient_keeps_unknown_values(spark):
    df = trips(spark, *UNKNOWN, *NAN, *BROKEN, *EDGE)
    kept = K.clean_trips(df, nulls="keep")
    assert kept.count() == len(UNKNOWN) + len(NAN) + len(EDGE)
    assert K.quality_report(df, nulls="keep").first().after_rows == kept.count()


@pytest.mark.parametrize("nulls", ["drop", "keep"])
def test_report_counts_what_cleaning_keeps(spark, nulls):
    df = trips(spark, {}, *UNKNOWN, *NAN, *BROKEN, *EDGE)
    limits = TripLimits(60, 10, 100, 4)
    report = K.quality_report(df, limits, nulls).first()
    assert report.after_rows == K.clean_trips(df, limits, nulls).count()


def test_empty_table(spark):
    empty = trips(spark, {}).limit(0)
    report = K.quality_report(empty).first()
    assert (report.before_rows, report.removed_rows, report.removal_rate) == (0, 0, 0.0)
    clean = K.clean_trips(empty)
    assert M.hourly_metrics(clean).count() == 0
    assert M.headline(clean).first().top_hour is None


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="fare_amount.*trip_distance"):
        K.clean_trips(trips(spark, {}).drop("trip_distance", "fare_amount"))


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], [" VendorID ", "Airport Fee"])
    assert K.normalize_columns(df).columns == ["vendorid", "airport_fee"]
    with pytest.raises(ValueError, match="collide"):
        K.normalize_columns(spark.createDataFrame([(1, 2)], ["A b", "a_B"]))


def test_unreadable_text_becomes_null(spark):
    df = spark.createDataFrame([("1.5", "x"), ("bad", "2024-01-01 00:00:00"), ("NaN", None)], ["a", "t"])
    rows = K.coerce_types(df, {"a": "double", "t": "timestamp", "absent": "int"}).collect()
    assert [r.a for r in rows] == [1.5, None, None]
    assert [r.t for r in rows] == [None, dt.datetime(2024, 1, 1), None]


def test_payment_codes(spark):
    df = spark.createDataFrame([(1,), (6,), (9,), (None,)], "code INT")
    labels = C.label_codes(df, "code", PAYMENT_LABELS, "label").collect()
    assert [r.label for r in labels] == ["credit_card", "voided_trip", "unknown", "unknown"]
    text = C.label_codes(spark.createDataFrame([("cash",), ("2",)], "code STRING"), "code", PAYMENT_LABELS, "label")
    assert [r.label for r in text.collect()] == ["unknown", "cash"]


def test_month_range(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    df = spark.createDataFrame([(d,) for d in days], "pickup_date DATE")
    assert [r.pickup_date for r in K.in_month(df, "2024-01").collect()] == days[1:3]
    with pytest.raises(ValueError):
        K.in_month(df, "2024-1")


def test_class_rule(spark):
    cases = [(8, 0.4, "severe"), (30, 0.9, "severe"), (18, 0.5, "moderate"), (50, 0.2, "smooth"),
             (12, 0.0, "severe"), (22, 0.0, "moderate"), (35, 0.0, "slow"), (35.01, 0.55, "slow"), (99, 0.72, "moderate")]
    df = spark.createDataFrame([(float(s), o, want) for s, o, want in cases], "s DOUBLE, o DOUBLE, want STRING")
    assert df.filter(C.classify_congestion(F.col("s"), F.col("o")) != F.col("want")).count() == 0


def test_bucket_edges(spark):
    values = [0.0, 0.5, 1.0, 1.01, 3.0, 5.0, 10.0, 20.0, 20.01, 100.0, 100.5, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    over = C.bucket("v", C.DISTANCE_EDGES, C.DISTANCE_LABELS, C.DISTANCE_OVERFLOW)
    bins = C.bucket("v", C.DISTANCE_BIN_EDGES[1:], C.DISTANCE_BIN_LABELS, None, C.DISTANCE_BIN_EDGES[0])
    got = [(r.a, r.b) for r in df.select(over.alias("a"), bins.alias("b")).collect()]
    assert [a for a, _ in got] == ["0-1", "0-1", "0-1", "1-3", "1-3", "3-5", "5-10", "10-20", "20+", "20+", "20+", "20+", "20+"]
    assert [b for _, b in got] == [None, "(0, 1]", "(0, 1]", "(1, 3]", "(1, 3]", "(3, 5]", "(5, 10]", "(10, 20]",
                                   "(20, 100]", "(20, 100]", None, None, None]


def test_periods(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    rows = hours.select("h", C.period_of_day("h").alias("p"), C.period_of_day("h", "five").alias("f")).collect()
    peak = {r.h: r.p for r in rows}
    five = {r.h: r.f for r in rows}
    assert [h for h in range(24) if peak[h] == "morning_peak"] == [7, 8, 9]
    assert [h for h in range(24) if peak[h] == "evening_peak"] == [17, 18, 19]
    assert [h for h in range(24) if peak[h] == "night"] == list(range(6))
    assert [five[h] for h in (0, 5, 6, 10, 11, 15, 16, 20, 21, 23)] == [
        "late_night", "late_night", "morning_peak", "morning_peak", "midday", "midday",
        "evening_peak", "evening_peak", "night", "night"]
    named = hours.select(C.period_of_day("h", names={"night": "夜间"}).alias("p")).distinct()
    assert "夜间" in {r.p for r in named.collect()}
