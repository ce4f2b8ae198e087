from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareway.functions.measures import round_half_up
from fareway.operators import metrics as M
from fareway.operators import numbering as N
from fareway.operators import windows as W

SILVER = (
    "pickup_date DATE, pickup_hour INT, pickup_zone STRING, od_pair STRING, trip_distance DOUBLE,"
    " fare_amount DOUBLE, total_amount DOUBLE, trip_duration_min DOUBLE, revenue DOUBLE, vendor_id INT"
)


def silver(spark, n=900, hot=300):
    """A third of the rows share date, hour, zone and route."""
    day = dt.date(2024, 1, 6)
    rows = [(day, 18, "zone_1", "zone_1_to_zone_2", 1.25, 10.1, 12.0, 7.5, 12.0, 1)] * hot
    for i in range(n - hot):
        zone = f"zone_{i % 7}"
        rows.append((day + dt.timedelta(days=i % 9), i % 24, zone, f"{zone}_to_zone_{i % 5}", (i % 50) / 8,
                     None if i % 31 == 0 else i / 3, i / 2, i % 40 + 1 / 60, i / 2, None if i % 10 == 0 else 2))
    return spark.createDataFrame(rows, SILVER)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cube_gives_the_same_tables(spark):
    trips = silver(spark).repartition(13)
    cube = M.trip_cube(trips)
    for table in (M.hourly_metrics, M.daily_metrics, M.pickup_hotspots, M.demand_features,
                  M.demand_pattern, M.peak_periods, M.weekday_hour, M.top_zones):
        assert rows(table(cube)) == rows(table(trips)), table.__name__


def test_results_do_not_depend_on_partitioning(spark):
    trips = silver(spark)
    assert rows(M.hourly_metrics(trips.repartition(1))) == rows(M.hourly_metrics(trips.repartition(29)))


def test_count_of_a_column_and_null_averages(spark):
    trips = silver(spark)
    by_rows = sum(r.trip_count for r in M.hourly_metrics(trips).collect())
    by_vendor = sum(r.trip_count for r in M.hourly_metrics(trips, count_col="vendor_id").collect())
    assert by_rows == 900 and by_vendor == 840
    unknown = trips.withColumn("fare_amount", F.lit(None).cast("double"))
    assert all(r.avg_fare is None for r in M.daily_metrics(unknown).collect())


def test_ties_go_to_the_smallest_key(spark):
    trips = silver(spark, 0, 0).unionByName(
        spark.createDataFrame([(dt.date(2024, 1, 1), h, z, z + "_x", 1.0, 1.0, 1.0, 1.0, 1.0, 1)
                               for h in (9, 3) for z in ("zone_b", "zone_a")], SILVER))
    head = M.headline(trips).first()
    assert tuple(head) == (3, "zone_a", "zone_a_x")
    assert [r.pickup_zone for r in M.top_zones(trips, 1).collect()] == ["zone_a"]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.675,), (None,)], "v DOUBLE")
    assert [r[0] for r in df.select(round_half_up(F.col("v"), 2)).collect()] == [0.13, -0.13, 2.68, None]


def test_grid_has_every_cell(spark):
    table = M.weekday_hour(silver(spark), fill=True)
    assert table.count() == 168
    assert table.filter("max_count < trip_count").count() == 0
    assert table.agg(F.sum("trip_count")).first()[0] == 900


# --- numbering and count windows ---------------------------------------------------


def test_numbers_are_dense_under_ties(spark):
    """A third of the rows share one time; the id tells them apart."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("t"))
    got = N.number_rows(df.repartition(7), ["t", "id"]).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(1, 3001))
    assert [(r.t, r.id) for r in got] == sorted((r.t, r.id) for r in got)
    assert N.number_rows(df.limit(0), ["t"]).count() == 0


def loop_windows(events, size, stride):
    out, window = [], []
    for i, (zone, fare, distance) in enumerate(events, 1):
        window = (window + [(zone, fare, distance)])[-size:]
        if i % stride == 0 or i == len(events):
            zones = [z for z, _, _ in window]
            best = min(set(zones), key=lambda z: (-zones.count(z), z))
            out.append((i, len(window), len(window), best))
    return out


def test_count_window_equals_a_loop(spark):
    for n, size, stride in [(503, 120, 25), (24, 120, 25), (25, 120, 25), (100, 10, 25), (60, 30, 7), (1, 5, 2)]:
        events = [(f"zone_{i * i % 7}", i / 4, i % 9 / 2) for i in range(n)]
        df = spark.createDataFrame([(i + 1, *e) for i, e in enumerate(events)],
                                   "event_id BIGINT, pickup_zone STRING, fare_amount DOUBLE, trip_distance DOUBLE")
        got = sorted((r.event_id, r.window_size, r.trip_count, r.hotspot_zone)
                     for r in W.count_window(df, size, stride).collect())
        assert got == loop_windows(events, size, stride)


def test_count_window_averages(spark):
    df = spark.createDataFrame([(i, "z", float(i), 0.5) for i in range(1, 31)],
                               "event_id BIGINT, pickup_zone STRING, fare_amount DOUBLE, trip_distance DOUBLE")
    got = {r.event_id: (r.avg_fare, r.avg_distance) for r in W.count_window(df, 10, 25).collect()}
    assert got == {25: (20.5, 0.5), 30: (25.5, 0.5)}


def test_measures_beyond_their_units_are_refused(spark):
    from fareway.functions.measures import limbs

    df = spark.createDataFrame([(1.23456,), (float("nan"),), (None,), (-9e14,), (-0.00005,), (-1.5,)], "v DOUBLE")
    got = [tuple(r) for r in df.select(*limbs("v")).collect()]
    assert got == [(12345, 600000), (None, None), (None, None), (-9 * 10**18, 0), (-1, 500000), (-15000, 0)]
    for wrong in (1e16, -1e16, float("inf"), float("-inf")):
        with pytest.raises(Exception, match="range of its units"):
            spark.createDataFrame([(wrong,)], "v DOUBLE").select(*limbs("v")).collect()
