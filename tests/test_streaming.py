from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from fareway.constants import roads_table
from fareway.operators import alerts as A
from fareway.plans import congestion as plan
from fareway.sources import streams
from fareway.streaming import congestion as S


def message(second, road="R001", speed=8.0, **more):
    minute, rest = divmod(second, 60)
    body = {
        "event_id": f"evt-{second}-{road}", "event_time": f"2024-01-01 00:{minute:02d}:{rest:02d}.000",
        "road_id": road, "road_name": f"name {road}", "district": "d", "speed_kmh": speed,
        "vehicle_count": 5, "occupancy": 0.4, "travel_time_sec": 60.0, "congestion_level": "severe",
        "lat": 1.0, "lon": 2.0,
    }
    return json.dumps({**body, **more})


class Feed:
    """A folder of message files, read one file per micro-batch in name order."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.inbox = root / "in"
        self.inbox.mkdir()
        self.files = 0

    def add(self, *lines):
        self.files += 1
        path = self.inbox / f"{self.files:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + self.files,) * 2)

    def messages(self):
        return streams.file_messages(self.spark, str(self.inbox), max_files=1)

    def run(self):
        query = plan.start(self.messages(), str(self.root / "sink"), str(self.root / "state"))
        query.awaitTermination()
        dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
        return plan.stored_alerts(self.spark, str(self.root / "sink")), dropped

    def batch(self):
        lines = self.spark.read.text(str(self.inbox))
        return S.congestion_alerts(streams.road_readings(lines))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def rows(df):
    return sorted(tuple(r) for r in df.select("window_start", "road_id", "vehicle_count", "avg_speed_kmh", "severity").collect())


def test_closed_windows_equal_the_batch(feed):
    feed.add(*[message(s, f"R00{s % 3 + 1}", 5 + s % 30) for s in range(0, 150)])
    feed.add(*[message(s, f"R00{s % 3 + 1}", 5 + s % 30) for s in range(150, 300)])
    stream, dropped = feed.run()
    assert dropped == 0
    closed = feed.batch().filter(F.col("window_end") <= F.lit("2024-01-01 00:04:54").cast("timestamp"))
    assert rows(stream) == rows(closed)
    assert feed.batch().count() > closed.count() > 0


def test_the_tail_comes_out_with_newer_readings(feed):
    feed.add(*[message(s) for s in range(100)])
    first, _ = feed.run()
    before = first.count()
    feed.add(message(400))
    second, _ = feed.run()
    assert second.count() > before
    assert second.select("window_start", "window_end", "road_id").distinct().count() == second.count()


def test_late_readings(feed):
    """Late into open windows counts; late for closed ones is dropped a batch later."""
    feed.add(*[message(s) for s in range(0, 120)])
    feed.add(message(95, "R002"), *[message(s) for s in range(120, 200)])
    feed.add(message(30, "R003"), *[message(s) for s in range(200, 300)])
    stream, dropped = feed.run()
    assert dropped == 6
    got = {r.road_id for r in stream.collect()}
    assert got == {"R001", "R002"}
    closed = feed.batch().filter((F.col("window_end") <= F.lit("2024-01-01 00:04:54").cast("timestamp")) & (F.col("road_id") != "R003"))
    assert rows(stream) == rows(closed)


def test_broken_messages_are_skipped(spark):
    lines = [message(1), "{broken", "", "[]", json.dumps({"road_id": "R1"}), message(2, event_time="never"),
             message(3, speed_kmh="fast"), message(4, vehicle_count=2.5), message(5, extra=1)]
    df = streams.road_readings(spark.createDataFrame([(v,) for v in lines], "value STRING"))
    got = {r.event_id: (r.speed_kmh, r.vehicle_count) for r in df.collect()}
    assert got == {"evt-1-R001": (8.0, 5), "evt-3-R001": (None, 5), "evt-4-R001": (8.0, None), "evt-5-R001": (8.0, 5)}


def test_binary_values_as_a_topic_gives_them(spark):
    df = spark.createDataFrame([(message(1).encode(),)], "value BINARY")
    assert streams.road_readings(df).first().road_id == "R001"


def test_panes_equal_direct_windows(spark):
    lines = [message(s * 7 % 311, f"R00{s % 4}", s % 60 / 3) for s in range(2000)] + [message(9, speed_kmh=None)]
    df = streams.road_readings(spark.createDataFrame([(v,) for v in lines], "value STRING"))
    limits = S.WindowThresholds()
    columns = ["window_start", "window_end", *S.ROAD_KEY, "events", "severe_events", "speed", "speed_n", "travel"]
    a = S._panes_to_windows(df, 60, 10, limits).select(columns)
    b = S._direct_windows(df, 60, 10, limits).select(columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).isEmpty()
    with pytest.raises(ValueError):
        S.congestion_alerts(df, size=60, slide=7)


def test_severity_and_condition_edges(spark):
    def one(speed, occupancy, level="slow"):
        line = message(5, speed=speed, occupancy=occupancy, congestion_level=level)
        df = streams.road_readings(spark.createDataFrame([(line,)], "value STRING"))
        found = S.congestion_alerts(df).limit(1).collect()
        return found[0].severity if found else None

    assert one(12.0, 0.1) == "severe" and one(12.01, 0.1) == "moderate"
    assert one(20.0, 0.1) == "moderate" and one(20.01, 0.1) == "slow"
    assert one(25.0, 0.1) == "slow" and one(25.01, 0.1) is None
    assert one(90.0, 0.65) == "slow" and one(90.0, 0.75) == "moderate" and one(90.0, 0.88) == "severe"
    assert one(90.0, 0.1, "severe") is None


def test_alert_text(spark):
    df = streams.road_readings(spark.createDataFrame([(message(5),)], "value STRING"))
    row = S.congestion_alerts(df).orderBy(F.desc("window_start")).first()
    assert row.alert_text == "name R001 在 2024-01-01 00:00:00.000 至 2024-01-01 00:01:00.000 窗口内平均速度 8.0 km/h"


def test_deduplicated_alert_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    line = json.dumps({"window_start": "2024-01-01 00:00:00", "window_end": "2024-01-01 00:01:00", "road_id": "R1"})
    other = json.dumps({"window_start": "2024-01-01 00:00:10", "window_end": "2024-01-01 00:01:10", "road_id": "R1"})
    feed.add(line, line)
    feed.add(line, other)
    parsed = feed.messages().select(F.from_json("value", "window_start TIMESTAMP, window_end TIMESTAMP, road_id STRING").alias("a")).select("a.*")
    query = streams.write_alerts(S.dedupe_alert_stream(parsed), str(tmp_path / "sink"), str(tmp_path / "state"), "json")
    query.awaitTermination()
    assert spark.read.json(str(tmp_path / "sink")).count() == 2


def test_enriched_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(*[message(s, "R010" if s % 2 else "X9") for s in range(0, 200)])
    alerts = A.enrich_roads(S.congestion_alerts(streams.road_readings(feed.messages())), roads_table(spark))
    streams.write_alerts(alerts, str(tmp_path / "sink"), str(tmp_path / "state")).awaitTermination()
    names = {(r.road_id, r.road_name, r.district) for r in plan.stored_alerts(spark, str(tmp_path / "sink")).collect()}
    assert names == {("R010", "会展中心环路", "新区"), ("X9", "name X9", "d")}


def test_ingest_counters_on_a_running_query(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(*[message(s) for s in range(50)])
    readings = A.observe_ingest(streams.road_readings(feed.messages()), "event_time")
    query = streams.write_alerts(readings, str(tmp_path / "sink"), str(tmp_path / "state"))
    query.awaitTermination()
    seen = [p["observedMetrics"]["ingest"]["messages"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(seen) == 50


def test_sink_format(spark):
    with pytest.raises(ValueError):
        streams.write_alerts(spark.range(1), "x", "y", "csv")


# --- served alerts -------------------------------------------------------------------

ALERT = ("window_start TIMESTAMP, window_end TIMESTAMP, road_id STRING, road_name STRING, district STRING,"
         " vehicle_count BIGINT, avg_speed_kmh DOUBLE, avg_occupancy DOUBLE, avg_travel_time_sec DOUBLE,"
         " severe_event_count BIGINT, severity STRING, alert_text STRING")


def alert_rows(spark, *changes):
    import datetime as dt

    start = dt.datetime(2024, 1, 1)
    base = dict(window_start=start, window_end=start + dt.timedelta(minutes=1), road_id="R001", road_name="n",
                district="d", vehicle_count=3, avg_speed_kmh=20.0, avg_occupancy=0.5, avg_travel_time_sec=1.0,
                severe_event_count=0, severity="slow", alert_text="t")
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], ALERT)


def test_ranking_with_unknown_values(spark):
    df = alert_rows(spark, {"road_id": "a", "severity": "severe", "avg_speed_kmh": None},
                    {"road_id": "b", "severity": "severe", "avg_speed_kmh": 30.0},
                    {"road_id": "c", "avg_speed_kmh": 1.0}, {"road_id": "d", "avg_speed_kmh": 1.0, "vehicle_count": 9},
                    {"road_id": "e", "severity": None, "avg_speed_kmh": 0.5},
                    {"road_id": "f", "avg_speed_kmh": 1.0, "vehicle_count": None})
    assert [r.road_id for r in A.rank_alerts(df).collect()] == ["b", "a", "e", "d", "c", "f"]
    assert A.rank_alerts(df, 2).count() == 2


def test_newest_alert_ignores_unknown_times(spark):
    df = alert_rows(spark, {"road_id": "a", "window_end": None}, {"road_id": "b"})
    assert A.newest_alert(df).first().road_id == "b"


def test_normalised_and_enriched(spark):
    df = alert_rows(spark, {"road_id": " R002 ", "avg_speed_kmh": 12.345, "avg_occupancy": None}, {"road_id": None})
    got = {r.road_id: r for r in A.enrich_roads(A.normalize_alerts(df), roads_table(spark)).collect()}
    assert got["R002"].road_name == "人民大道西段" and got["R002"].avg_speed_kmh == 12.35 and got["R002"].avg_occupancy is None
    assert got["R002"].alert_text.endswith("窗口内平均速度 12.35 km/h，车辆数 3")
    assert got[""].alert_text == "t"


def test_hot_alert_key(spark):
    """A third of the rows are deliveries of one alert; the last one stays."""
    first = alert_rows(spark, {}).first()
    rows = [(*first[:2], "R001" if i % 3 == 0 else str(i), *first[3:], i) for i in range(3000)]
    keyed = spark.createDataFrame(rows, ALERT + ", arrival INT")
    got = A.latest_alerts(keyed, 5000, "arrival")
    assert got.count() == 2001
    assert got.filter("road_id = 'R001'").first().arrival == 2997


def test_alert_counts(spark):
    df = alert_rows(spark, {"severity": "severe", "avg_speed_kmh": 0.0, "road_name": ""}, {"severity": "odd", "avg_speed_kmh": 7.0})
    assert {r.severity: r.alerts for r in A.severity_counts(df).collect()} == {"severe": 1, "moderate": 0, "slow": 0}
    assert tuple(A.alert_headline(df).first()) == (1, 7.0, 3)
    assert tuple(A.alert_headline(df.limit(0)).first()) == (0, None, 0)
    assert [tuple(r) for r in A.road_ranking(df).collect()] == [("n", 1, 7.0), ("R001", 1, 999.0)]


# --- state and sinks between batches ---------------------------------------------------


def count_events(spark, low, high):
    return spark.range(low, high).selectExpr(
        "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS pickup_datetime", "id AS trip_id",
        "concat('z', id % 4) AS pickup_zone", "CAST(id AS DOUBLE) AS fare_amount", "CASE WHEN id % 9 > 0 THEN id / 8 END AS trip_distance")


@pytest.mark.parametrize("cuts,size,stride", [((0, 7, 8, 30, 61), 12, 5), ((0, 3, 4), 120, 25), ((0, 50), 1, 1)])
def test_count_windows_over_batches(spark, tmp_path, cuts, size, stride):
    from fareway.operators.numbering import number_rows
    from fareway.operators.windows import count_window
    from fareway.streaming import count_windows as CW

    order, root = ("pickup_datetime", "trip_id"), str(tmp_path)
    assert CW.stored_count_windows(spark, root).count() == 0
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:])):
        events = count_events(spark, low, high).repartition(3)
        CW.count_window_batch(events, batch, root, order, size, stride)
        before = sorted(CW.stored_count_windows(spark, root, stride).collect())
        # the batch again, after part of a failed attempt was left behind
        CW.count_window_batch(events, batch, root, order, size, stride)
        CW.count_window_batch(events.limit(0), batch, root, order, size, stride)
        assert sorted(CW.stored_count_windows(spark, root, stride).collect()) == before
        want = count_window(number_rows(count_events(spark, 0, high), order, "event_id"), size, stride)
        assert before == sorted(want.collect())


def test_uncommitted_snapshots_are_not_shown(spark, tmp_path):
    from fareway.sources.versions import write_version
    from fareway.streaming import count_windows as CW

    order, root = ("pickup_datetime", "trip_id"), str(tmp_path)
    CW.count_window_batch(count_events(spark, 0, 40), 0, root, order)
    before = sorted(CW.stored_count_windows(spark, root).collect())
    # snapshots of a batch that failed before its state was written
    write_version(spark.createDataFrame([(50, 1, 1, 0.0, 0.0, "z")], CW.SNAPSHOT_SCHEMA), f"{root}/snapshots", 1)
    assert sorted(CW.stored_count_windows(spark, root).collect()) == before


def test_serving_reads_the_newest_periods_only(spark, tmp_path):
    from fareway.plans import congestion

    root = str(tmp_path)
    times = "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id)"
    alerts = spark.range(600).selectExpr(
        f"{times} AS window_start", f"{times} + interval 1 minute AS window_end", "'R001' AS road_id", "'n' AS road_name", "'d' AS district",
        "1L AS vehicle_count", "id / 1000 AS avg_speed_kmh", "0.5D AS avg_occupancy", "1.0D AS avg_travel_time_sec", "0L AS severe_event_count",
        "'severe' AS severity", "'t' AS alert_text")
    congestion.serve_batch(alerts, 0, root, "hour")
    congestion.serve_batch(alerts.withColumn("vehicle_count", F.lit(9).cast("bigint")), 1, root, "hour")
    stored = congestion.newest_stored(spark, root)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        text = stored._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # 1, then 2, then 4 periods, until they hold a hundred different alerts
    assert "2024-01-01-07" in text[text.index("PartitionFilters"):]
    assert {r[0] for r in stored.select("alert_period").distinct().collect()} == {f"2024-01-01-{h:02}" for h in (7, 8, 9, 10)}
    served = sorted(congestion.served_table(spark, root).collect())
    # the last to arrive counts, and the speeds are those of the newest hundred
    assert len(served) == 30 and {r.vehicle_count for r in served} == {9} and min(r.avg_speed_kmh for r in served) == 0.5
    congestion.serve_batch(alerts.withColumn("vehicle_count", F.lit(9).cast("bigint")), 1, root, "hour")
    assert sorted(congestion.served_table(spark, root).collect()) == served


def test_stored_batches_have_a_file_for_each_of_many_periods(spark, tmp_path):
    """Not one for each period and task."""
    end = "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 60)"
    alerts = spark.range(0, 1800, 1, 8).repartition(8).selectExpr(
        f"{end} - interval 1 minute AS window_start", f"{end} AS window_end", "'R001' AS road_id", "'n' AS road_name", "'d' AS district",
        "1L AS vehicle_count", "1.0D AS avg_speed_kmh", "0.5D AS avg_occupancy", "1.0D AS avg_travel_time_sec", "0L AS severe_event_count",
        "'severe' AS severity", "'t' AS alert_text")
    plan.store_batch(alerts, 0, str(tmp_path), "hour")
    assert len(list(tmp_path.glob("alerts/*/*/*.parquet"))) == 30
    # one period is still written by several tasks
    plan.store_batch(alerts.filter("window_end < timestamp'2024-01-01 01:00:00'"), 1, str(tmp_path), "hour")
    assert 1 < len(list(tmp_path.glob("alerts/*/arrival=1/*.parquet"))) <= 8


def test_large_deliveries_have_equally_many_files(spark, tmp_path):
    from fareway.registry import queries

    rows = spark.range(100).selectExpr("id", "CAST(id >= 40 AS INT) AS part")
    for file_rows, files in ((10, 4), (100, 1)):
        root = tmp_path / str(files)
        seen = []
        for n in queries._delivered(rows, "part", str(root), file_rows):
            seen.append(len(list(root.glob("*.parquet"))))
            assert n == files
        assert seen == [files, 2 * files]
        assert sorted(r.id for r in spark.read.parquet(str(root)).collect()) == list(range(100))
