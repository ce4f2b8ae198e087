from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from fareway import bindings as B
from fareway.constants import TripLimits
from fareway.operators import metrics as M
from fareway.operators import profile as P
from fareway.operators import reports as R
from fareway.plans import congestion, detection, warehouse
from fareway.session import shared_folder


@pytest.fixture(scope="module")
def job(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    source = str(root / "raw.parquet")
    B.raw_trips(spark, sf_dir).write.parquet(source)
    return str(root / "out"), warehouse.run(spark, source, str(root / "out"), forest={"trees": 4, "depth": 3})


def test_job_equals_the_operators(spark, sf_dir, job):
    _, tables = job
    e = F.col("event_id")
    direct = B.clean(spark, sf_dir).filter(e % 13 != 0)
    for name, table in (("hourly_metrics", M.hourly_metrics), ("demand_features", M.demand_features), ("od_routes", M.od_routes)):
        want, got = table(direct), tables[name]
        assert got.count() == want.count() > 0
        assert want.exceptAll(got.select(want.columns)).isEmpty(), name
    assert tables["silver"].count() == direct.count()


def test_job_reports(spark, job):
    root, tables = job
    report = spark.read.parquet(f"{root}/reports/quality_report").first()
    assert report.before_rows == tables["bronze"].count() and report.after_rows == tables["silver"].count()
    manifest = {r.table: r.rows for r in spark.read.parquet(f"{root}/reports/gold_manifest").collect()}
    assert set(manifest) == set(warehouse.GOLD_ORDER)
    assert manifest["daily_metrics"] == tables["daily_metrics"].count()
    bundle = spark.read.parquet(f"{root}/reports/dashboard")
    sections = {r.section: r.records for r in R.filled_sections(bundle).collect()}
    assert set(sections) == {"hourly", "daily", "hotspots", "od_routes", "payment", "predictions"}
    first = bundle.filter("section = 'hotspots' AND rank = 1").first()
    assert json.loads(first.record)["trip_count"] == tables["pickup_hotspots"].agg(F.max("trip_count")).first()[0]


def test_job_passes_its_checks(job):
    _, tables = job
    assert P.expectations(tables, warehouse.delivery_rules(100, 50)).filter("NOT ok").isEmpty()
    assert not P.expectations(tables, warehouse.delivery_rules()).filter("NOT ok").isEmpty()


def test_filters_reach_the_scan(spark, job):
    root, _ = job
    from fareway.operators.cleaning import clean_trips

    bronze = spark.read.parquet(f"{root}/bronze/trips").select(
        "*", F.col("trip_distance").try_cast("double").alias("d"), F.col("fare_amount").try_cast("double").alias("f"),
        F.col("tpep_pickup_datetime").try_cast("timestamp_ntz").alias("t"))
    typed = bronze.drop("trip_distance", "fare_amount", "tpep_pickup_datetime").withColumnsRenamed(
        {"d": "trip_distance", "f": "fare_amount", "t": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime",
         "pulocationid": "pickup_location_id", "dolocationid": "dropoff_location_id"})
    path = f"{root}/typed"
    typed.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = M.hourly_metrics(clean_trips(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    for text in ("GreaterThan(trip_distance,0.0)", "LessThanOrEqual(fare_amount,400.0)", "IsNotNull(pickup_location_id)"):
        assert text in pushed, text
    assert "tip_amount" not in plan[plan.index("ReadSchema"):]


def test_detection_samples(spark, sf_dir):
    samples = detection.training_boxes(B.images(spark, sf_dir), B.truth_boxes(spark, sf_dir))
    counts = {r.label: r["count"] for r in samples.groupBy("label").count().collect()}
    assert 0 < counts[0] <= int(counts[1] * 1.2)


def test_detector_from_windows_to_boxes(spark):
    """Windows with a feature vector, scored, thresholded, rescaled and suppressed."""
    from fareway.operators import boxes as X
    from fareway.operators import models as L

    images = spark.createDataFrame([(1, 256, 256), (2, 128, 128)], "image INT, width INT, height INT")
    grid = X.window_grid(images, scales=(1.0, 0.5))
    # the signal: windows near the left edge of image 1
    signal = F.when((F.col("image") == 1) & (F.col("x") < 32), 1.0).otherwise(-1.0)
    noise = (F.col("x") * 7 + F.col("y") * 3) % 11 / 50.0
    windows = L.as_vectors(grid.withColumn("v", F.array(signal + noise, noise)).withColumn("label", (signal > 0).cast("int")), "v")
    model = L.scaled_svm(max_iter=20).fit(windows)
    found = detection.detect(windows, model, 0.0)
    assert {r.image for r in found.collect()} == {1}
    assert found.filter("x1 >= 64").isEmpty()
    assert 0 < found.count() < windows.filter("label = 1").count()
    truth = found.select("image", F.col("det_id").alias("object_id"), "x1", "y1", "x2", "y2")
    rated = detection.evaluate(found, truth).first()
    assert (rated["tp"], rated["fp"], rated["fn"]) == (found.count(), 0, 0)


def test_served_alerts_from_a_stored_stream(spark, sf_dir, tmp_path):
    from fareway.sources import streams

    messages = streams.reading_messages(B.readings_of(B.event_stream(spark, sf_dir), congestion.roads_table(spark)))
    congestion.start(messages, str(tmp_path / "sink"), str(tmp_path / "state")).awaitTermination()
    served = congestion.served(spark, str(tmp_path / "sink")).collect()
    assert 0 < len(served) <= 30
    assert [r.severity for r in served] == sorted((r.severity for r in served), key=lambda s: s != "severe")


def test_limits_are_arguments(spark, sf_dir):
    from fareway.operators.cleaning import clean_trips

    wide = clean_trips(B.trips(spark, sf_dir), TripLimits(10_000, 10_000, 10_000, 100)).count()
    assert wide > B.clean(spark, sf_dir).count()


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) >= 100 and len(e.oracle_sql()) >= 100"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
