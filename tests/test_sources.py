from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fareway.constants import flat_schema
from fareway.operators import models as L
from fareway.operators import reports as R
from fareway.sources import tables as io


def test_csv_needs_a_schema_and_reads_bad_cells_as_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\nbad,y\n")
    path = str(tmp_path / "t.csv")
    with pytest.raises(ValueError):
        io.read_table(spark, path)
    rows = io.read_table(spark, path, flat_schema("a INT, b STRING")).collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (None, "y")]
    with pytest.raises(ValueError):
        io.read_table(spark, path, fmt="orc")


def test_write_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    io.write_table(spark.range(10), path)
    io.write_table(spark.range(3), path)
    assert io.read_table(spark, path).count() == 3


def test_partitioned_write_prunes_months(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(30).select("id", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"))
    io.write_table(df, path, partition_by=["month"])
    back = spark.read.schema(df.schema).parquet(path).filter("month = '2024-02'")
    assert back.count() == 10
    assert "PartitionFilters: [isnotnull(month" in back._jdf.queryExecution().toString()


def test_csv_export(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    io.export_csv(spark.range(4).withColumn("name", F.lit("a,b")), path)
    back = io.read_table(spark, path, flat_schema("id BIGINT, name STRING"))
    assert sorted(map(tuple, back.collect())) == [(i, "a,b") for i in range(4)]


def test_record_export_is_ordered_and_bounded(spark, tmp_path):
    path = tmp_path / "out.json"
    df = spark.range(100).selectExpr("id", "DATE '2024-01-01' AS day", "CAST(NULL AS INT) AS gap").repartition(5)
    io.export_records(df, str(path), [F.desc("id")], 7)
    lines = [json.loads(x) for f in sorted(path.glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["id"] for x in lines] == list(range(99, 92, -1))
    assert lines[0] == {"id": 99, "day": "2024-01-01", "gap": None}


def test_source_profile(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(10).repartition(2).write.parquet(path)
    rows = io.source_profile(spark, path).collect()
    assert sum(r.rows for r in rows) == 10 and len(rows) == 2
    assert all(r.file_size_bytes > 0 and r.columns == ["id"] for r in rows)


def test_bundle_ranks_and_limits(spark):
    df = spark.range(9).selectExpr("id", "CAST(NULL AS STRING) AS name")
    rows = R.dashboard_bundle({"a": R.Section(df, [F.desc("id")], 2), "b": R.Section(df, ["id"])}).collect()
    assert [(r.section, r["rank"]) for r in rows if r.section == "a"] == [("a", 1), ("a", 2)]
    assert json.loads(rows[0].record) == {"id": 8, "name": None}
    assert len(rows) == 11


def test_stack_fills_missing_columns(spark):
    a, b = spark.range(1), spark.range(1).withColumn("extra", F.lit("x"))
    rows = sorted(tuple(r) for r in R.stack_tables({"a": a, "b": b}).select("table", "extra").collect())
    assert rows == [("a", None), ("b", "x")]


def test_model_storage(spark, tmp_path):
    rows = [(d, h, d % 7, int(d % 7 > 4), f"zone_{z}", 1.0, 2.0, 3.0, float(z * 10 + h))
            for d in range(4) for h in range(6) for z in range(3)]
    df = spark.createDataFrame(rows, "pickup_date INT, pickup_hour INT, pickup_weekday INT, is_weekend INT,"
                               " pickup_zone STRING, avg_distance DOUBLE, avg_fare DOUBLE, avg_duration_min DOUBLE, demand DOUBLE")
    model = L.demand_pipeline(L.linear_model()).fit(df)
    L.save_model(model, str(tmp_path / "m"))
    L.save_model(model, str(tmp_path / "m"))
    again = L.load_model(str(tmp_path / "m"))
    unseen = df.limit(2).withColumn("pickup_zone", F.lit("zone_99"))
    for table in (df, unseen):
        a = [r.baseline_prediction for r in model.transform(table).collect()]
        b = [r.baseline_prediction for r in again.transform(table).collect()]
        assert a == b and len(a) == table.count()
