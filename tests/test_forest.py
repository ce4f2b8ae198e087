from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from fareway.operators import forest, models as L
from fareway.plans import demand


def trips(spark, rows, zones=60):
    """Demand that depends on everything; some rows have no zone."""
    i = F.col("id")
    df = spark.range(rows, numPartitions=3).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int")).alias("pickup_date"),
        (i % 24).cast("int").alias("pickup_hour"), (i % 7).cast("int").alias("pickup_weekday"), (i % 7 > 4).cast("int").alias("is_weekend"),
        F.when(i % 41 != 0, F.concat(F.lit("z"), F.floor(F.pow(F.rand(1), 2) * zones))).alias("pickup_zone"),
        (F.rand(2) * 20 - 3).alias("avg_distance"), F.round(F.rand(3) * 9).alias("avg_fare"), F.randn(4).alias("avg_duration_min"))
    level = F.abs(F.hash("pickup_zone")) % 40
    return df.withColumn("demand", (F.col("pickup_hour") + level + F.floor(F.col("avg_distance") / 4) * F.floor("avg_fare")).cast("int"))


def nodes(spark, model, path):
    model.write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").orderBy("treeID", "nodeData.id").collect()


def pipeline(df, places=4_096, memory=256, **kind):
    return L.demand_pipeline(L.forest_model(**kind).setMaxMemoryInMB(memory), encoded=L.zone_stages(df, places=places))


@pytest.mark.parametrize("rows, kind", [
    (400, {"trees": 7, "depth": 5}),
    (12_000, {"trees": 6, "depth": 8, "min_leaf": 3}),
    (12_000, {"trees": 4, "depth": 5, "places": 32}),
    (3_000, {"trees": 3, "depth": 3, "memory": 0}),
    (500, {"trees": 1, "depth": 4}),
])
def test_trees_are_those_of_the_estimator(spark, tmp_path, rows, kind):
    """Every node: split, threshold, sums, impurity and gain. Beyond 10,000 rows thresholds come from a sample; without memory a node is split at a time."""
    df = trips(spark, rows).cache()
    assert df.count() == rows
    want = pipeline(df, **kind).fit(df)
    got = forest.fit(pipeline(df, **kind), df, len(L.NUMERIC_FEATURES))
    assert nodes(spark, got.stages[-1], f"{tmp_path}/got") == nodes(spark, want.stages[-1], f"{tmp_path}/want")
    assert got.transform(df).select("improved_prediction").collect() == want.transform(df).select("improved_prediction").collect()
    df.unpersist()


def test_demand_models_do_not_visit_all_places(spark, monkeypatch):
    """The estimator's own fit visits a third of all places for each row."""
    def refused(*_):
        raise AssertionError("all places are visited for each row")

    monkeypatch.setattr(RandomForestRegressor, "_fit", refused)
    models = demand.train_demand_models(trips(spark, 600), trees=3, depth=3)
    assert models.forest.stages[-1].getNumTrees == 3
    assert models.predictions(10).count() == 10


def test_predictions_are_those_of_the_estimator(spark, monkeypatch):
    """As in demand_predictions: rows, order and every digit, and the estimator does not grow the trees."""
    df = trips(spark, 1_500)
    with monkeypatch.context() as m:
        m.setattr(RandomForestRegressor, "_fit", lambda *_: pytest.fail("all places are visited for each row"))
        models = demand.train_demand_models(df, trees=5, depth=4)
    want = pipeline(models.train, trees=5, depth=4).fit(demand._dealt(models.train))
    got = models.predictions(200).collect()
    assert got == L.predictions(want.transform(models.test), 200).collect()
    assert len(got) == 200 and got == sorted(got, key=lambda r: (r.pickup_date, r.pickup_hour, r.pickup_zone is not None, r.pickup_zone))


def test_rows_of_a_hot_place_are_spread(spark, monkeypatch):
    monkeypatch.setattr(forest, "_LEAST_ROWS", 500)
    df = trips(spark, 4_000).withColumn("pickup_zone", F.when(F.col("pickup_hour") > 1, "hot").otherwise(F.col("pickup_zone")))
    prepared = Pipeline(stages=pipeline(df).getStages()[:-1]).fit(df).transform(df)
    kept = []
    monkeypatch.setattr(forest, "_grown", lambda bagged, *_: kept.append(bagged) or [])
    monkeypatch.setattr(forest, "_model", lambda *_: None)
    forest.grow(prepared, L.forest_model(trees=3), 6)
    sizes = [r["count"] for r in kept[0].groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4_000 and len(sizes) == 8 and max(sizes) < 800


def test_sums_follow_the_rows_and_not_the_places():
    rng = np.random.default_rng(1)
    rows, numbers, places = 50, 3, 4_000
    shape = forest._Shape(numbers, places, numbers + places, True, (np.arange(31.0),) * numbers, np.ones(places, bool), 1, 0.0)
    values = np.concatenate([rng.integers(0, 32, (rows, numbers)), rng.integers(-1, places, (rows, 1))], axis=1).astype(np.int32)
    block = forest._Block(values, rng.integers(1, 9, rows).astype(float), rng.integers(0, 3, (1, rows)).astype(np.uint8))
    piece = forest._piece(0, forest._Tree(), [0], np.arange(shape.features)[None], shape)
    cells, sums = forest._cells(block, piece, shape)
    assert len(cells) == len(set(cells)) <= rows * (numbers + 1) + 1
    weight, at = block.counts[0].astype(float), dict(zip(cells.tolist(), sums.tolist(), strict=True))
    for place in range(places):
        here = values[:, numbers] == place
        want = [float((weight * block.label**p)[here].sum()) for p in range(3)]
        assert at.get(numbers * shape.bins + place, [0.0] * 3) == want
    assert at[shape.width - 1] == [float((weight * block.label**p).sum()) for p in range(3)]


def test_large_nodes_counts_are_cut_into_pieces(spark, tmp_path, monkeypatch):
    df = trips(spark, 2_000).cache()
    whole = forest.fit(pipeline(df, trees=3, depth=6), df, 6)
    monkeypatch.setattr(forest, "_PIECE_NODES", 3)
    monkeypatch.setattr(forest, "_LEAST_ROWS", 100)
    monkeypatch.setattr(forest, "_BLOCK_ROWS", 64)
    cut = forest.fit(pipeline(df, trees=3, depth=6), df, 6)
    assert nodes(spark, cut.stages[-1], f"{tmp_path}/cut") == nodes(spark, whole.stages[-1], f"{tmp_path}/whole")


def test_rows_that_cannot_be_learned_from_are_refused(spark):
    df = trips(spark, 50)
    stages = L.zone_stages(df)
    with pytest.raises(Exception, match="NaN or infinite"):
        forest.fit(L.demand_pipeline(L.forest_model(trees=2), encoded=stages), df.withColumn("avg_fare", F.lit(None).cast("double")), 6)
    with pytest.raises(ValueError, match="no rows"):
        prepared = Pipeline(stages=L.demand_pipeline(L.forest_model(), encoded=stages).getStages()[:-1]).fit(df).transform(df)
        forest.grow(prepared.limit(0), L.forest_model(), 6)
    with pytest.raises(ValueError, match="numbers must come first"):
        forest.grow(prepared, L.forest_model(), 5)
    with pytest.raises(ValueError, match="a third"):
        forest.grow(prepared, L.forest_model().setFeatureSubsetStrategy("sqrt"), 6)
