from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fareway.operators import models as L
from fareway.plans import demand


def planted(spark, n_days=12):
    """Demand that depends on hour and zone."""
    rng = random.Random(3)
    rows = [
        (d, h, d % 7, int(d % 7 > 4), f"zone_{z}", rng.random(), rng.random(), rng.random(),
         int(20 * z + 3 * h + (30 if h > 16 else 0) + rng.randrange(4)))
        for d in range(n_days) for h in range(24) for z in range(5)
    ]
    return spark.createDataFrame(
        rows, "pickup_date INT, pickup_hour INT, pickup_weekday INT, is_weekend INT, pickup_zone STRING,"
        " avg_distance DOUBLE, avg_fare DOUBLE, avg_duration_min DOUBLE, demand INT")


def test_models_beat_the_mean(spark, tmp_path):
    models = demand.train_demand_models(planted(spark), trees=20, depth=6)
    metrics = {r.model: r for r in models.metrics().collect()}
    assert metrics["baseline_mean"].r2 < 0.05
    assert metrics[demand.LINEAR].r2 > 0.8
    assert metrics[demand.FOREST].r2 > 0.9
    assert metrics[demand.FOREST].rmse < metrics["baseline_mean"].rmse / 3
    assert L.best_model(models.metrics()).first().model == max(metrics, key=lambda m: metrics[m].r2)
    table = models.predictions(10).collect()
    assert len(table) == 10 and table[0].pickup_date == 0
    models.save(str(tmp_path))
    again = L.load_model(f"{tmp_path}/{demand.FOREST}").transform(models.test)
    assert again.exceptAll(models.forest.transform(models.test)).isEmpty()


def test_scaled_features_variant(spark):
    models = demand.train_demand_models(planted(spark, 4), trees=5, depth=4, min_leaf=2, scale=True)
    assert models.metrics().filter("r2 > 0.5").count() == 2


def test_feature_vector_order(spark):
    df = planted(spark, 1)
    vector = L.demand_pipeline(L.linear_model()).fit(df).transform(df).filter("pickup_hour = 9").first()
    assert list(vector.features)[:3] == [9.0, 0.0, 0.0]
    assert len(vector.features) == 6 + 5


def test_metrics_agree_with_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.range(200).selectExpr("CAST(id % 17 AS DOUBLE) AS demand", "CAST(id % 13 AS DOUBLE) AS prediction")
    row = L.regression_metrics(df).first()
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="demand", predictionCol="prediction", metricName=name).evaluate(df)
        assert row[name] == pytest.approx(want, abs=5.1e-5)
    constant = spark.createDataFrame([(1.0, 2.0)], "demand DOUBLE, prediction DOUBLE")
    assert L.regression_metrics(constant).first().r2 is None


def test_hash_split_does_not_depend_on_partitioning(spark):
    df = planted(spark)
    a, b = L.hash_split(df), L.hash_split(df.repartition(13, "pickup_hour"))
    assert a[0].exceptAll(b[0]).isEmpty() and b[0].exceptAll(a[0]).isEmpty()
    assert a[0].count() + a[1].count() == df.count()
    assert 0.7 < a[0].count() / df.count() < 0.8


@pytest.mark.parametrize("percent", [80, 0, 100])
def test_stratified_split_is_exact_per_label(spark, percent):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("label"))
    split = L.stratified_split(df, "label", "id", percent)
    assert split.columns == ["id", "label", "in_train"]
    for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("in_train").alias("t")).collect():
        assert r.t == r.n * percent // 100
    again = L.stratified_split(df.repartition(11), "label", "id", percent)
    assert split.exceptAll(again).isEmpty()


def test_stratified_split_with_an_unknown_label(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, 1).alias("label"))
    counts = {r.label: r.t for r in L.stratified_split(df, "label", "id").groupBy("label").agg(F.count_if("in_train").alias("t")).collect()}
    assert counts == {1: 40, None: 40}


def test_svm_separates_a_planted_signal(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(2.0 if i % 2 else -2.0, 1.0), rng.gauss(0, 50)], i % 2) for i in range(300)]
    df = L.as_vectors(spark.createDataFrame(rows, "id INT, v ARRAY<DOUBLE>, label INT"), "v")
    train, test = L.hash_split(df, ["id"], 1)
    scored = L.decision_values(L.scaled_svm(max_iter=20).fit(train).transform(test))
    report = {r["class"]: r for r in L.class_report(scored.withColumn("prediction", F.col("prediction").cast("int"))).collect()}
    assert report[0].recall > 0.9 and report[1].recall > 0.9
    assert scored.filter((F.col("decision") > 0) != (F.col("prediction") == 1)).isEmpty()
    kept = L.decision_values(L.scaled_svm(max_iter=20).fit(train).transform(test), 0.5)
    assert 0 < kept.count() < scored.count()


def test_class_report_with_an_unpredicted_class(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "label INT, prediction INT")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in L.class_report(df).collect()}
    assert got == {0: (0.0, 0.0, 0.0, 0), 1: (1.0, 0.5, 0.6667, 2), 2: (0.0, 0.0, 0.0, 1)}


def test_linear_scores(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([0.5, -1.0],)], "embedding ARRAY<FLOAT>")
    assert [r.decision for r in L.linear_scores(df, [2.0, 3.0], -1.0).collect()] == [7.0, -3.0]


def test_counts_and_stack(spark):
    both = L.label_and_stack(spark.range(4), spark.range(6))
    row = L.sample_counts(both).first()
    assert (row.positives, row.negatives, row.negatives_per_positive) == (4, 6, 1.5)
    assert L.sample_counts(both.limit(0)).first().negatives_per_positive is None


def test_full_matrix_and_averages(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "label INT, prediction INT")
    cells = {(r.label, r.prediction): r["rows"] for r in L.full_confusion_matrix(df).collect()}
    assert cells == {(a, b): {(1, 1): 1, (1, 0): 1, (2, 0): 1}.get((a, b), 0) for a in (0, 1, 2) for b in (0, 1, 2)}
    got = {r.average: (r.precision, r.recall, r.f1, r.support) for r in L.report_averages(df).collect()}
    assert got == {
        "accuracy": (None, None, 0.3333, 3),
        "macro avg": (0.3333, 0.1667, 0.2222, 3),
        "weighted avg": (0.6667, 0.3333, 0.4444, 3),
    }
    assert L.full_confusion_matrix(df.limit(0)).count() == 0


def test_zone_line_agrees_with_the_library(spark):
    """Predictions of one-hot least squares; a feature that repeats another changes none."""
    df = planted(spark, 6).filter("pickup_zone <> 'zone_3' OR pickup_date < 4")
    line = L.fit_zone_line(df)
    library = L.linear_model().setMaxIter(2000).setTol(1e-14)
    both = line.transform(L.demand_pipeline(library).fit(df).transform(df).withColumnRenamed("baseline_prediction", "want"))
    assert both.agg(F.max(F.abs(F.col("want") - F.col("baseline_prediction")))).first()[0] < 1e-6
    repeated = df.withColumn("avg_fare", F.col("avg_distance") * 5)
    names = [c for c in L.NUMERIC_FEATURES if c != "avg_fare"]
    want = L.fit_zone_line(repeated, numeric=names).transform(repeated, "want")
    both = L.fit_zone_line(repeated).transform(want)
    assert both.agg(F.max(F.abs(F.col("want") - F.col("baseline_prediction")))).first()[0] < 1e-6
    one = df.limit(1)
    assert line.transform(one.withColumn("pickup_zone", F.lit("nowhere"))).first().baseline_prediction is not None
    assert line.transform(one.withColumn("avg_distance", F.lit(None).cast("double"))).first().baseline_prediction is None
    with pytest.raises(ValueError, match="complete rows"):
        L.fit_zone_line(df.limit(0))


def test_zone_line_of_a_million_zones(spark, tmp_path):
    n = 1_000_000
    e = F.col("id") % n
    df = spark.range(2 * n).select(
        e.cast("string").alias("pickup_zone"), (F.hash("id") % 100 / 10).alias("a"), (F.col("id") % 7).alias("b"))
    df = df.withColumn("demand", 3 * F.col("a") - 2 * F.col("b") + F.col("pickup_zone").cast("long") % 11)
    line = L.fit_zone_line(df, numeric=("a", "b"))
    assert line.coefficients == pytest.approx((3, -2)) and line.levels.count() == n
    line.save(str(tmp_path))
    again = L.load_zone_line(spark, str(tmp_path), ("a", "b"))
    assert again.transform(df).filter(F.abs(F.col("demand") - F.col("baseline_prediction")) > 1e-6).isEmpty()
    assert L.zone_numbers(df).agg(F.max("zone_index"), F.count_distinct("zone_index")).first() == (n - 1, n)


def test_many_zones_share_hashed_places(spark):
    df = planted(spark, 2)
    assert len(L.zone_stages(df, places=5)) == 2 and len(L.zone_stages(df, places=4)) == 1
    model = L.demand_pipeline(L.forest_model(trees=4, depth=4), encoded=L.zone_stages(df, places=4)).fit(df)
    scored = model.transform(df)
    assert scored.first().features.size == 6 + 4
    assert L.regression_metrics(scored, prediction="improved_prediction").first().r2 > 0.5


def test_squared_hinge_machine_is_the_least(spark):
    """No lower objective by a plain solver; the decision is w·x + b in SQL."""
    import duckdb
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6))
    x[:, 5] *= 30
    y = np.where(x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=400) > 0.3, 1, 0)
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, y))] + [(400, None, 1)], "id INT, scaled ARRAY<DOUBLE>, label INT")
    for c in (0.01, 1.0):
        machine = L.squared_hinge_svm(df.repartition(5), c=c)
        a, side, w = np.c_[x, np.ones(400)], np.where(y == 1, 1.0, -1.0), np.zeros(7)

        def value(w):
            return 0.5 * w @ w + c * (np.maximum(0, 1 - side * (a @ w)) ** 2).sum()

        for _ in range(20_000):
            gap = np.maximum(0, 1 - side * (a @ w))
            slope, step = w - 2 * c * (side * gap) @ a, 1.0
            while value(w - step * slope) > value(w) - 1e-4 * step * slope @ slope and step > 1e-12:
                step /= 2
            w = w - step * slope
            if np.linalg.norm(slope) < 1e-5:
                break
        got = np.r_[machine.weights, machine.bias]
        assert machine.objective == pytest.approx(value(got)) and machine.objective <= value(w) + 1e-6
        rows = machine.transform(df.filter("scaled IS NOT NULL")).select("id", "scaled", "decision", "prediction").toPandas()  # noqa: F841
        wrong = duckdb.sql(f"""SELECT count(*) FROM rows WHERE abs(decision - (list_dot_product(CAST(scaled AS DOUBLE[]), {list(machine.weights)}::DOUBLE[]) + {machine.bias})) > 1e-9
            OR (decision > 0) <> (prediction = 1)""").fetchall()[0][0]
        assert wrong == 0
    with pytest.raises(ValueError, match="components"):
        L.squared_hinge_svm(df.limit(0))


def test_matrix_of_too_many_classes_is_refused(spark, monkeypatch):
    monkeypatch.setattr(L, "_MOST_CLASSES", 2)
    with pytest.raises(Exception, match="more than 2 classes"):
        L.full_confusion_matrix(spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "label INT, prediction INT")).collect()


def test_many_training_rows_are_dealt_over_more_tasks(spark):
    rows = spark.range(1_000).selectExpr("DATE'2024-01-01' AS pickup_date", "1 AS pickup_hour", "id AS pickup_zone").coalesce(1)
    dealt = demand._dealt(rows, 50)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1_000 and len(sizes) >= 18 and max(sizes) <= 100
    assert dealt.exceptAll(rows).isEmpty()
    assert demand._dealt(rows, 1_000) is rows
