from __future__ import annotations

import random

import numpy as np
import pytest

from fareway.operators import profile as P


def values(kind, n=1000):
    rng = random.Random(7)
    return {
        "spread": [rng.uniform(-5, 500) for _ in range(n)],
        "hot": [42.0] * (n // 3) + [rng.choice([1.0, 2.5, 42.0, 1e6]) for _ in range(n)],
        "constant": [3.0] * 17,
        "single": [8.25],
        "two": [1.0, 2.0],
        "huge": [1e300, -1e300, 0.0, 5.0],
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "hot", "constant", "single", "two", "huge"])
def test_exact_quartiles(spark, kind):
    data = values(kind)
    df = spark.createDataFrame([(v,) for v in data] + [(None,), (float("nan"),)], "v DOUBLE")
    row = P.numeric_summary(df, ["v"], exact=True).first()
    assert row["count"] == len(data)
    assert [row.min, row.max] == [min(data), max(data)]
    want = np.percentile(data, [25, 50, 75])
    assert [row.q25, row.q50, row.q75] == pytest.approx(list(want), rel=1e-12)


def test_approximate_quartiles_are_values_near_the_rank(spark):
    df = spark.range(100_001).selectExpr("CAST(id AS DOUBLE) AS v")
    row = P.numeric_summary(df, ["v"]).first()
    assert abs(row.q50 - 50_000) <= 20
    assert row.stddev == pytest.approx(np.std(np.arange(100_001), ddof=1))


def test_missing_profile_of_odd_names(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "x")], "`a.b` DOUBLE, c STRING")
    plain = {r.column: r.missing_count for r in P.missing_profile(df).collect()}
    with_nan = {r.column: r.missing_count for r in P.missing_profile(df, nan=True).collect()}
    assert plain == {"a.b": 0, "c": 1}
    assert with_nan == {"a.b": 1, "c": 1}


def test_checks(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "model STRING, r2 DOUBLE")
    rules = [
        P.Rule("m", "rows", floor=2),
        P.Rule("m", "rows", floor=3),
        P.Rule("m", "columns", ("model", "r2")),
        P.Rule("m", "columns", ("model", "rmse")),
        P.Rule("m", "filled", ("model",)),
        P.Rule("m", "filled", ("r2",)),
        P.Rule("m", "filled", ("absent",)),
        P.Rule("m", "values", ("model",), values=("a", "b")),
        P.Rule("m", "values", ("model",), values=("a", "z")),
    ]
    got = [r.ok for r in P.expectations({"m": df}, rules).collect()]
    assert got == [True, False, True, False, True, False, False, True, False]
    empty = {r.rule: r.ok for r in P.expectations({"m": df.limit(0)}, rules[:1] + rules[2:3]).collect()}
    assert list(empty.values()) == [False, True]


def test_manifest(spark):
    rows = P.manifest({"t": (spark.range(3), "p/t")}).collect()
    assert [tuple(r) for r in rows] == [("t", "p/t", 3, ["id"])]


def test_exact_quartiles_beside_an_outlier(spark):
    values = [float(i % 997) for i in range(20_000)] + [1e12, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    row = P.numeric_summary(df, ["v"], exact=True).first()
    assert (row.q25, row.q50, row.q75) == tuple(np.percentile(values, [25, 50, 75]))


def test_rules_on_sections(spark):
    rows = [("model.metrics", 1, '{"model":"a","r2":0.5}'), ("model.metrics", 2, '{"model":"b","r2":1.5}'), ("empty", 1, None), ("odd", 1, "no json")]
    bundle = spark.createDataFrame(rows, "section STRING, rank INT, record STRING")
    numbers = spark.createDataFrame([(0.0,), (2.0,), (float("nan"),), (None,)], "v DOUBLE")
    rules = [
        P.Rule("b", "sections", values=("model.metrics", "empty", "absent")),
        P.Rule("b", "keys", ("model", "r2"), section="model.metrics"),
        P.Rule("b", "keys", ("model", "mae"), section="model.metrics"),
        P.Rule("b", "keys", ("model",), section="odd"),
        P.Rule("b", "bounds", ("r2",), section="model.metrics", high=1.0),
        P.Rule("b", "values", ("model",), values=("a", "b", "c"), section="model.metrics"),
        P.Rule("b", "filled", ("mae",), section="model.metrics"),
        P.Rule("b", "rows", floor=2, section="model.metrics"),
        P.Rule("n", "bounds", ("v",), low=0.0, high=1.0),
    ]
    got = [(r.observed, r.needed, r.ok) for r in P.expectations({"b": bundle, "n": numbers}, rules).collect()]
    assert got == [(1, 3, False), (0, 0, True), (-2, 0, False), (-1, 0, False), (-1, 0, False), (2, 3, False), (-2, 0, False), (2, 2, True), (-3, 0, False)]
    with pytest.raises(ValueError):
        P.expectations({"b": bundle}, [P.Rule("b", "columns", ("x",), section="odd")])


def test_quartiles_of_kept_sketches(spark):
    df = spark.range(50_000).selectExpr("id % 7 AS day", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 11 = 0 THEN double('NaN') ELSE id * id END AS v")
    cube = P.sketch_cube(df, ["day"], ["v"])
    found = P.rank_distances(df, P.sketch_quartiles(cube, columns=["v"]), ["v"]).collect()
    assert len(found) == 3 and all(r.distance < 0.01 for r in found)
    by_day = P.sketch_quartiles(cube, ["day"], ["v"])
    assert by_day.count() == 21
    assert P.sketch_quartiles(cube.limit(0), columns=["v"]).count() == 0
