from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fareway.operators import boxes as X
from fareway.plans import detection

BOX = "image INT, id BIGINT, x1 INT, y1 INT, x2 INT, y2 INT, score DOUBLE"


def overlap(a, b, epsilon=0.0):
    w = max(0, min(a[2], b[2]) - max(a[0], b[0]))
    h = max(0, min(a[3], b[3]) - max(a[1], b[1]))
    if w * h == 0:
        return 0.0
    area = lambda c: (c[2] - c[0]) * (c[3] - c[1])
    return w * h / (area(a) + area(b) - w * h + epsilon)


def random_boxes(seed, images, hot=0, copies=0):
    """Boxes of very different sizes; one image holds ``hot`` more, and copies of one box."""
    rng = random.Random(seed)
    out, number = [], 0

    def add(image, box=None):
        nonlocal number
        if box is None:
            side = rng.choice([1, 3, 20, 60, 200, 900])
            x, y = rng.randrange(-50, 400), rng.randrange(-50, 300)
            box = (x, y, x + rng.randrange(0, side) + rng.randrange(2), y + rng.randrange(side) + 1)
        number += 1
        out.append((image, number, *box, rng.randrange(1000) / 1000))

    for image in range(images):
        for _ in range(rng.randrange(1, 25)):
            add(image)
    for _ in range(hot):
        add(0)
    for _ in range(copies):
        add(0, (10, 10, 70, 130))
    return out


def loop_nms(rows, threshold):
    kept = []
    for row in sorted(rows, key=lambda r: (-r[6], r[2:6], r[1])):
        if all(row[0] != k[0] or overlap(row[2:6], k[2:6], 1e-6) < threshold for k in kept):
            kept.append(row)
    return sorted((r[0], *r[2:6], r[6]) for r in kept)


def loop_match(preds, truth, threshold):
    out = {}
    for image in {r[0] for r in preds} | {r[0] for r in truth}:
        mine = sorted((r for r in preds if r[0] == image), key=lambda r: (-r[6], r[1]))
        boxes = sorted((r for r in truth if r[0] == image), key=lambda r: r[1])
        taken = set()
        for p in mine:
            best, which = 0.0, None
            for t in boxes:
                value = overlap(p[2:6], t[2:6])
                if t[1] not in taken and value > best:
                    best, which = value, t[1]
            if which is not None and best >= threshold:
                taken.add(which)
        tp = len(taken)
        out[image] = (tp, len(mine) - tp, len(boxes) - tp, len(boxes), len(mine))
    return out


@pytest.mark.parametrize("seed,hot,copies,threshold", [(1, 0, 0, 0.45), (2, 150, 0, 0.3), (3, 60, 90, 0.05)])
def test_suppression_equals_a_loop(spark, seed, hot, copies, threshold):
    rows = random_boxes(seed, 6, hot, copies)
    df = spark.createDataFrame(rows, BOX)
    want = loop_nms(rows, threshold)
    for limit in (2000, 20, 1) if hot else (2000, 20):
        kept = X.nms(df, threshold, fold_limit=limit)
        assert kept.columns == df.columns
        assert sorted((r.image, r.x1, r.y1, r.x2, r.y2, r.score) for r in kept.collect()) == want, limit


def test_rounds_copy_only_crowded_images_to_cells(spark, monkeypatch):
    rows = random_boxes(4, 6, 60, 20)
    df, want = spark.createDataFrame(rows, BOX), loop_nms(rows, 0.3)
    reach, calls = X._in_reach, []
    monkeypatch.setattr(X, "_in_reach", lambda boxes, overlap: calls.append(1) or reach(boxes, overlap))

    def kept(**crowd):
        return sorted((r.image, r.x1, r.y1, r.x2, r.y2, r.score) for r in X.nms(df, 0.3, fold_limit=4, **crowd).collect())

    assert kept() == want and not calls
    # all images, and only the hot one
    for crowd in ((0, 0), (20, 20)):
        assert kept(crowd=crowd) == want and calls, crowd
        calls.clear()


def test_windows_of_few_images_are_dealt_over_all_tasks(spark):
    images = spark.range(40).selectExpr("id AS image", "320 AS width", "260 AS height").coalesce(1)
    parts = X.window_grid(images).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_windows_are_scored_once(spark):
    images = spark.range(4).selectExpr("id AS image", "320 AS width", "260 AS height")
    scored = X.window_grid(images).withColumn("decision", F.lit(0.1) * F.col("scale"))
    found = detection.detections(scored, 0.1)
    assert found.count() and all("good-windows" in name for name in found.inputFiles())


def test_suppression_of_tiny_boxes(spark):
    """Boxes without extent, or too small to reach the threshold, never suppress."""
    df = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 5.0, 0.5)] * 3 + [(1, 0.0, 0.0, 1e-4, 1e-4, 0.5)] * 3,
                               "image INT, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE, score DOUBLE")
    assert X.nms(df).count() == 6
    assert X.nms(df, fold_limit=1).count() == 6


@pytest.mark.parametrize("seed,hot,copies,threshold", [(5, 80, 0, 0.5), (6, 40, 60, 0.2)])
def test_matching_equals_a_loop(spark, seed, hot, copies, threshold):
    preds, truth = random_boxes(seed, 6, hot, copies), random_boxes(seed + 100, 7, hot // 2, copies // 2)
    p = spark.createDataFrame(preds, BOX).withColumnRenamed("id", "det_id")
    t = spark.createDataFrame(truth, BOX).withColumnRenamed("id", "object_id").drop("score")
    want = loop_match(preds, truth, threshold)
    for limit, crowd in ((10**9, X.CROWD), (10**9, (0, 0)), (40, (10**9, 20)), (0, X.CROWD)):
        got = {r.image: (r.tp, r.fp, r.fn, r.n_gt, r.n_pred)
               for r in X.match_boxes(p, t, threshold, fold_limit=limit, crowd=crowd).collect()}
        assert got == want, (limit, crowd)


@pytest.mark.parametrize("limit", [0.0, 0.15, 0.5])
def test_background_equals_a_loop(spark, limit):
    cands, truth = random_boxes(8, 6, 100, 50), random_boxes(9, 6, 30, 10)
    c, t = spark.createDataFrame(cands, BOX), spark.createDataFrame(truth, BOX)
    want = sorted(r[1] for r in cands
                  if not any(k[0] == r[0] and overlap(r[2:6], k[2:6]) > limit for k in truth))
    for crowd in (X.CROWD, (10**9, 20), (30, 10**9), (0, 0)):
        free = X.background_boxes(c, t, limit, crowd=crowd)
        assert free.columns == c.columns
        assert sorted(r.id for r in free.collect()) == want, crowd


def test_thresholds_are_refused_alike(spark):
    df = spark.createDataFrame(random_boxes(12, 1), BOX)
    for wrong in (0, -0.1, 1.1):
        for limit in (2000, 1):
            with pytest.raises(ValueError):
                X.nms(df, wrong, fold_limit=limit)
    for crowd in (X.CROWD, (0, 0)):
        with pytest.raises(ValueError):
            X.background_boxes(df, df, 1.1, crowd=crowd)


def test_repeated_detection_ids(spark):
    spots = [(0, 0, 10, 10), (50, 0, 60, 10), (99, 0, 109, 10)]
    truth = spark.createDataFrame([(1, i, *b) for i, b in enumerate(spots)] + [(1, 7, *spots[0])], "image INT, object_id BIGINT, x1 INT, y1 INT, x2 INT, y2 INT")
    preds = [(1, 7, *spots[0], 0.9), (1, 8, *spots[1], 0.8), (1, 7, *spots[2], 0.7), (1, 7, *spots[0], 0.9), (1, 7, *spots[0], 0.9)]
    dets = spark.createDataFrame(preds, BOX).withColumnRenamed("id", "det_id")
    for limit in (1000, 2, 0):
        assert tuple(X.match_boxes(dets, truth, fold_limit=limit).first()) == (1, 4, 1, 0, 4, 5), limit


def test_reach_covers_every_partner(spark):
    """Each pair over the threshold meets in exactly one cell."""
    a, b = random_boxes(10, 3, 200), random_boxes(11, 3, 200)
    for limit in (0.1, 0.5):
        home = X._at_home(spark.createDataFrame(a, BOX))
        near = X._prefixed(X._in_reach(spark.createDataFrame(b, BOX), limit), "t_")
        met = home.join(near, X._meet("image")).select("image", "id", "t_id").collect()
        pairs = [(r.image, r.id, r.t_id) for r in met]
        assert len(pairs) == len(set(pairs))
        want = {(p[0], p[1], q[1]) for p in a for q in b if p[0] == q[0] and overlap(p[2:6], q[2:6]) >= limit}
        assert want <= set(pairs)


TEXT = """# Compatible with PASCAL Annotation Version 1.00
Image filename : "Set/PNGImages/A1.png"
Objects with ground truth : 2 { "PASpersonWalking" "PASpersonStanding" }
# Details for pedestrian 1 ("PASpersonWalking")
Bounding box for object 1 "PASpersonWalking" (Xmin, Ymin) - (Xmax, Ymax) : (8, 33) - (174, 365)
Pixel mask for object 1 "PASpersonWalking" : "Set/Masks/A1_mask.png"

Bounding box for object 2 "PASpersonStanding" (Xmin, Ymin) - (Xmax, Ymax) : (452, 64) - (483, 353)
"""


def test_annotations(spark, tmp_path):
    from fareway.sources.tables import read_annotations

    (tmp_path / "A1.txt").write_text(TEXT)
    (tmp_path / "B.2.txt").write_text("no boxes here\n")
    texts = read_annotations(spark, str(tmp_path))
    assert sorted(r.image for r in texts.collect()) == ["A1", "B.2"]
    found = X.parse_boxes(texts).orderBy("object_id")
    assert [tuple(r) for r in found.collect()] == [("A1", 1, 8, 33, 174, 365), ("A1", 2, 452, 64, 483, 353)]
    assert [r.object_id for r in X.min_box(found).collect()] == [1]


def test_undefined_rates_are_zero(spark):
    none = spark.createDataFrame([], "tp BIGINT, fp BIGINT, fn BIGINT")
    assert tuple(X.detection_totals(none).first()) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_sampling_is_repeatable_and_capped(spark):
    images = spark.range(40).select(F.col("id").cast("int").alias("image"), F.lit(300).alias("width"),
                                    F.lit(250).alias("height"))
    truth = spark.createDataFrame([(i, 0, 0, 150, 250) for i in range(20)], "image INT, x1 INT, y1 INT, x2 INT, y2 INT")
    full = X.sample_background(images, truth)
    again = X.sample_background(images.repartition(9).union(images), truth)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, again.collect()))
    spread = X.sample_background(images, truth, crowd=(0, 0))
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, spread.collect()))
    assert {r["count"] for r in full.groupBy("image").count().collect()} == {10}
    capped = X.sample_background(images, truth, cap=123).collect()
    want = sorted(map(tuple, full.collect()))[:123]
    assert sorted(map(tuple, capped)) == want
    small = spark.createDataFrame([(1, 20, 20)], "image INT, width INT, height INT")
    assert X.sample_background(small, truth).count() == 0


def test_grid_has_a_window_for_small_images(spark):
    images = spark.createDataFrame([(1, 10, 10), (2, 128, 144)], "image INT, width INT, height INT")
    grid = X.window_grid(images, scales=(1.0,)).collect()
    assert sorted((r.image, r.x, r.y) for r in grid) == [(1, 0, 0)] + [
        (2, x, y) for x in (0, 16, 32, 48, 64) for y in (0, 16)]


def test_evaluate(spark):
    truth = spark.createDataFrame([(1, 1, 0, 0, 100, 200), (1, 2, 300, 0, 400, 200)],
                                  "image INT, object_id BIGINT, x1 INT, y1 INT, x2 INT, y2 INT")
    dets = spark.createDataFrame(
        [(1, 1, 0, 0, 100, 190, 0.9), (1, 2, 2, 0, 100, 200, 0.8), (1, 3, 600, 0, 700, 200, 0.7), (1, 4, 300, 0, 400, 200, 0.1)],
        "image INT, det_id BIGINT, x1 INT, y1 INT, x2 INT, y2 INT, score DOUBLE")
    row = detection.evaluate(dets, truth, score=0.5).first()
    assert (row.tp, row.fp, row.fn, row.precision, row.recall) == (1, 1, 1, 0.5, 0.5)


def rounds_of(monkeypatch, name):
    """How often an intermediate table of that name is written."""
    seen, plain = [], X.materialize
    monkeypatch.setattr(X, "materialize", lambda df, n: (seen.append(n), plain(df, n))[1])
    return lambda: seen.count(name)


def test_a_long_chain_of_boxes_takes_few_rounds(spark, monkeypatch):
    """Each box is suppressed by the one before it alone, so every second one stays."""
    n = 100_000
    df = spark.range(n).selectExpr("1 AS image", "6 * id AS x1", "0 AS y1", "6 * id + 10 AS x2", "10 AS y2", "1 - id / 1e6 AS score")
    written, chains = rounds_of(monkeypatch, "nms-left"), rounds_of(monkeypatch, "chains")
    kept = X.nms(df, 0.2).collect()
    assert sorted(r.x1 for r in kept) == list(range(0, 6 * n, 12))
    assert written() <= 3 and chains() <= 20


def test_a_long_chain_of_pairs_takes_few_rounds(spark, monkeypatch):
    """Each prediction overlaps its own box most, and the next one."""
    n = 3_000
    preds = spark.range(n).selectExpr("1 AS image", "id AS det_id", "10 * id + 3 AS x1", "0 AS y1", "10 * id + 13 AS x2", "10 AS y2", "1 - id / 1e6 AS score")
    truth = spark.range(n).selectExpr("1 AS image", "id AS object_id", "10 * id AS x1", "0 AS y1", "10 * id + 10 AS x2", "10 AS y2")
    written = rounds_of(monkeypatch, "match-left")
    row = X.match_boxes(preds, truth, 0.1, fold_limit=10).first()
    assert (row.tp, row.fp, row.fn) == (n, 0, 0)
    assert written() <= 4
    # the best prediction lies between: all others shift by one box
    shifted = preds.withColumn("x1", F.col("x1") + 4).withColumn("x2", F.col("x2") + 4)
    row = X.match_boxes(shifted, truth, 0.1, fold_limit=10).first()
    assert (row.tp, row.fp, row.fn) == (n - 1 + int(overlap((10 * n - 3, 0, 10 * n + 7, 10), (10 * n - 10, 0, 10 * n, 10)) >= 0.1), 0, 0) or row.tp >= n - 1
