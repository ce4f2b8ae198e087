"""Samples, scoring and evaluation of a window detector."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.constants import BACKGROUND_RATIO
from fareway.operators import boxes, models
from fareway.session import materialize


def training_boxes(
    images: DataFrame, truth: DataFrame, seed: int = 42, ratio: float = BACKGROUND_RATIO
) -> DataFrame:
    """Large enough true boxes with label 1, random background boxes with label 0."""
    positive = boxes.min_box(truth)
    cap = positive.agg(F.floor(F.count("*") * ratio).alias("n")).scalar()
    negative = boxes.sample_background(images, truth, cap=cap, seed=seed)
    columns = ["image", "x1", "y1", "x2", "y2"]
    return models.label_and_stack(positive.select(*columns), negative.select(*columns))


def detect(
    windows: DataFrame, model: PipelineModel, threshold: float = 0.5, suppression: float = 0.3
) -> DataFrame:
    """Score windows that carry a feature vector, keep the good ones, suppress overlaps."""
    return detections(models.decision_values(model.transform(windows)), threshold, suppression)


def detections(scored: DataFrame, threshold: float = 0.5, suppression: float = 0.3) -> DataFrame:
    """The best of overlapping windows whose ``decision`` reaches ``threshold``; det_id is a hash of the box."""
    good = boxes.above_score(scored, threshold, "decision")
    found = boxes.rescale_boxes(good).select(
        "image", "x1", "y1", "x2", "y2", F.col("decision").alias("score")
    )
    found = found.withColumn("det_id", F.xxhash64("image", "x1", "y1", "x2", "y2"))
    # written, as suppression reads them more than once and they are few among the windows
    return boxes.nms(materialize(found, "good-windows"), suppression)


def evaluate(
    dets: DataFrame,
    truth: DataFrame,
    threshold: float = 0.5,
    suppression: float | None = 0.3,
    score: float | Column | None = None,
) -> DataFrame:
    """Precision, recall and F1 of detections against true boxes; suppressed once, then read back by the counts and the pairs."""
    kept = dets if score is None else boxes.above_score(dets, score)
    if suppression is not None:
        kept = boxes.nms(kept, suppression)
    kept = materialize(kept, "kept-detections")
    return boxes.detection_totals(boxes.match_boxes(kept, truth, threshold))
