"""Box annotations, detection windows, suppression and matching.

Overlap joins are equi-joins on the image. A crowded image would put all its pairs
into one task, so its boxes are joined on (image, cell) instead: a box lives in one
cell, chosen by its size class and its upper left corner; the other side is copied to
the cells where a partner with enough overlap can live. Two boxes that reach an
overlap of t differ in size by at most 1/t, which bounds the size classes, and they
touch, which bounds the cells, so every qualifying pair meets exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareway.constants import (
    BACKGROUND_ATTEMPTS,
    BACKGROUND_PER_IMAGE,
    GRID_STEP,
    MIN_BOX,
    PYRAMID_SCALES,
    WINDOW_HEIGHT,
    WINDOW_WIDTH,
)
from fareway.functions import columns as C
from fareway.functions.columns import CORNERS
from fareway.operators.numbering import number_rows
from fareway.session import materialize

# fixed value: the box line of an annotation text, its corners as one group
BOX_PATTERN = r"Bounding box for object \d+[^\n]*?:\s*\((\d+,\s*\d+\)\s*-\s*\(\d+,\s*\d+)\)"

NMS_EPSILON = 1e-6
_CELL_SPAN = 8.0
_CELL = ("_level", "_cx", "_cy")


# --- annotations and filters --------------------------------------------------------


def parse_boxes(texts: DataFrame, image: str = "image", text: str = "value") -> DataFrame:
    """One row per box line of an annotation text, numbered in text order.

    The text is searched once; the corners are then split out of the short match.
    """
    lines = F.regexp_extract_all(text, F.lit(BOX_PATTERN), F.lit(1))
    found = texts.select(F.col(image).alias("image"), F.posexplode(lines).alias("pos", "line"))
    numbers = found.withColumn("n", F.split("line", r"\D+"))
    return numbers.select(
        "image",
        (F.col("pos") + 1).alias("object_id"),
        *[F.get("n", F.lit(i)).cast("int").alias(name) for i, name in enumerate(CORNERS)],
    )


def min_box(boxes: DataFrame, size: int = MIN_BOX) -> DataFrame:
    return boxes.filter(
        (F.col("x2") - F.col("x1") >= size) & (F.col("y2") - F.col("y1") >= size)
    )


def above_score(dets: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    return dets.filter(F.col(score) >= threshold)


def annotated_images(images: DataFrame, boxes: DataFrame, image: str = "image") -> DataFrame:
    return images.join(boxes.select(image).distinct(), image, "left_semi")


def class_counts(dets: DataFrame, by: str = "class", image: str = "image") -> DataFrame:
    return dets.groupBy(image, by).agg(F.count("*").alias("detections"))


# --- cells ----------------------------------------------------------------------------


def _longest_side() -> Column:
    return F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).cast("double")


def _level(size: Column) -> Column:
    """Size class; null for a box without extent, which overlaps nothing."""
    return F.when(size > 0, F.ceil(F.log2(size)).cast("int"))


def _cell_no(coordinate: Column, level: Column) -> Column:
    return F.floor(coordinate / (F.pow(F.lit(2.0), level) * _CELL_SPAN))


def _at_home(boxes: DataFrame) -> DataFrame:
    """The one cell a box lives in."""
    level = _level(_longest_side())
    return boxes.withColumn("_level", level).withColumns(
        {
            "_cx": _cell_no(F.col("x1"), F.col("_level")),
            "_cy": _cell_no(F.col("y1"), F.col("_level")),
        }
    )


def _check_overlap(overlap: float, least_open: bool = True) -> None:
    """Same refusal for small and crowded images."""
    if not 0 <= overlap <= 1 or (least_open and overlap == 0):
        raise ValueError(f"the overlap threshold must lie in {'(' if least_open else '['}0, 1]")


def _in_reach(boxes: DataFrame, overlap: float) -> DataFrame:
    """The box copied to every cell where a partner of at least ``overlap`` can live."""
    size = _longest_side()
    lowest = _level(size * (overlap * (1 - 1e-9)))
    highest = _level(size * ((1 + 1e-9) / overlap))
    partner = F.pow(F.lit(2.0), F.col("_level"))

    def cells(low: str, high: str) -> Column:
        return F.explode(
            F.sequence(
                _cell_no(F.col(low) - partner, F.col("_level")),
                _cell_no(F.col(high), F.col("_level")),
            )
        )

    return (
        boxes.withColumn("_level", F.explode(F.sequence(lowest, highest)))
        .withColumn("_cx", cells("x1", "x2"))
        .withColumn("_cy", cells("y1", "y2"))
    )


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + name for name in df.columns])


def _meet(image: str) -> Column:
    """Same image and cell; the reaching side has its columns prefixed with ``t_``."""
    condition = F.col(image) == F.col(f"t_{image}")
    for name in _CELL:
        condition = condition & (F.col(name) == F.col(f"t_{name}"))
    return condition


# boxes per image beyond which its pairs are spread over cells: of the side that asks,
# and of the side that is compared against
CROWD = (50_000, 1_000)


def _side_counts(left: DataFrame, right: DataFrame, image: str) -> DataFrame:
    sides = left.select(image, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(image, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return sides.groupBy(image).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def _crowded(counts: DataFrame, image: str, crowd: tuple[int, int]) -> DataFrame | None:
    """The crowded images as a written table of known size, or none."""
    over = (F.col("n_left") > crowd[0]) | (F.col("n_right") > crowd[1])
    busy = counts.filter(over & F.col(image).isNotNull()).select(image)
    return None if busy.isEmpty() else materialize(busy, "crowded")


def _partners(
    left: DataFrame,
    right: DataFrame,
    condition: Column,
    threshold: float,
    image: str,
    crowded: DataFrame | None,
    how: str,
) -> DataFrame:
    """Join boxes of one image where ``condition`` holds, which must imply an overlap
    of ``threshold``, above 0. Columns of ``right`` get the prefix ``t_``."""

    def plain(a: DataFrame, b: DataFrame) -> DataFrame:
        same = F.col(image) == F.col(f"t_{image}")
        return a.join(_prefixed(b, "t_"), same & condition, how)

    if crowded is None:
        return plain(left, right)
    quiet = plain(left.join(crowded, image, "left_anti"), right.join(crowded, image, "left_anti"))
    near = _prefixed(_in_reach(right.join(crowded, image, "left_semi"), threshold), "t_")
    home = _at_home(left.join(crowded, image, "left_semi"))
    busy = home.join(near, _meet(image) & condition, how)
    return quiet.unionByName(busy.drop(*_CELL, *[f"t_{name}" for name in _CELL]))


# --- background samples ----------------------------------------------------------------


def _free_boxes(
    candidates: DataFrame, truth: DataFrame, max_iou: float, image: str, crowded: DataFrame | None
) -> DataFrame:
    distinct = truth.select(image, *CORNERS).distinct()
    hit = C.iou(C.corners(), C.corners("t_")) > max_iou
    if max_iou == 0 and crowded is not None:
        quiet = _partners(
            candidates.join(crowded, image, "left_anti"), distinct, hit, max_iou, image, None, "left_anti"
        )
        busy = candidates.join(crowded, image, "left_semi")
        return quiet.unionByName(_untouched(busy, distinct.join(crowded, image, "left_semi"), hit, image))
    return _partners(candidates, distinct, hit, max_iou, image, crowded, "left_anti")


def _climbing(boxes: DataFrame, levels: DataFrame, image: str) -> DataFrame:
    """The box copied to the cells, at its own and all larger size classes in ``levels``,
    where a box it touches can live: at most two a side and class."""
    own = _prefixed(levels, "l_")
    higher = (F.col(image) == F.col(f"l_{image}")) & (_level(_longest_side()) <= F.col("l__level"))
    placed = boxes.join(own, higher).withColumn("_level", F.col("l__level")).drop(*own.columns)
    partner = F.pow(F.lit(2.0), F.col("_level"))

    def cells(low: str, high: str) -> Column:
        first = _cell_no(F.col(low) - partner, F.col("_level"))
        return F.explode(F.sequence(first, _cell_no(F.col(high), F.col("_level"))))

    return placed.withColumn("_cx", cells("x1", "x2")).withColumn("_cy", cells("y1", "y2"))


def _untouched(candidates: DataFrame, truth: DataFrame, hit: Column, image: str) -> DataFrame:
    """Candidates that no true box touches. Sizes of a touching pair are unbounded, so
    the smaller box climbs to the size class of the larger one."""

    def levels(boxes: DataFrame) -> DataFrame:
        # a class per doubling of the side: a few dozen rows an image
        return _at_home(boxes).filter("_level IS NOT NULL").select(image, "_level").distinct()

    climbing = _climbing(candidates.select(image, *CORNERS).distinct(), levels(truth), image)
    home = _prefixed(_at_home(truth), "t_")
    small = climbing.join(home, _meet(image) & hit, "left_semi").select(image, *CORNERS).distinct()
    left = candidates.join(small, [image, *CORNERS], "left_anti").select(candidates.columns)
    near = _prefixed(_climbing(truth, levels(candidates), image), "t_")
    return _at_home(left).join(near, _meet(image) & hit, "left_anti").drop(*_CELL)


def background_boxes(
    candidates: DataFrame,
    truth: DataFrame,
    max_iou: float = 0.15,
    image: str = "image",
    crowd: tuple[int, int] = CROWD,
) -> DataFrame:
    """Candidates that overlap no true box of their image by more than ``max_iou``, which may be 0."""
    _check_overlap(max_iou, least_open=False)
    crowded = _crowded(_side_counts(candidates, truth, image), image, crowd)
    return _free_boxes(candidates, truth, max_iou, image, crowded)


def sample_background(
    images: DataFrame,
    truth: DataFrame,
    per_image: int = BACKGROUND_PER_IMAGE,
    cap: int | Column | None = None,
    seed: int = 42,
    attempts: int = BACKGROUND_ATTEMPTS,
    window: tuple[int, int] = (WINDOW_WIDTH, WINDOW_HEIGHT),
    max_iou: float = 0.15,
    crowd: tuple[int, int] = CROWD,
) -> DataFrame:
    """Random background boxes: the first ``per_image`` accepted of ``attempts`` draws
    per image, and at most ``cap`` boxes overall in image order.

    Size and place come from a hash of image and attempt, so the draw does not
    depend on partitioning. Few images need all draws: the first ones are made for
    every image, the others only for images still short of boxes. ``cap`` may be a
    scalar column; since it can grow with the data, it is applied by distributed row
    numbers, not by a sort in one task.
    """
    _check_overlap(max_iou, least_open=False)
    sizes = images.groupBy("image").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    crowded = _crowded(_side_counts(truth.limit(0), truth, "image"), "image", crowd)

    def free(chosen: DataFrame, first: int, last: int) -> DataFrame:
        tries = _draws(chosen, first, last, seed, window)
        return _free_boxes(tries, truth, max_iou, "image", crowded)

    def first_ones(found: DataFrame) -> DataFrame:
        # at most ``attempts`` rows per image, whatever the size of the data
        order = F.row_number().over(Window.partitionBy("image").orderBy("attempt"))
        return found.withColumn("_n", order).filter(F.col("_n") <= per_image).drop("_n")

    early = min(attempts, 4 * per_image)
    chosen = first_ones(free(sizes, 1, early))
    if early < attempts:
        chosen = materialize(chosen, "background")
        served = chosen.groupBy("image").agg(F.count("*").alias("n")).filter(F.col("n") >= per_image)
        short = sizes.join(served, "image", "left_anti")
        chosen = first_ones(chosen.unionByName(free(short, early + 1, attempts)))
    if cap is None:
        return chosen
    numbered = number_rows(chosen, ["image", "attempt"], "_row")
    return numbered.filter(F.col("_row") <= cap).drop("_row")


def _draws(
    images: DataFrame, first: int, last: int, seed: int, window: tuple[int, int]
) -> DataFrame:
    """Boxes of half to one and a half window sizes, drawn inside the image."""
    tries = images.withColumn("attempt", F.explode(F.sequence(F.lit(first), F.lit(last))))
    digest = C.key_digest("image", "attempt", seed=seed)
    scale = F.lit(0.5) + C.digest_bits("_digest", 0) / F.lit(float(2**32))
    sized = tries.withColumn("_digest", digest).withColumns(
        {
            "_w": F.floor(scale * window[0]).cast("int"),
            "_h": F.floor(scale * window[1]).cast("int"),
        }
    ).filter((F.col("_w") <= F.col("width")) & (F.col("_h") <= F.col("height")))
    placed = sized.withColumns(
        {
            "x1": (C.digest_bits("_digest", 1) % (F.col("width") - F.col("_w") + 1)).cast("int"),
            "y1": (C.digest_bits("_digest", 2) % (F.col("height") - F.col("_h") + 1)).cast("int"),
        }
    )
    return placed.select(
        "image",
        "attempt",
        "x1",
        "y1",
        (F.col("x1") + F.col("_w")).alias("x2"),
        (F.col("y1") + F.col("_h")).alias("y2"),
    )


# --- detection windows --------------------------------------------------------------------


def window_grid(
    images: DataFrame,
    scales: Sequence[float] = PYRAMID_SCALES,
    step: int = GRID_STEP,
    window: tuple[int, int] = (WINDOW_WIDTH, WINDOW_HEIGHT),
) -> DataFrame:
    """All window positions of every image at every scale, one window at least.

    An image makes about a thousand rows, so the images are dealt over all tasks before:
    a small table of them would be read as one partition.
    """
    width, height = window
    tasks = int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def scaled(side: str, least: int) -> Column:
        return F.greatest(F.lit(least), F.floor(F.col(side) * F.col("scale")).cast("int"))

    def positions(side: str, least: int) -> Column:
        return F.explode(F.sequence(F.lit(0), scaled(side, least) - least, F.lit(step)))

    return (
        images.select("image", "width", "height")
        .repartition(tasks)
        .withColumn("scale", F.explode(F.array(*[F.lit(float(s)) for s in scales])))
        .withColumn("y", positions("height", height))
        .withColumn("x", positions("width", width))
        .select("image", "scale", "x", "y")
    )


def rescale_boxes(
    windows: DataFrame, window: tuple[int, int] = (WINDOW_WIDTH, WINDOW_HEIGHT)
) -> DataFrame:
    """Window positions back to image coordinates, cut off toward zero."""

    def back(value: Column) -> Column:
        return (value / F.col("scale")).cast("int")

    return windows.withColumns(
        {
            "x1": back(F.col("x")),
            "y1": back(F.col("y")),
            "x2": back(F.col("x") + window[0]),
            "y2": back(F.col("y") + window[1]),
        }
    )


# --- non-maximum suppression -----------------------------------------------------------------


def _suppresses(a: Sequence[Column], b: Sequence[Column], threshold: float) -> Column:
    return C.iou(a, b, NMS_EPSILON) >= threshold


def _struct_corners(box: Column) -> list[Column]:
    return [box.getField(name).cast("double") for name in CORNERS]


def _fold_nms(dets: DataFrame, threshold: float, image: str, score: str) -> DataFrame:
    """Suppression of each image as a fold over its boxes in score order."""
    row = F.struct(
        (-F.col(score)).alias("_rank"), *CORNERS, F.struct(*dets.columns).alias("_row")
    )
    boxes = F.array_sort(F.collect_list(row))

    def step(kept: Column, box: Column) -> Column:
        hit = F.exists(kept, lambda k: _suppresses(_struct_corners(k), _struct_corners(box), threshold))
        return F.when(hit, kept).otherwise(F.concat(kept, F.array(box)))

    grouped = dets.groupBy(image).agg(boxes.alias("_boxes"))
    nothing = F.filter("_boxes", lambda b: F.lit(False))
    kept = grouped.select(F.explode(F.aggregate("_boxes", nothing, step)).alias("_kept"))
    return kept.select("_kept._row.*")


def nms(
    dets: DataFrame,
    threshold: float = 0.3,
    image: str = "image",
    score: str = "score",
    fold_limit: int = 2_000,
    crowd: tuple[int, int] = CROWD,
) -> DataFrame:
    """Greedy non-maximum suppression per image, best score first.

    Equal scores are ordered by coordinates. Images up to ``fold_limit`` boxes are
    folded in one group each. Larger ones are first reduced in rounds that never
    bring an image together: a box that no better box suppresses is final, and what
    it suppresses is gone; a box that one other could suppress follows from that one, so
    a whole chain of them is settled in a round. Both lead to the same boxes as the
    sequential loop, since a box is kept exactly when no kept box suppresses it. Only
    images beyond ``crowd`` have their boxes copied to cells in a round.
    """
    _check_overlap(threshold)
    crowded = _crowded(_side_counts(dets, dets.limit(0), image), image, (fold_limit, 0))
    if crowded is None:
        return _fold_nms(dets, threshold, image, score)
    quiet = _fold_nms(dets.join(crowded, image, "left_anti"), threshold, image, score)
    busy = dets.join(crowded, image, "left_semi")
    return quiet.unionByName(_round_nms(busy, threshold, image, score, fold_limit, crowd)).select(dets.columns)


def _round_nms(
    dets: DataFrame, threshold: float, image: str, score: str, fold_limit: int, crowd: tuple[int, int]
) -> DataFrame:
    # of identical boxes only the best can stay, so copies go before any shuffle of pairs;
    # a box too small to suppress its own copy suppresses nothing and is never suppressed
    own = C.corners()
    flat = ~F.coalesce(_suppresses(own, own, threshold), F.lit(False))
    others = [c for c in dets.columns if c not in (image, score, *CORNERS)]
    best = F.min(F.struct((-F.col(score)).alias("_rank"), F.col(score), *others)).alias("b")
    solid = (
        dets.filter(~flat)
        .groupBy(image, *CORNERS)
        .agg(best)
        .select(image, *CORNERS, F.col(f"b.{score}"), *[F.col(f"b.{c}") for c in others])
        .select(dets.columns)
    )
    result = dets.filter(flat)
    rank = F.struct((-F.col(score)).alias("r"), *CORNERS)
    better = F.struct((-F.col(f"t_{score}")).alias("r"), *[f"t_{c}" for c in CORNERS]) < rank
    hit = _suppresses(C.corners(), C.corners("t_"), threshold)

    place = [image, *CORNERS]
    left = materialize(solid, "nms-left")
    # each box of an image is compared with all, so the smaller of the limits holds
    crowded = _crowded(_side_counts(left, left.limit(0), image), image, (min(crowd), 0))
    while True:
        sizes = left.groupBy(image).agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= fold_limit:
            return result.unionByName(_fold_nms(left, threshold, image, score))
        # how many open boxes may suppress a box, and one of them
        boxes = left.select(image, score, *CORNERS)
        met = _partners(boxes, boxes, better & hit, threshold, image, crowded, "inner")
        blocked = met.groupBy(*place).agg(
            F.count("*").alias("n"), F.max(F.struct(*[F.col(f"t_{c}").alias(c) for c in place])).alias("by")
        )
        blocked = materialize(blocked, "nms-blocked")
        final = materialize(left.join(blocked, place, "left_anti").select(left.columns), "nms-final")
        # a box with a single blocker stays exactly if that one goes
        single = blocked.filter("n = 1").select(F.struct(*place).alias("node"), F.col("by").alias("to"))
        ends = settle_chains(single)
        sure = ends.join(final.select(F.struct(*place).alias("to")), "to", "left_semi")
        sure = materialize(sure.select("node.*", F.col("odd").alias("gone")), "nms-sure")
        stays = left.join(sure.filter("NOT gone"), place, "left_semi").select(left.columns)
        settled = materialize(final.unionByName(stays), "nms-settled")
        result = result.unionByName(settled)
        # a settled box suppresses itself too, so it leaves the remainder as well
        left = left.join(sure.filter("gone"), place, "left_anti").select(left.columns)
        by = settled.select(image, score, *CORNERS)
        left = materialize(_partners(left, by, hit, threshold, image, crowded, "left_anti"), "nms-left")


def settle_chains(links: DataFrame) -> DataFrame:
    """node, to, odd: where each chain of ``links`` (node, to) ends, and whether its number of links is odd.

    A node has one link, and links do not circle. Two links at a time are followed, so the
    rounds grow with the logarithm of the longest chain.
    """
    links = materialize(links.withColumn("odd", F.lit(True)), "chains")
    while True:
        ahead = links.select(F.col("node").alias("to"), F.col("to").alias("further"), F.col("odd").alias("ahead_odd"))
        step = links.join(ahead, "to", "left")
        if step.filter("further IS NOT NULL").isEmpty():
            return links
        moved = F.col("further").isNotNull()
        links = materialize(
            step.select("node", F.coalesce("further", "to").alias("to"), F.when(moved, F.col("odd") != F.col("ahead_odd")).otherwise(F.col("odd")).alias("odd")),
            "chains",
        )


# --- matching -----------------------------------------------------------------------------------


def _overlap_edges(
    preds: DataFrame,
    truth: DataFrame,
    threshold: float,
    image: str,
    pred_id: str,
    score: str,
    object_id: str,
    crowded: DataFrame | None,
) -> DataFrame:
    """Pairs of a prediction and a true box that overlap enough.

    Equal true boxes of an image are one row with a capacity, named by their lowest
    object id, so copies on both sides do not multiply. A prediction is known by its id,
    score and corners, and equal rows by a running number, so a repeated id is no repeat
    of the prediction.
    """
    boxes = truth.groupBy(image, *CORNERS).agg(
        F.min(object_id).cast("bigint").alias("box"), F.count("*").alias("capacity")
    )
    asked = (
        preds.groupBy(image, F.col(pred_id).alias("id"), F.col(score).alias("score"), *CORNERS)
        .agg(F.count("*").alias("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(image, "score", *CORNERS, F.struct("id", "score", *CORNERS, "copy").alias("pred"))
    )
    value = C.iou(C.corners(), C.corners("t_"))
    pairs = _partners(asked, boxes, value >= threshold, threshold, image, crowded, "inner")
    return pairs.select(
        image,
        (-F.col("score")).alias("rank"),
        "pred",
        (-value).alias("distance"),
        F.col("t_box").alias("box"),
        F.col("t_capacity").alias("capacity"),
    )


def _fold_matches(edges: DataFrame, image: str) -> DataFrame:
    """Matches per image: walk the pairs in order, take a pair when both ends are free."""
    pair = F.struct("rank", "pred", "distance", "box", "capacity")
    pairs = F.array_sort(F.collect_list(pair))

    def step(state: Column, p: Column) -> Column:
        used = state.getField("used")
        free = ~state.getField("last").eqNullSafe(p.getField("pred"))
        room = F.size(F.filter(used, lambda b: b == p.getField("box"))) < p.getField("capacity")
        taken = F.struct(
            p.getField("pred").alias("last"), F.concat(used, F.array(p.getField("box"))).alias("used")
        )
        return F.when(free & room, taken).otherwise(state)

    kind = dict(edges.dtypes)["pred"]
    start = F.struct(
        F.lit(None).cast(kind).alias("last"), F.array().cast("array<bigint>").alias("used")
    )
    grouped = edges.groupBy(image).agg(pairs.alias("pairs"))
    return grouped.select(
        image, F.size(F.aggregate("pairs", start, step).getField("used")).cast("bigint").alias("tp")
    )


def _round_matches(edges: DataFrame, image: str, fold_limit: int) -> DataFrame:
    """Matches per image in rounds, until at most ``fold_limit`` pairs an image are left to fold.

    A pair is final when the box is the best free one of the prediction and the
    prediction is among the best of the box, as many as the box has room for: no
    better prediction can fill the box before its turn. A pair that one better pair alone
    can prevent follows from that one, so a whole chain of them is settled in a round.
    Each round settles at least the best open prediction of every image.
    """
    totals: list[DataFrame] = []
    left = materialize(edges, "match-left")
    while (left.groupBy(image).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > fold_limit:
        placed = _place_in_group(left, [image, "box"], ["rank", "pred"], "at_box")
        placed = _place_in_group(placed, [image, "pred"], ["distance", "box"], "at_pred")
        # better open pairs that can take an end: at the box only those that fill it
        room = F.col("at_box") < F.col("capacity")
        blockers = F.col("at_pred") + F.when(room, 0).when(F.col("capacity") == 1, F.col("at_box")).otherwise(2)
        pair = F.struct(image, "pred", "box")
        placed = materialize(placed.withColumns({"blockers": blockers, "pair": pair}), "match-placed")
        best = placed.filter("blockers = 0").select(image, "pred", "box", "pair")
        heads = placed.filter("at_pred = 0").select(image, "pred", F.col("pair").alias("of_pred"))
        tops = placed.filter("at_box = 0").select(image, "box", F.col("pair").alias("of_box"))
        single = placed.filter("blockers = 1").join(heads, [image, "pred"]).join(tops, [image, "box"])
        single = single.select(F.col("pair").alias("node"), F.when(F.col("at_pred") == 1, F.col("of_pred")).otherwise(F.col("of_box")).alias("to"))
        ends = settle_chains(single).join(best.select(F.col("pair").alias("to")), "to", "left_semi")
        sure = materialize(ends.select("node", F.col("odd").alias("gone")), "match-sure")
        final = best.select(image, "pred", "box").unionByName(sure.filter("NOT gone").select("node.*"))
        final = materialize(final, "match-final")
        totals.append(final.groupBy(image).agg(F.count("*").alias("tp")))
        used = final.groupBy(image, "box").agg(F.count("*").alias("_used"))
        gone = sure.filter("gone").select("node.*")
        left = materialize(
            left.join(final.select(image, "pred"), [image, "pred"], "left_anti")
            .join(gone, [image, "pred", "box"], "left_anti")
            .join(used, [image, "box"], "left")
            .withColumn("capacity", F.col("capacity") - F.coalesce("_used", F.lit(0)))
            .filter(F.col("capacity") > 0)
            .select(edges.columns),
            "match-left",
        )
    result = _fold_matches(left, image)
    for part in totals:
        result = result.unionByName(part)
    return result


def _place_in_group(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """The place of each row among those with its keys, from 0, without bringing a group together."""
    ranked = number_rows(df, [*keys, *order], "_no")
    starts = ranked.groupBy(*keys).agg(F.min("_no").alias("_start"))
    return ranked.join(starts, keys).withColumn(name, F.col("_no") - F.col("_start")).drop("_no", "_start")


def match_boxes(
    preds: DataFrame,
    truth: DataFrame,
    threshold: float = 0.5,
    image: str = "image",
    pred_id: str = "det_id",
    score: str = "score",
    object_id: str = "object_id",
    fold_limit: int = 5_000,
    crowd: tuple[int, int] = CROWD,
) -> DataFrame:
    """Greedy one-to-one matching per image in score order.

    Each prediction takes the free true box it overlaps most (equal overlap: lowest
    object id); at ``threshold`` and above it is a true positive. Only pairs that
    reach the threshold matter. Images whose pairs exceed ``fold_limit`` are matched
    in rounds instead of a fold.
    """
    _check_overlap(threshold)
    counts = _side_counts(preds, truth, image)
    most = counts.agg(
        F.max("n_left").alias("left"),
        F.max("n_right").alias("right"),
        F.max(F.col("n_left").cast("double") * F.col("n_right")).alias("pairs"),
    ).first()
    spread = (most.left or 0) > crowd[0] or (most.right or 0) > crowd[1]
    crowded = _crowded(counts, image, crowd) if spread else None
    edges = _overlap_edges(preds, truth, threshold, image, pred_id, score, object_id, crowded)
    if (most.pairs or 0) <= fold_limit:
        matched = _fold_matches(edges, image)
    else:
        edges = materialize(edges, "match-edges")
        per_image = edges.groupBy(image).agg(F.count("*").alias("n"))
        busy = materialize(per_image.filter(F.col("n") > fold_limit).select(image), "match-busy")
        if busy.isEmpty():
            matched = _fold_matches(edges, image)
        else:
            matched = _fold_matches(edges.join(busy, image, "left_anti"), image).unionByName(
                _round_matches(edges.join(busy, image, "left_semi"), image, fold_limit)
            )
    counts = counts.withColumnsRenamed({"n_left": "n_pred", "n_right": "n_gt"})
    zero = F.lit(0).cast("bigint")
    rows = counts.select(image, zero.alias("tp"), "n_gt", "n_pred").unionByName(
        matched.select(image, "tp", zero.alias("n_gt"), zero.alias("n_pred"))
    )
    return rows.groupBy(image).agg(
        F.sum("tp").alias("tp"), F.sum("n_gt").alias("n_gt"), F.sum("n_pred").alias("n_pred")
    ).select(
        image,
        "tp",
        (F.col("n_pred") - F.col("tp")).alias("fp"),
        (F.col("n_gt") - F.col("tp")).alias("fn"),
        "n_gt",
        "n_pred",
    )


def detection_totals(matches: DataFrame) -> DataFrame:
    """Totals with precision, recall and F1, each 0 where undefined."""
    sums = matches.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(
            part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0)
        )

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    scored = sums.withColumns({"precision": share(tp, tp + fp), "recall": share(tp, tp + fn)})
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", share(F.lit(2.0) * F.col("precision") * F.col("recall"), both))
