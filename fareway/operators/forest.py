"""Spark's random forest of regression trees, for rows of a few numbers and one place among many.

``RandomForestRegressor`` visits a third of all features for every row, tree and level, and
thousands of them are places. A row has one place, so here only the entries that are there are
added up; the rows beside a place are the node's sums less those at it. Bootstrap and sample
are drawn by Spark, features of a node, order of nodes, splits and ties follow its rules: the
trees are those the estimator grows from the same rows in the same tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.session import materialize, new_folder

# workers get these functions themselves, so they need not find the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows a task holds at once.
_BLOCK_ROWS = 262_144
#: Rows that are worth a task.
_LEAST_ROWS = 8_000
#: Nodes of a tree whose sums a task holds at once, one for each bin and place.
_PIECE_NODES = 256
#: Rows that thresholds are found from, as in Spark.
_SAMPLE_ROWS = 10_000


def fit(pipeline: Pipeline, train: DataFrame, numeric: int) -> PipelineModel:
    """What ``pipeline.fit(train)`` gives, for a forest over ``numeric`` numbers followed by one place vector."""
    *stages, estimator = pipeline.getStages()
    prepared = Pipeline(stages=stages).fit(train)
    return PipelineModel([*prepared.stages, grow(prepared.transform(train), estimator, numeric)])


def grow(rows: DataFrame, estimator: RandomForestRegressor, numeric: int) -> RandomForestRegressionModel:
    """What ``estimator.fit(rows)`` gives, if features from ``numeric`` on are a vector with one entry, 1, or none."""
    features, looked, ordered = _features(rows, estimator, numeric)
    total = rows.count()
    if not total:
        raise ValueError("no rows to grow trees from")
    packed = _packed(rows, estimator, numeric)
    sample, share = _sample(packed, estimator, total, _row_type(numeric))
    cuts = [_thresholds(sample["numbers"][:, f], share * total, min(estimator.getMaxBins(), total) - 1) for f in range(numeric)]
    here = np.bincount(sample["place"] + 1, minlength=features - numeric + 1)
    # a hashed place is a number to Spark: one that the sample does not show has no threshold
    known = np.ones(features - numeric, bool) if ordered else (here[1:] > 0) & (here[1:] < share * total * (1 - 1e-9))
    shape = _Shape(numeric, features - numeric, looked, ordered, tuple(cuts), known, estimator.getMinInstancesPerNode(), estimator.getMinInfoGain())
    bagged = _bagged(packed, estimator, shape, total, here)
    trees = _grown(bagged, estimator, shape)
    return _model(rows.sparkSession, estimator, shape, trees)


@dataclass(frozen=True)
class _Shape:
    numbers: int
    places: int
    #: Features a node looks at.
    looked: int
    #: Places are categories: the side with the lower mean is the left one.
    ordered: bool
    cuts: tuple[np.ndarray, ...]
    #: Places that can be split by.
    known: np.ndarray
    min_rows: int
    min_gain: float

    @property
    def features(self) -> int:
        return self.numbers + self.places

    @property
    def bins(self) -> int:
        return max([len(c) + 1 for c in self.cuts], default=1)

    @property
    def width(self) -> int:
        """Sums a node has: bins of the numbers, places, all rows."""
        return self.numbers * self.bins + self.places + 1


def _features(rows: DataFrame, estimator: RandomForestRegressor, numeric: int) -> tuple[int, int, bool]:
    """Features, features a node looks at, and whether places are categories."""
    for name, value in {"impurity": "variance", "minWeightFractionPerNode": 0.0}.items():
        if estimator.getOrDefault(name) != value:
            raise ValueError(f"{name} must be {value}")
    if estimator.isSet("weightCol") or estimator.getMaxBins() > 65_536:
        raise ValueError("row weights and more than 65,536 bins are not supported")
    kept = rows.schema[estimator.getFeaturesCol()].metadata["ml_attr"]
    features, kinds = kept["num_attrs"], kept.get("attrs", {})
    binary = sorted(a["idx"] for a in kinds.get("binary", []))
    if kinds.get("nominal") or binary not in ([], [*range(numeric, features)]):
        raise ValueError(f"numbers must come first, {numeric} of them, and places after them")
    strategy = estimator.getFeatureSubsetStrategy()
    if strategy == "auto":
        strategy = "onethird" if estimator.getNumTrees() > 1 else "all"
    if strategy not in ("all", "onethird"):
        raise ValueError("a node looks at a third of the features or at all")
    return features, features if strategy == "all" else -(-features // 3), bool(binary)


# --- rows ---------------------------------------------------------------------------------


def _row_type(numeric: int) -> np.dtype:
    return np.dtype([("numbers", "<f8", (numeric,)), ("label", "<f8"), ("place", "<i4")])


def _bag_type(numeric: int, trees: int) -> np.dtype:
    return np.dtype([("bins", "<u2", (numeric,)), ("place", "<i4"), ("label", "<f8"), ("counts", "u1", (trees,))])


def _binary(records: np.ndarray) -> pa.Array:
    ends = np.arange(len(records) + 1, dtype=np.int32) * records.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(records), [None, pa.py_buffer(ends), pa.py_buffer(records.tobytes())])


def _matrix(column: pa.Array) -> np.ndarray:
    """The entries of a binary column, all as long, a row each; not copied."""
    column = column if pa.types.is_binary(column.type) else column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    size = int(ends[1] - ends[0])
    if (np.diff(ends) != size).any():
        raise ValueError("records of different sizes")
    return np.frombuffer(column.buffers()[2], np.uint8, size * len(column), int(ends[0])).reshape(len(column), size)


def _records(column: pa.Array, kind: np.dtype) -> np.ndarray:
    return _matrix(column).view(kind).ravel() if len(column) else np.empty(0, kind)


def _unpacked_vectors(vectors: pa.StructArray, numeric: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each vector, sparse or dense, and the place of its one further entry, or -1."""
    n, values, indices = len(vectors), vectors.field("values"), vectors.field("indices")
    ends, sparse = values.offsets.to_numpy(), vectors.field("type").to_numpy(zero_copy_only=False) == 0
    sizes = np.diff(ends)
    row = np.repeat(np.arange(n), sizes)
    value = values.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    index = np.arange(len(value)) - np.repeat(ends[:-1] - ends[0], sizes)
    given = indices.offsets.to_numpy()
    index[sparse[row]] = indices.values.to_numpy(zero_copy_only=False)[given[0] : given[-1]]
    if not np.isfinite(value).all():
        raise ValueError("features must not be NaN or infinite")
    numbers, place = np.zeros((n, numeric)), np.full(n, -1, np.int32)
    first, at = index < numeric, (index >= numeric) & (value != 0)
    numbers[row[first], index[first]] = value[first]
    place[row[at]] = index[at] - numeric
    if (value[at] != 1).any() or np.count_nonzero(place >= 0) != np.count_nonzero(at):
        raise ValueError("a place vector has one entry, 1, at most")
    return numbers, place


def _packed(rows: DataFrame, estimator: RandomForestRegressor, numeric: int) -> DataFrame:
    """A record of numbers, label and place for each row, in the same tasks and order."""
    kind = _row_type(numeric)

    def pack(batches):
        for batch in batches:
            label, vectors = batch.column(0), batch.column(1)
            if label.null_count or vectors.null_count:
                raise ValueError("labels and features must not be null")
            records = np.empty(len(label), kind)
            records["label"] = label.to_numpy(zero_copy_only=False)
            if not np.isfinite(records["label"]).all():
                raise ValueError("labels must not be NaN or infinite")
            records["numbers"], records["place"] = _unpacked_vectors(vectors, numeric)
            yield pa.RecordBatch.from_arrays([_binary(records)], names=["row"])

    label = F.col(estimator.getLabelCol()).cast("double")
    return rows.select(label.alias("label"), estimator.getFeaturesCol()).mapInArrow(pack, "row BINARY")


def _java_rows(packed: DataFrame):
    """The records as Spark's own distributed rows of bytes."""
    return getattr(packed._jdf, "as")(packed.sparkSession._jvm.org.apache.spark.sql.Encoders.BINARY()).rdd()


def _sample(packed: DataFrame, estimator: RandomForestRegressor, total: int, kind: np.dtype) -> tuple[np.ndarray, float]:
    """The rows Spark finds thresholds from, and their share."""
    spark = packed.sparkSession
    jvm, rows = spark._jvm, _java_rows(packed)
    wanted = max(min(estimator.getMaxBins(), total) ** 2, _SAMPLE_ROWS)
    share = wanted / total if wanted < total else 1.0
    if share < 1:
        rows = rows.sample(False, share, jvm.org.apache.spark.util.random.XORShiftRandom(estimator.getSeed()).nextInt())
    found = DataFrame(spark._jsparkSession.createDataset(rows, jvm.org.apache.spark.sql.Encoders.BINARY()).toDF(), spark)
    return np.frombuffer(b"".join(bytes(r[0]) for r in found.collect()), kind), share


def _thresholds(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Middles between neighbouring values, all of them or those next to ``most`` equal shares of the rows.

    ``expected`` rows stand behind the sample; those that are not among its values other than 0 count as 0.
    """
    found, counts = np.unique(values[values != 0], return_counts=True)
    if not len(found):
        return np.empty(0)
    counts = counts.astype(float)
    zeros = expected - counts.sum()
    if zeros > np.finfo(float).eps * expected * 100:
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, zeros)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) <= most:
        return middles
    stride = expected / (most + 1)
    chosen, passed, target = [], counts[0], stride
    for i in range(1, len(found)):
        before, passed = passed, passed + counts[i]
        if abs(before - target) < abs(passed - target):
            chosen.append(middles[i - 1])
            target += stride
    return np.array(chosen)


def _array_in(stream: np.ndarray, name: bytes, size: int, length: int, kind) -> tuple[int, int, np.dtype | str]:
    """Start and bytes of the array of a class in a serialised Java object, and what to read it as."""
    # the class is described by its name, a number of 8 bytes, a flag, no fields and no parent
    at = stream.tobytes().index(b"ur\x00\x02" + name) + 19
    if int.from_bytes(stream[at : at + 4].tobytes(), "big") != length:
        raise ValueError("a bagged row of another layout")
    return at + 4, size * length, kind


def _bagged(packed: DataFrame, estimator: RandomForestRegressor, shape: _Shape, total: int, here: np.ndarray) -> DataFrame:
    """Binned rows with their bootstrap counts for each tree, written; rows of a place lie together.

    Counts are drawn by Spark's ``BaggedPoint``. The only way out of it is as serialised objects:
    a record and its counts lie in them as two arrays, all at the same place.
    """
    spark = packed.sparkSession
    jvm, bag = spark._jvm, spark._jvm.org.apache.spark.ml.tree.impl.BaggedPoint
    trees, row_type, bag_type = estimator.getNumTrees(), _row_type(shape.numbers), _bag_type(shape.numbers, estimator.getNumTrees())
    drawn = bag.convertToBaggedRDD(
        _java_rows(packed), estimator.getSubsamplingRate(), trees, estimator.getBootstrap(), getattr(bag, "convertToBaggedRDD$default$5")(), estimator.getSeed()
    )
    objects = jvm.org.apache.spark.sql.Encoders.javaSerialization(jvm.java.lang.Class.forName("org.apache.spark.ml.tree.impl.BaggedPoint"))
    rows = DataFrame(spark._jsparkSession.createDataset(drawn, objects).toDF(), spark)
    cores = spark.sparkContext.defaultParallelism
    parts = min(cores * -(-total // (_BLOCK_ROWS * cores)), -(-total // _LEAST_ROWS))
    # places one after another, each as wide as its share of the sample, a little if it is not there
    wide = here + 0.01
    starts = np.r_[0, np.cumsum(wide)] / wide.sum()
    cuts = shape.cuts

    def unbag(batches):
        passed = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _matrix(batch.column(0))
            given, counts = (
                np.ascontiguousarray(raw[:, at : at + size]).view(kind)
                for at, size, kind in (_array_in(raw[0], b"[B", 1, row_type.itemsize, row_type), _array_in(raw[0], b"[I", 4, trees, ">i4"))
            )
            given = given.ravel()
            if counts.max() > 255:
                raise ValueError("a row is drawn more than 255 times")
            records = np.empty(len(given), bag_type)
            for f, cut in enumerate(cuts):
                records["bins"][:, f] = np.searchsorted(cut, given["numbers"][:, f])
            records["place"], records["label"], records["counts"] = given["place"], given["label"], counts
            spot = np.arange(passed, passed + len(given)) * 0.6180339887498949 % 1
            passed += len(given)
            low, high = starts[given["place"] + 1], starts[given["place"] + 2]
            deal = np.minimum(((low + spot * (high - low)) * parts).astype(np.int32), parts - 1)
            yield pa.RecordBatch.from_arrays([pa.array(deal), _binary(records)], names=["deal", "row"])

    dealt = rows.mapInArrow(unbag, "deal INT, row BINARY").repartitionById(parts, "deal")
    return materialize(dealt.select("row"), "bagged")


# --- trees --------------------------------------------------------------------------------


@dataclass
class _Tree:
    """Nodes of a growing tree; node 0 is its root."""

    level: list[int] = field(default_factory=lambda: [0])
    #: Count, sum and sum of squares of the labels.
    sums: list[np.ndarray] = field(default_factory=lambda: [np.zeros(3)])
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    #: The rows at a place go to the left.
    turned: list[bool] = field(default_factory=lambda: [False])
    children: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    valid: list[bool] = field(default_factory=lambda: [True])

    def add(self, level: int, sums: np.ndarray) -> int:
        for column, value in ((self.level, level), (self.sums, sums), (self.feature, -1), (self.cut, 0), (self.turned, False), (self.gain, -1.0), (self.valid, True)):
            column.append(value)
        self.children.append((len(self.children), len(self.children)))
        return len(self.level) - 1


@dataclass(frozen=True)
class _Piece:
    """Nodes of one tree that are split in one pass, and the way to them."""

    tree: int
    #: For each node of the tree: column it looks at, first value and number of values that go one way, node for the others and for these.
    column: np.ndarray
    base: np.ndarray
    span: np.ndarray
    ahead: np.ndarray
    steps: int
    #: Place among the nodes split, or -1.
    slot: np.ndarray
    #: Features each node looks at, in order.
    order: np.ndarray


def _piece(index: int, tree: _Tree, nodes: Sequence[int], order: np.ndarray, shape: _Shape) -> _Piece:
    n = len(tree.level)
    feature, cut = np.array(tree.feature), np.array(tree.cut, np.int32)
    at_place = feature >= shape.numbers
    base = np.where(at_place, feature - shape.numbers, cut + 1).astype(np.int32)
    span = np.where(at_place, 1, 2**31).astype(np.uint32)
    ahead = np.array(tree.children, np.int32)
    turned = np.array(tree.turned)
    ahead[turned] = ahead[turned][:, ::-1]
    slot = np.full(n, -1, np.int32)
    slot[list(nodes)] = np.arange(len(nodes))
    column = np.where(feature < 0, 0, np.minimum(feature, shape.numbers))
    return _Piece(index, column, base, span, ahead.ravel(), max(tree.level[i] for i in nodes), slot, order)


def _grown(bagged: DataFrame, estimator: RandomForestRegressor, shape: _Shape) -> list[_Tree]:
    trees, depth = [_Tree() for _ in range(estimator.getNumTrees())], estimator.getMaxDepth()
    sizes = np.r_[[len(c) + 1 for c in shape.cuts], np.where(shape.known, 2, 1)].astype(np.int64) * 3 * 8
    room, draws = estimator.getMaxMemoryInMB() << 20, _JavaRandom(estimator.getSeed())
    # the last one is the next to be split
    stack = [(t, 0) for t in range(len(trees))]
    while stack:
        ahead = stack[: -1 - max(room // int(shape.looked * sizes.min()), 1) - 1 : -1]
        before = draws.state
        seeds = [draws.next_long() for _ in ahead] if shape.looked < shape.features else None
        orders = _looked_at(seeds, shape.features, shape.looked) if seeds else np.tile(np.arange(shape.features), (len(ahead), 1))
        used = np.cumsum(sizes[orders].sum(1))
        fits = max(int(np.searchsorted(used, room, "right")), 1)
        if seeds and fits < len(ahead):  # one more has been drawn for, which found no room
            draws.state = before
            for _ in range(fits + 1):
                draws.next_long()
        group: dict[int, list[int]] = {}
        places: dict[int, list[int]] = {}
        for i, (t, node) in enumerate(ahead[:fits]):
            group.setdefault(t, []).append(node)
            places.setdefault(t, []).append(i)
        del stack[len(stack) - fits :]
        pieces = [
            _piece(t, trees[t], nodes[i : i + _PIECE_NODES], orders[places[t][i : i + _PIECE_NODES]].astype(np.uint16 if shape.features < 65_536 else np.int32), shape)
            for t, nodes in group.items() for i in range(0, len(nodes), _PIECE_NODES)
        ]
        found = _best_splits(bagged, pieces, shape)
        for t in _map_order(bagged.sparkSession._jvm, group):
            tree = trees[t]
            for node in group[t]:
                _split(tree, node, found.get((t, node)), depth, stack, t)
    return trees


def _split(tree: _Tree, node: int, best: np.void | None, depth: int, stack: list[tuple[int, int]], index: int) -> None:
    """Take over the best split of a node; its children are next on the stack if they can be split."""
    if best is None:  # a tree without rows
        tree.valid[node] = False
        return
    tree.sums[node], tree.valid[node] = best["total"], bool(best["valid"])
    if not best["valid"] or best["gain"] <= 0 or tree.level[node] == depth:
        return
    level, right = tree.level[node] + 1, best["total"] - best["left"]
    tree.gain[node], tree.feature[node], tree.cut[node], tree.turned[node] = float(best["gain"]), int(best["feature"]), int(best["cut"]), bool(best["turned"])
    tree.children[node] = (tree.add(level, best["left"]), tree.add(level, right))
    for child in tree.children[node]:
        if level < depth and abs(_impurity(*tree.sums[child])) >= np.finfo(float).eps:
            stack.append((index, child))


def _map_order(jvm, keys: Iterable[int]) -> list[int]:
    """Keys in the order in which Spark reads them from a Scala map."""
    made = jvm.scala.collection.mutable.HashMap()
    for k in keys:
        made.put(k, k)
    left, order = made.toMap(getattr(jvm.scala.Predef, "$conforms")()).keysIterator(), []
    while left.hasNext():
        order.append(left.next())
    return order


# --- draws --------------------------------------------------------------------------------


class _JavaRandom:
    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        return (self.state >> 16 ^ 1 << 31) - (1 << 31)

    def next_long(self) -> int:
        return ((self._next() << 32) + self._next()) & (1 << 64) - 1


def _murmur(data: bytes, seed: int) -> int:
    def turn(x: int, by: int) -> int:
        return (x << by | x >> 32 - by) & 0xFFFFFFFF

    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        h = turn(h ^ turn(k, 15) * 0x1B873593 & 0xFFFFFFFF, 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _first_state(seed: int) -> int:
    """State of Spark's XORShiftRandom with a seed."""
    data = seed.to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _looked_at(seeds: Sequence[int], features: int, looked: int) -> np.ndarray:
    """Features of a node for each seed: Spark's reservoir sample, all nodes at once."""
    state = np.array([_first_state(s) for s in seeds], np.uint64)
    chosen = np.tile(np.arange(looked, dtype=np.int32), (len(seeds), 1))
    shifts = [np.uint64(s) for s in (21, 35, 4)]

    def step(bits: int) -> np.ndarray:
        nonlocal state
        state = state ^ state << shifts[0]
        state ^= state >> shifts[1]
        state ^= state << shifts[2]
        return state & np.uint64((1 << bits) - 1)

    for item in range(looked, features):
        double = ((step(26) << np.uint64(27)) + step(27)).astype(np.float64) * 2.0**-53
        to = (double * (item + 1)).astype(np.int64)
        hit = np.flatnonzero(to < looked)
        chosen[hit, to[hit]] = item
    return chosen


# --- passes -------------------------------------------------------------------------------


_BEST = np.dtype([("feature", "<i4"), ("cut", "<i4"), ("turned", "?"), ("valid", "?"), ("gain", "<f8"), ("left", "<f8", (3,)), ("total", "<f8", (3,))])


def _best_splits(bagged: DataFrame, pieces: list[_Piece], shape: _Shape) -> dict[tuple[int, int], np.void]:
    """The best split of each node in ``pieces``: sums by bin and place, added up by piece."""
    spark = bagged.sparkSession
    context = spark.sparkContext
    sent = context.broadcast(cloudpickle.dumps((pieces, shape)))

    def add_up(batches):
        pieces, shape = cloudpickle.loads(sent.value)
        for block in _blocks(batches, shape.numbers):
            for i, piece in enumerate(pieces):
                cells, sums = _cells(block, piece, shape)
                if len(cells):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([cells.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())], names=["piece", "cells", "sums"]
                    )

    def choose(batches):
        pieces, shape = cloudpickle.loads(sent.value)
        for i, total in _by_piece(batches, pieces, shape):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_best(total, pieces[i], shape).tobytes()], pa.binary())], names=["piece", "best"])

    sums = bagged.mapInArrow(add_up, "piece INT, cells BINARY, sums BINARY")
    sums = sums.repartitionById(min(len(pieces), 4 * context.defaultParallelism), "piece").sortWithinPartitions("piece")
    found = {}
    for row in sums.mapInArrow(choose, "piece INT, best BINARY").collect():
        piece = pieces[row["piece"]]
        best = np.frombuffer(bytes(row["best"]), _BEST)
        nodes = np.flatnonzero(piece.slot >= 0)
        found |= {(piece.tree, int(node)): best[piece.slot[node]] for node in nodes}
    sent.destroy()
    return found


@dataclass(frozen=True)
class _Block:
    #: Bins and, as the last column, the place.
    values: np.ndarray
    label: np.ndarray
    #: A row for each tree.
    counts: np.ndarray


def _blocks(batches, numeric: int) -> Iterator[_Block]:
    """Rows of many batches at once."""
    held, rows = [], 0

    def block() -> _Block:
        records = np.concatenate(held)
        values = np.concatenate([records["bins"].astype(np.int32), records["place"][:, None]], axis=1)
        return _Block(values, records["label"].copy(), np.ascontiguousarray(records["counts"].T))

    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(0)
        size = _matrix(column).shape[1]
        held.append(_records(column, _bag_type(numeric, size - 2 * numeric - 12)))
        rows += batch.num_rows
        if rows >= _BLOCK_ROWS:
            yield block()
            held, rows = [], 0
    if held:
        yield block()


def _cells(block: _Block, piece: _Piece, shape: _Shape) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of a block at the nodes of a piece: (node, bin or place) and count, sum and sum of squares."""
    columns = shape.numbers + 1
    values, counts = block.values.ravel(), block.counts[piece.tree]
    rows = np.flatnonzero(counts)
    start, at = rows * columns, np.zeros(len(rows), np.int32)
    for _ in range(piece.steps):
        inside = (values[start + piece.column[at]] - piece.base[at]).view(np.uint32) < piece.span[at]
        at = piece.ahead[2 * at + inside]
    slot = piece.slot[at]
    if (slot < 0).any():
        here = np.flatnonzero(slot >= 0)
        rows, start, slot = rows[here], start[here], slot[here]
    if not len(rows):
        return np.empty(0, np.int64), np.empty((0, 3))
    nodes, bins, width = len(piece.order), shape.bins, shape.width
    count = counts[rows].astype(np.float64)
    first = count * block.label[rows]
    weights = (count, first, first * block.label[rows])
    looks = np.zeros((nodes, shape.features), bool)
    np.put_along_axis(looks, piece.order.astype(np.int64), True, 1)
    cells, sums = [], []

    def keep(key: np.ndarray, some: tuple[np.ndarray, ...], offset: int, wide: int) -> None:
        added = np.stack([np.bincount(key, w, nodes * wide) for w in some], axis=1)
        there = np.flatnonzero(added[:, 0])
        cells.append(there // wide * width + offset + there % wide)
        sums.append(added[there])

    for f in range(shape.numbers):
        if not len(shape.cuts[f]):
            continue
        use = np.flatnonzero(looks[:, f][slot])
        keep(slot[use] * bins + values[start[use] + f], tuple(w[use] for w in weights), f * bins, bins)
    place = values[start + shape.numbers]
    use = np.flatnonzero(place >= 0)
    use = use[(looks[:, shape.numbers :] & shape.known)[slot[use], place[use]]] if shape.places else use[:0]
    if len(use):
        low, high = int(place[use].min()), int(place[use].max())
        wide = high - low + 1
        keep(slot[use].astype(np.int64) * wide + (place[use] - low), tuple(w[use] for w in weights), shape.numbers * bins + low, wide)
    keep(slot, weights, width - 1, 1)
    return np.concatenate(cells), np.concatenate(sums)


def _by_piece(batches, pieces: list[_Piece], shape: _Shape) -> Iterator[tuple[int, np.ndarray]]:
    """The sums of each piece added up, from rows in the order of pieces."""
    now, total = None, None
    for batch in batches:
        for i, cells, sums in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if i != now:
                if now is not None:
                    yield now, total
                now, total = i, np.zeros((len(pieces[i].order) * shape.width, 3))
            total[np.frombuffer(cells, np.int64)] += np.frombuffer(sums).reshape(-1, 3)
    if now is not None:
        yield now, total


def _impurity(count, first, second):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (second - first * first / count) / count)


def _gains(left: np.ndarray, total: np.ndarray, shape: _Shape) -> np.ndarray:
    """Gain in variance of splitting ``total`` into ``left`` and the rest; -inf where it is not allowed. Sums lie along the first axis."""
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _impurity(*total) - left[0] / total[0] * _impurity(*left) - right[0] / total[0] * _impurity(*right)
    allowed = (left[0] >= shape.min_rows) & (right[0] >= shape.min_rows) & (gain >= shape.min_gain)
    return np.where(allowed, gain, -np.inf)


def _best(total: np.ndarray, piece: _Piece, shape: _Shape) -> np.ndarray:
    """The best split of each node; of equal ones the first in the order in which the node looks at features."""
    nodes, numbers, bins = len(piece.order), shape.numbers, shape.bins
    sums = total.reshape(nodes, shape.width, 3).transpose(2, 0, 1)
    whole = sums[:, :, -1]
    scores = np.full((nodes, shape.features), -np.inf)
    cuts = np.zeros((nodes, numbers), np.int32)
    if bins > 1:
        left = sums[:, :, : numbers * bins].reshape(3, nodes, numbers, bins).cumsum(-1)[..., :-1]
        gains = _gains(left, whole[:, :, None, None], shape)
        cuts = gains.argmax(-1).astype(np.int32)
        scores[:, :numbers] = np.take_along_axis(gains, cuts[..., None], -1)[..., 0]
    at = sums[:, :, numbers * bins : -1]
    beside = whole[:, :, None] - at
    turned = np.zeros((nodes, shape.places), bool)
    if shape.ordered:
        with np.errstate(divide="ignore", invalid="ignore"):
            turned = (at[0] > 0) & (beside[0] > 0) & (at[1] / at[0] < beside[1] / beside[0])
    if shape.places:
        scores[:, numbers:] = _gains(np.where(turned, at, beside), whole[:, :, None], shape)
    order = piece.order.astype(np.int64)
    feature = np.take_along_axis(order, np.take_along_axis(scores, order, 1).argmax(1)[:, None], 1)[:, 0]
    best, row = np.zeros(nodes, _BEST), np.arange(nodes)
    best["feature"], best["gain"], best["total"] = feature, scores[row, feature], whole.T
    best["valid"] = best["gain"] > -np.inf
    number = np.flatnonzero(best["valid"] & (feature < numbers))
    if len(number):
        best["cut"][number] = cuts[number, feature[number]]
        best["left"][number] = left[:, number, feature[number], best["cut"][number]].T
    other = np.flatnonzero(best["valid"] & (feature >= numbers))
    place = feature[other] - numbers
    best["turned"][other] = turned[other, place]
    best["left"][other] = np.where(turned[other, place], at[:, other, place], beside[:, other, place]).T
    return best


# --- model --------------------------------------------------------------------------------


def _node_rows(tree: _Tree, shape: _Shape) -> list[tuple]:
    """Nodes as Spark stores them, a node before its children; children that are leaves of one prediction are dropped."""

    def mean(node: int) -> float:
        count, first, _ = tree.sums[node]
        return float(first / count) if count else 0.0

    leaf = [feature < 0 for feature in tree.feature]
    for node in reversed(range(len(leaf))):  # children have higher numbers
        if not leaf[node]:
            left, right = tree.children[node]
            leaf[node] = leaf[left] and leaf[right] and mean(left) == mean(right)
    rows = []

    def add(node: int) -> int:
        number = len(rows)
        rows.append(None)
        sums = [float(x) for x in tree.sums[node]]
        impurity = float(_impurity(*tree.sums[node])) if tree.valid[node] else -1.0
        if leaf[node]:
            left = right = -1
            # a dropped split leaves the prediction of its children
            prediction = mean(node if tree.feature[node] < 0 else _first_leaf(tree, node))
            gain, split = -1.0, (-1, [], -1)
        else:
            left, right = (add(child) for child in tree.children[node])
            prediction, gain, feature = mean(node), tree.gain[node], tree.feature[node]
            if feature < shape.numbers:
                split = (feature, [float(shape.cuts[feature][tree.cut[node]])], -1)
            else:
                split = (feature, [float(tree.turned[node])], 2) if shape.ordered else (feature, [0.5], -1)
        rows[number] = (number, prediction, impurity, sums, int(sums[0]), gain, left, right, split)
        return number

    add(0)
    return rows


def _first_leaf(tree: _Tree, node: int) -> int:
    while tree.feature[node] >= 0:
        node = tree.children[node][0]
    return node


def _model(spark: SparkSession, estimator: RandomForestRegressor, shape: _Shape, trees: list[_Tree]) -> RandomForestRegressionModel:
    """A model of Spark with these trees: one of bare leaves is stored, its nodes are replaced, and it is loaded."""
    context = spark.sparkContext
    jvm, gateway = spark._jvm, context._gateway
    ml = jvm.org.apache.spark.ml
    leaf = ml.tree.LeafNode(0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0))
    bare = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    for t in range(len(trees)):
        bare[t] = ml.regression.DecisionTreeRegressionModel(leaf, shape.features)
    path = new_folder(spark, "forest")
    estimator._copyValues(RandomForestRegressionModel(ml.regression.RandomForestRegressionModel(estimator.uid, bare, shape.features))).save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    nodes = [(t, row) for t, tree in enumerate(trees) for row in _node_rows(tree, shape)]
    spark.createDataFrame(nodes, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)
