"""Approximate nearest neighbours by adaptive dimension scan of inverted lists.

Vectors are rotated at random, so that every block of dimensions tells as much about a
distance as any other, and stored as column blocks in the list of their nearest
centroid. A scan adds up squared distances block by block; after each block a
hypothesis test abandons the candidates whose distance, judged from the dimensions
seen, exceeds the tenth best so far. Survivors get their exact distance in double
precision from the original vectors. Equal vectors are indexed once, with the
smallest ids that can be among the answers. Neighbouring lists make up bundles, one to
a task, so that a query goes to a task once and its bound holds for all lists there.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareway.llm.common import map_rows, ship
from fareway.session import materialize

#: Dimensions in a column block.
BLOCK = 16
#: Strictness of the test; a true neighbour is abandoned with a probability of about exp(-EPSILON^2).
EPSILON = 2.1
#: Vectors of a bundle of lists, and queries, in one task.
_TASK_ROWS = 4096
_TASK_QUERIES = 512


class Index:
    """Rotation and centroids, fitted on a sample."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 5, rounds: int = 12):
        rng = np.random.default_rng(seed)
        dims = sample.shape[1]
        self.rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        x = sample @ self.rotation
        lists = max(1, min(lists, len(x)))
        self.centroids = x[rng.choice(len(x), lists, replace=False)].copy()
        for _ in range(rounds):
            near = self.nearest_lists(x, 1)[:, 0]
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, near, x)
            counts = np.bincount(near, minlength=lists)
            filled = counts > 0
            self.centroids[filled] = sums[filled] / counts[filled, None]

    def nearest_lists(self, rotated: np.ndarray, n: int) -> np.ndarray:
        out = []
        for i in range(0, len(rotated), 2048):
            d = (self.centroids**2).sum(1) - 2 * rotated[i : i + 2048] @ self.centroids.T
            out.append(np.argsort(d, axis=1, kind="stable")[:, :n])
        return np.concatenate(out) if out else np.zeros((0, n), np.int64)


def valid_vectors(rows: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id and vec (doubles) of rows with an id and a vector that is not null, empty or zero and has only finite components."""
    vec = F.col(column).cast("array<double>")
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vec, lambda x: x + F.lit(0.0)).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    return rows.filter(finite & F.exists("vec", lambda x: x != 0))


def fit_index(classes: DataFrame, lists: int | None = None, sample: int = 16_384) -> Index | None:
    """Index fitted on at most ``sample`` distinct vectors, those of smallest hash; lists default to the root of all rows."""
    count = classes.count()
    if not count:
        return None
    rows = classes.select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(sample)
    return Index(np.array([r["vec"] for r in rows.select("vec").collect()], float), lists or math.ceil(math.sqrt(count)))


def scan(blocks: list[np.ndarray], query: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Those of ``rows`` that may be among the ``k`` nearest, by the adaptive test; ``k`` of them at least, if there are as many.

    ``blocks`` are the columns of the rotated vectors; nearer lists should come first among ``rows``.
    """
    dims = sum(b.shape[1] for b in blocks)
    parts = np.split(query, np.cumsum([b.shape[1] for b in blocks])[:-1])
    # the first rows are measured whole: the k-th of them is the first bound
    head = rows[: 4 * k]
    whole = sum(((b[head] - q) ** 2).sum(1) for b, q in zip(blocks, parts, strict=True))
    if len(head) < k:
        return rows
    best = np.argpartition(whole, k - 1)[:k]
    worst = whole[best].max()
    alive, partial, end = rows, np.zeros(len(rows)), 0
    for block, part in zip(blocks, parts, strict=True):
        partial = partial + ((block[alive] - part) ** 2).sum(1)
        end += len(part)
        factor = 1.0 if end == dims else (1 + EPSILON / math.sqrt(end)) ** 2 * end / dims
        keep = partial <= worst * factor * (1 + 1e-9)
        alive, partial = alive[keep], partial[keep]
    if len(alive) > k:
        alive = alive[partial <= np.partition(partial, k - 1)[k - 1] * (1 + 1e-9)]
    # the test may abandon some of the best: those measured whole stay
    return np.union1d(alive, head[best])


class Bundles:
    """Which bundle a vector of a list lies in: lists in a row, or a part of a large list."""

    def __init__(self, sizes: dict[int, tuple[int, int]], lists: int, k: int):
        rows = np.array([sizes.get(i, (0, 0))[0] for i in range(lists)], np.int64)
        #: Candidates a list holds.
        self.ids = np.array([sizes.get(i, (0, 0))[1] for i in range(lists)], np.int64)
        self.k = k
        self.parts = np.maximum(1, -(-rows // _TASK_ROWS))
        self.first = np.zeros(lists, np.int64)
        at, held = 0, 0
        for i, n in enumerate(rows):
            if held and (held + n > _TASK_ROWS or self.parts[i] > 1):
                at, held = at + 1, 0
            self.first[i] = at
            if self.parts[i] > 1:
                at, held = at + int(self.parts[i]), 0
            else:
                held += n

    def probed(self, near: np.ndarray, least: int) -> np.ndarray:
        """Lists to search, nearest first: ``least`` of them, and more until they hold k + 1 candidates."""
        enough = np.searchsorted(np.cumsum(self.ids[near]), self.k + 1) + 1
        return near[: max(least, int(enough))]


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, lists: int | None = None, probe: float = 0.6,
            id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest rows found for each query.

    ``queries`` has the columns of ``rows``. score is the Euclidean distance of the original
    vectors in double precision; ties go to the smaller id; the query's own id is no
    candidate. A query probes the share ``probe`` of the lists, nearest centroid first, and
    more until they hold ``k`` candidates, so fewer answers come only where there are fewer
    rows. Rows without an id, null or zero vectors and those with null or non-finite
    components take no part; vectors of each length are searched among themselves; rows
    with an id that repeats are one candidate for each distinct vector. An empty table gives no rows;
    other columns are not read. The index is fitted on a bounded sample and holds every row.
    """
    spark = rows.sparkSession
    found = materialize(valid_vectors(rows, id_col, column).distinct(), "vectors")
    asked = materialize(valid_vectors(queries, id_col, column).distinct(), "asked")
    # one length, unless the table mixes vectors of several models
    lengths = sorted(r["n"] for r in asked.select(F.size("vec").alias("n")).distinct().collect())
    parts = [_nearest(*(t.filter(F.size("vec") == n) for t in (found, asked)), k, lists, probe) for n in lengths]
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionByName, parts)


def _nearest(found: DataFrame, asked: DataFrame, k: int, lists: int | None, probe: float) -> DataFrame | None:
    spark = found.sparkSession
    # at most k + 1 ids of equal vectors can matter: k answers and the query itself
    order = Window.partitionBy("vec").orderBy("vec_id")
    classes = (
        found.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1)
        .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    classes = materialize(classes, "vector-classes")
    index = fit_index(classes, lists)
    if index is None:
        return None
    shared = spark.sparkContext.broadcast(index)
    least = max(1, math.ceil(probe * len(index.centroids)))

    def place(batches):
        model = shared.value
        for batch in batches:
            x = _matrix(batch["vec"])
            yield {"vec": batch["vec"], "ids": batch["ids"], "list": model.nearest_lists(x @ model.rotation, 1)[:, 0]}

    placed = materialize(map_rows(classes, "vec array<double>, ids array<long>, list int", place), "lists")
    # a row for each list, as many as centroids
    sizes = placed.groupBy("list").agg(F.count("*").alias("rows"), F.sum(F.size("ids")).alias("ids")).collect()
    bundles = spark.sparkContext.broadcast(Bundles({r["list"]: (r["rows"], r["ids"]) for r in sizes}, len(index.centroids), k))

    def bundle(batches):
        layout = bundles.value
        for batch in batches:
            at = np.asarray(batch["list"])
            yield {
                "bundle": layout.first[at] + np.asarray(batch["share"]) % layout.parts[at], "list": at,
                "vec": batch["vec"], "ids": batch["ids"],
            }

    indexed = placed.withColumn("share", F.pmod(F.xxhash64("vec"), F.lit(2**31 - 1)))
    indexed = map_rows(indexed, "bundle long, list int, vec array<double>, ids array<long>", bundle)

    # a number stands for each distinct query vector
    numbers = asked.groupBy("vec").agg(F.min("vec_id").alias("query"))
    numbered = materialize(asked.join(numbers, "vec").select(F.col("vec_id").alias("query_id"), "query", "vec"), "queries")
    numbers = numbered.filter("query_id = query").select("query", "vec")

    def spread(batches):
        model, layout = shared.value, bundles.value
        for batch in batches:
            x = _matrix(batch["vec"])
            near = model.nearest_lists(x @ model.rotation, len(model.centroids))
            out: dict[str, list] = {"query": [], "bundle": [], "lists": []}
            at = []
            for i, query in enumerate(batch["query"].to_pylist()):
                mine = layout.probed(near[i], least)
                # a large list lies in several bundles
                spread_ = np.repeat(mine, layout.parts[mine])
                step = np.arange(len(spread_)) - np.repeat(np.cumsum(layout.parts[mine]) - layout.parts[mine], layout.parts[mine])
                home = layout.first[spread_] + step
                for b in np.unique(home).tolist():
                    at.append(i)
                    out["query"].append(query)
                    out["bundle"].append(b)
                    out["lists"].append(spread_[home == b].tolist())
            yield out | {"vec": batch["vec"].take(pa.array(at, pa.int64()))}

    probing = map_rows(numbers, "query long, bundle long, lists array<int>, vec array<double>", spread)
    probing = materialize(probing, "probing")
    groups = probing.groupBy("bundle").agg(F.ceil(F.count("*") / _TASK_QUERIES).cast("int").alias("turns"))
    probing = probing.join(groups, "bundle").withColumn("turn", F.pmod(F.xxhash64("query"), F.col("turns")).cast("int")).drop("turns")
    stored = indexed.join(groups, "bundle").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")

    def search(task, asked_rows: pa.Table, held: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "ids": [], "score": []}
        if asked_rows.num_rows and held.num_rows:
            model = shared.value
            own = np.asarray(held["list"])
            order = np.argsort(own, kind="stable")
            x, own, q = _matrix(held["vec"])[order], own[order], _matrix(asked_rows["vec"])
            rotated, turned = x @ model.rotation, q @ model.rotation
            blocks = [np.ascontiguousarray(rotated[:, i : i + BLOCK]) for i in range(0, rotated.shape[1], BLOCK)]
            ids = held["ids"].to_pylist()
            for i, (query, near) in enumerate(zip(asked_rows["query"].to_pylist(), asked_rows["lists"].to_pylist(), strict=True)):
                begins, ends = np.searchsorted(own, near), np.searchsorted(own, near, side="right")
                candidates = np.concatenate([np.arange(b, e) for b, e in zip(begins, ends, strict=True)])
                # one answer more than asked for, as the query's own vector may be one
                alive = scan(blocks, turned[i], candidates, k + 1)
                out["query"] += [query] * len(alive)
                out["ids"] += [ids[order[a]] for a in alive]
                out["score"] += np.sqrt(((x[alive] - q[i]) ** 2).sum(1)).tolist()
        return pa.table({
            "query": pa.array(out["query"], pa.int64()), "ids": pa.array(out["ids"], pa.list_(pa.int64())), "score": pa.array(out["score"], pa.float64()),
        })

    ship(spark)
    keys = ["bundle", "turn"]
    met = probing.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(search, "query long, ids array<long>, score double")
    # k + 1 nearest classes of each query vector, then their ids for each query id
    top = Window.partitionBy("query").orderBy("score", F.col("ids")[0])
    short = met.withColumn("at", F.row_number().over(top)).filter(F.col("at") <= k + 1)
    answers = short.select("query", "score", F.explode("ids").alias("vec_id")).distinct()
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    answers = answers.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= k + 1).drop("at")
    matched = numbered.select("query_id", "query").join(answers, "query").filter("query_id <> vec_id")
    rank = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    matched = matched.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return matched.select("query_id", "rank", "vec_id", "score")


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
