"""Splits, demand models, linear classifiers and their metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareway.constants import DEMAND_KEY, NUMERIC_FEATURES, PREDICTION_COLUMNS, SPLIT_SEED
from fareway.functions import columns as C
from fareway.functions.measures import round_half_up
from fareway.operators.numbering import number_rows
from fareway.session import materialize

# --- splits ---------------------------------------------------------------------------


def labelled(df: DataFrame, label: str = "demand") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def hash_split(
    df: DataFrame, keys: Sequence[str] = DEMAND_KEY, seed: int = SPLIT_SEED, percent: int = 75
) -> tuple[DataFrame, DataFrame]:
    """Train and test by a hash of the row key: the same rows in any partitioning."""
    place = C.key_hash(*keys, seed=seed) % 100
    return df.filter(place < percent), df.filter(place >= percent)


def hash_part(
    df: DataFrame, keys: Sequence[str] = DEMAND_KEY, seed: int = SPLIT_SEED, percent: int = 75
) -> DataFrame:
    """The rows of ``hash_split`` in one pass, with ``part`` train or test."""
    place = C.key_hash(*keys, seed=seed) % 100
    return df.withColumn("part", F.when(place < percent, "train").otherwise("test"))


_SPLIT_BITS = 16


def stratified_split(
    df: DataFrame, label: str, key: str, percent: int = 80, seed: int = 42
) -> DataFrame:
    """Add ``in_train``: exactly the first ⌊percent·n⌋ rows per label in hash order.

    Rows are never sorted as a whole. The hash order is cut into 2^16 cells; counts
    per cell tell the cell in which a label's cut falls, cells before it are train,
    and only the rows of that one cell are ranked. ``key`` should be unique.
    """
    code = C.key_hash(key, seed=seed)
    placed = df.withColumn("_code", code).withColumn(
        "_cell", F.shiftright("_code", 32 - _SPLIT_BITS)
    )
    cells = placed.groupBy(label, "_cell").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(label).orderBy("_cell")
    whole = Window.partitionBy(label)
    cells = cells.withColumns(
        {
            "_upto": F.sum("_n").over(running),
            "_quota": F.floor(F.sum("_n").over(whole) * percent / 100),
        }
    )
    # one row per label: the cell that holds the cut and the rows it may still give
    cut = cells.groupBy(label).agg(
        F.min(F.when(F.col("_upto") > F.col("_quota"), F.struct("_cell", "_upto", "_n", "_quota"))).alias("c")
    )
    cut = cut.select(
        F.col(label).alias("_label"),
        F.col("c._cell").alias("_cut"),
        (F.col("c._quota") - (F.col("c._upto") - F.col("c._n"))).alias("_share"),
    )
    # written, so the planner knows its size: broadcast for classes, shuffled if huge
    cut = materialize(cut, "split-cut")
    joined = placed.join(cut, F.col(label).eqNullSafe(F.col("_label")), "left")
    before = F.col("_cut").isNull() | (F.col("_cell") < F.col("_cut"))
    inside = F.coalesce(F.col("_cell") == F.col("_cut"), F.lit(False))
    ranked = (
        joined.filter(inside)
        .withColumn("_rank", F.row_number().over(Window.partitionBy(label).orderBy("_code", key)))
        .withColumn("in_train", F.col("_rank") <= F.col("_share"))
        .drop("_rank")
    )
    rest = joined.filter(~inside).withColumn("in_train", before)
    return rest.unionByName(ranked).select(*df.columns, "in_train")


def label_and_stack(positive: DataFrame, negative: DataFrame, label: str = "label") -> DataFrame:
    """Positive rows with label 1 over negative rows with label 0."""
    return positive.withColumn(label, F.lit(1)).unionByName(
        negative.withColumn(label, F.lit(0)), allowMissingColumns=True
    )


def sample_counts(df: DataFrame, label: str = "label", in_train: str | None = None) -> DataFrame:
    """Positives, negatives and their ratio, with train and test rows if split."""
    counts = [
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    ]
    if in_train:
        counts.append(F.count_if(F.col(in_train)).alias("train_rows"))
        counts.append(F.count_if(~F.col(in_train)).alias("test_rows"))
    ratio = F.col("negatives").cast("double") / F.nullif(
        F.col("positives").cast("double"), F.lit(0.0)
    )
    return df.agg(*counts).withColumn("negatives_per_positive", round_half_up(ratio, 2))


# --- demand models --------------------------------------------------------------------


def zone_index(zone: str = "pickup_zone") -> StringIndexer:
    """Index of a zone by falling count, equal counts by name; zones not seen share the next index."""
    return StringIndexer(inputCol=zone, outputCol=f"{zone}_index", handleInvalid="keep")


def zone_numbers(df: DataFrame, zone: str = "pickup_zone") -> DataFrame:
    """The same index as a table (zone, zone_index), numbered where the zones lie; none of them reaches the driver."""
    counts = df.groupBy(zone).agg(F.count("*").alias("n")).filter(F.col(zone).isNotNull())
    numbered = number_rows(counts, [F.desc("n"), F.asc(zone)], "no")
    return numbered.select(zone, (F.col("no") - 1).alias("zone_index"))


#: Zones that get a place of their own in a feature vector; more of them share this many places by hash.
ZONE_PLACES = 4_096


def zone_stages(df: DataFrame | None = None, zone: str = "pickup_zone", places: int = ZONE_PLACES) -> list:
    """Stages from a zone to its vector: index and one-hot for up to ``places`` zones in ``df``, hashed places for more.

    A vector is never wider than ``places``, and no more than that many labels reach the driver.
    """
    zones = 0 if df is None else df.select(zone).distinct().limit(places + 1).count()
    if zones > places:
        return [FeatureHasher(inputCols=[zone], outputCol=f"{zone}_vec", numFeatures=places)]
    return [zone_index(zone), OneHotEncoder(inputCols=[f"{zone}_index"], outputCols=[f"{zone}_vec"])]


def demand_pipeline(
    estimator: Estimator,
    zone: str = "pickup_zone",
    numeric: Sequence[str] = NUMERIC_FEATURES,
    scale: bool = False,
    encoded: Sequence | None = None,
) -> Pipeline:
    """Zone vector, numeric features, estimator. Unseen zones are kept.

    ``scale`` standardises the numeric features first; ``encoded`` replaces the stages that
    make the zone vector.
    """
    stages: list = list(zone_stages(zone=zone) if encoded is None else encoded)
    inputs = list(numeric)
    if scale:
        stages += [
            VectorAssembler(inputCols=inputs, outputCol="numeric", handleInvalid="keep"),
            StandardScaler(
                inputCol="numeric", outputCol="numeric_scaled", withMean=True, withStd=True
            ),
        ]
        inputs = ["numeric_scaled"]
    stages.append(
        VectorAssembler(
            inputCols=[*inputs, f"{zone}_vec"], outputCol="features", handleInvalid="keep"
        )
    )
    return Pipeline(stages=[*stages, estimator])


@dataclass(frozen=True)
class ZoneLine:
    """A line over numeric features with a level for each zone: least squares with one-hot zones."""

    numeric: tuple[str, ...]
    coefficients: tuple[float, ...]
    #: Level of a zone that was not seen.
    level: float
    #: (zone, level)
    levels: DataFrame
    zone: str

    def transform(self, df: DataFrame, prediction: str = "baseline_prediction") -> DataFrame:
        """``df`` with the prediction; null where a feature is null."""
        known = self.levels.select(F.col(self.zone).alias("_zone"), F.col("level").alias("_level"))
        joined = df.join(known, F.col(self.zone).eqNullSafe(F.col("_zone")), "left")
        slope = [F.col(c).cast("double") * F.lit(b) for c, b in zip(self.numeric, self.coefficients, strict=True)]
        value = reduce(lambda a, b: a + b, slope, F.coalesce("_level", F.lit(self.level)))
        return joined.withColumn(prediction, value).drop("_zone", "_level")

    def table(self) -> DataFrame:
        """(feature, coefficient) rows; the level of unseen zones is named ``level``."""
        spark = self.levels.sparkSession
        return spark.createDataFrame([*zip(self.numeric, self.coefficients, strict=True), ("level", self.level)], "feature STRING, coefficient DOUBLE")

    def save(self, path: str) -> None:
        self.table().coalesce(1).write.mode("overwrite").parquet(f"{path}/line")
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")


def load_zone_line(spark, path: str, numeric: Sequence[str] = NUMERIC_FEATURES, zone: str = "pickup_zone") -> ZoneLine:
    line = {r["feature"]: r["coefficient"] for r in spark.read.parquet(f"{path}/line").collect()}
    return ZoneLine(tuple(numeric), tuple(line[c] for c in numeric), line["level"], spark.read.parquet(f"{path}/levels"), zone)


def fit_zone_line(
    train: DataFrame, label: str = "demand", numeric: Sequence[str] = NUMERIC_FEATURES, zone: str = "pickup_zone"
) -> ZoneLine:
    """Least squares of ``label`` on numeric features and one-hot zones, for any number of zones.

    One grouped pass gives counts, sums and products of each zone. Taking the zone's means
    off removes the zone block from the normal equations, so what is solved is as small as
    the numeric features; a zone's level follows from its means. Features that say nothing
    beyond the others share the smallest solution. Rows with a null or NaN are left out.
    """
    names, k = [*numeric, label], len(numeric)
    values = [F.col(c).cast("double") for c in names]
    whole = reduce(lambda a, b: a & b, [v.isNotNull() & ~F.isnan(v) for v in values])
    rows = train.filter(whole).select(zone, *[v.alias(f"v{i}") for i, v in enumerate(values)])
    # a column for each product; features are few
    pairs = [(i, j) for i in range(k) for j in range(i, k + 1)]
    sums = materialize(
        rows.groupBy(zone).agg(
            F.count("*").alias("n"), *[F.sum(f"v{i}").alias(f"s{i}") for i in range(k + 1)],
            *[F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"p{i}_{j}") for i, j in pairs],
        ),
        "zone-sums",
    )
    inside = [F.sum(F.col(f"p{i}_{j}") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n")).alias(f"p{i}_{j}") for i, j in pairs]
    total = sums.agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(k + 1)], *inside).first()
    if not total["n"]:
        raise ValueError("no complete rows to fit a line to")
    products = np.zeros((k + 1, k + 1))
    for i, j in pairs:
        products[i, j] = products[j, i] = total[f"p{i}_{j}"]
    scale = np.sqrt(np.maximum(np.diag(products)[:k], 0))
    scale[scale <= 1e-9 * max(scale.max(), 1e-300)] = 1.0
    system = products[:k, :k] / np.outer(scale, scale)
    line = np.linalg.lstsq(system, products[:k, k] / scale, rcond=1e-9)[0] / scale
    rest = F.col(f"s{k}")
    for i, b in enumerate(line):
        rest = rest - F.col(f"s{i}") * F.lit(float(b))
    levels = sums.select(zone, (rest / F.col("n")).alias("level"))
    level = (total[f"s{k}"] - sum(float(b) * total[f"s{i}"] for i, b in enumerate(line))) / total["n"]
    return ZoneLine(tuple(numeric), tuple(map(float, line)), float(level), levels, zone)


def linear_model(prediction: str = "baseline_prediction") -> LinearRegression:
    return LinearRegression(
        featuresCol="features", labelCol="demand", predictionCol=prediction, maxIter=50
    )


def forest_model(
    prediction: str = "improved_prediction",
    trees: int = 80,
    depth: int = 8,
    min_leaf: int = 1,
    seed: int = SPLIT_SEED,
) -> RandomForestRegressor:
    """80 trees of depth 8; the second published form has 120 trees and leaves of 2."""
    return RandomForestRegressor(
        featuresCol="features",
        labelCol="demand",
        predictionCol=prediction,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        seed=seed,
    )


def mean_baseline(
    train: DataFrame, test: DataFrame, label: str = "demand", prediction: str = "baseline_prediction"
) -> DataFrame:
    """Test rows with the mean of train as prediction, a scalar subquery."""
    return test.withColumn(prediction, train.agg(F.avg(label)).scalar())


def prediction_table(scored: DataFrame, columns: Sequence[str] = (*DEMAND_KEY, "pickup_weekday")) -> DataFrame:
    """Actual demand, baseline and improved prediction side by side, to three digits."""
    values = {"actual_demand": "demand", "baseline_prediction": "baseline_prediction", "improved_prediction": "improved_prediction"}
    rounded = [round_half_up(F.col(c).cast("double"), 3).alias(name) for name, c in values.items()]
    return scored.select(*columns, *rounded)


def predictions(
    scored: DataFrame,
    n: int = 5000,
    columns: Sequence[str] = PREDICTION_COLUMNS,
) -> DataFrame:
    """The first ``n`` scored rows in date, hour and zone order."""
    return scored.select(*columns).orderBy(*DEMAND_KEY).limit(n)


# --- vectors ----------------------------------------------------------------------------


def as_vectors(df: DataFrame, source: str, target: str = "features") -> DataFrame:
    return df.withColumn(target, array_to_vector(F.col(source)))


def scaled_svm(
    features: str = "features", label: str = "label", reg: float = 0.01, max_iter: int = 100
) -> Pipeline:
    """Standard scaling fitted on train only, then a linear support vector machine."""
    return Pipeline(
        stages=[
            StandardScaler(inputCol=features, outputCol="scaled", withMean=True, withStd=True),
            LinearSVC(
                featuresCol="scaled",
                labelCol=label,
                predictionCol="prediction",
                rawPredictionCol="raw",
                regParam=reg,
                maxIter=max_iter,
            ),
        ]
    )


@dataclass(frozen=True)
class LinearMachine:
    """A linear decision w·x + b."""

    weights: tuple[float, ...]
    bias: float
    #: 0.5 (|w|² + b²) + c Σ max(0, 1 - y (w·x + b))²
    objective: float
    rounds: int

    def transform(self, df: DataFrame, vector: str = "scaled") -> DataFrame:
        """``df`` with ``decision``, and ``prediction`` 1 where it is positive."""
        scored = linear_scores(df, self.weights, self.bias, vector)
        return scored.withColumn("prediction", (F.col("decision") > 0).cast("int"))


#: Components of a vector a machine is trained on; the driver holds a matrix of that width.
_MOST_COMPONENTS = 4_096


def _hinge_sums(rows: DataFrame, point: np.ndarray, c: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Objective, gradient and second derivatives at a point, from vector sums of the rows inside the margin.

    A task adds up its rows in numpy and hands on a row for each row of the matrix; Spark
    adds those up over the tasks.
    """
    width = len(point)

    def add(batches):
        matrix, slope, loss = np.zeros((width, width)), np.zeros(width), 0.0
        for batch in batches:
            n = batch.num_rows
            x = np.c_[batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1), np.ones(n)] if n else np.zeros((0, width))
            y = batch["y"].to_numpy(zero_copy_only=False)
            gap = 1 - y * (x @ point)
            inside = gap > 0
            x, y, gap = x[inside], y[inside], gap[inside]
            loss += float(gap @ gap)
            slope -= (y * gap) @ x
            matrix += x.T @ x
        values = [*matrix, np.r_[slope], np.r_[loss, np.zeros(width - 1)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width + 2), pa.int32()), pa.array([v.tolist() for v in values], pa.list_(pa.float64()))], names=["row", "values"]
        )

    parts = rows.mapInArrow(add, "row INT, values ARRAY<DOUBLE>")
    total = parts.groupBy("row").agg(Summarizer.sum(array_to_vector("values")).alias("total")).collect()
    by_row = {r["row"]: r["total"].toArray() for r in total}
    matrix = np.array([by_row[i] for i in range(width)])
    return (
        0.5 * float(point @ point) + c * float(by_row[width + 1][0]),
        point + 2 * c * by_row[width],
        np.eye(width) + 2 * c * matrix,
    )


def squared_hinge_svm(
    train: DataFrame, vector: str = "scaled", label: str = "label", c: float = 0.01, rounds: int = 50, tolerance: float = 1e-8
) -> LinearMachine:
    """Linear support vector machine of least squared hinge loss, by Newton steps.

    Minimises 0.5 (|w|² + b²) + ``c`` Σ max(0, 1 - y (w·x + b))² with y = 1 for label 1, else
    -1: the intercept is penalised like a weight. Each step is one pass over the rows; a
    step that does not lower the objective is halved. Rows with a null vector or label are left out.
    """
    rows = train.filter(F.col(vector).isNotNull() & F.col(label).isNotNull())
    rows = rows.select(F.transform(vector, lambda v: v.cast("double")).alias("x"), F.when(F.col(label) == 1, 1.0).otherwise(-1.0).alias("y"))
    rows = materialize(rows, "svm-rows")
    sizes = rows.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if sizes.low is None or sizes.low != sizes.high or not 0 < sizes.high <= _MOST_COMPONENTS:
        raise ValueError(f"vectors of 1 to {_MOST_COMPONENTS} components, all as long, are needed")
    point = np.zeros(sizes.high + 1)
    value, slope, curve = _hinge_sums(rows, point, c)
    first = np.linalg.norm(slope)
    done = 0
    while done < rounds and np.linalg.norm(slope) > tolerance * max(first, 1e-12):
        step, share = np.linalg.solve(curve, slope), 1.0
        while True:
            done += 1
            ahead = _hinge_sums(rows, point - share * step, c)
            if ahead[0] < value or share < 1e-6 or done >= rounds:
                break
            share /= 2
        if ahead[0] >= value:
            break
        point, (value, slope, curve) = point - share * step, ahead
    return LinearMachine(tuple(map(float, point[:-1])), float(point[-1]), value, done)


def standard_scaler(features: str = "features") -> StandardScaler:
    return StandardScaler(inputCol=features, outputCol="scaled", withMean=True, withStd=True)


def decision_values(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """Signed distance of a fitted SVM as ``decision``; with ``threshold`` only rows at or above."""
    valued = scored.withColumn("decision", vector_to_array("raw")[1])
    return valued if threshold is None else valued.filter(F.col("decision") >= threshold)


def linear_scores(
    df: DataFrame, weights: Sequence[float], bias: float, vector: str = "embedding"
) -> DataFrame:
    """w·x + b for rows of a vector column, without a Python worker."""
    w = F.array(*[F.lit(float(v)) for v in weights])
    products = F.zip_with(F.col(vector), w, lambda x, v: x.cast("double") * v)
    total = F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)
    return df.withColumn("decision", total + F.lit(float(bias)))


# --- metrics ------------------------------------------------------------------------------


def regression_metrics(
    df: DataFrame, label: str = "demand", prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and R² to four digits, in one pass."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction).cast("double")
    sums = df.filter(F.col(label).isNotNull()).agg(
        F.count("*").alias("rows"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("variance"),
    )
    r2 = F.lit(1.0) - F.col("mse") / F.nullif(F.col("variance"), F.lit(0.0))
    return sums.select(
        round_half_up(F.sqrt("mse"), 4).alias("rmse"),
        round_half_up(F.col("mae"), 4).alias("mae"),
        round_half_up(r2, 4).alias("r2"),
    )


def compare_models(
    scored: Mapping[str, tuple[DataFrame, str]], label: str = "demand"
) -> DataFrame:
    """One row of metrics per model, from (scored rows, prediction column)."""
    rows = [
        regression_metrics(df, label, prediction).select(F.lit(name).alias("model"), "*")
        for name, (df, prediction) in scored.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest R²; equal ones in name order."""
    first = F.min(F.struct((-F.col("r2")).alias("rank"), F.col("model"), F.col("r2")))
    return metrics.filter(F.col("r2").isNotNull()).agg(first.alias("b")).select("b.model", "b.r2")


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("rows")
    )


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


#: Classes a full matrix is made for.
_MOST_CLASSES = 10_000


def full_confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """A cell for each label with each prediction among the classes of either side; 0 where no row falls."""
    cells = confusion_matrix(df, label, prediction)
    classes = cells.select(F.explode(F.array("label", "prediction")).alias("class")).distinct()
    # the classes alone lie in one row, and no more of them than can be shown as a table
    listed = classes.agg(F.array_sort(F.collect_set("class")).alias("all"))
    checked = F.when(F.size("all") <= _MOST_CLASSES, F.col("all")).otherwise(
        F.raise_error(F.lit(f"a matrix of more than {_MOST_CLASSES} classes")).cast(listed.schema["all"].dataType)
    )
    # a row for each class, each with all of them
    grid = listed.select(F.explode(checked).alias("label"), "all").select("label", F.explode("all").alias("prediction"))
    return grid.join(cells, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("rows", F.lit(0)).alias("rows"))


def _class_rates(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """class, hit, actual, guessed, p, r and f1 of each class, not rounded."""
    cells = confusion_matrix(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = cells.select(
        F.col("label").alias("class"), hit.cast("bigint").alias("hit"), F.col("rows").alias("actual"), zero.alias("guessed")
    ).unionByName(
        cells.select(
            F.col("prediction").alias("class"), zero.alias("hit"), zero.alias("actual"), F.col("rows").alias("guessed")
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("hit", "actual", "guessed")])

    rated = sums.withColumns(
        {
            "p": _share(F.col("hit"), F.col("guessed")),
            "r": _share(F.col("hit"), F.col("actual")),
        }
    )
    both = F.col("p") + F.col("r")
    return rated.withColumn("f1", _share(F.lit(2.0) * F.col("p") * F.col("r"), both))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, 0 where undefined."""
    return _class_rates(df, label, prediction).select(
        "class",
        round_half_up(F.col("p"), 4).alias("precision"),
        round_half_up(F.col("r"), 4).alias("recall"),
        round_half_up(F.col("f1"), 4).alias("f1"),
        F.col("actual").alias("support"),
    )


def report_averages(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and F1 over all classes: plain means and means weighted by support."""
    rates = ("p", "r", "f1")
    sums = _class_rates(df, label, prediction).agg(
        F.sum("actual").alias("support"),
        _share(F.sum("hit"), F.sum("actual")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in rates],
        *[_share(F.sum(F.col(c) * F.col("actual")), F.sum("actual")).alias(f"weighted_{c}") for c in rates],
    )
    none = F.lit(None).cast("double")
    rows = [("accuracy", none, none, F.col("accuracy"))]
    rows += [(f"{kind} avg", *[F.col(f"{kind}_{c}") for c in rates]) for kind in ("macro", "weighted")]
    entries = [
        F.struct(
            F.lit(name).alias("average"),
            round_half_up(p, 4).alias("precision"),
            round_half_up(r, 4).alias("recall"),
            round_half_up(f1, 4).alias("f1"),
            F.col("support"),
        )
        for name, p, r, f1 in rows
    ]
    return sums.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


# --- storage ---------------------------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> Model:
    return PipelineModel.load(path)
