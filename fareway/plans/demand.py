"""Train and compare demand models on the feature table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from fareway.constants import FOREST, LINEAR, NUMERIC_FEATURES, SPLIT_SEED
from fareway.operators import forest, models
from fareway.session import materialize


@dataclass(frozen=True)
class DemandModels:
    linear: models.ZoneLine
    forest: PipelineModel
    train: DataFrame
    test: DataFrame

    def scored(self) -> dict[str, tuple[DataFrame, str]]:
        return {
            "baseline_mean": (
                models.mean_baseline(self.train, self.test, prediction="mean_prediction"),
                "mean_prediction",
            ),
            LINEAR: (self.linear.transform(self.test), "baseline_prediction"),
            FOREST: (self.forest.transform(self.test), "improved_prediction"),
        }

    def metrics(self) -> DataFrame:
        return models.compare_models(self.scored())

    def predictions(self, n: int = 5000) -> DataFrame:
        return models.predictions(self.forest.transform(self.test), n)

    def side_by_side(self) -> DataFrame:
        """Actual demand, the mean and the forest's prediction for every test row."""
        mean = models.mean_baseline(self.train, self.test)
        return models.prediction_table(self.forest.transform(mean))

    def save(self, root: str) -> None:
        self.linear.save(f"{root}/{LINEAR}")
        models.save_model(self.forest, f"{root}/{FOREST}")


#: Training rows in a task that the forest draws its rows from; the draws follow the tasks.
_TREE_ROWS = 40_000


def _dealt(train: DataFrame, rows_each: int = _TREE_ROWS) -> DataFrame:
    """``train`` in as many tasks as keep to ``rows_each`` rows, in key order, so draws repeat; as it is if its tasks are small.

    Files are packed into tasks by their size, which says nothing of the size of the rows in memory.
    """
    parts = -(-train.count() // rows_each)
    if parts <= train.rdd.getNumPartitions():
        return train
    width = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return train.repartition(max(width, parts), *models.DEMAND_KEY).sortWithinPartitions(*models.DEMAND_KEY)


def train_demand_models(
    features: DataFrame,
    trees: int = 80,
    depth: int = 8,
    min_leaf: int = 1,
    seed: int = SPLIT_SEED,
    scale: bool = False,
) -> DemandModels:
    """Fit both models on three quarters of the rows.

    The averages among the features come from the same trips that are counted as
    demand, so the models describe demand; they do not forecast it. The line has a level
    for each zone, however many; the forest sees up to ``models.ZONE_PLACES`` zones one by
    one, and more of them by hash.
    """
    # training passes over its rows many times, so the features are written once, in as
    # many files as there are shuffle partitions: the forest draws its rows in that many tasks
    width = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = models.labelled(features).repartition(width, *models.DEMAND_KEY)
    table = materialize(spread, "demand-features")
    train, test = models.hash_split(table, seed=seed)
    linear = models.fit_zone_line(train)
    pipeline = models.demand_pipeline(
        models.forest_model(trees=trees, depth=depth, min_leaf=min_leaf, seed=seed),
        scale=scale, encoded=models.zone_stages(train),
    )
    return DemandModels(linear, forest.fit(pipeline, _dealt(train), len(NUMERIC_FEATURES)), train, test)
