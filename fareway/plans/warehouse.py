"""Raw trips to clean trips, metric tables, analysis tables and dashboard bundles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareway.constants import FOREST, LINEAR, TripLimits
from fareway.operators import cleaning, metrics, models, profile, reports
from fareway.plans import demand
from fareway.sources import tables as io

# --- fixed values: table names, section names, row limits and checked columns ---------

# table name -> order of its rows in an export
GOLD_ORDER = {
    "hourly_metrics": ["pickup_hour"],
    "daily_metrics": ["pickup_date"],
    "pickup_hotspots": [F.desc, "trip_count", "pickup_zone"],
    "od_routes": [F.desc, "trip_count", "od_pair"],
    "payment_metrics": [F.desc, "trip_count", "payment_type"],
    "demand_features": ["pickup_date", "pickup_hour", "pickup_zone"],
}
ANALYSIS_ORDER = {
    "demand_pattern": ["pickup_hour"],
    "peak_periods": [F.desc, "trip_count", "period"],
    "hotspots": [F.desc, "trip_count", "pickup_zone"],
    "fare_distance": ["bucket_no"],
    "time_features": ["pickup_weekday", "pickup_hour"],
    "od_rank": [F.desc, "trip_count", "od_pair"],
}


def export_order(name: str) -> list:
    """Columns of a total order; a leading ``F.desc`` applies to the first of them."""
    spec = {**GOLD_ORDER, **ANALYSIS_ORDER}[name]
    return [F.desc(spec[1]), *spec[2:]] if spec[0] is F.desc else list(spec)


@dataclass(frozen=True)
class Layout:
    """Where the job keeps its tables."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/trips"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/trips"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def build_bronze(
    spark: SparkSession, source: str, layout: Layout, schema: T.StructType | None = None
) -> DataFrame:
    """Land the raw file with normalised names and write its profiles."""
    raw = cleaning.normalize_columns(io.read_table(spark, source, schema))
    io.write_table(raw, layout.bronze)
    bronze = spark.read.schema(raw.schema).parquet(layout.bronze)
    io.write_table(profile.missing_profile(bronze), layout.report("missing_profile"))
    io.write_table(profile.table_profile(bronze), layout.report("table_profile"))
    return bronze


def build_silver(
    bronze: DataFrame, layout: Layout, limits: TripLimits = TripLimits(), nulls: str = "drop"
) -> DataFrame:
    """Clean trips partitioned by month, so that a month is pruned at the scan."""
    named = cleaning.standardize_trips(bronze)
    clean = cleaning.clean_trips(named, limits, nulls)
    # rows of a month go to few tasks, a day to one, so that a month is not a file for every task
    io.write_table(clean.repartition("pickup_month", "pickup_date"), layout.silver, partition_by=["pickup_month"])
    # the month comes back from the folder names, as text
    silver = bronze.sparkSession.read.schema(clean.schema).parquet(layout.silver)
    io.write_table(
        cleaning.stored_quality_report(bronze, silver), layout.report("quality_report")
    )
    io.write_table(profile.numeric_summary(silver), layout.report("numeric_summary"))
    return silver


def gold_tables(cube: DataFrame, trips: DataFrame) -> dict[str, DataFrame]:
    """Metric tables. All but routes and payments re-aggregate the cube."""
    return {
        "hourly_metrics": metrics.hourly_metrics(cube),
        "daily_metrics": metrics.daily_metrics(cube),
        "pickup_hotspots": metrics.pickup_hotspots(cube),
        "od_routes": metrics.od_routes(trips),
        "payment_metrics": metrics.payment_metrics(trips),
        "demand_features": metrics.demand_features(cube),
    }


def build_gold(silver: DataFrame, layout: Layout, records: int = 500) -> dict[str, DataFrame]:
    """Write each metric table once, then its exports from the written table."""
    spark = silver.sparkSession
    cube = metrics.trip_cube(silver)
    io.write_table(cube, layout.gold("trip_cube"))
    cube = spark.read.schema(cube.schema).parquet(layout.gold("trip_cube"))
    written = {}
    for name, table in gold_tables(cube, silver).items():
        io.write_table(table, layout.gold(name))
        written[name] = spark.read.schema(table.schema).parquet(layout.gold(name))
        io.export_csv(written[name], layout.report(f"{name}.csv"))
        io.export_records(written[name], layout.report(f"{name}.json"), export_order(name), records)
    listing = profile.manifest({n: (t, layout.gold(n)) for n, t in written.items()})
    io.write_table(listing, layout.report("gold_manifest"))
    return written


def analysis_tables(cube: DataFrame, trips: DataFrame) -> dict[str, DataFrame]:
    return {
        "demand_pattern": metrics.demand_pattern(cube),
        "peak_periods": metrics.peak_periods(cube),
        "hotspots": metrics.top_zones(cube, 30),
        "fare_distance": metrics.fare_by_distance(trips),
        "time_features": metrics.weekday_hour(cube),
        "od_rank": metrics.top_routes(trips, 50),
    }


def build_analysis(silver: DataFrame, layout: Layout, records: int = 500) -> dict[str, DataFrame]:
    spark = silver.sparkSession
    cube_path = layout.gold("trip_cube")
    cube = spark.read.parquet(cube_path)
    written = {}
    for name, table in analysis_tables(cube, silver).items():
        path = layout.report(f"analysis_{name}")
        io.write_table(table, path)
        written[name] = spark.read.schema(table.schema).parquet(path)
        io.export_csv(written[name], f"{path}.csv")
        io.export_records(written[name], f"{path}.json", export_order(name), records)
    io.write_table(metrics.headline(silver), layout.report("analysis_summary"))
    return written


# section -> table, and how many of its rows are shown
SMALL_SECTIONS = {
    "hourly": ("hourly_metrics", None),
    "daily": ("daily_metrics", None),
    "hotspots": ("pickup_hotspots", 15),
    "od_routes": ("od_routes", 15),
    "payment": ("payment_metrics", None),
}
FULL_SECTIONS = {
    "hourly": ("hourly_metrics", None),
    "daily": ("daily_metrics", None),
    "hotspots": ("pickup_hotspots", 50),
    "od_routes": ("od_routes", 50),
    "payment": ("payment_metrics", None),
    "demand_features": ("demand_features", 500),
}
ANALYSIS_LIMITS = {"hotspots": 30, "od_rank": 50}
QUALITY_ORDER = {"source": "rows", "bronze_profile": "column", "silver_quality": "before_rows", "gold_manifest": "table"}
MODEL_ORDER = {"metrics": ["model"], "evaluation_report": ["target"], "predictions": ["pickup_date", "pickup_hour", "pickup_zone"]}
PREDICTIONS_SHOWN = {"small": 80, "full": 500}


def small_bundle(gold: dict[str, DataFrame], predictions: DataFrame | None = None) -> DataFrame:
    """The short dashboard: whole small tables, 15 zones and routes, 80 predictions."""
    sections = {
        shown: reports.Section(gold[name], export_order(name), limit)
        for shown, (name, limit) in SMALL_SECTIONS.items()
    }
    if predictions is not None:
        sections["predictions"] = reports.Section(predictions, MODEL_ORDER["predictions"], PREDICTIONS_SHOWN["small"])
    return reports.dashboard_bundle(sections)


def full_bundle(
    gold: dict[str, DataFrame],
    analysis: dict[str, DataFrame],
    quality: dict[str, DataFrame],
    model: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The long dashboard: metric, analysis, quality and model sections.

    ``analysis`` may hold the ``summary``; ``quality`` and ``model`` are named as in
    ``QUALITY_ORDER`` and ``MODEL_ORDER``.
    """
    sections = {
        f"gold.{shown}": reports.Section(gold[name], export_order(name), limit)
        for shown, (name, limit) in FULL_SECTIONS.items()
    }
    for name, table in analysis.items():
        order = ["top_hour"] if name == "summary" else export_order(name)
        sections[f"analysis.{name}"] = reports.Section(table, order, ANALYSIS_LIMITS.get(name))
    for name, table in quality.items():
        sections[f"quality.{name}"] = reports.Section(table, [QUALITY_ORDER[name]])
    for name, table in (model or {}).items():
        limit = PREDICTIONS_SHOWN["full"] if name == "predictions" else None
        sections[f"model.{name}"] = reports.Section(table, MODEL_ORDER[name], limit)
    return reports.dashboard_bundle(sections)


def evaluation_report(metrics: DataFrame, train: DataFrame, test: DataFrame, target: str = "demand") -> DataFrame:
    """What was learned from how many rows, and the model of the highest R²."""
    best = models.best_model(metrics).select(F.lit(target).alias("target"), F.col("model").alias("selected_model"))
    counted = best.withColumns({"train_rows": train.agg(F.count("*")).scalar(), "test_rows": test.agg(F.count("*")).scalar()})
    return counted.select("target", "train_rows", "test_rows", "selected_model")


def build_models(features: DataFrame, layout: Layout, records: int = 500, **forest) -> dict[str, DataFrame]:
    """Train the demand models on the feature table; write them, their metrics, predictions and report."""
    spark = features.sparkSession
    trained = demand.train_demand_models(features, **forest)
    trained.save(f"{layout.root}/models")
    found = {"metrics": trained.metrics(), "predictions": trained.side_by_side()}
    written = {}
    for name, table in found.items():
        io.write_table(table, layout.report(f"model_{name}"))
        written[name] = spark.read.schema(table.schema).parquet(layout.report(f"model_{name}"))
    io.export_csv(written["predictions"], layout.report("demand_predictions.csv"))
    io.export_records(written["predictions"], layout.report("demand_predictions.json"), MODEL_ORDER["predictions"], records)
    report = evaluation_report(written["metrics"], trained.train, trained.test)
    io.write_table(report, layout.report("model_evaluation_report"))
    written["evaluation_report"] = spark.read.schema(report.schema).parquet(layout.report("model_evaluation_report"))
    return written


def build_bundles(
    spark: SparkSession, source: str, layout: Layout, gold: dict[str, DataFrame], analysis: dict[str, DataFrame], model: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Both dashboards, from written tables."""
    shown = {"summary": spark.read.parquet(layout.report("analysis_summary")), **analysis}
    quality = {
        "source": io.source_profile(spark, source) if source.rstrip("/").endswith(".parquet") else None,
        "bronze_profile": spark.read.parquet(layout.report("missing_profile")),
        "silver_quality": spark.read.parquet(layout.report("quality_report")),
        "gold_manifest": spark.read.parquet(layout.report("gold_manifest")),
    }
    quality = {name: table for name, table in quality.items() if table is not None}
    written = {}
    for name, bundle in (("dashboard", small_bundle(gold, model["predictions"])), ("offline", full_bundle(gold, shown, quality, model))):
        io.write_table(bundle, layout.report(name))
        written[name] = spark.read.schema(bundle.schema).parquet(layout.report(name))
    return written


def run(
    spark: SparkSession,
    source: str,
    root: str,
    schema: T.StructType | None = None,
    limits: TripLimits = TripLimits(),
    forest: dict | None = None,
) -> dict[str, DataFrame]:
    """The whole offline job: tables, analysis, models and dashboards. Returns the written tables by name.

    ``forest`` are parameters of ``demand.train_demand_models``.
    """
    layout = Layout(root)
    bronze = build_bronze(spark, source, layout, schema)
    silver = build_silver(bronze, layout, limits)
    gold = build_gold(silver, layout)
    analysis = build_analysis(silver, layout)
    model = build_models(gold["demand_features"], layout, **(forest or {}))
    bundles = build_bundles(spark, source, layout, gold, analysis, model)
    return {"bronze": bronze, "silver": silver, **gold, **analysis, **{f"model_{n}": t for n, t in model.items()}, **bundles}


def delivery_rules(minimum_rows: int = 1_000_000, minimum_features: int = 10_000) -> list[profile.Rule]:
    """What a finished month has to satisfy."""
    silver = (
        "pickup_datetime",
        "dropoff_datetime",
        "trip_duration_min",
        "pickup_hour",
        "pickup_weekday",
        "pickup_zone",
        "dropoff_zone",
        "od_pair",
        "payment_type_label",
    )
    return [
        profile.Rule("bronze", "rows", floor=minimum_rows),
        profile.Rule("silver", "rows", floor=minimum_rows),
        profile.Rule("silver", "columns", silver),
        profile.Rule("demand_features", "rows", floor=minimum_features),
        profile.Rule("demand_pattern", "rows"),
        profile.Rule("od_rank", "rows"),
    ]


def model_rules() -> list[profile.Rule]:
    return [
        profile.Rule("model_metrics", "values", ("model",), values=(LINEAR, FOREST)),
        profile.Rule("model_metrics", "filled", ("rmse", "mae", "r2")),
        profile.Rule("model_metrics", "bounds", ("r2",), high=1.0),
    ]


def bundle_rules() -> list[profile.Rule]:
    """Sections both dashboards must hold, and what the model section must say."""
    offline = (
        *[f"quality.{name}" for name in QUALITY_ORDER], "gold.hourly", "analysis.summary", "analysis.demand_pattern",
        "analysis.peak_periods", "analysis.od_rank", *[f"model.{name}" for name in MODEL_ORDER],
    )
    return [
        profile.Rule("dashboard", "sections", values=(*SMALL_SECTIONS, "predictions")),
        profile.Rule("offline", "sections", values=offline),
        profile.Rule("offline", "keys", ("model", "rmse", "mae", "r2"), section="model.metrics"),
        profile.Rule("offline", "bounds", ("r2",), section="model.metrics", high=1.0),
    ]
