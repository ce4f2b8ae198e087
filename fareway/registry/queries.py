"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway import bindings as B
from fareway.constants import (
    PAYMENT_LABELS,
    REQUIRED_TRIP_COLUMNS,
    TRIP_RENAMES,
    TRIP_TYPES,
    TripLimits,
    flat_schema,
    roads_table,
)
from fareway.functions import columns as C
from fareway.functions.measures import count_known, limb_sums, round_half_up, rounded_avg, rounded_sum
from fareway.operators import (
    alerts as A,
    boxes as X,
    cleaning as K,
    metrics as M,
    models as L,
    numbering as N,
    profile as P,
    reports as R,
    windows as W,
)
from fareway.plans import congestion as stream_plan
from fareway.plans import demand, detection, warehouse
from fareway.session import materialize, new_folder
from fareway.sources import streams, tables
from fareway.streaming import congestion as S
from fareway.streaming import count_windows as CW

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return {name: _in_utc(fn) for name, fn in _QUERIES.items()}


def _in_utc(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# --- columns and cleaning -----------------------------------------------------------


@query
def table_scan(spark, sf):
    """Declared schema, only the needed columns read."""
    schema = "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ"
    df = tables.read_table(spark, f"{sf}/lineitem.parquet", flat_schema(schema))
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query
def raw_trip_names(spark, sf):
    """Canonical names of a raw table, as rows."""
    named = K.rename_columns(K.normalize_columns(B.raw_trips(spark, sf)), TRIP_RENAMES)
    return P.table_profile(named).select("position", "column", "rows")


@query
def typed_raw_trips(spark, sf):
    """Raw text columns to types, unreadable values to null."""
    typed = K.coerce_types(K.standardize_trips(B.raw_trips(spark, sf)), TRIP_TYPES)
    return typed.select(
        "event_id",
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        "trip_distance",
        "fare_amount",
        "payment_type_label",
    )


@query
def payment_labels(spark, sf):
    """P3."""
    trips = B.trips_of(B.events(spark, sf)).select("event_id", "payment_type")
    return C.label_codes(trips, "payment_type", PAYMENT_LABELS, "payment_type_label")


@query
def payment_labels_missing_column(spark, sf):
    """Without the code column every row is unknown."""
    trips = B.trips_of(B.events(spark, sf)).select("event_id")
    return C.label_codes(trips, "payment_type", PAYMENT_LABELS, "payment_type_label")


@query
def trip_durations(spark, sf):
    """P5: whole seconds and fractional."""
    rows = B.events(spark, sf).withColumn(
        "end", F.col("ts") + F.expr("INTERVAL '0.75' SECOND") * (F.col("event_id") % 400)
    )
    return rows.select(
        "event_id",
        C.duration_min("ts", "end").alias("duration_min"),
        C.duration_min("ts", "end", fractional=True).alias("duration_min_fractional"),
    )


@query
def calendar_columns(spark, sf):
    """P6 over order dates."""
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return C.calendar_features(orders, "o_orderdate", "order").drop("o_orderdate")


@query
def zone_and_route_keys(spark, sf):
    """Unknown zones give unknown keys."""
    trips = B.trips_of(B.events(spark, sf))
    return C.zone_keys(trips).select("event_id", "pickup_zone", "dropoff_zone", "od_pair")


@query
def trip_revenue(spark, sf):
    """P8."""
    return C.revenue(B.trips_of(B.events(spark, sf))).select("event_id", "revenue")


@query
def clean_trips_strict(spark, sf):
    """F1."""
    return _clean_columns(B.clean(spark, sf))


@query
def clean_trips_lenient(spark, sf):
    """F2."""
    return _clean_columns(B.clean(spark, sf, nulls="keep"))


def _clean_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "passenger_count", "trip_duration_min", "pickup_date", "pickup_month",
        "pickup_hour", "pickup_weekday", "is_weekend", "pickup_zone", "dropoff_zone", "od_pair",
        "revenue", "payment_type_label",
    )


@query
def required_columns(spark, sf):
    """The error each table would raise, as a row."""
    found = {"trips": B.trips(spark, sf), "events": B.events(spark, sf), "fares": B.trips(spark, sf).drop("fare_amount", "payment_type")}
    return K.column_report(found, REQUIRED_TRIP_COLUMNS)


@query
def quality_report(spark, sf):
    """F3, P17."""
    return K.quality_report(B.trips(spark, sf))


@query
def quality_report_lenient(spark, sf):
    """lenient rule, four digits."""
    return K.quality_report(B.trips(spark, sf), nulls="keep", digits=4)


@query
def quality_report_tight(spark, sf):
    """F1 limits as arguments."""
    return K.quality_report(B.trips(spark, sf), TripLimits(60, 10, 100, 4))


@query
def trip_event_rows(spark, sf):
    """P18."""
    return K.trip_events(B.clean(spark, sf))


@query
def payment_display_names(spark, sf):
    """P20 on payment labels, with counts."""
    table = M.payment_metrics(B.clean(spark, sf))
    return C.display_labels(table, payment="payment_type").select(
        "payment_type", "payment_type_display", "trip_count"
    )


# --- profiles and checks ---------------------------------------------------------------


@query
def missing_values(spark, sf):
    """A12."""
    return P.missing_profile(B.trips(spark, sf))


@query
def missing_values_with_nan(spark, sf):
    """NaN counts as missing."""
    e = F.col("event_id")
    odd = F.when(e % 9 == 0, F.lit(float("nan"))).otherwise(F.when(e % 7 != 0, F.col("value")))
    rows = B.events(spark, sf).select("event_id", odd.alias("value"), "event_type")
    return P.missing_profile(rows, nan=True)


@query
def column_types(spark, sf):
    """A13."""
    return P.table_profile(B.table(spark, sf, "lineitem"))


@query
def numeric_summary(spark, sf):
    """A14, approximate quartiles; its exact columns only."""
    return _rounded_summary(P.numeric_summary(B.clean(spark, sf))).drop("q25", "q50", "q75")


@query
def sketched_quartiles(spark, sf):
    """Quartiles from sketches kept by date and hour, and whether their ranks are within the bound."""
    trips = B.clean(spark, sf)
    cube = materialize(P.sketch_cube(trips, ["pickup_date", "pickup_hour"]), "sketches")
    found = P.rank_distances(trips, materialize(P.sketch_quartiles(cube), "quartiles"))
    bound = 0.01
    return found.select("column", "count", "quartile", F.lit(bound).alias("bound"), (F.col("distance") <= bound).alias("within"))


@query
def numeric_summary_exact(spark, sf):
    """A14, exact quartiles."""
    return _rounded_summary(P.numeric_summary(B.clean(spark, sf), exact=True))


@query
def lineitem_summary_exact(spark, sf):
    """A14 over a large table."""
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    return _rounded_summary(P.numeric_summary(B.table(spark, sf, "lineitem"), columns, exact=True))


def _rounded_summary(df: DataFrame) -> DataFrame:
    values = ["mean", "stddev", "min", "q25", "q50", "q75", "max"]
    return df.select("column", "count", *[round_half_up(F.col(v), 4).alias(v) for v in values])


@query
def table_manifest(spark, sf):
    """S10."""
    gold, _, _ = _gold(spark, sf)
    listing = P.manifest({name: (df, f"gold/{name}") for name, df in gold.items()})
    return listing.withColumn("columns", F.concat_ws(",", "columns"))


@query
def source_files(spark, sf):
    """Rows and columns of the landed file."""
    profile = tables.source_profile(spark, f"{sf}/orders.parquet")
    return profile.agg(
        F.sum("rows").alias("rows"),
        F.max(F.concat_ws(",", "columns")).alias("columns"),
        F.max(F.col("file_size_bytes") > 0).alias("has_size"),
    )


@query
def delivery_checks(spark, sf):
    """Tables, models, and sections of both dashboards. One of the two demanded models is missing, so its rule fails."""
    clean = B.clean(spark, sf)
    small, full, model = _bundles(spark, sf)
    checked = {
        "bronze": B.trips(spark, sf),
        "silver": clean,
        "demand_features": M.demand_features(clean),
        "demand_pattern": M.demand_pattern(clean),
        "od_rank": M.top_routes(clean),
        "model_metrics": materialize(model["metrics"], "metrics"),
        "dashboard": materialize(small, "bundle"),
        "offline": materialize(full, "bundle"),
    }
    rules = warehouse.delivery_rules(5_000, 1_000) + [
        P.Rule("bronze", "filled", ("passenger_count",)),
        P.Rule("silver", "values", ("payment_type_label",), values=("cash", "dispute", "barter")),
        *warehouse.model_rules(),
        *warehouse.bundle_rules(),
    ]
    return P.expectations(checked, rules)


# --- metric tables -------------------------------------------------------------------------


@query
def hourly_metrics(spark, sf):
    """A1."""
    return M.hourly_metrics(B.clean(spark, sf))


@query
def hourly_metrics_counting_passengers(spark, sf):
    """Rows counted by a column that may be null."""
    return M.hourly_metrics(B.clean(spark, sf, nulls="keep"), count_col="passenger_count")


@query
def daily_metrics(spark, sf):
    """A2."""
    return M.daily_metrics(B.clean(spark, sf))


@query
def daily_metrics_in_month(spark, sf):
    """F8."""
    return K.in_month(M.daily_metrics(B.clean(spark, sf)), "2024-01")


@query
def pickup_hotspots(spark, sf):
    """A3."""
    return M.pickup_hotspots(B.clean(spark, sf))


@query
def od_routes(spark, sf):
    """A4."""
    return M.od_routes(B.clean(spark, sf))


@query
def payment_metrics(spark, sf):
    """A5."""
    return M.payment_metrics(B.clean(spark, sf))


@query
def payment_metrics_by_code(spark, sf):
    """A5 by raw code."""
    return M.payment_metrics(B.clean(spark, sf), by="payment_type")


@query
def demand_features(spark, sf):
    """A6."""
    return M.demand_features(B.clean(spark, sf))


@query
def demand_features_weekend_share(spark, sf):
    """A6b."""
    return M.demand_features(B.clean(spark, sf), weekend_share=True)


@query
def demand_pattern_from_cube(spark, sf):
    """A7 re-aggregated from the cube."""
    return M.demand_pattern(M.trip_cube(B.clean(spark, sf)))


@query
def peak_periods(spark, sf):
    """A8, P10a."""
    return M.peak_periods(B.clean(spark, sf))


@query
def peak_periods_five(spark, sf):
    """A8, P10b."""
    return M.peak_periods(B.clean(spark, sf), scheme="five")


@query
def fare_by_distance(spark, sf):
    """A9, P11a; lenient trips, so unknown distances would show."""
    return M.fare_by_distance(B.clean(spark, sf, nulls="keep"))


@query
def fare_by_distance_bins(spark, sf):
    """A9, P11b."""
    return M.fare_by_distance(B.clean(spark, sf), scheme="bins")


@query
def weekday_hour(spark, sf):
    """A10."""
    return M.weekday_hour(B.clean(spark, sf))


@query
def weekday_hour_grid(spark, sf):
    """A10 with every cell."""
    return M.weekday_hour(B.clean(spark, sf), fill=True)


@query
def trip_headline(spark, sf):
    """A11."""
    return M.headline(B.clean(spark, sf))


@query
def top_zones(spark, sf):
    """L2."""
    return M.top_zones(B.clean(spark, sf))


@query
def top_routes(spark, sf):
    """L3."""
    return M.top_routes(B.clean(spark, sf))


@query
def seven_decimals(spark, sf):
    """Sums and averages of values of either sign with seven decimals."""
    e = F.col("event_id")
    value = (F.col("value") + e / 10_000_000) * F.when(e % 3 == 0, -1).otherwise(1)
    rows = B.events(spark, sf).select("event_type", value.alias("v"))
    sums = rows.groupBy("event_type").agg(F.count("*").alias("rows"), *limb_sums("v", "v"), count_known("v").alias("known"))
    return sums.select("event_type", "rows", rounded_sum("v", 7).alias("total"), rounded_avg("v", F.col("known"), 7).alias("average"))


def _line_trips(spark, sf):
    """Line items as trips between suppliers and parts."""
    lines = B.table(spark, sf, "lineitem")
    return lines.select(
        F.concat(F.lit("zone_"), F.col("l_suppkey").cast("string")).alias("pickup_zone"),
        F.concat_ws(
            "_to_",
            F.concat(F.lit("zone_"), F.col("l_suppkey").cast("string")),
            F.concat(F.lit("zone_"), F.col("l_partkey").cast("string")),
        ).alias("od_pair"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_linenumber") * 7.5).alias("trip_duration_min"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )


@query
def lineitem_hotspots(spark, sf):
    """A3 over a large table."""
    return M.pickup_hotspots(_line_trips(spark, sf))


@query
def lineitem_routes(spark, sf):
    """A4 over a large table with many keys."""
    return M.od_routes(_line_trips(spark, sf))


@query
def lineitem_top_routes(spark, sf):
    """L3 over a large table."""
    return M.top_routes(_line_trips(spark, sf))


# --- records and bundles ----------------------------------------------------------------------


@query
def first_feature_records(spark, sf):
    """The rows an export of 500 records holds."""
    table = M.demand_features(B.clean(spark, sf))
    return M.first_n(table, ["pickup_date", "pickup_hour", "pickup_zone"], 500)


@query
def stored_table(spark, sf):
    """Written twice, read back with its schema."""
    table = M.demand_features(B.clean(spark, sf))
    path = new_folder(spark, "stored")
    for _ in range(2):
        tables.write_table(table, path)
    return tables.read_table(spark, path, table.schema)


@query
def stored_csv(spark, sf):
    """S6, S2."""
    table = M.od_routes(B.clean(spark, sf))
    path = new_folder(spark, "stored") + ".csv"
    tables.export_csv(table, path)
    return tables.read_table(spark, path, table.schema)


@query
def stored_records(spark, sf):
    """The JSON records an export leaves behind."""
    table = M.demand_features(B.clean(spark, sf))
    path = new_folder(spark, "stored")
    tables.export_records(table, path, warehouse.export_order("demand_features"), 500)
    return spark.read.schema(table.schema).json(path)


def _gold(spark, sf):
    """Metric tables over a stored cube, the cube, clean trips."""
    clean = B.clean(spark, sf)
    cube = materialize(M.trip_cube(clean), "cube")
    return warehouse.gold_tables(cube, clean), cube, clean


def _line_models(features: DataFrame) -> dict[str, DataFrame]:
    """Model sections from the mean and the zone line, which SQL can repeat."""
    train, test = L.hash_split(materialize(L.labelled(features), "features"))
    line = L.fit_zone_line(train, numeric=LINE_FEATURES)
    scored = L.mean_baseline(train, line.transform(test, "improved_prediction"))
    metrics = L.compare_models({"baseline_mean": (scored, "baseline_prediction"), demand.LINEAR: (scored, "improved_prediction")})
    shown = metrics.select("model", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("rmse", "mae", "r2")])
    return {
        "metrics": shown,
        "evaluation_report": warehouse.evaluation_report(metrics, train, test),
        "predictions": L.prediction_table(scored),
    }


def _bundles(spark, sf):
    gold, cube, clean = _gold(spark, sf)
    bronze = B.trips(spark, sf)
    analysis = {"summary": M.headline(clean), **warehouse.analysis_tables(cube, clean)}
    model = _line_models(gold["demand_features"])
    files = tables.source_profile(spark, f"{sf}/events.parquet")
    quality = {
        "source": files.agg(F.sum("rows").alias("rows"), F.max("columns").alias("columns")),
        "bronze_profile": P.missing_profile(bronze),
        "silver_quality": K.quality_report(bronze),
        "gold_manifest": P.manifest({name: (df, f"gold/{name}") for name, df in gold.items()}),
    }
    return warehouse.small_bundle(gold, model["predictions"]), warehouse.full_bundle(gold, analysis, quality, model), model


@query
def dashboard_small(spark, sf):
    """S8, with predictions."""
    gold, _, _ = _gold(spark, sf)
    return warehouse.small_bundle(gold, _line_models(gold["demand_features"])["predictions"])


@query
def dashboard_full(spark, sf):
    """Metric, analysis, quality and model sections."""
    return _bundles(spark, sf)[1]


@query
def dashboard_sections(spark, sf):
    """sections that have records."""
    gold, _, _ = _gold(spark, sf)
    return R.filled_sections(warehouse.small_bundle(gold))


@query
def stacked_tables(spark, sf):
    """U2."""
    clean = B.clean(spark, sf)
    return R.stack_tables(
        {"hourly": M.hourly_metrics(clean), "daily": M.daily_metrics(clean), "pattern": M.demand_pattern(clean)}
    )


# --- road readings and alerts -----------------------------------------------------------------------


@query
def congestion_classes(spark, sf):
    """P12."""
    rows = B.events(spark, sf)
    occupancy = (F.col("event_id") * 13 % 100) / 100
    return rows.select("event_id", C.classify_congestion(F.col("value"), occupancy).alias("congestion_level"))


@query
def reading_measures(spark, sf):
    """P13."""
    rows = B.readings(spark, sf).select("event_id", "road_id", "vehicle_count", "speed_kmh")
    roads = roads_table(spark).select("road_id", "capacity")
    return rows.join(roads, "road_id").select(
        "event_id",
        round_half_up(C.occupancy_ratio(F.col("vehicle_count"), F.col("capacity")), 4).alias("occupancy"),
        C.travel_time(F.col("speed_kmh")).alias("travel_time_sec"),
    )


@query
def json_readings(spark, sf):
    """S3: readings through their JSON messages, broken ones skipped."""
    messages = streams.reading_messages(B.readings(spark, sf)).select("value")
    broken = B.events(spark, sf).select(F.concat(F.lit("{broken "), F.col("props")).alias("value"))
    back = streams.road_readings(messages.unionByName(broken))
    return back.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query
def hop_windows(spark, sf):
    """ST2."""
    hopped = S.hop(B.readings(spark, sf).select("event_time", "road_id"))
    return hopped.groupBy("window_start", "window_end", "road_id").agg(F.count("*").alias("readings"))


def _alerts(spark, sf):
    return S.congestion_alerts(B.readings(spark, sf))


@query
def congestion_alerts(spark, sf):
    """ST3, F5, P14, P15, P17."""
    return _alerts(spark, sf)


@query
def stream_congestion_alerts(spark, sf):
    """S3, S4, ST1-ST5: the same alerts from a stream of JSON messages, closed windows only."""
    messages = streams.reading_messages(B.readings_of(B.event_stream(spark, sf), roads_table(spark)))
    folder = new_folder(spark, "alerts")
    run = stream_plan.start(messages, f"{folder}/sink", f"{folder}/state", state_partitions=_state_width(spark))
    run.awaitTermination()
    return _plain_times(stream_plan.stored_alerts(spark, f"{folder}/sink"))


def _state_width(spark: SparkSession) -> int:
    """State partitions of a stream: as many as tasks run at once, the shuffle width at most."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


@contextmanager
def _state_conf(spark: SparkSession):
    """The shuffle width a stream takes its state partitions from when it starts."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(_state_width(spark)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _plain_times(alerts: DataFrame) -> DataFrame:
    return alerts.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


#: Rows of a delivery in one file at least.
_FILE_ROWS = 100_000


def _delivered(df: DataFrame, delivery: str, root: str, file_rows: int = _FILE_ROWS):
    """Write the rows of each value of ``delivery``, in order; yields the number of files after each.

    All deliveries have the same number of files, so a stream that takes that many at once
    takes a delivery a batch. The smallest has ``file_rows`` a file at least, dealt evenly, or one file.
    """
    placed = materialize(df, "deliveries")
    sizes = {r[0]: r[1] for r in placed.groupBy(delivery).count().collect()}
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = max(1, min(width, min(sizes.values(), default=0) // file_rows))
    for n in sorted(sizes):
        rows = placed.filter(F.col(delivery) == n).drop(delivery)
        rows = rows.coalesce(1) if files == 1 else rows.repartition(files)
        rows.write.mode("append").parquet(root)
        yield files


def _part_of(number: Column, last: Column, parts: int) -> Column:
    """Which of ``parts`` equal ranges of 0..last a number falls into."""
    return (number * parts / (last + 1)).cast("int")


LATE_PARTS = 5


@query
def stream_late_readings(spark, sf):
    """ST1, ST4, ST5: readings in five deliveries, a batch each; one in 40 comes a delivery late, one in 40 two and is dropped where its window is closed."""
    events = B.events(spark, sf)
    number, last = F.col("number"), F.col("last")
    part = _part_of(number, last, LATE_PARTS)
    delay = F.when(number % 40 == 7, 1).when(number % 40 == 9, 2).otherwise(0)
    rows = B.readings(spark, sf).withColumns({"number": F.col("event_id").cast("bigint"), "last": events.agg(F.max("event_id")).scalar()})
    rows = rows.withColumn("delivery", F.least(part + delay, F.lit(LATE_PARTS - 1))).drop("number", "last")
    messages = streams.reading_messages(rows.drop("delivery")).columns
    fields = [F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSS").alias(n) if k.startswith("timestamp") else F.col(n) for n, k in rows.dtypes if n != "delivery"]
    rows = rows.select("delivery", F.col("road_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
    folder = new_folder(spark, "late")
    files = max(_delivered(rows, "delivery", f"{folder}/in"), default=1)
    incoming = spark.readStream.schema("key STRING, value STRING").option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
    stream_plan.start(incoming.select(*messages), f"{folder}/sink", f"{folder}/state", state_partitions=_state_width(spark)).awaitTermination()
    return _plain_times(stream_plan.stored_alerts(spark, f"{folder}/sink"))


@query
def served_alerts_from_sink(spark, sf):
    """S4, ST6, W4, J1, L4: readings in three deliveries, a run of the stream for each; the served table after the last."""
    last = B.events(spark, sf).agg(F.max("event_id")).scalar()
    rows = B.readings(spark, sf)
    part = _part_of(F.col("number"), F.col("last"), 3)
    placed = rows.withColumns({"number": F.col("event_id").cast("bigint"), "last": last}).withColumn("delivery", part).drop("number", "last")
    folder = new_folder(spark, "serving")
    with _state_conf(spark):
        for _ in _delivered(placed, "delivery", f"{folder}/in"):
            incoming = streams.reading_messages(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"))
            stream_plan.start_serving(incoming, folder, f"{folder}/state", period="hour").awaitTermination()
    return _plain_times(stream_plan.served_table(spark, folder))


@query
def stream_named_alerts(spark, sf):
    """Alerts in three deliveries, each repeated with another count in the next; first deliveries come out, named."""
    alerts = _alerts(spark, sf).withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    alerts = alerts.withColumn("road_name", F.lit("?"))
    spans = alerts.agg(F.min("window_end").alias("low"), F.max("window_end").alias("high"))
    seconds = {n: F.unix_seconds(spans.select(n).scalar()) for n in ("low", "high")}
    part = _part_of(F.unix_seconds("window_end") - F.col("low"), F.col("high") - F.col("low"), 3)
    first = alerts.withColumns(seconds).withColumn("delivery", part).drop("low", "high")
    again = first.withColumns({"delivery": F.col("delivery") + 1, "vehicle_count": F.col("vehicle_count") + 1})
    folder = new_folder(spark, "naming")
    files = max(_delivered(first.unionByName(again), "delivery", f"{folder}/in"), default=1)
    incoming = spark.readStream.schema(stream_plan.ALERT_SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
    stream_plan.start_naming(incoming, f"{folder}/sink", f"{folder}/state", state_partitions=_state_width(spark)).awaitTermination()
    return _plain_times(stream_plan.stored_alerts(spark, f"{folder}/sink"))


@query
def severe_alerts(spark, sf):
    """F9."""
    return A.severe_only(_alerts(spark, sf)).select("window_start", "window_end", "road_id", "avg_speed_kmh")


@query
def enriched_alerts(spark, sf):
    """J1, P15 with count, P16: unnamed alerts with untrimmed ids."""
    bare = _alerts(spark, sf).withColumns(
        {
            "road_id": F.concat(F.lit(" "), F.col("road_id"), F.lit(" ")),
            "road_name": F.lit(None).cast("string"),
            "district": F.lit("?"),
        }
    )
    known = roads_table(spark).filter(F.col("road_id") != "R010")
    return A.enrich_roads(A.normalize_alerts(bare), known)


@query
def latest_alerts(spark, sf):
    """Every alert delivered twice, with a higher count the second time."""
    alerts = _alerts(spark, sf).withColumn("arrival", F.lit(1))
    again = alerts.withColumns({"arrival": F.lit(2), "vehicle_count": F.col("vehicle_count") + 1})
    both = alerts.unionByName(again)
    return A.latest_alerts(both, 100, "arrival").select(
        "window_start", "window_end", "road_id", "vehicle_count", "arrival"
    )


@query
def ranked_alerts(spark, sf):
    """L4."""
    return A.rank_alerts(_alerts(spark, sf)).select(
        "window_start", "window_end", "road_id", "severity", "avg_speed_kmh", "vehicle_count"
    )


@query
def newest_alert(spark, sf):
    """L5."""
    return A.newest_alert(_alerts(spark, sf)).select("window_start", "window_end", "road_id", "avg_speed_kmh")


@query
def served_alerts(spark, sf):
    """ST6."""
    return A.serve_alerts(_alerts(spark, sf), roads_table(spark))


@query
def speed_trend(spark, sf):
    """W6."""
    return A.speed_trend(_alerts(spark, sf))


@query
def severity_counts(spark, sf):
    """A16, P20."""
    return C.display_labels(A.severity_counts(_alerts(spark, sf)), severity="severity")


@query
def road_ranking(spark, sf):
    """A17."""
    return A.road_ranking(_alerts(spark, sf))


@query
def alert_headline(spark, sf):
    """A18."""
    return A.alert_headline(_alerts(spark, sf))


def _current(spark, sf):
    """The dashboard over alerts of which every one was delivered twice."""
    alerts = _alerts(spark, sf)
    return stream_plan.dashboard(alerts.unionByName(alerts))


@query
def current_severity_counts(spark, sf):
    """W4, A16, P20."""
    return C.display_labels(_current(spark, sf)["severity_counts"], severity="severity")


@query
def current_road_ranking(spark, sf):
    """W4, A17."""
    return _current(spark, sf)["road_ranking"]


@query
def current_alert_headline(spark, sf):
    """W4, A18."""
    return _current(spark, sf)["alert_headline"]


@query
def current_speed_trend(spark, sf):
    """W4, W6."""
    return _current(spark, sf)["speed_trend"]


@query
def ingest_stats(spark, sf):
    """ST7."""
    return A.ingest_stats(_alerts(spark, sf), "window_end")


# --- event windows ----------------------------------------------------------------------------------


EVENT_ORDER = ("pickup_datetime", "trip_id")


def _trip_events(spark, sf):
    clean = B.clean(spark, sf)
    return clean.select(
        "pickup_datetime", F.col("event_id").alias("trip_id"), "pickup_zone", "fare_amount", "trip_distance"
    )


@query
def numbered_events(spark, sf):
    """W1 over all events."""
    return N.number_events(_trip_events(spark, sf), EVENT_ORDER).select("event_id", "trip_id")


@query
def first_events(spark, sf):
    """The first 500 in time order."""
    return N.number_events(_trip_events(spark, sf), EVENT_ORDER, limit=500).select("event_id", "trip_id", "pickup_zone")


@query
def count_windows(spark, sf):
    """W2, W3, ST8 over all events."""
    return W.count_window(N.number_events(_trip_events(spark, sf), EVENT_ORDER))


@query
def stream_count_windows(spark, sf):
    """W2, W3, ST8: the same snapshots from a stream, in four deliveries with a run for each."""
    events = _trip_events(spark, sf)
    at = F.unix_micros(F.col("pickup_datetime").cast("timestamp"))
    cuts = materialize(events.withColumn("at", at), "trip-events")
    edges = cuts.approxQuantile("at", [0.25, 0.5, 0.75], 0.01)
    delivery = sum(((F.col("at") > edge).cast("int") for edge in edges), F.lit(0))
    folder = new_folder(spark, "count-windows")
    for _ in _delivered(cuts.withColumn("delivery", delivery).drop("at"), "delivery", f"{folder}/in"):
        incoming = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        CW.start_count_windows(incoming, folder, f"{folder}/state-of-query", EVENT_ORDER).awaitTermination()
    return CW.stored_count_windows(spark, folder)


# --- boxes --------------------------------------------------------------------------------------------


@query
def annotation_boxes(spark, sf):
    """S12."""
    return X.parse_boxes(B.annotation_texts(spark, sf))


@query
def large_boxes(spark, sf):
    """F7 at a size that splits the boxes."""
    return X.min_box(B.truth_boxes(spark, sf), 70)


@query
def confident_detections(spark, sf):
    """F6."""
    return X.above_score(B.detections(spark, sf), 0.25).select("image", "det_id", "score")


@query
def detection_classes(spark, sf):
    """A22."""
    return X.class_counts(B.detections(spark, sf))


@query
def images_with_boxes(spark, sf):
    """Images that have a large true box."""
    large = X.min_box(B.truth_boxes(spark, sf), 95)
    return X.annotated_images(B.images(spark, sf), large)


@query
def background_boxes(spark, sf):
    """J2."""
    return X.background_boxes(B.detections(spark, sf), B.truth_boxes(spark, sf)).select(
        "image", "det_id", *C.CORNERS
    )


@query
def suppressed_boxes(spark, sf):
    """W5 at 0.3."""
    return X.nms(B.detections(spark, sf)).select("image", "det_id", "score")


@query
def suppressed_boxes_loose(spark, sf):
    """W5 at 0.45."""
    return X.nms(B.detections(spark, sf), 0.45).select("image", "det_id", "score")


@query
def suppressed_boxes_in_rounds(spark, sf):
    """W5 with every image treated as a large one."""
    return X.nms(B.detections(spark, sf), fold_limit=4).select("image", "det_id", "score")


@query
def matched_boxes(spark, sf):
    """J3."""
    return X.match_boxes(B.detections(spark, sf), B.truth_boxes(spark, sf))


@query
def matched_boxes_in_rounds(spark, sf):
    """J3 with every image treated as a large one."""
    return X.match_boxes(B.detections(spark, sf), B.truth_boxes(spark, sf), fold_limit=1)


@query
def detection_totals(spark, sf):
    """A19."""
    matches = X.match_boxes(B.detections(spark, sf), B.truth_boxes(spark, sf))
    totals = X.detection_totals(matches)
    return totals.select(
        "tp", "fp", "fn", *[round_half_up(F.col(c), 4).alias(c) for c in ("precision", "recall", "f1")]
    )


@query
def scanned_images(spark, sf):
    """Windows of every image scored by fixed weights, suppressed, matched, rated."""
    place = (F.col("x") * 7919 + F.col("y") * 104729 + F.col("image") * 31) % 999983 / F.lit(999983.0)
    windows = X.window_grid(B.images(spark, sf)).withColumn("features", F.array(place, F.col("scale")))
    found = detection.detections(L.linear_scores(windows, (1.0, -0.05), 0.0, "features"), 0.93)
    totals = detection.evaluate(found, B.truth_boxes(spark, sf), suppression=None)
    return totals.select(
        "tp", "fp", "fn", *[round_half_up(F.col(c), 4).alias(c) for c in ("precision", "recall", "f1")]
    )


@query
def sampled_background(spark, sf):
    """W7, H: per image only, without the overall cap."""
    return X.sample_background(B.images(spark, sf), B.truth_boxes(spark, sf))


@query
def training_boxes(spark, sf):
    """W7 with cap, F7, U1."""
    return detection.training_boxes(B.images(spark, sf), B.truth_boxes(spark, sf))


@query
def training_counts(spark, sf):
    """A23."""
    return L.sample_counts(detection.training_boxes(B.images(spark, sf), B.truth_boxes(spark, sf)))


@query
def detection_windows(spark, sf):
    """Windows per image and scale with sums of their corners."""
    grid = X.rescale_boxes(X.window_grid(B.images(spark, sf)))
    sums = [F.sum(c).alias(f"sum_{c}") for c in C.CORNERS]
    return grid.groupBy("image", "scale").agg(F.count("*").alias("windows"), *sums)


# --- splits, scores, models ------------------------------------------------------------------------------


@query
def hash_split(spark, sf):
    """M1."""
    return L.hash_part(M.demand_features(B.clean(spark, sf))).select(*L.DEMAND_KEY, "part")


@query
def zone_indexes(spark, sf):
    """M3: index of every zone of the feature table."""
    numbers = L.zone_numbers(M.demand_features(B.clean(spark, sf)))
    return numbers.select("pickup_zone", F.col("zone_index").cast("int").alias("zone_index"))


@query
def assembled_features(spark, sf):
    """M4: numeric features of every row as one vector."""
    features = M.demand_features(B.clean(spark, sf))
    rows = VectorAssembler(inputCols=list(L.NUMERIC_FEATURES), outputCol="vector").transform(features)
    return rows.select(*L.DEMAND_KEY, vector_to_array("vector").alias("vector"))


@query
def stratified_split(spark, sf):
    """M2."""
    rows = B.events(spark, sf).select("event_id", "event_type")
    return L.stratified_split(rows, "event_type", "event_id")


@query
def split_counts(spark, sf):
    """M2, A23."""
    rows = B.events(spark, sf).select(
        "event_id", F.col("event_type").isin(*B.TRUTH_TYPES).cast("int").alias("label")
    )
    return L.sample_counts(L.stratified_split(rows, "label", "event_id"), in_train="in_train")


def _baseline(spark, sf):
    features = L.labelled(M.demand_features(B.clean(spark, sf)))
    train, test = L.hash_split(features)
    return L.mean_baseline(train, test)


@query
def mean_baseline(spark, sf):
    """M6, F4."""
    rows = _baseline(spark, sf)
    return rows.select(*L.DEMAND_KEY, round_half_up(F.col("baseline_prediction"), 4).alias("baseline_prediction"))


@query
def mean_baseline_metrics(spark, sf):
    """A21."""
    return L.regression_metrics(_baseline(spark, sf), prediction="baseline_prediction")


def _price_models(spark, sf):
    lines = B.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    guess = lines.select("l_extendedprice", (F.col("l_quantity") * 1000).alias("by_quantity"), F.lit(25000.0).alias("flat"))
    return L.compare_models(
        {"by_quantity": (guess, "by_quantity"), "flat": (guess, "flat")}, label="l_extendedprice"
    )


@query
def model_comparison(spark, sf):
    """M11, A21."""
    return _price_models(spark, sf)


@query
def best_model(spark, sf):
    """L8."""
    return L.best_model(_price_models(spark, sf))


@query
def model_display_names(spark, sf):
    """P20 on model names; a name without entry stays."""
    renamed = _price_models(spark, sf).withColumn(
        "model", F.when(F.col("model") == "by_quantity", demand.LINEAR).otherwise(F.col("model"))
    )
    return C.display_labels(renamed, model="model").select("model", "model_display", "r2")


WEIGHTS = [((i * 7) % 13 - 6) / 10 for i in range(64)]


def _scored(spark, sf):
    rows = L.linear_scores(B.table(spark, sf, "embeddings"), WEIGHTS, 0.1)
    return rows.select(
        "vec_id",
        "decision",
        (F.col("label") < 5).cast("int").alias("label"),
        (F.col("decision") >= 0).cast("int").alias("prediction"),
    )


@query
def linear_scores(spark, sf):
    """M12."""
    return _scored(spark, sf).select("vec_id", round_half_up(F.col("decision"), 6).alias("decision"))


@query
def confusion_matrix(spark, sf):
    """A20."""
    return L.confusion_matrix(_scored(spark, sf))


@query
def class_report(spark, sf):
    """A20."""
    return L.class_report(_scored(spark, sf))


@query
def report_averages(spark, sf):
    """A20."""
    return L.report_averages(_scored(spark, sf))


@query
def full_confusion_matrix(spark, sf):
    """Only rows judged 1, so two of four cells are empty."""
    return L.full_confusion_matrix(_scored(spark, sf).filter("prediction = 1"))


@query
def scaled_vectors(spark, sf):
    """M5: fitted on all rows, one output row per vector and dimension."""
    rows = L.as_vectors(B.table(spark, sf, "embeddings"), "embedding")
    scaled = L.standard_scaler().fit(rows).transform(rows)
    return scaled.select("vec_id", F.posexplode(L.vector_to_array("scaled")).alias("dim", "z")).select(
        "vec_id", "dim", round_half_up(F.col("z"), 4).alias("z")
    )


@query
def stored_model(spark, sf):
    """A fitted scaler saved, loaded and applied."""
    rows = L.as_vectors(B.table(spark, sf, "embeddings"), "embedding")
    path = new_folder(spark, "model")
    L.save_model(L.Pipeline(stages=[L.standard_scaler()]).fit(rows), path)
    scaled = L.load_model(path).transform(rows)
    return scaled.select("vec_id", F.posexplode(L.vector_to_array("scaled")).alias("dim", "z")).select(
        "vec_id", "dim", round_half_up(F.col("z"), 4).alias("z")
    )


def _svm_rows(spark, sf):
    """Embeddings with a label, scaled on the training rows; and the squared-hinge machine trained on those."""
    rows = B.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", (F.col("label") < 5).cast("int").alias("label")
    )
    split = L.as_vectors(materialize(L.stratified_split(rows, "label", "vec_id"), "split"), "embedding")
    scaled = L.standard_scaler().fit(split.filter("in_train")).transform(split)
    scaled = materialize(scaled.select("vec_id", "label", "in_train", L.vector_to_array("scaled").alias("scaled")), "scaled")
    return scaled, L.squared_hinge_svm(scaled.filter("in_train"))


@query
def svm_decisions(spark, sf):
    """Squared-hinge linear SVM on embeddings, decision values of the held-out rows."""
    scaled, machine = _svm_rows(spark, sf)
    return machine.transform(scaled.filter("NOT in_train")).select("vec_id", "label", "prediction", "decision")


@query
def svm_optimum(spark, sf):
    """Training rows, and whether the trained machine is the least: no weight can move and lower the objective, whose slope is summed again in SQL terms."""
    scaled, machine = _svm_rows(spark, sf)
    side = F.when(F.col("label") == 1, 1.0).otherwise(-1.0)
    scored = machine.transform(scaled.filter("in_train")).withColumn("gap", F.greatest(F.lit(0.0), 1 - side * F.col("decision")))
    pulls = scored.select("vec_id", F.posexplode(F.transform("scaled", lambda v: v * side * F.col("gap"))).alias("dim", "pull"), (side * F.col("gap")).alias("push"))
    slopes = pulls.groupBy("dim").agg(F.sum("pull").alias("pull"), F.sum("push").alias("push"), F.count("*").alias("rows"))
    weights = F.lit(list(machine.weights))
    at_rest = F.abs(F.element_at(weights, F.col("dim") + 1) - 0.02 * F.col("pull")) < 1e-6
    level = F.abs(F.lit(machine.bias) - 0.02 * F.col("push")) < 1e-6
    return slopes.select("dim", "rows", at_rest.alias("weight_at_rest"), level.alias("bias_at_rest"))


#: The average distance is a fifth of the average fare in these trips, so a line over both has no single solution.
LINE_FEATURES = ("pickup_hour", "pickup_weekday", "is_weekend", "avg_fare", "avg_duration_min")


def _zone_line(spark, sf):
    train, test = L.hash_split(materialize(L.labelled(M.demand_features(B.clean(spark, sf))), "features"))
    return L.fit_zone_line(train, numeric=LINE_FEATURES), test


@query
def zone_line_coefficients(spark, sf):
    """M7: least squares with a level for each zone."""
    line, _ = _zone_line(spark, sf)
    return line.table().select("feature", round_half_up(F.col("coefficient"), 6).alias("coefficient"))


@query
def zone_line_predictions(spark, sf):
    """M7, M9: predictions of the held-out rows."""
    line, test = _zone_line(spark, sf)
    return line.transform(test).select(*L.DEMAND_KEY, round_half_up(F.col("baseline_prediction"), 5).alias("baseline_prediction"))


@query
def demand_prediction_rows(spark, sf):
    """M8, M9: the first 5,000 held-out rows in order, and whether the forest's prediction lies among the labels."""
    models = demand.train_demand_models(M.demand_features(B.clean(spark, sf)), trees=8, depth=5)
    spread = models.train.agg(F.min("demand").alias("low"), F.max("demand").alias("high")).first()
    rows = models.predictions()
    return rows.select(
        "pickup_date", "pickup_hour", "pickup_weekday", "pickup_zone", "demand",
        F.col("improved_prediction").between(spread.low, spread.high).alias("in_range"),
    )


@query
def demand_model_metrics(spark, sf):
    """Three demand models compared."""
    return demand.train_demand_models(M.demand_features(B.clean(spark, sf))).metrics()


@query
def demand_predictions(spark, sf):
    """M9 with the smaller published forest."""
    return demand.train_demand_models(M.demand_features(B.clean(spark, sf))).predictions()
