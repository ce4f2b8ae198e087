"""Aggregates of clean trips.

Every table is built from exact sums and counts, so a table can be
re-aggregated from a finer one (``trip_cube``) with the same result to the last
digit as from the trips. No table is ordered here; order belongs to exports.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareway.functions import columns as C
from fareway.functions.measures import (
    MINUTE_UNITS,
    Measure,
    count_known,
    limb_sums,
    resummed,
    rounded_avg,
    rounded_sum,
)

MEASURES: dict[str, Measure] = {
    "avg_distance": Measure("avg", "trip_distance"),
    "avg_fare": Measure("avg", "fare_amount"),
    "avg_duration_min": Measure("avg", "trip_duration_min", units=MINUTE_UNITS),
    "avg_tip": Measure("avg", "tip_amount"),
    "avg_total": Measure("avg", "total_amount"),
    "revenue": Measure("sum", "revenue"),
    "weekend_share": Measure("avg", "is_weekend"),
}

Keys = Sequence[str] | Mapping[str, Column]


def _units_name(measure: Measure) -> str:
    return f"u_{measure.column}"


def _filled_name(measure: Measure) -> str:
    return f"n_{measure.column}"


def _partials(names: Sequence[str], reaggregate: bool) -> list[Column]:
    """Exact sums and, for averages, the number of values behind them."""
    sums: dict[str, list[Column]] = {}
    for name in names:
        m = MEASURES[name]
        units, filled = _units_name(m), _filled_name(m)
        sums[units] = resummed(units) if reaggregate else limb_sums(units, m.column, m.units)
        if m.kind == "avg":
            sums[filled] = [(F.sum(filled) if reaggregate else count_known(m.column)).alias(filled)]
    return [col for cols in sums.values() for col in cols]


def _finish(name: str) -> Column:
    m = MEASURES[name]
    units = _units_name(m)
    if m.kind == "sum":
        return rounded_sum(units, m.digits, m.units).alias(name)
    return rounded_avg(units, F.col(_filled_name(m)), m.digits, m.units).alias(name)


def summarize(
    trips: DataFrame,
    keys: Keys,
    names: Sequence[str],
    count_name: str = "trip_count",
    count_col: str | None = None,
) -> DataFrame:
    """Group trips, or a cube of them, and give the named measures.

    ``count_col`` counts rows where that column is filled instead of all rows; on
    a cube the counting was decided when the cube was made.
    """
    group = (
        [col.alias(name) for name, col in keys.items()]
        if isinstance(keys, Mapping)
        else [F.col(name) for name in keys]
    )
    key_names = list(keys)
    cube = "trip_rows" in trips.columns
    if cube:
        counted = F.sum("trip_rows")
    else:
        counted = F.count(F.col(count_col)) if count_col else F.count("*")
    table = trips.groupBy(*group).agg(counted.alias(count_name), *_partials(names, cube))
    return table.select(*key_names, count_name, *[_finish(name) for name in names])


def trip_cube(trips: DataFrame, count_col: str | None = None) -> DataFrame:
    """Sums and counts per date, hour and pickup zone: hourly, daily, hotspot,
    pattern, period and feature tables are all re-aggregations of it."""
    names = ["avg_distance", "avg_fare", "avg_duration_min", "revenue"]
    counted = F.count(F.col(count_col)) if count_col else F.count("*")
    return trips.groupBy("pickup_date", "pickup_hour", "pickup_zone").agg(
        counted.alias("trip_rows"), *_partials(names, False)
    )


# --- warehouse tables ------------------------------------------------------------


def hourly_metrics(trips: DataFrame, count_col: str | None = None) -> DataFrame:
    names = ["avg_distance", "avg_fare", "avg_duration_min", "revenue"]
    return summarize(trips, ["pickup_hour"], names, count_col=count_col)


def daily_metrics(trips: DataFrame, count_col: str | None = None) -> DataFrame:
    return summarize(trips, ["pickup_date"], ["revenue", "avg_fare"], count_col=count_col)


def pickup_hotspots(trips: DataFrame, count_col: str | None = None) -> DataFrame:
    return summarize(trips, ["pickup_zone"], ["revenue", "avg_distance"], count_col=count_col)


def od_routes(trips: DataFrame, count_col: str | None = None) -> DataFrame:
    return summarize(trips, ["od_pair"], ["avg_fare", "avg_duration_min"], count_col=count_col)


def payment_metrics(
    trips: DataFrame, by: str = "payment_type_label", count_col: str | None = None
) -> DataFrame:
    """Per label, or per raw code with ``by='payment_type'``."""
    return summarize(
        trips, {"payment_type": F.col(by)}, ["revenue", "avg_tip"], count_col=count_col
    )


def demand_features(
    trips: DataFrame, weekend_share: bool = False, count_col: str | None = None
) -> DataFrame:
    """Demand per date, hour and zone. Weekday and weekend flag follow from the
    date, so they are derived afterwards and stay out of the shuffle key."""
    names = ["avg_distance", "avg_fare", "avg_duration_min"]
    if weekend_share:
        names.append("weekend_share")
    table = summarize(
        trips,
        ["pickup_date", "pickup_hour", "pickup_zone"],
        names,
        count_name="demand",
        count_col=count_col,
    )
    weekday = C.weekday_of(F.col("pickup_date"))
    return table.select(
        "pickup_date",
        "pickup_hour",
        weekday.alias("pickup_weekday"),
        C.weekend_flag(weekday).alias("is_weekend"),
        "pickup_zone",
        "demand",
        *names,
    )


# --- analysis tables ---------------------------------------------------------------


def demand_pattern(trips: DataFrame, count_col: str | None = None) -> DataFrame:
    return summarize(trips, ["pickup_hour"], ["revenue", "avg_duration_min"], count_col=count_col)


def peak_periods(
    trips: DataFrame,
    scheme: str = "peak",
    names: Mapping[str, str] | None = None,
    count_col: str | None = None,
) -> DataFrame:
    period = C.period_of_day("pickup_hour", scheme, names)
    return summarize(
        trips, {"period": period}, ["avg_fare", "avg_duration_min"], count_col=count_col
    )


def fare_by_distance(
    trips: DataFrame, scheme: str = "overflow", count_col: str | None = None
) -> DataFrame:
    """Per distance bucket, with its position for sorting.

    ``overflow`` puts everything beyond the last edge, and unknown distances, in
    one last bucket; ``bins`` drops what lies outside its closed range.
    """
    if scheme == "overflow":
        edges, labels, rest, lower = C.DISTANCE_EDGES, C.DISTANCE_LABELS, C.DISTANCE_OVERFLOW, None
    elif scheme == "bins":
        edges, labels, rest = C.DISTANCE_BIN_EDGES[1:], C.DISTANCE_BIN_LABELS, None
        lower = C.DISTANCE_BIN_EDGES[0]
    else:
        raise ValueError(f"unknown bucket scheme {scheme!r}")
    ordinal = C.bucket_ordinal("trip_distance", edges, rest is not None, lower)
    placed = trips.withColumn("bucket_no", ordinal).filter(F.col("bucket_no").isNotNull())
    names = F.array(*[F.lit(name) for name in [*labels, *([rest] if rest else [])]])
    table = summarize(placed, ["bucket_no"], ["avg_fare", "avg_total"], count_col=count_col)
    return table.select(
        F.get(names, F.col("bucket_no")).alias("distance_bucket"),
        "bucket_no",
        "trip_count",
        "avg_fare",
        "avg_total",
    )


def weekday_hour(
    trips: DataFrame, fill: bool = False, count_col: str | None = None
) -> DataFrame:
    """Trips per weekday and hour; ``fill`` gives all 168 cells and the largest count."""
    weekday = (
        C.weekday_of(F.col("pickup_date"))
        if "pickup_weekday" not in trips.columns
        else F.col("pickup_weekday")
    )
    table = summarize(
        trips,
        {"pickup_weekday": weekday, "pickup_hour": F.col("pickup_hour")},
        ["avg_fare"],
        count_col=count_col,
    )
    if not fill:
        return table
    cells = table.sparkSession.range(7 * 24).select(
        F.floor(F.col("id") / 24).cast("int").alias("pickup_weekday"),
        (F.col("id") % 24).cast("int").alias("pickup_hour"),
    )
    whole = Window.partitionBy()
    return cells.join(table, ["pickup_weekday", "pickup_hour"], "left").select(
        "pickup_weekday",
        "pickup_hour",
        F.coalesce("trip_count", F.lit(0)).alias("trip_count"),
        "avg_fare",
        F.max(F.coalesce("trip_count", F.lit(0))).over(whole).alias("max_count"),
    )


def headline(trips: DataFrame) -> DataFrame:
    """Busiest hour, zone and route, in one row; equal counts go to the smallest key.

    One scan: the three groupings share an expand and a partial aggregation.
    """
    hour, zone, route = F.col("pickup_hour"), F.col("pickup_zone"), F.col("od_pair")
    counts = trips.groupingSets([[hour], [zone], [route]], hour, zone, route).agg(
        F.count("*").alias("n"), F.grouping_id().alias("kept")
    )

    def busiest(name: str, grouping: int) -> Column:
        mine = F.col("kept") == grouping
        first = F.struct((-F.col("n")).alias("rank"), F.col(name).alias("key"))
        return F.min(F.when(mine, first)).getField("key")

    return counts.agg(
        busiest("pickup_hour", 0b011).alias("top_hour"),
        busiest("pickup_zone", 0b101).alias("top_zone"),
        busiest("od_pair", 0b110).alias("top_od_pair"),
    )


# --- rankings ----------------------------------------------------------------------


def first_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First rows of a total order, for bounded reports."""
    return df.orderBy(*order).limit(n)


def top_zones(trips: DataFrame, n: int = 30, count_col: str | None = None) -> DataFrame:
    table = summarize(trips, ["pickup_zone"], ["avg_fare"], count_col=count_col)
    return first_n(table, [F.desc("trip_count"), F.asc("pickup_zone")], n)


def top_routes(trips: DataFrame, n: int = 50, count_col: str | None = None) -> DataFrame:
    table = summarize(trips, ["od_pair"], ["avg_fare"], count_col=count_col)
    return first_n(table, [F.desc("trip_count"), F.asc("od_pair")], n)
