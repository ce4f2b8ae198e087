"""Column names, types and validity of trip tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.constants import (
    PAYMENT_LABELS,
    REQUIRED_TRIP_COLUMNS,
    TRIP_RENAMES,
    TRIP_TYPES,
    TripLimits,
)
from fareway.functions import columns as C


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim, lower-case, blanks to underscores. Names that collide are refused."""
    names = [name.strip().lower().replace(" ", "_") for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"column names collide after normalising: {repeated}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist, leave the rest."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    return sorted(set(names) - set(df.columns))


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def column_report(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """A row for each table: its name, its rows, and what ``require_columns`` would say of it, null if nothing."""
    names = list(names)
    rows = []
    for name, df in tables.items():
        missing = missing_columns(df, names)
        error = F.lit(f"missing required columns: {missing}") if missing else F.lit(None).cast("string")
        rows.append(df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", error.alias("error")))
    return reduce(DataFrame.unionByName, rows)


def coerce_types(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast to the wanted types; what cannot be read becomes null.

    Columns that already have the type stay untouched, so that filters on them
    still reach the scan. Doubles lose NaN only where they were parsed from text.
    """
    have = dict(df.dtypes)
    changed: dict[str, Column] = {}
    for name, wanted in spec.items():
        if name not in have or have[name] == wanted:
            continue
        if wanted == "timestamp":
            if have[name] == "timestamp_ntz":
                continue
            parsed = (
                F.try_to_timestamp(name) if have[name] == "string" else F.col(name).try_cast(wanted)
            )
        else:
            parsed = F.col(name).try_cast(wanted)
            if wanted == "double" and have[name] == "string":
                parsed = F.when(~F.isnan(parsed), parsed)
        changed[name] = parsed
    return df.withColumns(changed) if changed else df


def standardize_trips(raw: DataFrame) -> DataFrame:
    """Raw monthly table to canonical names, with the payment label added."""
    named = rename_columns(normalize_columns(raw), TRIP_RENAMES)
    return C.label_codes(named, "payment_type", PAYMENT_LABELS, "payment_type_label")


def _bounds(limits: TripLimits) -> dict[str, Column]:
    """The rule of each measured column, null where it is unknown."""
    highest = {
        "trip_duration_min": limits.max_duration_min,
        "trip_distance": limits.max_trip_distance,
        "fare_amount": limits.max_fare_amount,
        "passenger_count": limits.max_passenger_count,
    }
    return {name: (F.col(name) > 0) & (F.col(name) <= bound) for name, bound in highest.items()}


def _strict(limits: TripLimits) -> list[Column]:
    """What a trip without unknown values must pass, as bare comparisons a scan can evaluate; null counts as no."""
    needed = ("pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id")
    return [*[F.col(name).isNotNull() for name in needed], *_bounds(limits).values()]


def _all_of(rules: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, rules)


def trip_validity(limits: TripLimits = TripLimits(), nulls: str = "drop") -> Column:
    """The rule a trip must pass, never null.

    ``drop`` refuses a trip with any unknown value. ``keep`` removes a trip only
    where a rule is broken: unknown distance, fare or passenger count stays, and
    zones are not tested; both times are needed either way.
    """
    if nulls == "drop":
        return F.coalesce(_all_of(_strict(limits)), F.lit(False))
    if nulls == "keep":
        times = [F.col("pickup_datetime").isNotNull(), F.col("dropoff_datetime").isNotNull()]
        known = [F.isnan(F.col(name).cast("double")) | F.coalesce(rule, F.lit(True)) for name, rule in _bounds(limits).items()]
        return _all_of([*times, *known])
    raise ValueError(f"nulls must be 'drop' or 'keep', not {nulls!r}")


def typed_trips(df: DataFrame, fractional: bool = False) -> DataFrame:
    """Required columns, types and the duration: what the validity rule looks at."""
    typed = coerce_types(require_columns(df, REQUIRED_TRIP_COLUMNS), TRIP_TYPES)
    return typed.withColumn(
        "trip_duration_min", C.duration_min("pickup_datetime", "dropoff_datetime", fractional)
    )


def derive_trip_columns(valid: DataFrame) -> DataFrame:
    return C.revenue(C.zone_keys(C.calendar_features(valid)))


def clean_trips(
    df: DataFrame,
    limits: TripLimits = TripLimits(),
    nulls: str = "drop",
    fractional: bool = False,
) -> DataFrame:
    """Valid trips with calendar, zone, route and revenue columns."""
    return derive_trip_columns(typed_trips(df, fractional).filter(_pushable(limits, nulls)))


def _pushable(limits: TripLimits, nulls: str) -> Column:
    """The same rule without the outer null guard: a filter drops null anyway,
    and bare comparisons are what the scan can evaluate itself."""
    return _all_of(_strict(limits)) if nulls == "drop" else trip_validity(limits, nulls)


def quality_report(
    df: DataFrame,
    limits: TripLimits = TripLimits(),
    nulls: str = "drop",
    digits: int = 6,
    fractional: bool = False,
) -> DataFrame:
    """Rows before and after cleaning, in one pass over the input."""
    counted = typed_trips(df, fractional).agg(
        F.count("*").alias("before_rows"),
        F.count_if(trip_validity(limits, nulls)).alias("after_rows"),
    )
    return _removal(counted, digits)


def stored_quality_report(before: DataFrame, after: DataFrame, digits: int = 6) -> DataFrame:
    """The same report from two written tables: both counts come from file footers."""
    counted = before.agg(F.count("*").alias("before_rows")).withColumn(
        "after_rows", after.agg(F.count("*")).scalar()
    )
    return _removal(counted, digits)


def _removal(counted: DataFrame, digits: int) -> DataFrame:
    removed = F.col("before_rows") - F.col("after_rows")
    unit = float(10**digits)
    rate = F.floor(
        removed.cast("double") * F.lit(unit) / F.nullif(F.col("before_rows").cast("double"), F.lit(0.0))
        + F.lit(0.5)
    ) / F.lit(unit)
    return counted.select(
        "before_rows",
        "after_rows",
        removed.alias("removed_rows"),
        F.coalesce(rate, F.lit(0.0)).alias("removal_rate"),
    )


def trip_events(trips: DataFrame) -> DataFrame:
    """Narrow event rows for the count window."""
    return trips.select(
        F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("pickup_datetime"),
        F.col("pickup_zone").cast("string").alias("pickup_zone"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
    )


def in_month(df: DataFrame, month: str, column: str = "pickup_date") -> DataFrame:
    """Rows of one month as a half-open range, which the scan can prune."""
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"month must look like 2024-01, not {month!r}")
    start = F.to_date(F.lit(f"{month}-01"))
    return df.filter((F.col(column) >= start) & (F.col(column) < F.add_months(start, 1)))
