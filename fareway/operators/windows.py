"""Count-based windows over numbered events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.functions.measures import count_known, limb_sums, resummed, rounded_avg


def count_window(
    events: DataFrame, size: int = 120, stride: int = 25, number: str = "event_id", after: int = 0
) -> DataFrame:
    """A snapshot of the last ``size`` events at every ``stride`` events and at the end.

    The snapshot after event k covers the numbers k-size+1 to k; those up to ``after`` are left out. Each event is sent
    to the few snapshots that cover it and counted there per zone; the snapshot is
    then put together from its zones. Equal zone counts go to the smallest zone.
    """
    last = events.agg(F.max(number)).scalar()
    n = F.col(number)
    nothing = F.array().cast("array<bigint>")
    first_end = (F.greatest(F.ceil(n / stride), F.lit(after // stride + 1)) * stride).cast("bigint")
    last_end = (F.floor(F.least(n + (size - 1), last) / stride) * stride).cast("bigint")
    regular = F.when(
        first_end <= last_end, F.sequence(first_end, last_end, F.lit(stride).cast("bigint"))
    ).otherwise(nothing)
    final = F.when(n > last - size, F.array(last.cast("bigint"))).otherwise(nothing)
    covered = F.array_union(regular, final)
    per_zone = (
        events.select(
            F.explode(covered).alias("event_id"),
            "pickup_zone",
            "fare_amount",
            "trip_distance",
        )
        .groupBy("event_id", "pickup_zone")
        .agg(
            F.count("*").alias("n"),
            *limb_sums("fare", "fare_amount"),
            count_known("fare_amount").alias("fares"),
            *limb_sums("distance", "trip_distance"),
            count_known("trip_distance").alias("distances"),
        )
    )
    busiest = F.min(F.struct((-F.col("n")).alias("rank"), "pickup_zone"))
    snapshots = per_zone.groupBy("event_id").agg(
        F.sum("n").alias("trip_count"),
        *resummed("fare"),
        F.sum("fares").alias("fares"),
        *resummed("distance"),
        F.sum("distances").alias("distances"),
        busiest.getField("pickup_zone").alias("hotspot_zone"),
    )
    return snapshots.select(
        "event_id",
        F.col("trip_count").cast("int").alias("window_size"),
        "trip_count",
        rounded_avg("fare", F.col("fares"), 3).alias("avg_fare"),
        rounded_avg("distance", F.col("distances"), 3).alias("avg_distance"),
        "hotspot_zone",
    )
