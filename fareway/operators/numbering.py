"""Row numbers of a whole table without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareway.session import materialize


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_no") -> DataFrame:
    """Number all rows 1..n in the given order.

    The table is range-partitioned by the whole order key, so a value shared by a
    third of the rows is still split as long as a later key tells its rows apart.
    Each row keeps its place inside its partition; the sorted table is written once,
    and the row counts of the partitions (one row each) give every partition its
    offset. Keys should be unique for repeatable numbers.
    """
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(width, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "numbered",
    )
    # the id holds the partition in its upper 31 bits and the place in the lower 33
    part, place = F.shiftright("_slot", 33), F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    offsets = sizes.select("_part", before.alias("_before"))
    # as many rows as partitions: bounded by the shuffle width, not by the data
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + place + 1)
        .drop("_part", "_slot", "_before")
    )


def number_events(
    df: DataFrame,
    order: Sequence[str | Column],
    limit: int | None = None,
    name: str = "event_id",
) -> DataFrame:
    """Number events from 1 in ``order``, whose last keys must tell rows apart; ``limit`` keeps the first ones."""
    numbered = number_rows(df, order, name)
    return numbered if limit is None else numbered.filter(F.col(name) <= limit)
