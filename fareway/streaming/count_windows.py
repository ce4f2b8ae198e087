"""Count windows over a stream: events are numbered as they arrive, across batches and restarts.

What a batch needs of those before it are the last events, one fewer than a window
holds, with their numbers. They are kept as a versioned table, a version for each batch,
and the version is written last: it commits the batch. A batch that is repeated after a
failure starts from the version before its own, which never changes, and writes the same
numbers and snapshots over whatever the failed attempt has left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fareway.constants import flat_schema
from fareway.operators.numbering import number_rows
from fareway.operators.windows import count_window
from fareway.sources.versions import drop_versions, read_version, versions, write_version

SNAPSHOT_SCHEMA = flat_schema(
    "event_id BIGINT, window_size INT, trip_count BIGINT, avg_fare DOUBLE, avg_distance DOUBLE, hotspot_zone STRING"
)


def count_window_batch(
    events: DataFrame, batch: int, root: str, order: Sequence[str], size: int = 120, stride: int = 25
) -> None:
    """Snapshots of one batch and the state after it. The batch is numbered in ``order``, after all batches before."""
    spark = events.sparkSession
    if events.isEmpty():
        return
    state = f"{root}/state"
    earlier = [v for v in versions(spark, state) if v < batch]
    numbered, last = number_rows(events, order, "event_id"), 0
    if earlier:
        held = read_version(spark, state, earlier[-1], numbered.schema)
        last = held.agg(F.max("event_id")).first()[0]
        numbered = held.unionByName(numbered.withColumn("event_id", F.col("event_id") + last))
    write_version(count_window(numbered, size, stride, after=last), f"{root}/snapshots", batch)
    newest = numbered.agg(F.max("event_id")).scalar()
    write_version(numbered.filter(F.col("event_id") > newest - max(size - 1, 1)), state, batch)
    if earlier:
        # the version before stays, for a repeat of this batch
        drop_versions(spark, state, earlier[-1])


def start_count_windows(
    events: DataFrame, root: str, checkpoint: str, order: Sequence[str], size: int = 120, stride: int = 25
) -> StreamingQuery:
    """Run over whatever has arrived; a later run with the same folders goes on from there."""
    writer = events.writeStream.foreachBatch(lambda batch, n: count_window_batch(batch, n, root, order, size, stride))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_count_windows(spark: SparkSession, root: str, stride: int = 25) -> DataFrame:
    """Snapshots of all committed batches, and the one after the last event so far."""
    done = versions(spark, f"{root}/state")
    if not done:
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)
    versioned = T.StructType([*SNAPSHOT_SCHEMA.fields, T.StructField("version", T.LongType())])
    rows = spark.read.schema(versioned).parquet(f"{root}/snapshots")
    # a batch ends with a snapshot of its own, which the next batch replaces
    shown = (F.col("version") <= done[-1]) & ((F.col("event_id") % stride == 0) | (F.col("version") == done[-1]))
    return rows.filter(shown).drop("version")
