"""Mixing sources to target weights by weighted sampling without replacement.

Only DataFrame functions: no Python runs on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareway.llm.common import key, unkey, unused
from fareway.operators.numbering import number_rows
from fareway.session import materialize

#: Runs of anything but white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Anything but letters and white space.
MARK = r"[^\p{L}\x20\x09-\x0D]"
WEIGHTS = (1, 2, 3)


def text_quality(text: Column) -> Column:
    """Share of letters and white space in a text, 0.05 at least."""
    marks = F.regexp_count(text, F.lit(MARK)) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(1.0) - marks, F.lit(0.05))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = 3) -> DataFrame:
    """source, source_size and target; ``sizes`` has one row a source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum
    of all sizes. A target stops at ``most`` times its source's size; the rest goes to
    the others by weight. With level L the targets are least(most * size, weight * L);
    going through the sources by most * size / weight, the level that is right for the
    sources behind rises up to the true one and then falls, so it is their maximum.
    """
    by_name = F.col("source").asc_nulls_last()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("no") - 1) % len(weights) + 1).cast("int"))
    weighed = number_rows(sizes, [by_name], "no").withColumn("weight", weight)
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    weighed = running_sums(weighed.withColumn("turn", F.col("cap") / F.col("weight")), [F.asc("turn"), by_name], ["cap", "weight"])
    total = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    left = total.select("size").scalar() - F.col("before_cap")
    rest = total.select("weight").scalar() - F.col("before_weight")
    level = weighed.agg(F.max(left / rest)).scalar()
    target = F.greatest(F.least(F.col("cap"), F.col("weight") * level), F.lit(0.0))
    return weighed.select("source", "source_size", target.alias("target"))


def running_sums(df: DataFrame, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """``df`` with ``before_`` and each of ``columns``: its sum over all rows that come earlier in ``order``.

    Rows are dealt by ranges of the whole order, so no key or source stays in one piece:
    sums run inside a range, and the sums of whole ranges, as many as the shuffle is wide, over them.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(width, *order).withColumn("range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("range").agg(*[F.sum(c).alias(c) for c in columns])
    totals = totals.select("range", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"up_to_{c}") for c in columns])
    summed = placed.withColumns({f"before_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in columns})
    joined = summed.join(F.broadcast(totals), "range")
    joined = joined.withColumns({f"before_{c}": F.col(f"before_{c}") + F.col(f"up_to_{c}") for c in columns})
    return joined.drop("range", *[f"up_to_{c}" for c in columns])


def mix(docs: DataFrame, quality: Column | None = None, weights=WEIGHTS, most: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row of ``docs``.

    size counts words. Each source takes all its rows as often as its target holds the
    source whole; for the rest of the target its rows are ordered by exponential keys
    -ln(u) / quality, u from a hash of id and ``seed``, and taken while that brings the
    sum nearer to the target. So a source misses its target by at most half the size of
    one row, and no row is taken more than ``most`` times. Running sums go by ranges of the
    order, so that a source with a third of all rows spreads over many tasks.

    Null texts have size 0 and are taken as 0 words; a null source is a source of its
    own; rows with null ids take u from their text. Rows equal in id, key and size are
    interchangeable: either may be the last taken. An empty table gives no rows. Other columns are only
    read by ``quality``, an expression above 0.
    """
    weight = text_quality(F.coalesce("text", F.lit(""))) if quality is None else quality
    named = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    digits = F.conv(F.substring(F.md5(F.concat(named, F.lit(f"|{seed}")).cast("binary")), 1, 12), 16, 10)
    u = (digits.cast("double") + 0.5) / F.lit(float(16**12))
    rows = materialize(
        docs.select(
            key().alias("doc_id"),
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            (-F.log(u) / weight).alias("order"),
        ),
        "mix",
    )
    order = [F.col("source").asc_nulls_last(), F.asc("order"), F.asc("doc_id"), F.asc("size")]
    summed = running_sums(rows, order, ["size"])
    sizes = materialize(summed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("before_size").alias("start")), "sources")
    targets = source_targets(sizes.drop("start"), weights, most).alias("t").join(sizes.alias("s"), F.col("s.source").eqNullSafe(F.col("t.source")))
    plan = targets.select(F.col("t.source").alias("plan_source"), "t.source_size", "t.target", "s.start")
    joined = summed.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("before", F.col("before_size") - F.col("start"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    extra = (2 * F.col("before") + F.col("size") <= 2 * rest) & (F.col("size") > 0) & (rest > 0)
    copies = F.least(F.col("epochs") + extra.cast("long"), F.lit(most)).cast("int")
    return (
        joined.withColumn("epochs", epochs.cast("long"))
        .withColumn("copies", copies)
        .select(
            unkey().alias("doc_id"), "source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """``docs`` itself as mixed: each row as often as ``mix`` takes it, rows taken 0 times gone.

    Rows are known by id and text: of rows equal in both, each is repeated as the most
    often taken of them. Rows without id are mixed by their text. Null and empty texts
    add no words and come as often as their source is taken whole. All columns pass through, whatever their names; an empty table stays empty.
    """
    node = F.xxhash64(key(), F.coalesce("text", F.lit("")))
    # mix() knows a row by its id alone; the hash goes through it as the id
    copies = mix(docs.select(node.alias("doc_id"), "source", "text"), **how).filter("copies > 0")
    names = [unused(docs, name) for name in ("mix_node", "mix_copies", "mix_copy")]
    copies = copies.groupBy(F.col("doc_id").alias(names[0])).agg(F.max("copies").alias(names[1]))
    joined = docs.join(copies, node == F.col(names[0])).withColumn(names[2], F.explode(F.sequence(F.lit(1), names[1])))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
