"""Prefix trie of conversations, with a count-min screen that keeps lone tails out of the shuffle.

Each turn has a digest; the digest of a prefix sums the mixed digests of its turns and
their depths in two 64-bit lanes, so that a conversation may be summed in pieces. A
count-min sketch counts the digests of all prefixes. It never counts too low: where it
says one, no other conversation has that prefix, nor any longer one, and the nodes of
that tail are written where the conversation lies. Only prefixes that may be shared
are shuffled and grouped exactly.

What a node says of its subtree needs no walk over the trie. The smallest member of a
node owns it, and a conversation owns the end of its own path, from some depth on. So a
subtree's sums are sums over the node's members: of the words in turns that a member does
not own, of ends that a member owns and nothing continues, of children that a member owns.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.llm.common import map_rows, mix, ship
from fareway.operators.numbering import number_rows
from fareway.session import materialize

#: Conversations of one base conversation, and turns a conversation may take from it.
FAMILY, HEAD = 20, 3
#: Cells of a sketch row: four for each prefix, within these bounds; and cells that are merged in one piece.
_LEAST_BITS, _MOST_BITS, _PIECE_BITS = 12, 24, 16
#: Ids of one piece of a node's list of ends.
_ENDS = 1 << 16
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_digest(role: bytes, text: bytes) -> bytes:
    return hashlib.sha256(hashlib.sha256(role).digest() + hashlib.sha256(text).digest()).digest()[:16]


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest and words of every turn of a conversation with an id."""

    def run(batches):
        for batch in batches:
            roles, texts = ([x.as_py().encode() for x in batch[c]] for c in ("role", "text"))
            yield {
                "conv_id": batch["conv_id"], "turn": batch["turn"], "words": [len(t.split()) for t in texts],
                "digest": [turn_digest(r, t) for r, t in zip(roles, texts, strict=True)],
            }

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    return map_rows(rows, "conv_id long, turn long, digest binary, words long", run)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id and length of every rebuilt conversation; conv_id, pos (from 1), digest, words, length of its turns."""
    turns = number_rows(materialize(_turns(conversations), "turns"), [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")], "row_no")
    own = turns.groupBy("conv_id").agg(F.min("row_no").alias("first"), F.count("*").alias("n"))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    own = own.withColumn("head", F.when(F.col("base") == F.col("conv_id"), 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % (HEAD + 1)))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = own.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("n_base", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    convs = materialize(convs.select("conv_id", "base", "first", "head", "taken", "length"), "conversations")
    numbered = turns.join(convs, "conv_id").withColumn("pos", F.col("row_no") - F.col("first") + 1)
    rest = numbered.filter("pos > head").withColumn("pos", F.col("pos") - F.col("head") + F.col("taken"))
    heads = numbered.filter((F.col("pos") <= HEAD) & (F.col("conv_id") == F.col("base"))).select("base", "pos", "digest", "words")
    # a base conversation lends three turns at most to at most 39 others
    lent = convs.filter("taken > 0").select("conv_id", "base", "taken", "length").join(heads, "base").filter("pos <= taken")
    names = ["conv_id", "pos", "digest", "words", "length"]
    return convs.select("conv_id", "length"), materialize(rest.select(*names).unionByName(lent.select(*names)), "rebuilt")


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos, a, b (digest of the prefix), words, total (words of the prefix) and length, in order of conversations.

    Rows are dealt by ranges of (conv_id, pos), so one long conversation lies in many
    partitions; each sums its own piece, and pieces that continue another get its sum.
    """
    spark = turns.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.repartitionByRange(width, "conv_id", "pos").sortWithinPartitions("conv_id", "pos")

    def run(batches):
        part, at, sums = TaskContext.get().partitionId(), None, np.zeros(3, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, pos, words = (np.array(batch[c]).astype(np.int64) for c in ("conv_id", "pos", "words"))
            halves = np.frombuffer(b"".join(batch["digest"].to_pylist()), "<u8").reshape(-1, 2).astype(np.uint64)
            depth = pos.astype(np.uint64)
            values = np.stack([
                mix(mix(halves[:, 0] + depth * _ODD[0]) + halves[:, 1]), mix(mix(halves[:, 1] + depth * _ODD[1]) ^ halves[:, 0]),
                words.astype(np.uint64),
            ])
            running = np.cumsum(values, axis=1, dtype=np.uint64)
            first = np.r_[True, conv[1:] != conv[:-1]]
            start = np.maximum.accumulate(np.where(first, np.arange(len(conv)), 0))
            running -= (running - values)[:, start]
            if conv[0] == at:
                running[:, start == 0] += sums[:, None]
            at, sums = conv[-1], running[:, -1].copy()
            signed = running.view(np.int64)
            yield {
                "conv_id": conv, "pos": pos, "a": signed[0], "b": signed[1], "total": signed[2], "words": words,
                "length": batch["length"], "part": np.full(len(conv), part, np.int32),
            }

    schema = "conv_id long, pos long, a long, b long, total long, words long, length long, part int"
    placed = materialize(map_rows(rows, schema, run), "prefixes")
    ends = placed.groupBy("conv_id", "part").agg(
        F.min("pos").alias("low"), F.max("length").alias("length"), F.max(F.struct("pos", "a", "b", "total")).alias("end")
    )
    # pieces of conversations cut by an edge between partitions: two for each partition at most
    cut = ends.filter("low > 1 OR end.pos < length").orderBy("conv_id", "part").collect()
    carry, at, sums = {}, None, np.zeros(3, np.uint64)
    for piece in cut:
        if piece.conv_id != at:
            at, sums = piece.conv_id, np.zeros(3, np.uint64)
        if piece.low > 1:
            carry[piece.part] = (at, sums)
        sums = sums + np.array([piece.end.a, piece.end.b, piece.end.total], np.int64).view(np.uint64)

    def add(batches):
        for batch in batches:
            conv, part = (np.array(batch[c]).astype(np.int64) for c in ("conv_id", "part"))
            running = np.stack([np.array(batch[c]).astype(np.int64) for c in ("a", "b", "total")]).view(np.uint64)
            for p in np.unique(part):
                if p in carry:
                    whose, before = carry[p]
                    running[:, (part == p) & (conv == whose)] += before[:, None]
            a, b, total = running.view(np.int64)
            yield {c: batch[c] for c in ("conv_id", "pos", "words", "length")} | {"a": a, "b": b, "total": total}

    if not carry:
        return placed.drop("part")
    return map_rows(placed, "conv_id long, pos long, a long, b long, total long, words long, length long", add)


def _cells(batch: pa.RecordBatch, bits: int) -> list[np.ndarray]:
    """Cell of each prefix in each row of the sketch."""
    a, b, pos = (np.array(batch[c]).astype(np.int64).view(np.uint64) for c in ("a", "b", "pos"))
    keys = (mix(a + pos), mix(b ^ mix(pos + _ODD[0])))
    return [(k >> np.uint64(64 - bits)).astype(np.int64) for k in keys]


def _sketch(prefixes: DataFrame, bits: int) -> list[np.ndarray]:
    """Count-min sketch of two rows of 2^bits cells over all prefixes; a cell counts 0, 1 or more (2)."""
    piece = 1 << min(bits, _PIECE_BITS)

    def count(batches):
        rows = [np.zeros(1 << bits, np.uint8) for _ in range(2)]
        for batch in batches:
            for row, cells in zip(rows, _cells(batch, bits), strict=True):
                hit, times = np.unique(cells, return_counts=True)
                row[hit] = np.minimum(row[hit] + np.minimum(times, 2), 2)
        for r, row in enumerate(rows):
            for k in range(0, len(row), piece):
                if row[k : k + piece].any():
                    yield {"row": [r], "start": [k], "cells": [zlib.compress(row[k : k + piece].tobytes(), 1)]}

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = np.zeros(piece, np.uint8)
        for cells in table["cells"]:
            total = np.minimum(total + np.frombuffer(zlib.decompress(cells.as_py()), np.uint8), 2)
        cells = zlib.compress(total.tobytes(), 1)
        return pa.table({
            "row": pa.array([key[0].as_py()], pa.int32()), "start": pa.array([key[1].as_py()], pa.int64()), "cells": pa.array([cells], pa.binary()),
        })

    schema = "row int, start long, cells binary"
    pieces = map_rows(prefixes.select("a", "b", "pos"), schema, count)
    rows = [np.zeros(1 << bits, np.uint8) for _ in range(2)]
    # two rows of 2^24 bytes at most, whatever the table
    for found in pieces.groupBy("row", "start").applyInArrow(merge, schema).collect():
        rows[found.row][found.start : found.start + piece] = np.frombuffer(zlib.decompress(found.cells), np.uint8)
    return rows


def _screened(spark: SparkSession, prefixes: DataFrame) -> DataFrame:
    """``prefixes`` with ``lone``: whether the sketch proves a prefix a singleton, and ``follows``: so was the one before it."""
    n = prefixes.count()
    bits = min(_MOST_BITS, max(_LEAST_BITS, (4 * n - 1).bit_length() if n else 0))
    sketch = spark.sparkContext.broadcast(_sketch(prefixes, bits))

    def run(batches):
        rows = sketch.value
        at, open_tail, last = None, False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, pos = (np.array(batch[c]).astype(np.int64) for c in ("conv_id", "pos"))
            one = np.minimum(*(row[cells] for row, cells in zip(rows, _cells(batch, bits), strict=True))) == 1
            # whatever follows a singleton in the same conversation is one too
            joined = np.r_[(conv[0], pos[0]) == (at, (last or 0) + 1), (conv[1:] == conv[:-1]) & (pos[1:] == pos[:-1] + 1)]
            start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(conv))))
            seen = np.cumsum(one)
            lone = seen - (seen - one)[start] > 0
            if joined[0] and open_tail:
                lone |= start == 0
            follows = joined & np.r_[open_tail, lone[:-1]]
            at, last, open_tail = conv[-1], pos[-1], bool(lone[-1])
            yield {c: batch[c] for c in ("conv_id", "pos", "a", "b", "total", "words", "length")} | {"lone": lone, "follows": follows}

    schema = "conv_id long, pos long, a long, b long, total long, words long, length long, lone boolean, follows boolean"
    return materialize(map_rows(prefixes, schema, run), "screened")


def _ends(rows: DataFrame) -> DataFrame:
    """pos, a, b and the hash of the ascending, comma-joined conv_ids of each node.

    Ids are sorted by ranges, so those of one node lie in many partitions; only joined pieces of the list meet in one task, and stream through the hash.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["pos", "a", "b"]
    rows = rows.select(*keys, "conv_id").repartitionByRange(width, *keys, "conv_id").sortWithinPartitions(*keys, "conv_id")

    def join(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            pos, a, b, conv = (np.array(batch[c]).astype(np.int64) for c in (*keys, "conv_id"))
            new = np.r_[True, (pos[1:] != pos[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            starts = np.flatnonzero(new)
            starts = np.concatenate([np.arange(s, e, _ENDS) for s, e in zip(starts, np.r_[starts[1:], len(pos)], strict=True)])
            ids = [",".join(map(str, conv[s:e].tolist())).encode() for s, e in zip(starts, np.r_[starts[1:], len(pos)], strict=True)]
            yield {"pos": pos[starts], "a": a[starts], "b": b[starts], "first": conv[starts], "ids": ids}

    pieces = map_rows(rows, "pos long, a long, b long, first long, ids binary", join)
    pieces = pieces.repartition(*keys).sortWithinPartitions(*keys, "first")

    def digest(batches):
        at, state = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*(batch[c].to_pylist() for c in (*keys, "ids")), strict=True):
                if node != at:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = node, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            if done:
                yield dict(zip((*keys, "ends_sha256"), zip(*done, strict=True), strict=True))
        if at is not None:
            yield {"pos": [at[0]], "a": [at[1]], "b": [at[2]], "ends_sha256": [state.hexdigest()]}

    return map_rows(pieces, "pos long, a long, b long, ends_sha256 string", digest)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    Turns are ordered by turn, null first, equal ones by the hash of role and text; rows
    equal in all of these are turns of their own. A null role or text is empty. Every
    conversation c is rebuilt: the first crc32(c) % 4 turns of conversation c - c % 20
    (remainder of the sign of c), then its own turns after as many. Each distinct sequence of leading turns is a node, the root has
    depth 0; its members are the rebuilt conversations that begin with it, conv_id is the
    smallest, n_leaves and saved_tokens cover its subtree, ends_sha256 the members that end there.

    Rows without conv_id belong to no conversation. A conversation that is left without
    turns is a member of the root alone. An empty table has no root and gives no rows;
    other columns are not read. Prefixes are told apart by 128-bit digests.

    The sketch holds two rows of at most 2^24 cells (32 MB); beyond some ten million
    prefixes it proves fewer of them alone, and more are grouped: results are the same.
    """
    spark = conversations.sparkSession
    ship(spark)
    convs, turns = rebuilt(conversations)
    rows = _screened(spark, _prefixes(turns))

    shared = rows.filter("NOT lone").drop("lone", "follows")
    keys = ["pos", "a", "b"]
    groups = shared.groupBy(*keys).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.max("length").alias("longest"))
    met = materialize(shared.join(groups, keys), "shared")
    foreign = F.col("owner") != F.col("conv_id")
    ends = F.col("pos") == F.col("length")
    # how far a conversation's path is owned by others, and whether its end is theirs or goes on
    paths = materialize(met.groupBy("conv_id").agg(
        F.max(F.when(foreign, F.struct("pos", "owner", "total"))).alias("up"),
        F.max(F.when(ends & (foreign | (F.col("longest") > F.col("length"))), 1).otherwise(0)).alias("no_leaf"),
    ).select("conv_id", F.coalesce("up.pos", F.lit(0)).alias("up"), F.col("up.owner").alias("up_owner"), F.coalesce("up.total", F.lit(0)).alias("up_words"), "no_leaf"), "paths")

    sums = convs.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.coalesce(F.sum((F.col("length") > 0).cast("long")), F.lit(0)).alias("live")
    ).first()
    if not sums.n_convs:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    root = F.lit(sums.conv_id)
    parent = F.when(F.col("pos") == 1, root).when(F.col("pos") > F.col("up") + 1, F.col("conv_id")).otherwise(F.col("up_owner"))

    nodes = met.join(paths, "conv_id").groupBy(*keys).agg(
        F.min("owner").alias("conv_id"), F.min("n_convs").alias("n_convs"),
        F.max(F.when(~foreign, parent)).alias("parent_conv_id"),
        F.sum(((F.col("up") <= F.col("pos")) & (F.col("pos") < F.col("length"))).cast("long")).alias("n_children"),
        F.sum(1 - F.col("no_leaf")).cast("long").alias("n_leaves"),
        F.sum(F.greatest(F.lit(0), F.col("up_words") - F.col("total") + F.col("words"))).alias("saved_tokens"),
    )
    nodes = nodes.join(_ends(met.filter(ends)), keys, "left").select(
        "conv_id", F.col("pos").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )

    def tails(part: DataFrame, above) -> DataFrame:
        return part.select(
            "conv_id", F.col("pos").alias("depth"), above.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
            (F.col("pos") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(ends, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_EMPTY)).alias("ends_sha256"),
        )

    lone = rows.filter("lone")
    inner = tails(lone.filter("follows OR pos = 1"), F.when(F.col("pos") == 1, root).otherwise(F.col("conv_id")))
    first = lone.filter("NOT follows AND pos > 1").join(paths, "conv_id", "left").withColumn("up", F.coalesce("up", F.lit(0)))
    first = tails(first, parent)

    above = paths.agg(
        F.coalesce(F.sum((F.col("up") > 0).cast("long")), F.lit(0)).alias("foreign"), F.coalesce(F.sum("no_leaf"), F.lit(0)).alias("no_leaf"),
        F.coalesce(F.sum("up_words"), F.lit(0)).alias("saved"),
    )
    turnless = convs.filter("length = 0").select(*(F.lit(0).cast("long").alias(k) for k in keys), "conv_id")
    turnless = _ends(turnless).select("ends_sha256").unionByName(spark.range(1).select(F.lit(_EMPTY).alias("ends_sha256")))
    # one row each
    listed = turnless.agg(F.coalesce(F.max(F.when(F.col("ends_sha256") != _EMPTY, F.col("ends_sha256"))), F.lit(_EMPTY))).first()[0]
    top = above.select(
        root.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(sums.n_convs).cast("long").alias("n_convs"), (F.lit(sums.live) - F.col("foreign")).cast("long").alias("n_children"),
        (F.lit(sums.live) - F.col("no_leaf") if sums.live else F.lit(1)).cast("long").alias("n_leaves"),
        F.col("saved").cast("long").alias("saved_tokens"), F.lit(listed).alias("ends_sha256"),
    )
    return nodes.unionByName(inner).unionByName(first).unionByName(top)
