"""SimHash near-duplicate groups: chains of segments that keep to their share of the budget.

The 64 bits lie in a ring of ``budget + 1`` segments. If two fingerprints differ in
``budget`` bits at most, then from some segment on every chain of consecutive segments
keeps to its proportional share: the first differs in no bit, the first two in one at
most, the first three in two at most, and so on. The first two segments of a chain make
the join key: the first as it is, the second with one of its bits masked. Pairs that
meet under a key must keep to the shares of the longer chains before the full distance
is taken.

Equal fingerprints are one node. Not all pairs of a bucket are looked at: first each
node meets the smallest of its bucket; then only buckets that still hold several
components are searched, in blocks, and a block gives one link a component at most.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareway.llm.common import NO_ID, id_and_text, map_rows, unkey
from fareway.llm.near_dup import components
from fareway.session import materialize

#: Seed of the shingle hash.
SEED = 42
#: Fingerprints of a bucket in one half of a block pair.
_BLOCK = 4096
_BITS = np.array([1 << b for b in range(64)], np.uint64)


def fingerprint(text: str, n: int) -> int:
    """Majority of the bits of the hashes of all ``n``-word shingles, repeats included; zero without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    m = min(n, len(words))
    ones, total = np.zeros(64, np.int64), len(words) - m + 1
    for at in range(0, total, 1 << 16):
        stop = min(total, at + (1 << 16))
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + m]), SEED) for i in range(at, stop)), np.uint64, stop - at
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(_BITS[2 * ones > total].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, n: int = 4) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), n) for t in batch["text"]), np.uint64, batch.num_rows)
            yield {"doc_id": batch["doc_id"], "fp": found.view(np.int64)}

    return map_rows(id_and_text(docs), "doc_id long, fp long", run)


def _segments(budget: int) -> list[tuple[int, int]]:
    """First bit and width of each segment of the ring."""
    parts = budget + 1
    edges = [64 * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def chains(budget: int) -> list[tuple[int, int, bool, list[int]]]:
    """Key mask, masked bit, whether the slot is its chain's first, and masks of the longer chains of each slot.

    One slot stands for each segment and each bit of the segment after it. The masks take in
    three segments, four and so on, and allow two differing bits, three and so on.
    """
    parts = _segments(budget)
    ring = [((1 << width) - 1) << first for first, width in parts]
    if len(ring) < 2:
        return [(ring[0], 0, True, [])]
    out = []
    for i, own in enumerate(ring):
        second, (first, width) = ring[(i + 1) % len(ring)], parts[(i + 1) % len(ring)]
        longer, mask = [], own | second
        for step in range(2, len(ring)):
            mask |= ring[(i + step) % len(ring)]
            longer.append(mask)
        out += [(own | second & ~(1 << bit), 1 << bit, bit == first, longer) for bit in range(first, first + width)]
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class _Ring:
    """The chains of a budget as arrays over slots."""

    def __init__(self, budget: int):
        plan = chains(budget)
        self.budget = budget
        self.bit = np.array([c[1] for c in plan], np.uint64)
        self.first = np.array([c[2] for c in plan])
        self.longer = np.array([c[3] for c in plan], np.uint64).reshape(len(plan), -1)

    def close(self, a: np.ndarray, b: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Which pairs of a bucket keep to every chain of their slot and to the budget.

        A pair whose second segments are equal shares all slots of the chain; only the first of them looks at it.
        """
        x = a ^ b
        at = np.flatnonzero((x & self.bit[slot] != 0) | self.first[slot])
        for step in range(self.longer.shape[1]):
            at = at[np.bitwise_count(x[at] & self.longer[slot[at], step]) <= step + 2]
        ok = np.zeros(len(a), bool)
        ok[at] = np.bitwise_count(x[at]) <= self.budget
        return ok


def _joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels (positions) after u and v have one label, the smaller."""
    while True:
        low = np.minimum(label[u], label[v])
        if (label[u] == low).all() and (label[v] == low).all():
            return label
        for end in (u, v):
            np.minimum.at(label, label[end], low)
            np.minimum.at(label, end, low)
        while (label[label] != label).any():
            label = label[label]


def _links(slot, group, own, fp, component, ring: _Ring) -> tuple[np.ndarray, np.ndarray]:
    """Links between components over sorted groups; at most one less than components met in a group of groups.

    ``own`` is -1 where a group is one whole bucket or one block with itself, else the side (0, 1) of a block pair:
    then only pairs across the sides count.
    """
    names, label = np.unique(component, return_inverse=True)
    label = label.astype(np.int64)
    root = np.arange(len(names))
    shift, n = 1, len(fp)
    alive = np.arange(n)
    while len(alive):
        alive = alive[alive + shift < n]
        alive = alive[group[alive] == group[alive + shift]]
        far = alive + shift
        apart = (root[label[alive]] != root[label[far]]) & ((own[alive] < 0) | (own[alive] != own[far]))
        left, right = alive[apart], far[apart]
        ok = ring.close(fp[left], fp[right], slot[left])
        if ok.any():
            root = _joined(root, label[left[ok]], label[right[ok]])
        shift += 1
    moved = np.flatnonzero(root != np.arange(len(root)))
    return names[moved], names[root[moved]]


def _across(buckets: DataFrame, placed: DataFrame, budget: int) -> DataFrame:
    """u, v: components that some close pair of a bucket links."""
    rows = buckets.select("slot", "bucket", F.col("fp").alias("node")).join(placed, "node")
    mixed = rows.groupBy("slot", "bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / _BLOCK).cast("int").alias("parts")
    ).filter("low < high")
    rows = rows.join(mixed.select("slot", "bucket", "parts"), ["slot", "bucket"])
    # any two nodes of a bucket meet in one pair of its blocks
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    keys = ["slot", "bucket", "i", "j"]
    rows = rows.select(*keys, "own", "node", "component").repartition(*keys).sortWithinPartitions(*keys)
    names = [*keys, "own", "node", "component"]

    def run(batches):
        held: list[np.ndarray] | None = None
        ring = _Ring(budget)

        def search(part: list[np.ndarray]) -> dict:
            slot, bucket, i, j, own, node, component = part
            new = np.r_[True, np.any([c[1:] != c[:-1] for c in (slot, bucket, i, j)], axis=0)] if len(slot) else np.zeros(0, bool)
            side = np.where(i == j, -1, (own == j).astype(np.int64))
            u, v = _links(slot, np.cumsum(new), side, node.view(np.uint64), component, ring)
            return {"u": u, "v": v}

        for batch in batches:
            if not batch.num_rows:
                continue
            part = [np.array(batch[c]).astype(np.int64) for c in names]
            if held is not None:
                part = [np.concatenate(two) for two in zip(held, part, strict=True)]
            # the last group may go on in the next batch
            last = np.any([c != c[-1] for c in part[:4]], axis=0)
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if cut:
                yield search([c[:cut] for c in part])
            held = [c[cut:] for c in part]
        if held is not None:
            yield search(held)

    return map_rows(rows, "u long, v long", run)


def simhash_groups(docs: DataFrame, n: int = 4, budget: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    A-Z are lower-cased; words are runs of anything but white space; shingles are ``n``
    words joined by a space, repeats included, the whole sequence if it is shorter. A bit
    of the fingerprint is 1 if it is set in over half of the shingles' XXH64 values (seed
    42). Fingerprints of at most ``budget`` differing bits link; component_id is the
    smallest doc_id reachable, itself included. Every link is found.

    Null and empty texts have the fingerprint zero and link like any other. Rows that
    share an id but not a fingerprint are separate nodes. Null ids stay null and stand
    for one smallest id. An empty table gives no rows; other columns are not read.
    """
    if not 0 <= budget < 32:
        raise ValueError("the budget is a number of bits from 0 to 31")
    rows = materialize(fingerprints(docs, n), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    slots = [F.struct(F.lit(s).alias("slot"), F.col("fp").bitwiseAND(F.lit(_signed(c[0]))).alias("bucket")) for s, c in enumerate(chains(budget))]
    # a node becomes a row for each slot: few small partitions would make large tasks.
    # Not by fp, as the grouping is: that exchange would be left out and its partitions joined.
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = nodes.repartition(width).select("fp", F.explode(F.array(*slots)).alias("key")).select("fp", "key.*")
    # the smallest of a bucket and whether another follows, in one pass that holds two rows at a time
    in_order = Window.partitionBy("slot", "bucket").orderBy("fp")
    met = keyed.select("*", F.first("fp").over(in_order).alias("hub"), F.lead("fp").over(in_order).alias("next"))
    shared = (F.col("fp") != F.col("hub")) | F.col("next").isNotNull()
    buckets = materialize(met.filter(shared).drop("next"), "buckets")
    stars = buckets.filter((F.col("fp") != F.col("hub")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= budget))
    found = components(stars.select(F.col("fp").alias("u"), F.col("hub").alias("v")))
    met = buckets.select(F.col("fp").alias("node")).distinct()
    placed = met.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    placed = materialize(placed, "placed")
    merged = components(_across(buckets, placed, budget)).select(F.col("node").alias("component"), F.col("component").alias("lower"))
    placed = placed.join(merged, "component", "left").select(F.col("node").alias("fp"), F.coalesce("lower", "component").alias("component"))
    members = materialize(nodes.join(placed, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "members")
    firsts = members.groupBy("component").agg(F.min("doc_id").alias("first"))
    named = members.join(firsts, "component").select("fp", "first")
    return rows.join(named, "fp").select(
        unkey().alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.nullif("first", F.lit(NO_ID)).alias("component_id"),
    )
