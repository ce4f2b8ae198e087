"""Benchmark items inside documents by size-partitioned MinHash containment search.

Items are the queries. They are partitioned by the size of their shingle sets; for the
partition of sizes up to u a document is cut into windows of 2u shingles that start
every u, so an item of the partition that stands in the document lies whole in one
window, however long the document is. The containment threshold becomes a Jaccard
threshold for window and item sizes of the partition, and that the shape of the bands.
Items too small for any shape of the bands are looked up by some of their shingles instead,
of which a document that holds the item to the threshold has at least one.
Candidates are verified: the exact share of an item's shingles found in the whole document.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import PLAIN, WordCodes, append, distinct, id_and_text, key, map_rows, mix, shingles, small_batches, unkey, unused

MINIMA = 64
_MISS = 1e-5
_rng = np.random.default_rng(977)
_A = (_rng.integers(0, 2**63, MINIMA, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _rng.integers(0, 2**63, MINIMA, dtype=np.int64).astype(np.uint64)
_SMALLEST = 8
_CHUNK = 1 << 11


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return (text or "").encode().translate(PLAIN).split()


def bands(jaccard: float) -> tuple[int, int] | None:
    """Bands, and most rows a band, that still find a pair of this similarity but for ``_MISS``; None if no shape does."""
    for rows in range(8, 0, -1):
        hit = jaccard**rows
        count = math.ceil(math.log(_MISS) / math.log1p(-hit)) if hit < 1 else 1
        if count * rows <= MINIMA:
            return count, rows
    return None


class Items:
    """Benchmark items as sorted band keys, by size partition."""

    def __init__(self, rows: list[tuple[int, str]], n: int, threshold: float):
        codes = WordCodes()
        self.n, self.threshold = n, threshold
        self.short: dict[int, list[tuple[int, int]]] = {}
        self.sets: list[tuple[int, np.ndarray]] = []
        sizes: dict[int, list[int]] = {}
        prefixes, prefix_owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for item_id, text in rows:
            own = codes.of(words(text))
            if not len(own):
                continue
            if len(own) < n:
                self.short.setdefault(len(own), []).append((item_id, int(shingles(own, n)[0])))
                continue
            own = distinct(shingles(own, n))
            upper = _SMALLEST
            while upper < len(own):
                upper *= 2
            if self._shape(len(own), upper) is None:
                # a document without any of these misses more than the threshold allows
                prefix = own[: len(own) - max(1, math.ceil(threshold * len(own) - 1e-9)) + 1]
                prefixes.append(prefix), prefix_owners.append(np.full(len(prefix), len(self.sets)))
            else:
                sizes.setdefault(upper, []).append(len(self.sets))
            self.sets.append((item_id, own))
        self.exact = _index(np.concatenate(prefixes), np.concatenate(prefix_owners))
        self.partitions = []
        for upper, members in sorted(sizes.items()):
            lower = min(len(self.sets[m][1]) for m in members)
            count, per_band = self._shape(lower, upper)
            keys, owners = [], []
            for m in members:
                found = _band_keys(_minima(self.sets[m][1], np.array([0])), count, per_band)[0]
                keys.append(found)
                owners.append(np.full(len(found), m))
            self.partitions.append((upper, count, per_band, *_index(np.concatenate(keys), np.concatenate(owners))))

    def _shape(self, size: int, upper: int) -> tuple[int, int] | None:
        """Shape of the bands for items of ``size`` shingles in the partition up to ``upper``."""
        return bands(self.threshold * size / (2 * upper + (1 - self.threshold) * size))

    def search(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """item, shingles found and shingles of every item contained in the document to the threshold."""
        out = []
        for length, items in self.short.items():
            if len(codes) >= length:
                mine = set(shingles(codes, length).tolist())
                out += [(item, 1, 1) for item, code in items if code in mine]
        if len(codes) < self.n or not self.sets:
            return out
        grams = shingles(codes, self.n)
        candidates = _owners(grams, *self.exact)
        smallest = self.partitions[0][0] if self.partitions else _SMALLEST
        # minima over blocks of the smallest size; larger partitions join neighbouring blocks
        largest = self.partitions[-1][0] if self.partitions else _SMALLEST
        chunk = max(_CHUNK, 8 * largest)
        for begin in range(0, len(grams) if self.partitions else 0, chunk):
            part = grams[begin : begin + chunk + 2 * largest]
            blocks, size = _minima(part, np.arange(0, len(part), smallest)), smallest
            for upper, count, per_band, keys, owners, seen in self.partitions:
                while size < upper:
                    if len(blocks) % 2:
                        blocks = np.concatenate([blocks, blocks[-1:]])
                    blocks, size = np.minimum(blocks[::2], blocks[1::2]), size * 2
                windows = np.minimum(blocks[:-1], blocks[1:]) if len(blocks) > 1 else blocks
                candidates |= _owners(_band_keys(windows, count, per_band).reshape(-1), keys, owners, seen)
        if candidates:
            grams = distinct(grams)
            for m in sorted(candidates):
                item, own = self.sets[m]
                where = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                shared = int((grams[where] == own).sum())
                if shared >= self.threshold * len(own) - 1e-9:
                    out.append((item, shared, len(own)))
        return out


def _index(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, their owners, and which upper 20 bits occur."""
    order = np.argsort(keys, kind="stable")
    seen = np.zeros(1 << 20, bool)
    seen[keys >> np.uint64(44)] = True
    return keys[order], owners[order], seen


def _owners(found: np.ndarray, keys: np.ndarray, owners: np.ndarray, seen: np.ndarray) -> set[int]:
    """Owners of the keys among ``found``."""
    out: set[int] = set()
    if len(keys):
        found = found[seen[found >> np.uint64(44)]]
        low, high = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
        for a, b in zip(low[low < high], high[low < high], strict=True):
            out.update(owners[a:b].tolist())
    return out


def _minima(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima of every hash over each block of codes: blocks x hashes."""
    return np.minimum.reduceat(codes[None, :] * _A[:, None] + _B[:, None], starts, axis=1).T


def _band_keys(minima: np.ndarray, count: int, per_band: int) -> np.ndarray:
    used = minima[:, : count * per_band].reshape(len(minima), count, per_band)
    total = np.broadcast_to(np.arange(count, dtype=np.uint64), used.shape[:2])
    for r in range(per_band):
        total = mix(total + used[:, :, r])
    return total


def item_blocks(benchmark: DataFrame, most_items: int = 20_000, most_bytes: int = 16_000_000):
    """The benchmark in blocks of bounded size, in id order; most benchmarks are one block."""
    held, size = [], 0
    rows = benchmark.select(key("item_id").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if len(held) >= most_items or size >= most_bytes:
            yield held
            held, size = [], 0
    yield held


def contained_items(docs: DataFrame, benchmark: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_shared, n_item and containment of every benchmark item found in a document.

    Sets are the distinct ``n``-word shingles of whole texts; n_item is the size of the
    item's set, n_shared how many of them the document holds, containment their ratio,
    ``threshold`` at least. An item of fewer words than ``n`` is one shingle of its own
    length. An item in one piece is missed with probability 1e-5 at most; scattered pieces count
    once some window makes the item a candidate; items too small for the bands are never missed. Items without words match nothing, as do
    null and empty texts. Null ids stay null; repeated documents and repeated items give
    a row each. The benchmark is searched in blocks of bounded size, one pass over the
    documents each. Empty tables give no rows; other columns are not read.
    """
    found = None
    small_batches(docs.sparkSession)
    for rows in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(Items(rows, n, threshold))

        def run(batches, shared=shared):
            codes, items = WordCodes(), shared.value
            for batch in batches:
                out: dict[str, list] = {"doc_id": [], "item_id": [], "n_shared": [], "n_item": []}
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                    for item, both, size in items.search(codes.of(words(text.as_py()))):
                        for name, value in zip(out, (doc_id, item, both, size), strict=True):
                            out[name].append(value)
                yield out

        part = map_rows(id_and_text(docs), "doc_id long, item_id long, n_shared long, n_item long", run)
        found = part if found is None else found.unionByName(part)
    return found.select(
        unkey().alias("doc_id"), unkey("item_id").alias("item_id"), "n_shared", "n_item",
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the rows in which a benchmark item is contained.

    Each row is judged by itself: repeated rows stay or go together, null and empty texts
    stay. All columns pass through, whatever their names; empty tables change nothing.
    """
    name = unused(docs, "contaminated")
    small_batches(docs.sparkSession)
    for rows in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast((Items(rows, n, threshold), WordCodes()))

        def hits(batch, shared=shared) -> dict:
            items, codes = shared.value
            return {name: [bool(items.search(codes.of(words(t.as_py())))) for t in batch["text"]]}

        docs = append(docs, f"`{name}` boolean", hits).filter(~F.col(f"`{name}`")).drop(name)
    return docs
