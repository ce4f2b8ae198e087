"""Repeated word windows across all documents, by super-k-mers.

A window is ``window`` consecutive words. Its minimiser is the smallest hash of the
runs of ``MINIMISER`` words inside. Consecutive windows that share a minimiser make up
one run, and equal windows have equal minimisers. Runs whose minimiser occurs once in
the corpus hold no repeat. The others travel as one packed string of words to the
bucket of their minimiser, equal strings as one, and there their windows are sorted;
the first place of each window stays. The strings of a minimiser that is very common
are cut again by a further minimiser, into shorter strings and more buckets.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import WordCodes, id_and_text, map_rows, mix, shingles, unkey
from fareway.session import materialize

MINIMISER = 5
#: Distinct packed strings of one bucket that are sorted in one task; beyond, they are cut by a further minimiser.
_HOT = 2_000
#: Further minimisers; windows that are in a crowded bucket by all of them travel alone, as 128 bits each.
_LEVELS = 1


def split_words(text: str) -> list[bytes]:
    return text.encode().split()


def _minimisers(codes: np.ndarray, window: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``MINIMISER`` words, and the minimiser of each window; each level has hashes of its own."""
    m = min(MINIMISER, window)
    hashes = shingles(codes, m, salt=4 + level if level else 1)
    if len(codes) < window:
        return hashes, hashes[:0]
    # minima over 1, 2, 4, ... places, then over all places of a window
    best, span, places = hashes, 1, window - m + 1
    while span < places:
        step = min(span, places - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    return hashes, best


def runs(codes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, minimiser and its places (1 or 2 for more) of each run."""
    hashes, best = _minimisers(codes, window)
    if not len(best):
        return (np.zeros(0, np.int64),) * 2 + (best, np.zeros(0, np.int64))
    first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    sizes = np.diff(np.r_[first, len(best)])
    # places of the minimiser among the hashes the run covers
    hits = np.zeros(len(first), np.int64)
    longest = window - min(MINIMISER, window)
    step = np.repeat(np.arange(len(first)), sizes)
    same = hashes[: len(best)] == best
    hits += np.bincount(step[same], minlength=len(first))
    for extra in range(longest):
        at = first + sizes + extra
        hits += hashes[at] == best[first]
    return first, sizes, best[first], np.minimum(hits, 2)


def _window_hashes(strings: list[bytes], window: int, codes: WordCodes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit codes of every window of packed strings, its string and its offset there."""
    counts = np.array([s.count(b" ") + 1 for s in strings])
    words = codes.of(b" ".join(strings).split(b" "))
    windows = counts - window + 1
    owner = np.repeat(np.arange(len(strings)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.repeat(np.cumsum(counts) - counts, windows) + offset
    return shingles(words, window, salt=2)[at], shingles(words, window, salt=3)[at], owner, offset


def _first_places(strings: list[tuple], window: int, codes: WordCodes) -> dict:
    """Places of the windows of packed strings (doc_id, start, content, packed) that stand nowhere earlier in the list."""
    high, low, owner, offset = _window_hashes([s[3] for s in strings], window, codes)
    docs, starts, contents = (np.array([s[i] for s in strings], np.int64)[owner] for i in range(3))
    at = starts + offset
    order = np.lexsort((contents, at, docs, low, high))
    high, low = high[order], low[order]
    first = order[np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]]
    return {"doc_id": docs[first], "content": contents[first], "at": at[first]}


def duplicate_windows(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, content, suspects and firsts: per text, runs whose windows repeat, and those windows that come first.

    All windows of the suspects (start, size, minimiser) but the firsts repeat an earlier window.
    """
    if window < 1:
        raise ValueError("a window holds a word at least")
    texts = _texts(docs)

    def find(batches):
        codes = WordCodes()
        for batch in batches:
            parts = [runs(codes.of(split_words(text.as_py())), window) for text in batch["text"]]
            counts = [len(p[0]) for p in parts]
            first, sizes, best, hits = map(np.concatenate, zip(*parts, strict=True)) if parts else [np.zeros(0, np.uint64)] * 4
            yield {
                "doc_id": np.repeat(np.asarray(batch["doc_id"]), counts), "content": np.repeat(np.asarray(batch["content"]), counts),
                "start": first, "size": sizes, "minimiser": best.view(np.int64), "hits": hits,
            }

    schema = "doc_id long, content long, start int, size int, minimiser long, hits int"
    # read twice: for the minimisers' counts, and for the runs of those that repeat
    found = materialize(map_rows(texts, schema, find), "runs")
    often = found.groupBy("minimiser").agg(F.sum("hits").alias("times")).filter("times > 1").select("minimiser")
    suspects = (
        found.join(often, "minimiser", "left_semi")
        .groupBy("doc_id", "content").agg(F.sort_array(F.collect_set(F.struct("start", "size", "minimiser"))).alias("suspects"))
    )
    suspects = materialize(suspects, "suspects")

    def pack(batches):
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "content": [], "start": [], "minimiser": [], "packed": []}
            rows = zip(*(batch[c].to_pylist() for c in ("doc_id", "content")), batch["text"], batch["suspects"], strict=True)
            for doc_id, content, text, mine in rows:
                own = zlib.decompress(text.as_py()).split()
                mine = mine.values.flatten()
                starts, sizes = mine[0].to_pylist(), mine[1].to_pylist()
                out["doc_id"] += [doc_id] * len(starts)
                out["content"] += [content] * len(starts)
                out["start"] += starts
                out["minimiser"] += mine[2].to_pylist()
                out["packed"] += [b" ".join(own[at : at + size + window - 1]) for at, size in zip(starts, sizes, strict=True)]
            yield out

    with_runs = _packed_texts(docs).join(suspects, ["doc_id", "content"])
    strings = map_rows(with_runs, "doc_id long, content long, start long, minimiser long, packed binary", pack)
    strings = strings.groupBy("minimiser", "packed").agg(F.min(F.struct("doc_id", "start", "content")).alias("first"))
    strings = materialize(strings.select("minimiser", "packed", "first.*"), "strings")

    def sort_buckets(batches):
        codes, held = WordCodes(), []
        for batch in batches:
            keys = batch["minimiser"].to_pylist()
            rows = list(zip(keys, *(batch[c].to_pylist() for c in ("doc_id", "start", "content", "packed")), strict=True))
            cut = next((i for i in range(len(rows), 0, -1) if rows[i - 1][0] != keys[-1]), 0)
            if cut or (held and held[-1][0] != keys[0]):
                yield _first_places([r[1:] for r in held + rows[:cut]], window, codes)
                held = []
            held += rows[cut:]
        if held:
            yield _first_places([r[1:] for r in held], window, codes)

    places = "doc_id long, content long, at long"
    sorted_parts = []
    for level in range(_LEVELS + 1):
        sizes = strings.groupBy("minimiser").agg(F.count("*").alias("n"))
        hot = materialize(sizes.filter(F.col("n") > _HOT).select("minimiser"), "hot")
        cold = strings.join(hot, "minimiser", "left_anti").repartition("minimiser").sortWithinPartitions("minimiser")
        sorted_parts.append(map_rows(cold, places, sort_buckets))
        strings = strings.join(hot, "minimiser", "left_semi")
        if level == _LEVELS or not hot.limit(1).count():
            break
        strings = _cut_again(strings, window, level + 1)

    def spread(batches):
        codes = WordCodes()
        for batch in batches:
            if batch.num_rows:
                high, low, owner, offset = _window_hashes(batch["packed"].to_pylist(), window, codes)
                taken = {c: np.asarray(batch[c])[owner] for c in ("doc_id", "content", "start")}
                at = taken.pop("start") + offset
                yield taken | {"at": at, "high": high.view(np.int64), "low": low.view(np.int64)}

    alone = map_rows(strings, places + ", high long, low long", spread)
    warm = alone.groupBy("high", "low").agg(F.min(F.struct("doc_id", "at", "content")).alias("first"))
    found = warm.select("first.doc_id", "first.content", "first.at")
    for part in sorted_parts:
        found = found.unionByName(part)
    firsts = found.groupBy("doc_id", "content").agg(F.collect_set("at").alias("firsts"))
    return suspects.join(firsts, ["doc_id", "content"], "left").select("doc_id", "content", "suspects", "firsts")


def _cut_again(strings: DataFrame, window: int, level: int) -> DataFrame:
    """Packed strings cut where the minimiser of ``level`` changes, each in the bucket of all its minimisers, equal ones as one."""

    def cut(batches):
        codes = WordCodes()
        for batch in batches:
            out: dict[str, list] = {"minimiser": [], "packed": [], "doc_id": [], "start": [], "content": []}
            for bucket, packed, doc_id, start, content in zip(*(batch[c].to_pylist() for c in out), strict=True):
                words = packed.split(b" ")
                best = _minimisers(codes.of(words), window, level)[1]
                first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
                keys = mix(best[first] + np.uint64(bucket % 2**64))
                out["minimiser"] += keys.view(np.int64).tolist()
                for begin, end in zip(first.tolist(), [*first[1:].tolist(), len(best)], strict=True):
                    out["packed"].append(b" ".join(words[begin : end - 1 + window]))
                    out["start"].append(start + begin)
                out["doc_id"] += [doc_id] * len(first)
                out["content"] += [content] * len(first)
            yield out

    finer = map_rows(strings, "minimiser long, packed binary, doc_id long, start long, content long", cut)
    finer = finer.groupBy("minimiser", "packed").agg(F.min(F.struct("doc_id", "start", "content")).alias("first"))
    return materialize(finer.select("minimiser", "packed", "first.*"), "strings")


def _texts(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("content", F.xxhash64("text"))


def _packed_texts(docs: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle to their runs, at half the size the shuffle's own codec reaches."""

    def run(batches):
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "content": batch["content"], "text": [zlib.compress(t.as_py().encode(), 1) for t in batch["text"]]}

    return map_rows(_texts(docs), "doc_id long, content long, text binary", run)


def removed_words(n_words: int, suspects, firsts, window: int) -> np.ndarray:
    """Which words a repeated window covers."""
    delta = np.zeros(n_words + 1, np.int64)
    if suspects:
        repeated = np.zeros(n_words, bool)
        for run in suspects:
            repeated[run["start"] : run["start"] + run["size"]] = True
        if firsts:
            at = np.array(firsts, np.int64)
            repeated[at[at < n_words]] = False
        starts = np.flatnonzero(repeated)
        np.add.at(delta, starts, 1)
        np.add.at(delta, starts + window, -1)
    return np.cumsum(delta[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words left, joined by one space) of every row.

    A word goes if a window that covers it also starts earlier: in a document of smaller
    id, or earlier in its own. Windows are judged on the input. Texts with fewer words
    than ``window`` lose nothing; null and empty texts keep the empty string. Rows equal
    in id and text are one document and give equal results; of rows that share only the
    id, the smaller start and then the smaller text hash is earlier. Null ids stay null and stand for one smallest id.
    An empty table gives no rows; other columns are not read.
    """
    found = duplicate_windows(docs, window)

    def cut(batches):
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            lists = zip(batch["doc_id"].to_pylist(), batch["text"], batch["suspects"], batch["firsts"], strict=True)
            for doc_id, text, suspects, firsts in lists:
                own = zlib.decompress(text.as_py()).split()
                n = len(own)
                suspects = suspects.as_py()
                if suspects:
                    gone = removed_words(n, suspects, firsts.as_py(), window)
                    own = [own[i] for i in np.flatnonzero(~gone)]
                kept = b" ".join(own)
                row = (doc_id, n, n - len(own), hashlib.sha256(kept).hexdigest(), kept.decode())
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
            yield out

    rows = _packed_texts(docs).join(found, ["doc_id", "content"], "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    return map_rows(rows, schema, cut).withColumn("doc_id", unkey())
