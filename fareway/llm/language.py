"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareway.llm.common import append, map_rows, segments, small_batches

UNDETERMINED = "und"
_BLANK = 32
#: Counts a task holds before it adds up those of equal n-grams.
_PENDING = 500_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point, blank for all that is no letter."""
    out = np.full(0x110000, _BLANK, np.int64)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            out[point] = ord(lower) if len(lower) == 1 else point
    return out


def _count(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        codes = np.sort(codes)
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
        return codes[first], np.diff(np.r_[first, len(codes)])
    order = np.argsort(codes)
    codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(weights, first) if len(first) else weights


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Ascending codes and counts of the 1- to 3-grams of a text's blank-padded words.

    A code packs the code points, 21 bits each; blanks between words count once
    and no n-gram spans two words.
    """
    parts = []
    for segment in segments(text):
        x = _letters()[np.frombuffer(f" {segment} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
        x = x[np.r_[True, (x[1:] != _BLANK) | (x[:-1] != _BLANK)]]
        tri = (x[:-2] << 42) | (x[1:-1] << 21) | x[2:]
        parts.append(_count(np.concatenate([x[x != _BLANK], (x[:-1] << 21) | x[1:], tri[x[1:-1] != _BLANK]])))
    if len(parts) == 1:
        return parts[0]
    return _count(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))


def decode(code: int) -> str:
    points = [code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF]
    return "".join(chr(p) for p in points if p)


def learn_profiles(docs: DataFrame, size: int = 300) -> DataFrame:
    """The ``size`` most frequent n-grams of each language: lang, code, rank (from 0).

    Rows need ``text`` and ``lang``; those with a null in either are not used, and texts
    without letters add nothing. Counts cover every row, repeated ones too, and whole texts
    of any length. Ties go to the smaller code. An empty table has no profiles.
    """

    def counts(batches):
        held: dict[str, list] = {}
        pending = 0

        def add_up():
            for lang, parts in held.items():
                held[lang] = [_count(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))]
            return sum(len(parts[0][0]) for parts in held.values())

        def flush():
            for lang, parts in held.items():
                codes, n = parts[0]
                yield {"lang": [lang] * len(codes), "code": codes, "n": n}
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                part = gram_counts(text.as_py())
                held.setdefault(lang, []).append(part)
                pending += len(part[0])
                if pending > _PENDING:
                    pending = add_up()
                    if pending > _PENDING // 2:
                        yield from flush()
                        pending = 0
        add_up()
        yield from flush()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("lang").cast("string").alias("lang"), "text").dropna()
    grams = map_rows(rows, "lang string, code long, n long", counts).groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    # this form lets every task keep its own first rows of a language before they meet
    first = grams.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
    return first.select("lang", "code", (F.col("place") - 1).alias("rank"))


class Profiles:
    """Learned profiles as arrays: ranks[gram, language], ``size`` where a language lacks the n-gram."""

    def __init__(self, rows, size: int):
        self.size = size
        self.langs = sorted({r["lang"] for r in rows})
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.codes = np.array(sorted({r["code"] for r in rows}), np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), size, np.int64)
        if rows:
            where = np.searchsorted(self.codes, [r["code"] for r in rows])
            self.ranks[where, [at[r["lang"]] for r in rows]] = [r["rank"] for r in rows]

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = gram_counts(text or "")
        if not len(codes) or not self.langs:
            return UNDETERMINED, 0.0
        top = codes[np.argsort(-counts, kind="stable")[: self.size]]
        where = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        where[self.codes[where] != top] = len(self.codes)
        ranks = self.ranks[where]
        out_of_place = np.where(ranks < self.size, np.abs(ranks - np.arange(len(top))[:, None]), self.size).sum(0)
        best = int(out_of_place.argmin())
        return self.langs[best], 1.0 - float(out_of_place[best]) / (len(top) * self.size)


def load_profiles(profiles: DataFrame, size: int = 300, max_languages: int = 1000) -> Profiles:
    """Profiles on the driver, ``size`` rows a language; more than ``max_languages`` is an error."""
    rows = profiles.limit(size * max_languages + 1).collect()
    if len(rows) > size * max_languages:
        raise ValueError(f"more than {max_languages} languages: is the language column right?")
    return Profiles(rows, size)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with lang_pred and score, from the text alone.

    The distance of a document to a language is the sum, over the document's most
    frequent n-grams, of the difference between the two ranks, or the profile size
    where the language lacks the n-gram. score is 1 minus that distance over the
    largest possible one. Null texts and texts without a letter: ``und`` and 0.
    Ties between languages go to the smaller name. Without any learned language
    every row is ``und``. Repeated rows get equal results; other columns pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    small_batches(docs.sparkSession)

    def predict(batch: pa.RecordBatch) -> dict:
        model = shared.value
        found = [model.predict(t.as_py()) for t in batch["text"]]
        return {"lang_pred": [p for p, _ in found], "score": [s for _, s in found]}

    return append(docs, "lang_pred string, score double", predict)


def least_scores(docs: DataFrame, profiles: Profiles, distance: float = 6.0, least_gap: float = 0.05, steps: int = 1000) -> DataFrame:
    """lang_pred and least: the score below which a text is not in the language, for each language of ``profiles``.

    It lies ``distance`` times the gap between median and lower quartile below the median
    of the scores of the documents that are labelled with the language and found to be
    in it, so up to a quarter of them may be noise. A language of few documents takes the
    gap of all languages if that is wider, and a language without any their median too.
    No gap is narrower than ``least_gap``. Scores are counted in ``steps`` steps, those of
    equal texts once, over every row of ``docs``, in any partitioning alike.
    """
    # labelled like the learned rows; a label is compared as it is, without regard to what identify() adds
    rows = docs.select(F.col("lang").cast("string").alias("label"), "text").dropna()
    found = identify(rows, profiles).filter("label = lang_pred")
    counted = found.groupBy("lang_pred", F.floor(F.col("score") * steps).cast("long").alias("step")).agg(F.count_distinct(F.xxhash64("text")).alias("n"))
    held: dict[str, dict[int, int]] = {}
    together: dict[int, int] = {}
    for row in counted.collect():
        held.setdefault(row["lang_pred"], {})[row["step"]] = row["n"]
        together[row["step"]] = together.get(row["step"], 0) + row["n"]

    def quantile(counts: dict[int, int], share: float) -> float:
        order = sorted(counts)
        at = np.searchsorted(np.cumsum([counts[s] for s in order]), share * sum(counts.values()))
        return order[int(at)] / steps

    names, least = [], []
    for lang in profiles.langs if together else ():
        middle = quantile(held.get(lang, together), 0.5)
        gap = max(middle - quantile(held.get(lang, together), 0.25), quantile(together, 0.5) - quantile(together, 0.25), least_gap)
        names.append(lang), least.append(middle - distance * gap)
    # an Arrow table becomes rows without Python workers of another kind, which would stay beside the others
    found = pa.table({"lang_pred": pa.array(names, pa.string()), "least": pa.array(least, pa.float64())})
    return docs.sparkSession.createDataFrame(found)


def is_held_out(modulus: int, remainder: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))
