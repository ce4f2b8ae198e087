"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage is encoded by a small
learned layer; gated attention, learned from document labels alone, weighs the
passages; a logistic output scores the weighted mean.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import append, map_rows, mix, segments

WORDS = 64
_MARKS = "|$%&*#!.,"
_BUCKETS = 24
_UPPER, _LOWER, _DIGIT, _WIDE, _LINE, _OTHER, _MARK = range(7)
_CLASSES = _MARK + len(_MARKS)
FEATURES = _CLASSES + 7 + _BUCKETS


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of the first 256 code points; a code point above counts as a wide letter."""
    out = np.full(256, _OTHER, np.int64)
    out[128:] = _WIDE
    for low, high, kind in ((65, 91, _UPPER), (97, 123, _LOWER), (48, 58, _DIGIT), (10, 11, _LINE)):
        out[low:high] = kind
    for i, mark in enumerate(_MARKS):
        out[ord(mark)] = _MARK + i
    return out


def _encode(text: str) -> np.ndarray:
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    in_word = (x != 32) & ((x < 9) | (x > 13))
    starts = np.flatnonzero(in_word & ~np.r_[False, in_word[:-1]])
    if not len(starts):
        return np.zeros((0, FEATURES), np.float32)
    ends = np.flatnonzero(in_word & ~np.r_[in_word[1:], False]) + 1
    n = -(-len(starts) // WORDS)
    passage = np.arange(len(starts)) // WORDS
    words = np.bincount(passage, minlength=n)
    low = np.minimum(x, 255).astype(np.int64)
    at = np.zeros(len(x), np.int64)
    at[starts[WORDS::WORDS]] = 1
    at = np.cumsum(at)
    chars = np.bincount(at, minlength=n)[:, None]
    kinds = np.bincount(at * _CLASSES + _classes()[low], minlength=n * _CLASSES).reshape(n, -1)
    grams = ((x[:-1] | 32) * np.uint32(31) + (x[1:] | 32)) % np.uint32(_BUCKETS)
    hashed = np.bincount(at[1:] * _BUCKETS + grams, minlength=n * _BUCKETS).reshape(n, -1)
    lengths = ends - starts
    mean = np.bincount(passage, lengths, n) / words
    spread = np.sqrt(np.maximum(np.bincount(passage, lengths.astype(float) ** 2, n) / words - mean**2, 0))
    # a word's code: a sum over its characters that depends on their order, wrapping
    place = np.arange(starts[0], len(x)) - np.repeat(starts, np.diff(np.r_[starts, len(x)]))
    char = mix(x[starts[0] :].astype(np.uint64) * np.uint64(2**32) + place.astype(np.uint64))
    codes = np.add.reduceat(char * in_word[starts[0] :], starts - starts[0])
    again = np.r_[False, codes[1:] == codes[:-1]]
    order = np.lexsort((codes, passage))
    p, c = passage[order], codes[order]
    distinct = np.bincount(p, np.r_[True, (p[1:] != p[:-1]) | (c[1:] != c[:-1])], n)
    stats = np.stack(
        [mean / 10, np.minimum(mean, 100) ** 0.5, spread / 10, distinct / words, np.bincount(passage, again, n) / words,
         np.bincount(passage, lengths == 1, n) / words, words / WORDS], 1)
    return np.concatenate([np.sqrt(kinds / chars), stats, hashed / chars], 1).astype(np.float32)


def passages(text: str | None) -> np.ndarray:
    """One row of features for every passage of the whole text; one row of zeros for a text without words."""
    found = np.concatenate([_encode(s) for s in segments(text or "")])
    return found if len(found) else np.zeros((1, FEATURES), np.float32)


def stretches(x: np.ndarray, most: int) -> np.ndarray:
    """``x`` itself, or the means of ``most`` stretches of its rows if it has more."""
    if len(x) <= most:
        return x
    edges = len(x) * np.arange(most + 1) // most
    return (np.add.reduceat(x, edges[:-1]) / np.diff(edges)[:, None]).astype(np.float32)


class AttentionModel:
    """h = tanh(We x); weight = softmax(w · tanh(V h) · sigmoid(U h)); score = sigmoid(c · Σ weight h + b)."""

    SHAPES = {"We": (FEATURES + 1, 24), "V": (24, 16), "U": (24, 16), "w": (16, 1), "c": (24, 1), "b": (1, 1)}

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in self.SHAPES.items()}
        self.p["b"][:] = 0
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, np.ones((len(z), 1))], 1)

    def _forward(self, z: np.ndarray, starts: np.ndarray, bag: np.ndarray):
        p = self.p
        h = np.tanh(z @ p["We"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        raw = ((t * g) @ p["w"])[:, 0]
        e = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        m = np.add.reduceat(a[:, None] * h, starts)
        return h, t, g, a, m, 1 / (1 + np.exp(-np.clip(m @ p["c"] + p["b"], -30, 30)[:, 0]))

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(b) for b in bags])
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        return self._forward(self._inputs(np.concatenate(bags)), starts, np.repeat(np.arange(len(bags)), sizes))[-1]

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, batch: int = 64, rate: float = 0.01):
        """Adam on the log loss with a small weight decay; the same rows in the same order give the same model."""
        rows = np.concatenate(bags)
        self.mean, self.scale = rows.mean(0), rows.std(0) + 1e-3
        inputs = [self._inputs(b) for b in bags]
        rng = np.random.default_rng(1)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, steps = 0, epochs * -(-len(bags) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), batch):
                chosen = order[i : i + batch]
                sizes = np.array([len(inputs[k]) for k in chosen])
                starts, bag = np.r_[0, np.cumsum(sizes)[:-1]], np.repeat(np.arange(len(chosen)), sizes)
                grads = self._gradients(np.concatenate([inputs[k] for k in chosen]), starts, bag, labels[chosen])
                step += 1
                now = rate * (1 - 0.95 * step / steps)
                for k, grad in grads.items():
                    grad = grad + 1e-4 * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad**2
                    self.p[k] = self.p[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, z, starts, bag, y) -> dict:
        p = self.p
        h, t, g, a, m, score = self._forward(z, starts, bag)
        out = ((score - y) / len(y))[:, None]
        dm = (out @ p["c"].T)[bag]
        da = (dm * h).sum(1)
        draw = (a * (da - np.add.reduceat(a * da, starts)[bag]))[:, None]
        dtg = draw @ p["w"].T
        dt, dg = dtg * g * (1 - t**2), dtg * t * g * (1 - g)
        dh = (dm * a[:, None] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h**2)
        return {"We": z.T @ dh, "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ draw, "c": m.T @ out, "b": out.sum(keepdims=True)}


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 6000, bag: int = 32) -> AttentionModel:
    """Model fitted on at most ``sample`` labelled documents, each with its whole text.

    Of a text of more than ``bag`` passages, neighbouring ones are put together: the bag
    holds the means of ``bag`` stretches of equal length, so every passage counts.
    ``labels`` holds doc_id and quality (0 or 1; others are not used); an id with several
    labels, or several texts, is a document for each. The sample is the rows of smallest
    id hash, so it repeats. With labels of one kind or none the untrained output only
    shifts to that kind or stays near one half.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .withColumn("order", F.xxhash64("doc_id", F.lit("quality")))
        .orderBy("order", "doc_id", "quality")
        .limit(sample)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def encode(batches):
        for batch in batches:
            bags = []
            for text in batch["text"]:
                bags.append(stretches(passages(text.as_py()), bag).tobytes())
            yield {"doc_id": batch["doc_id"], "order": batch["order"], "quality": batch["quality"], "bag": bags}

    found = map_rows(rows, "doc_id long, order long, quality int, bag binary", encode).collect()
    found.sort(key=lambda r: (r["order"], r["doc_id"], r["quality"], bytes(r["bag"])))
    model = AttentionModel()
    if not found:
        return model
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in found]
    return model.fit(bags, np.array([r["quality"] for r in found], float))


def score_quality(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5), from the whole text alone.

    Null and empty texts are a bag with one passage of zeros. Repeated rows get
    equal scores; other columns pass through; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> dict:
        scores: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size = 0
        for text in batch["text"]:
            held.append(passages(text.as_py()))
            size += len(held[-1])
            if size > 20_000:
                scores.append(shared.value.scores(held))
                held, size = [], 0
        if held:
            scores.append(shared.value.scores(held))
        all_scores = np.concatenate(scores) if scores else np.zeros(0)
        return {"score": all_scores, "predicted": (all_scores >= 0.5).astype(np.int32)}

    return append(docs, "score double, predicted int", score)
