"""Token counts by rank-synchronous merging of ragged numpy arrays.

The vocabulary is a byte-fallback BPE model of the sentencepiece library: two
neighbouring symbols merge when their concatenation is a piece, pieces of higher
score (lower rank) first, ties to the left. Pre-tokens are lines cut before each
run of spaces; no piece crosses such a cut.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import id_and_text, map_rows, unkey

SPACE = "▁"
_REMEMBERED = 500_000
_BATCH_SYMBOLS = 400_000
#: Characters from which a pre-token is a long one.
_LONG = 256
_NO_RANK = np.int32(2**31 - 1)


class PieceMerger:
    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = [
            i for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in plain}
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in pieces):
            raise ValueError("a piece crosses a pre-token border")
        if model.encode("  a b ") != model.encode(f"{SPACE}{SPACE}a{SPACE}b{SPACE}"):
            raise ValueError("the model normalises spaces in another way than the escape")
        scores = sorted(set(pieces.values()), reverse=True)
        rank = {score: r for r, score in enumerate(scores)}
        shared = len(scores) < len(pieces)
        self.ids = {p: i for i, p in enumerate(pieces)}
        n = len(pieces)
        self.rank = np.array([rank[s] for s in pieces.values()], np.int32)
        left, right, whole = [], [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), whole.append(i)
        left, right, whole = (np.array(x, np.int64) for x in (left, right, whole))
        # tame: no merge with this piece comes before, or level with, the merge that makes it
        self.tame = np.ones(n, bool)
        for part in (left, right):
            self.tame[part[self.rank[whole] <= self.rank[part]]] = False
        if shared:
            same = np.bincount(self.rank)[self.rank] > 1
            self.tame[same] = False
        # characters outside the vocabulary never merge: ids n + number of their UTF-8 bytes
        self.unknown = n
        self.base = n + 5
        keys = left * self.base + right
        order = np.argsort(keys)
        self._build(keys[order], whole[order])
        self.known: dict[str, int] = {}

    def _build(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open-addressing table: slot = multiplied key's top bits, then the next slots."""
        self.bits = max(10, int(np.ceil(np.log2(len(keys) * 4 + 1))))
        size = 1 << self.bits
        self.slots, self.found = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        pending, self.probes = np.arange(len(keys)), 0
        while len(pending):
            slot = (self._slot(keys[pending]) + self.probes) & (size - 1)
            free = self.slots[slot] < 0
            winner = np.zeros(len(pending), bool)
            winner[np.unique(slot, return_index=True)[1]] = True
            take = free & winner
            self.slots[slot[take]], self.found[slot[take]] = keys[pending[take]], values[pending[take]]
            pending = pending[~take]
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece made of two neighbours, -1 if there is none."""
        keys = left * self.base + right
        slot = self._slot(keys)
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        for probe in range(self.probes):
            at = (slot[open_] + probe) & (len(self.slots) - 1)
            here = self.slots[at]
            hit = here == keys[open_]
            out[open_[hit]] = self.found[at[hit]]
            open_ = open_[~hit & (here >= 0)]
            if not len(open_):
                break
        return out

    def _symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        distinct, inverse = np.unique(points, return_inverse=True)
        ids = []
        for p in distinct:
            char = chr(p)
            ids.append(self.ids.get(char, self.unknown + len(char.encode())))
        return np.array(ids, np.int64)[inverse]

    def count_batch(self, tokens: list[str]) -> np.ndarray:
        """Number of surviving symbols of every pre-token, all merged at the same time.

        In each round a pre-token's lowest-ranked pair merges: all its places from the
        left if the made piece is tame, which cannot change the outcome, else the first.
        """
        if not tokens:
            return np.zeros(0, np.int64)
        lengths = np.array([len(t) for t in tokens])
        result = np.zeros(len(tokens), np.int64)
        ids = self._symbols("".join(tokens))
        owner = np.repeat(np.arange(len(tokens)), lengths)
        while len(ids):
            joined = self._merged(ids[:-1], ids[1:])
            joined[owner[1:] != owner[:-1]] = -1
            ranks = np.where(joined >= 0, self.rank[joined], _NO_RANK)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(np.r_[ranks, _NO_RANK], first)
            sizes = np.diff(np.r_[first, len(ids)])
            mergeable = best < _NO_RANK
            if not mergeable.all():
                # finished pre-tokens leave: a piece is one token, an unknown character one a byte
                done = np.repeat(~mergeable, sizes)
                result += np.bincount(owner[done], np.maximum(ids[done] - self.unknown, 1), len(tokens)).astype(np.int64)
                keep = ~done
                joined, ranks = np.r_[joined, -1][keep][:-1], np.r_[ranks, _NO_RANK][keep][:-1]
                ids, owner, best, sizes = ids[keep], owner[keep], best[mergeable], sizes[mergeable]
                if not len(ids):
                    break
            pick = np.flatnonzero(ranks == np.repeat(best, sizes)[:-1])
            # one place each, unless tame: then every second of a run of overlapping places
            own = owner[pick]
            new = np.r_[True, own[1:] != own[:-1]]
            runs = np.r_[True, (pick[1:] != pick[:-1] + 1) | new[1:]]
            start = np.maximum.accumulate(np.where(runs, pick, 0))
            pick = pick[new | (self.tame[joined[pick]] & ((pick - start) % 2 == 0))]
            ids[pick] = joined[pick]
            gone = np.zeros(len(ids), bool)
            gone[pick + 1] = True
            ids, owner = ids[~gone], owner[~gone]
        return result

    def count_long(self, tokens: list[str]) -> list[int]:
        """Number of surviving symbols of long pre-tokens, in time that hardly grows faster than their length.

        Ranks come up in order over all pre-tokens. All places of a rank merge at once, every
        second of a run of overlapping ones. Only where a made piece would merge on at once,
        because its pair with a neighbour ranks no later, the places behind it come up again.
        """
        lengths = np.array([len(t) for t in tokens])
        ids = self._symbols("".join(tokens))
        n = len(ids)
        owner = np.repeat(np.arange(len(tokens)), lengths)
        after = np.arange(1, n + 1)
        after[np.cumsum(lengths) - 1] = n
        before = np.arange(-1, n - 1)
        before[np.cumsum(lengths) - lengths] = -1
        # n stands for no neighbour; -1 marks a symbol that went into the one before it
        ids = np.r_[ids, -1]
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def pairs(left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            left = left[(ids[left] >= 0) & (after[left] < n)]
            joined = self._merged(ids[left], ids[after[left]])
            return left[joined >= 0], joined[joined >= 0]

        def push(left: np.ndarray) -> None:
            left, joined = pairs(left)
            rank = self.rank[joined]
            order = np.argsort(rank, kind="stable")
            left, rank = left[order], rank[order]
            cuts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]]) if len(rank) else []
            for r, part in zip(rank[cuts].tolist(), np.split(left, cuts[1:]), strict=True) if len(rank) else ():
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(part)

        push(np.arange(n))
        while ranks:
            rank = heapq.heappop(ranks)
            left, joined = pairs(np.unique(np.concatenate(waiting.pop(rank))))
            now = self.rank[joined] == rank
            left, joined = left[now], joined[now]
            if not len(left):
                continue
            own = owner[left]
            new = np.r_[True, own[1:] != own[:-1]]
            # places that follow one another overlap: the second symbol of one is the first of the next
            starts = np.r_[True, after[left[:-1]] != left[1:]] | new
            step = np.arange(len(left)) - np.maximum.accumulate(np.where(starts, np.arange(len(left)), 0))
            pick = step % 2 == 0
            if not self.tame[joined].all():
                pick[pick] = self._undisturbed(ids, before, after, owner, left[pick], joined[pick], rank)
            rest, left, joined = left[~pick], left[pick], joined[pick]
            right = after[left]
            ids[left], ids[right] = joined, -1
            beyond = after[right]
            after[left] = beyond
            inside = beyond < n
            before[beyond[inside]] = left[inside]
            touched = np.concatenate([left, before[left], rest])
            push(np.unique(touched[touched >= 0]))
        kept = ids[:-1] >= 0
        return np.bincount(owner[kept], np.maximum(ids[:-1][kept] - self.unknown, 1), len(tokens)).astype(np.int64).tolist()

    def _undisturbed(self, ids, before, after, owner, left, joined, rank: int) -> np.ndarray:
        """Which places merge before anything else does: those up to the first of a pre-token whose piece merges on at once."""
        right = after[left]
        # the symbol to the left is the piece of the place before, if that ends there
        chained = np.r_[False, before[left[1:]] == right[:-1]]
        near = np.where(chained, np.r_[-1, joined[:-1]], ids[before[left]])
        near[(before[left] < 0) & ~chained] = -1
        beyond = ids[after[right]]
        disturbed = np.zeros(len(left), bool)
        for a, b, there in ((near, joined, near >= 0), (joined, beyond, beyond >= 0)):
            made = self._merged(a[there].astype(np.int64), b[there].astype(np.int64))
            disturbed[np.flatnonzero(there)[(made >= 0) & (self.rank[made] <= rank)]] = True
        seen = np.cumsum(disturbed) - disturbed
        first = np.r_[True, owner[left[1:]] != owner[left[:-1]]]
        return seen == seen[np.maximum.accumulate(np.where(first, np.arange(len(left)), 0))]

    def _learn(self, tokens: set[str]) -> None:
        long = [t for t in tokens if len(t) >= _LONG]
        if long:
            self.known.update(zip(long, self.count_long(long), strict=True))
        # like lengths share a batch, so that few rounds serve it
        todo, size = [], 0
        for token in sorted((t for t in tokens if len(t) < _LONG), key=len):
            todo.append(token)
            size += len(token)
            if size >= _BATCH_SYMBOLS:
                self.known.update(zip(todo, self.count_batch(todo).tolist(), strict=True))
                todo, size = [], 0
        self.known.update(zip(todo, self.count_batch(todo).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        cut = [pre_tokens(t) for t in texts]
        counts = []
        held: list[tuple[int, list[str]]] = []
        missing: set[str] = set()
        for lines, tokens in cut:
            held.append((lines, tokens))
            missing.update(t for t in tokens if t not in self.known)
            if len(missing) >= _REMEMBERED // 2:
                counts += self._settle(held, missing)
                held, missing = [], set()
        return counts + self._settle(held, missing)

    def _settle(self, held, missing) -> list[int]:
        if len(self.known) + len(missing) > _REMEMBERED:
            # words that the held texts need stay, however many they are
            self.known = {t: self.known[t] for _, tokens in held for t in tokens if t in self.known}
        if missing:
            self._learn(missing)
        known = self.known
        counts = [lines + sum(map(known.__getitem__, tokens)) for lines, tokens in held]
        # long pre-tokens hardly come again and would fill the memory
        for token in [t for t in missing if len(t) >= _LONG]:
            del known[token]
        return counts


def pre_tokens(text: str) -> tuple[int, list[str]]:
    """Number of line feeds (one byte token each), and the pieces between, cut before each run of spaces."""
    if not text:
        return 0, []
    text = SPACE + text.replace(" ", SPACE)
    lines = text.count("\n")
    if SPACE + SPACE in text:
        return lines, re.findall(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+", text)
    return lines, [t for t in text.replace(SPACE, "\n" + SPACE).split("\n") if t]


_MERGERS: dict[str, PieceMerger] = {}


def _merger(model_file: str) -> PieceMerger:
    if model_file not in _MERGERS:
        _MERGERS[model_file] = PieceMerger(model_file)
    return _MERGERS[model_file]


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``, whole texts.

    ``model_file`` is a path every worker can read. Null and empty texts have no bytes
    and no tokens; very long texts, also without any space, count whole; null ids stay
    null; repeated rows give equal rows; an empty table gives none; other columns are
    not read.
    """

    def run(batches):
        merger = _merger(model_file)
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": merger.count(batch["text"].to_pylist())}

    rows = id_and_text(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = map_rows(rows, "doc_id long, n_bytes long, n_tokens long", run)
    return counted.withColumn("doc_id", unkey()).withColumn("over_limit", F.col("n_tokens") > limit)
