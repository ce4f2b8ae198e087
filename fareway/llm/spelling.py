"""Spelling variants: words one edit apart, by pairs of trie nodes.

The words stand in order, read forwards and read backwards; a node of either trie is
numbered by a word that has it as prefix and its depth. A word is then a row of forward
and backward node numbers, and a pair (node of what stands before, node of what stands
after) names a word with a place skipped, or a split where a place may be inserted.
Words that share a skip pair differ in that place alone; a word whose split pair is
another's skip pair lacks that one code point. Such a group holds at most one word for
each letter and one more, so no group can grow with the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import map_rows
from fareway.operators.numbering import number_rows
from fareway.session import materialize

#: Words that are numbered one after the other in one task.
_CHUNK = 1 << 13
#: Lower bits of a node number, for its depth.
_DEPTH_BITS = 24
#: Distinct words a task counts before it hands them on.
_COUNTED = 200_000
#: One of so many words of a document loses a code point.
_DAMAGE = 199


def damaged(doc_id: int | None, run: str) -> str:
    """``run`` as the document spells it: one of 199 lacks a code point; rows without id keep all."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % _DAMAGE else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, length: int, least: int) -> DataFrame:
    """word and n of the words of at least ``length`` code points that occur at least ``least`` times."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{length},}}")

    def count(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                # bytes lower-case A-Z only
                for run, k in Counter(runs.findall(text.as_py().encode().lower().decode())).items():
                    counts[damaged(doc_id, run)] += k
                if len(counts) >= _COUNTED:
                    yield {"word": list(counts), "n": list(counts.values())}
                    counts.clear()
        yield {"word": list(counts), "n": list(counts.values())}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = map_rows(rows, "word string, n long", count).filter(F.length("word") >= length)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def trie_nodes(words: DataFrame) -> DataFrame:
    """word_id (or any other columns) and nodes of every row of ``words`` (spelled, rank): the trie node of each prefix, the empty one first.

    Ranks number the spellings in order from 1. A node is named by its depth and the
    first word that has it: of all words if they lie in one chunk, else the word at the
    first edge between chunks that it spans. Chunks are read one word after the other.
    """
    chunk = ((F.col("rank") - 1) / _CHUNK).cast("long")
    placed = words.withColumn("chunk", chunk)
    edge = placed.filter((F.col("rank") - 1) % _CHUNK == 0).select(F.col("chunk").alias("edge"), F.lit(1).alias("side"), "spelled", "rank")
    edge = edge.unionByName(placed.filter(F.col("rank") % _CHUNK == 0).select((F.col("chunk") + 1).alias("edge"), F.lit(0).alias("side"), "spelled", "rank"))

    def starts(batches):
        # a row for each edge between chunks, that is one for 8,192 words
        names: list[int] = []
        before, spanned = None, ""
        for batch in batches:
            for edge, side, spelled, rank in zip(*(batch[c].to_pylist() for c in ("edge", "side", "spelled", "rank")), strict=True):
                if not side:
                    before = spelled
                    continue
                shared = common_prefix(before, spelled) if before is not None and edge else 0
                # nodes that span the edge before as well keep their names
                kept = common_prefix(spanned, spelled[:shared])
                names = names[:kept] + [(rank << _DEPTH_BITS) + d for d in range(kept + 1, shared + 1)]
                spanned = spelled[:shared]
                yield {"edge": [edge], "spanned": [spanned], "names": [names]}

    spans = map_rows(edge.repartition(1).sortWithinPartitions("edge", "side"), "edge long, spanned string, names array<long>", starts)
    spans = materialize(spans, "spans")
    columns = ["chunk", "rank", "spelled", "names", *[c for c in words.columns if c not in ("rank", "spelled")]]
    rest = columns[4:]
    meta = [
        spans.select((F.col("edge") - back).alias("chunk"), F.lit(back - 1).cast("long").alias("rank"), F.col("spanned").alias("spelled"), "names")
        for back in (0, 1)
    ]
    rows = placed.withColumn("names", F.lit(None).cast("array<long>")).select(*columns)
    rows = rows.unionByName(meta[0], allowMissingColumns=True).unionByName(meta[1], allowMissingColumns=True)
    rows = rows.repartition("chunk").sortWithinPartitions("chunk", "rank")

    def number(batches):
        at, spanned, before, nodes = None, [], "", []
        for batch in batches:
            out: dict[str, list] = {c: [] for c in (*rest, "nodes", "spelled")}
            for chunk, rank, spelled, names, *values in zip(*(batch[c].to_pylist() for c in columns), strict=True):
                if chunk != at:
                    at, spanned, before, nodes = chunk, [], "", []
                if rank <= 0:
                    spanned.append((spelled, names))
                    continue
                if len(spelled) >= 1 << _DEPTH_BITS:
                    raise ValueError("a word of 16,777,216 code points or more cannot be numbered")
                shared = common_prefix(before, spelled)
                nodes = nodes[:shared] + [(rank << _DEPTH_BITS) + d for d in range(shared + 1, len(spelled) + 1)]
                for prefix, known in spanned:
                    d = common_prefix(prefix, spelled)
                    nodes[:d] = known[:d]
                before = spelled
                out["nodes"].append([0, *nodes])
                out["spelled"].append(spelled)
                for c, value in zip(rest, values, strict=True):
                    out[c].append(value)
            yield out

    fields = {f.name: f.dataType.simpleString() for f in words.schema.fields}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in rest), "nodes array<long>", "spelled string"])
    return map_rows(rows, schema, number)


def _places(words: DataFrame) -> DataFrame:
    """before, after, kind, word_id, n: every skipped place (kind 0, or 1 where it starts a run of one letter) and every split (2)."""

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("before", "after", "kind", "word_id", "n")}
            columns = (batch[c].to_pylist() for c in ("word", "word_id", "n", "forward", "backward"))
            for word, word_id, n, forward, backward in zip(*columns, strict=True):
                backward.reverse()
                size = len(word)
                out["before"] += forward[:-1] + forward
                out["after"] += backward[1:] + backward
                out["kind"] += [1, *(int(a != b) for a, b in zip(word, word[1:], strict=False))] + [2] * (size + 1)
                out["word_id"] += [word_id] * (2 * size + 1)
                out["n"] += [n] * (2 * size + 1)
            yield out

    return map_rows(words, "before long, after long, kind int, word_id long, n long", run)


def _best(members: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The two commonest members (n, -word_id)."""
    return sorted(members, reverse=True)[:2]


def near_words(words: DataFrame) -> DataFrame:
    """word_id, n_near (words one edit away), near_n and near_id (the commonest of them) of words (word, word_id, n) that have any."""
    backward = number_rows(words.select("word_id", F.reverse("word").alias("spelled")), ["spelled"], "rank")
    backward = trie_nodes(backward).select("word_id", F.col("nodes").alias("backward"))
    forward = trie_nodes(words.select(F.col("word_id").alias("rank"), F.col("word").alias("spelled"), "word_id", "n"))
    forward = forward.select("word_id", "n", F.col("spelled").alias("word"), F.col("nodes").alias("forward"))
    places = _places(forward.join(backward, "word_id"))
    # one word for each letter of the skipped place, and one without it: a bound by the alphabet
    groups = places.groupBy("before", "after").agg(F.collect_list(F.struct("kind", "word_id", "n")).alias("members")).filter(F.size("members") > 1)

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("word_id", "n_near", "near_n", "near_id")}
            for members in batch["members"].to_pylist():
                skips = [(m["n"], -m["word_id"], m["kind"]) for m in members if m["kind"] < 2]
                short = [(m["n"], -m["word_id"]) for m in members if m["kind"] == 2]
                top = _best([s[:2] for s in skips])
                for n, number, kind in skips:
                    near = [t for t in top if t[1] != number] + (short if kind else [])
                    count = len(skips) - 1 + (len(short) if kind else 0)
                    if count:
                        best = max(near)
                        for c, value in zip(out, (-number, count, best[0], -best[1]), strict=True):
                            out[c].append(value)
                longer = [s[:2] for s in skips if s[2]]
                for _, number in short if longer else ():
                    best = max(longer)
                    for c, value in zip(out, (-number, len(longer), best[0], -best[1]), strict=True):
                        out[c].append(value)
            yield out

    found = map_rows(groups.select("members"), "word_id long, n_near long, near_n long, near_id long", run)
    found = found.groupBy("word_id").agg(F.sum("n_near").alias("n_near"), F.max(F.struct("near_n", (-F.col("near_id")).alias("low"))).alias("best"))
    return found.select("word_id", "n_near", F.col("best.near_n").alias("near_n"), (-F.col("best.low")).alias("near_id"))


def _roots(forms: DataFrame) -> DataFrame:
    """word_id and root_id of words that have a form, by following two forms at a time.

    A form is at least five times as common, so chains are short and the rounds few.
    """
    links = materialize(forms.select("word_id", F.col("form_id").alias("root_id")), "roots")
    while True:
        ahead = links.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("further"))
        step = links.join(ahead, "root_id", "left")
        if not step.filter("further IS NOT NULL").limit(1).count():
            return links
        links = materialize(step.select("word_id", F.coalesce("further", "root_id").alias("root_id")), "roots")


def spelling_variants(docs: DataFrame, length: int = 6, least: int = 5, ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n and root of the words of ``docs``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, of which
    one in 199 of a document lacks a code point, as crc32 of ``<doc_id>:<run>`` says; those
    of at least ``length`` code points and ``least`` occurrences are kept. Near words differ
    by one inserted, deleted or replaced code point. The form is the commonest near word
    (ties: smallest in code-point order) if it is at least ``ratio`` times as common as the
    word; the root is where the forms lead.

    Null and empty texts hold no words. Rows without id lose no code point; repeated rows
    count each. A word of 2^24 code points or more raises an error. An empty table gives no
    rows; other columns are not read.
    """
    if length < 1 or ratio < 2:
        raise ValueError("words need a code point, and forms must be commoner than their words")
    words = materialize(word_counts(docs, length, least), "words")
    words = materialize(number_rows(words, ["word"], "word_id"), "numbered-words")
    near = near_words(words).withColumn("form_id", F.col("near_id"))
    rows = words.join(near, "word_id", "left").withColumn("common", F.col("near_n") >= ratio * F.col("n"))
    rows = materialize(rows.select(
        "word_id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("common"), F.col("near_id")).alias("form_id"), F.when(F.col("common"), F.col("near_n")).alias("form_n"),
    ), "forms")
    linked = rows.filter("form_id IS NOT NULL")
    named = words.select(F.col("word_id").alias("id"), F.col("word").alias("name"))
    linked = linked.join(_roots(linked), "word_id")
    linked = linked.join(named.withColumnRenamed("name", "form"), linked.form_id == F.col("id")).drop("id")
    linked = linked.join(named.withColumnRenamed("name", "root"), linked.root_id == F.col("id")).drop("id")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = rows.filter("form_id IS NULL").withColumn("form", F.lit(None).cast("string")).withColumn("root", F.col("word"))
    return linked.select(*columns).unionByName(alone.select(*columns))
