"""Stages of the pipeline against plain loops, on tables with clashing names, repeated rows, ties and nothing; parts of op1, op3, op4, op5, op7, op9 too."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex

from fareway.llm import decontaminate, language, licenses, mixing, near_dup, neighbours, quality, substring_dedup, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = "doc_id long, text string, lang string, source string, contaminated int, gone_id int, gone int, mix_copies int, mix_copy int, mix_node int, `a.b` string, ROW int, again int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rows_of(seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé1") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [None, "", " \n", "one", prose(60), prose(3), "$$$ 12 %", prose(9000)]
    for _ in range(3):
        base = prose(80).split()
        for changes in (0, 0, 1, 2, 4, 9, 30):
            copy = list(base)
            for at in rng.sample(range(80), changes):
                copy[at] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [prose(30) + " " + texts[4] + " " + prose(20), texts[4].upper(), prose(30)]
    rows = [(i * 7 % 41, t, "en", None if i % 7 == 0 else f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(3, texts[9], "en", "s0"), (None, texts[10], "en", "s1"), (None, None, "en", "s2"), rows[9], rows[9], rows[1], (14, texts[12], "en", "s2")]
    return [(*r, k, 2, 3, 4, 5, 6, "x", 7, 8) for k, r in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, CLASHES).repartition(3)


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


def sets(text, n):
    words = WORD.findall(lower(text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_near_duplicate_stage_keeps_one_row_of_each_group(docs, rows):
    shingles = [sets(r[1], 5) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(shingles):
        for j in range(i):
            b = shingles[j]
            same_row = rows[i][:2] == rows[j][:2] or (rows[i][0] == rows[j][0] and not rows[i][1] and not rows[j][1])
            if same_row or (a and b and 100 * len(a & b) >= 80 * len(a | b)):
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = Counter(top(i) for i in range(len(rows)))
    left = near_dup.without_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = left.collect()
    at = {tuple(r): i for i, r in enumerate(rows)}
    assert Counter(top(at[tuple(r)]) for r in kept) == Counter(dict.fromkeys(groups, 1))
    for r in kept:
        group = [rows[i] for i in range(len(rows)) if top(i) == top(at[tuple(r)])]
        smallest = min((g[0] is not None, g[0] or 0) for g in group)
        assert (r["doc_id"] is not None, r["doc_id"] or 0) == smallest
        # of equal rows the first in the order of all columns
        assert r["contaminated"] == min(g[4] for g in group if g[:2] == tuple(r)[:2])


def test_empty_sets_are_not_linked():
    none, some = np.zeros(0, np.uint64), np.array([1, 2], np.uint64)
    assert not near_dup._linked(none, none, 80, 100) and not near_dup._linked(none, some, 80, 100)
    assert near_dup._linked(some, some, 80, 100)


def test_decontamination_stage(spark, docs, rows):
    items = [(1, rows[4][1]), (2, " ".join(rows[7][1].split()[40:75])), (3, "nothing of this stands anywhere here"), (None, None)]
    plain = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def grams(text):
        words = plain.findall(lower(text or ""))
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    wanted = [grams(t) for _, t in items]
    hit = lambda t: any(w and len(w & grams(t)) >= 0.8 * len(w) for w in wanted)
    left = decontaminate.without_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert left.columns == docs.columns
    assert as_rows(left) == Counter(r for r in rows if not hit(r[1])) != Counter(rows)


def plain_mix(rows):
    """Copies of (id, text, source) rows: as many whole rounds as the target holds, then by exponential keys."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    sources = sorted({s for *_, s in rows if s is not None}) + ([None] if any(s is None for *_, s in rows) else [])
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in sources}
    weight = {s: float((1, 2, 3)[i % 3]) for i, s in enumerate(sources)}
    target, left, free = {}, float(sum(size)), list(sources)
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * total[s]]
        if not over:
            target |= share
            break
        target |= {s: 3.0 * total[s] for s in over}
        left -= sum(3 * total[s] for s in over)
        free = [s for s in free if s not in over]
    copies = [0] * len(rows)
    for s in sources:
        mine = []
        for k, (doc_id, text, source) in enumerate(rows):
            if source == s:
                text = text or ""
                name = str(doc_id) if doc_id is not None else hashlib.md5(text.encode()).hexdigest()
                u = (int(hashlib.md5(f"{name}|42".encode()).hexdigest()[:12], 16) + 0.5) / 16**12
                good = max(1 - len(regex.findall(r"[^\p{L}\x20\x09-\x0D]", text)) / max(len(text), 1), 0.05)
                mine.append((-math.log(u) / good, -(2**63) if doc_id is None else doc_id, size[k], k))
        epochs = math.floor(target[s] / total[s]) if total[s] else 0
        rest, before = target[s] - epochs * total[s], 0
        for _, _, n, k in sorted(mine):
            copies[k] = min(epochs + int(n > 0 and rest > 0 and 2 * before + n <= 2 * rest), 3)
            before += n
    return copies


def test_mix_takes_the_rows_a_loop_takes(docs, rows, spark):
    copies = plain_mix([(r[0], r[1], r[3]) for r in rows])
    want = Counter((r[0], r[3], len(WORD.findall(r[1] or "")), c) for r, c in zip(rows, copies))
    assert Counter(tuple(r) for r in mixing.mix(docs).select("doc_id", "source", "size", "copies").collect()) == want
    # keys so equal that only the id tells rows apart
    flat = mixing.mix(docs, quality=docs["mix_copy"] * 0.0 + 1.0)
    assert flat.count() == len(rows)


def test_mixing_stage_repeats_rows(docs, rows):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = as_rows(out)
    assert set(got) <= set(rows) and max(got.values()) <= 3
    words = lambda some: sum(len(WORD.findall(r[1] or "")) * n for r, n in some.items())
    everything = Counter(rows)
    longest = max(len(WORD.findall(r[1] or "")) for r in rows)
    assert abs(words(got) - words(everything)) <= 4 * longest
    # texts without words come as often as their source is taken whole
    rounds = {r["source"]: int(r["target"] // r["source_size"]) for r in mixing.mix(docs).collect()}
    assert all(got[r] == rounds[r[3]] for r in rows if not (r[1] or "").strip())
    # rows equal in id and text are repeated alike
    by_text = {}
    for r in rows:
        by_text.setdefault((r[0], r[1], r[3]), set()).add(got[r])
    assert all(len(n) == 1 for n in by_text.values())


def test_language_stage_with_any_columns(spark, docs):
    import corpus_pipeline

    left = corpus_pipeline.language_stage(spark, docs, "")
    assert left.columns == docs.columns
    assert not any((r["text"] or "").strip() == "" for r in left.collect())


def test_pipeline_of_an_empty_table(spark, sf_dir, tmp_path):
    import corpus_pipeline

    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_odd_rows(spark, docs, sf_dir):
    """Every stage takes the table with clashing names and gives rows of it."""
    import corpus_pipeline

    left, columns = docs, docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, sf_dir)
        assert left.columns == columns
    assert corpus_pipeline.token_stage(spark, left, sf_dir).count() == left.count() > 0


# ---- op1: further minimisers


@pytest.mark.parametrize("hot,levels", [(0, 0), (0, 2), (3, 1), (10**6, 3)])
def test_crowded_minimisers_change_nothing(spark, monkeypatch, hot, levels):
    rng = random.Random(4)
    words = [rng.choice("abc") for _ in range(400)]
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(20)] + [" ".join(words[i : i + 90]) for i in range(0, 300, 40)]
    seen, want = set(), {}
    for d, t in enumerate(texts):
        own, gone = t.split(), set()
        for i in range(len(own) - 7):
            window = tuple(own[i : i + 8])
            if window in seen:
                gone.update(range(i, i + 8))
            seen.add(window)
        want[d] = " ".join(w for i, w in enumerate(own) if i not in gone)
    monkeypatch.setattr(substring_dedup, "_HOT", hot)
    monkeypatch.setattr(substring_dedup, "_LEVELS", levels)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["kept"] for r in substring_dedup.remove_repeats(table, 8).collect()} == want


# ---- op3: out-of-place distance


def test_rank_order_distance_equals_a_loop(spark):
    rng = random.Random(8)
    make = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))
    rows = [(i, make("aabcd" if i % 2 else "ccdef", 40), "x" if i % 2 else "y") for i in range(30)] + [(30, None, "x"), (31, "1 2", "y"), (32, "abc", None)]
    size = 40

    def grams(text):
        out = Counter()
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            padded = f" {word} "
            for n in (1, 2, 3):
                for i in range(len(padded) - n + 1):
                    gram = padded[i : i + n]
                    if gram != " " and not (n == 3 and gram[1] == " "):
                        out[gram] += 1
        return out

    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    profiles = {}
    for lang in ("x", "y"):
        total = sum((grams(t) for _, t, own in rows if own == lang), Counter())
        profiles[lang] = {g: r for r, g in enumerate(sorted(total, key=lambda g: (-total[g], code(g)))[:size])}
    table = spark.createDataFrame(rows, "doc_id int, text string, lang string").repartition(3)
    learned = language.learn_profiles(table, size)
    assert {(r["lang"], language.decode(r["code"]).replace("\x00", ""), r["rank"]) for r in learned.collect()} == {
        (lang, g, r) for lang, ranks in profiles.items() for g, r in ranks.items()}
    # equal distances go to the smaller name
    model = language.load_profiles(learned, size)
    for r in language.identify(table, model).collect():
        own = grams(r["text"])
        top = sorted(own, key=lambda g: (-own[g], code(g)))[:size]
        far = {lang: sum(abs(ranks[g] - i) if g in ranks else size for i, g in enumerate(top)) for lang, ranks in profiles.items()}
        if not top:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        best = min(sorted(far), key=far.get)
        assert r["lang_pred"] == best and abs(r["score"] - (1 - far[best] / (len(top) * size))) < 1e-12
    tie = language.Profiles([{"lang": lang, "code": c, "rank": 0} for lang in ("b", "a") for c in (97,)], 10)
    assert tie.predict("a")[0] == "a"


# ---- op4: forward pass, bags of long texts


def test_forward_pass_equals_a_loop():
    rng = np.random.default_rng(2)
    model = quality.AttentionModel(seed=3)
    bags = [rng.normal(size=(n, quality.FEATURES)).astype(np.float32) for n in (1, 4, 2)]
    model.mean, model.scale = rng.normal(size=quality.FEATURES), rng.uniform(0.5, 2, quality.FEATURES)
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    dot = lambda a, b: sum(float(x) * float(y) for x, y in zip(a, b, strict=True))
    want = []
    for bag in bags:
        hidden, raw = [], []
        for x in bag:
            z = [min(6.0, max(-6.0, (float(v) - m) / s)) for v, m, s in zip(x, model.mean, model.scale)] + [1.0]
            h = [math.tanh(dot(z, model.p["We"][:, j])) for j in range(24)]
            gated = [math.tanh(dot(h, model.p["V"][:, j])) * sigmoid(dot(h, model.p["U"][:, j])) for j in range(16)]
            hidden.append(h), raw.append(dot(gated, model.p["w"][:, 0]))
        weights = [math.exp(r) / sum(map(math.exp, raw)) for r in raw]
        mean = [sum(w * h[j] for w, h in zip(weights, hidden)) for j in range(24)]
        want.append(sigmoid(dot(mean, model.p["c"][:, 0]) + float(model.p["b"][0, 0])))
    assert np.allclose(model.scores(bags), want)


def test_long_texts_are_fitted_whole():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(101, 3)).astype(np.float32)
    short = quality.stretches(x, 32)
    assert short.shape == (32, 3) and quality.stretches(x[:32], 32) is not x and (quality.stretches(x[:32], 32) == x[:32]).all()
    edges = [101 * i // 32 for i in range(33)]
    assert np.allclose(short, [x[a:b].mean(0) for a, b in zip(edges, edges[1:])], atol=1e-6)
    for at in range(101):
        moved = x.copy()
        moved[at] += 1
        assert not np.allclose(quality.stretches(moved, 32), short)


def test_passage_features_equal_a_loop():
    rng = random.Random(6)
    text = " ".join(rng.choice(["Ab", "cd", "cd", "é1", "x|y", "日本", "a,b."]) for _ in range(150)) + "\nend"
    found = quality.passages(text)
    words = text.split()
    assert len(found) == -(-len(words) // quality.WORDS)
    for k, row in enumerate(found):
        own = words[k * quality.WORDS : (k + 1) * quality.WORDS]
        lengths = [len(w) for w in own]
        mean = sum(lengths) / len(own)
        spread = math.sqrt(max(0.0, sum(n * n for n in lengths) / len(own) - mean**2))
        again = sum(a == b for a, b in zip(own, own[1:]))
        if k:
            again += own[0] == words[k * quality.WORDS - 1]
        want = [mean / 10, min(mean, 100) ** 0.5, spread / 10, len(set(own)) / len(own), again / len(own),
                sum(n == 1 for n in lengths) / len(own), len(own) / quality.WORDS]
        assert np.allclose(row[quality._CLASSES : quality._CLASSES + 7], want, atol=1e-5)


# ---- op5: automata and places


def as_pattern(template):
    """A template as an expression over words that each end in a space."""
    out = ""
    for part in re.findall(r"<<[^>]*>>|[^\s<>]+", template):
        if part == "<<optional>>":
            out += "(?:"
        elif part == "<</optional>>":
            out += ")?"
        elif part.startswith("<<replace"):
            out += rf"(?:\S+ ){{0,{int(part[9:-2])}}}"
        else:
            out += re.escape(part) + " "
    return re.compile(r"(?<!\S)" + out)


def test_automata_equal_expressions():
    rng = random.Random(12)
    scanner = licenses.LicenseScanner()
    patterns = [(label, as_pattern(t)) for label, t in licenses.TEMPLATES]
    pieces = [re.sub(r"<<optional>>|<</optional>>", " ", t) for _, t in licenses.TEMPLATES]
    for trial in range(400):
        words = []
        for _ in range(rng.randint(0, 4)):
            piece = rng.choice(pieces)
            piece = re.sub(r"<<replace (\d+)>>", lambda m: " ".join(["filler"] * rng.randint(0, int(m[1]) + 1)), piece).split()
            if rng.random() < 0.5:
                del piece[rng.randrange(len(piece))]
            if rng.random() < 0.3:
                piece.insert(rng.randrange(len(piece)), "filler")
            words += ["under", "the", "mit"][: rng.randint(0, 3)] + piece
        text = " ".join(w.upper() if rng.random() < 0.2 else w for w in words)
        flat = "".join(w + " " for w in words)
        want = {label for label, pattern in patterns if pattern.search(flat)}
        starts = [i for phrase in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase[1].split())] == phrase[1].split()]
        base = {label for label, phrase in licenses.PHRASES if f" {phrase} " in f" {flat}"}
        got = scanner.scan(text)
        assert got["labels"] == ",".join(sorted(want | base)), (trial, text)
        assert (got["n_base"], got["first_word"], got["last_word"]) == (len(starts), min(starts, default=None), max(starts, default=None))


@pytest.mark.parametrize("label,text", [
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("lgpl-2.1", "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("apache-2", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd-2", "SPDX-License-Identifier: BSD-2-Clause"),
])
def test_known_notices(label, text):
    assert label in licenses.LicenseScanner().scan("x " * 50 + text)["labels"].split(",")


# ---- op7: answers are complete


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 11, 16, 30])
def test_few_vectors_are_all_found(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, [1.0, 2.0]), (1001, [1.0, 3.0]), (1002, [5.0, 5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(table, table, k=10).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q in range(n):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = min(10, n - 1)
        mine = got.get(q, {})
        assert sorted(mine) == list(range(1, want + 1))
        if n <= 11:
            assert [mine[r][0] for r in sorted(mine)] == [i for i in np.lexsort((np.arange(n), d)) if i != q][:10]
    # vectors of another length are searched among themselves
    assert [v for v, _ in (got[1000][1], got[1000][2])] == [1001, 1002] and len(got[1001]) == 2


def test_large_lists_lie_in_several_bundles(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_TASK_ROWS", 40)
    monkeypatch.setattr(neighbours, "_TASK_QUERIES", 7)
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(size=(200, 24)), rng.normal(size=(300, 24)) * 0.01 + 3]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, table.filter("vec_id % 10 = 0"), k=5, probe=1.0).collect()
    hits = 0
    for q in range(0, 500, 10):
        d = ((x - x[q]) ** 2).sum(1)
        want = [i for i in np.argsort(d, kind="stable") if i != q][:5]
        mine = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q)
        assert [r for r, _ in mine] == [1, 2, 3, 4, 5]
        hits += len({v for _, v in mine} & set(want))
    assert hits >= 0.95 * 250


# ---- op9: long pre-tokens


def test_long_texts_without_spaces(monkeypatch):
    import time

    import sentencepiece

    file, rng = public_tokenizers.path("piece_bpe_32k.model"), random.Random(11)
    model, merger = sentencepiece.SentencePieceProcessor(model_file=file), token_counts.PieceMerger(file)
    texts = [base64.b64encode(rng.randbytes(n)).decode() for n in (300, 20_000, 750_000)]
    texts += ["".join(rng.choice("日本語の文章をここに書くと分かる") for _ in range(300_000)), "".join(rng.choice(["the", "ing", "er", "é", "of"]) for _ in range(50_000))]
    texts += ["a" * 100_001, "ab" * 40_000 + "a", "=" * 9_999 + " x"]
    begun = time.time()
    assert merger.count(texts) == [len(x) for x in model.encode(texts)]
    assert time.time() - begun < 60
    assert not any(len(t) >= token_counts._LONG for t in merger.known)
    monkeypatch.setattr(token_counts, "_LONG", 2)
    marks = ["a", "th", "e", "in", "é", "日", "  ", "\t", "<s>", "1", "=", "-", "▁", "\U0001f600", "er", "ing"]
    some = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 80))) for _ in range(4000)]
    assert token_counts.PieceMerger(file).count(some) == [len(x) for x in model.encode(some)]


