"""Spelling variants, SimHash groups and the prefix trie against plain loops."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from fareway.llm import prefix_trie, simhash, spelling
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---- spelling variants


def plain_variants(rows, least=5, ratio=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= least}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    form, count = {}, {}
    for w in n:
        others = [o for o in n if near(w, o)]
        count[w] = len(others)
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return out


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(3)
    stems = ["".join(rng.choice("abéß") for _ in range(rng.randint(5, 8))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "aaaabaa"]
    words = []
    for stem in stems:
        words += [stem] * rng.choice([5, 30, 200])
        for _ in range(6):
            at = rng.randrange(len(stem))
            other = rng.choice([stem[:at] + stem[at + 1 :], stem[:at] + rng.choice("abéßz") + stem[at:], stem[:at] + "z" + stem[at + 1 :]])
            words += [other] * rng.choice([1, 5, 6, 30])
    words += ["x" * 3000] * 6 + ["x" * 2999 + "y"] * 40
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40]) + "1Word") for i in range(40)]
    return rows + [(None, "Aaaaaa aaaaaa-aaaaaa " * 3), (41, None), (42, ""), (43, "÷×÷×÷× short"), rows[3], rows[3]]


@pytest.mark.parametrize("chunk", [None, 3, 8])
def test_variants_equal_loops(spark, spelled, monkeypatch, chunk):
    if chunk:
        monkeypatch.setattr(spelling, "_CHUNK", chunk)
    docs = spark.createDataFrame([(*r, "x", 1) for r in spelled], "doc_id long, text string, word string, n int").repartition(3)
    found = [tuple(r) for r in spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_variants(spelled)


def test_variants_of_nothing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_trie_nodes_name_prefixes(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_CHUNK", 4)
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(90)})
    rows = spark.createDataFrame([(w, i + 1, i + 1) for i, w in enumerate(words)], "spelled string, rank long, word_id long")
    names = defaultdict(set)
    for r in spelling.trie_nodes(rows).collect():
        assert len(r.nodes) == len(r.spelled) + 1
        for d, node in enumerate(r.nodes):
            names[node].add(r.spelled[:d])
    assert all(len(p) == 1 for p in names.values())
    assert len(names) == len({w[:d] for w in words for d in range(len(w) + 1)})


# ---- SimHash


def plain_fingerprint(text, n):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    m = min(n, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + m]).encode(), 42) for i in range(len(words) - m + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(links, nodes):
    root = {x: x for x in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {x: top(x) for x in nodes}


def check_groups(found, rows, prints, budget):
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= budget]
    top = plain_components(links, range(len(rows)))
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[top[i]] = min(smallest.get(top[i], (doc_id is not None, doc_id or 0)), (doc_id is not None, doc_id or 0))
    want = Counter((rows[i][0], f"{prints[i]:016x}", smallest[top[i]][1] if smallest[top[i]][0] else None) for i in range(len(rows)))
    assert Counter(tuple(r) for r in found) == want


@pytest.mark.parametrize("budget", [0, 1, 4, 7])
def test_simhash_equals_loops(spark, budget):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5))) for _ in range(200)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [None, "", " \t", "a", "A b", "a b", prose(70000)] + [prose(rng.randint(1, 60)) for _ in range(60)]
    for _ in range(4):
        base = prose(400).split()
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 12)):
                copy[rng.randrange(400)] = rng.choice(vocabulary)
            texts.append("  ".join(copy))
    rows = [(i * 13 % 131, t) for i, t in enumerate(texts)] + [(13, "another text"), (None, texts[40]), (26, texts[2])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, component string").repartition(3)
    found = simhash.simhash_groups(docs, 4, budget).select("doc_id", "fingerprint", "component_id").collect()
    check_groups(found, rows, [plain_fingerprint(t, 4) for _, t in rows], budget)


def test_simhash_groups_of_close_fingerprints(spark, monkeypatch):
    """Chains of links, dense balls and buckets of several blocks."""
    rng = random.Random(9)
    monkeypatch.setattr(simhash, "_BLOCK", 16)
    prints = [0, 1, 2**63, 2**64 - 1]
    for _ in range(3):
        at = rng.getrandbits(64)
        for _ in range(130):
            prints.append(at)
            for _ in range(rng.randint(1, 5)):
                at ^= 1 << rng.randrange(64)
        center = rng.getrandbits(64)
        for _ in range(150):
            x = center
            for _ in range(rng.randint(2, 5)):
                x ^= 1 << rng.randrange(64)
            prints.append(x)
    rows = [(i, str(p)) for i, p in enumerate(prints)]
    as_long = lambda p: p - 2**64 if p >> 63 else p
    table = spark.createDataFrame([(i, as_long(p)) for i, p in enumerate(prints)], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, n: table)
    found = simhash.simhash_groups(table).select("doc_id", "fingerprint", "component_id").collect()
    check_groups(found, rows, prints, 4)


def test_chains_let_every_close_pair_meet():
    rng = random.Random(2)
    for budget in (1, 2, 4, 6):
        ring = simhash._Ring(budget)
        masks = np.array([c[0] for c in simhash.chains(budget)], np.uint64)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), rng.randint(0, budget)):
                b ^= 1 << bit
            a, b = np.uint64(a), np.uint64(b)
            slots = np.flatnonzero((a & masks) == (b & masks))
            assert ring.close(np.full(len(slots), a), np.full(len(slots), b), slots).any()


def test_simhash_buckets_need_no_join(spark, monkeypatch):
    plans, write = {}, simhash.materialize

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(simhash, "materialize", noted)
    docs = spark.createDataFrame([(i, f"a b c d {i}") for i in range(20)], "doc_id long, text string")
    assert simhash.simhash_groups(docs).count() == 20
    assert "Window" in plans["buckets"] and "Join" not in plans["buckets"]


def test_simhash_of_nothing(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- prefix trie


def plain_trie(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(hashlib.sha256(role.encode()).digest() + hashlib.sha256(text.encode()).digest()).digest()[:16]
            convs[conv_id].append(((turn is not None, turn or 0), key, (role, text)))
    convs = {c: [t[2] for t in sorted(turns)] for c, turns in convs.items()}
    paths = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        paths[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = set()
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        childless = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in sorted(inside) if len(paths[c]) == len(node))
        out.add((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
            sum(len(x) == len(node) + 1 for x in below), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def conversations():
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 75), 103, 104, 111, -3, -20, -21, 2000]:
        if c in (20, 45):
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice(["same words here", "other", "A b  c\td", "", None])))
    first = [(40, t, "user", "the long way") for t in range(12)]
    rows += [(c, t, r, x) for c in (300, 320, 340, 360, 401) for _, t, r, x in first]
    rows += [(500, None, "user", "no turn"), (500, 0, "user", "tie"), (500, 0, "assistant", "tie"), (500, 0, "user", "tie")]
    rows += [(600, t % 700, "user", f"long {t}") for t in range(900)]
    return rows + [(None, 1, "user", "no conversation")]


@pytest.mark.parametrize("bits", [None, 3])
def test_trie_equals_loops(spark, monkeypatch, bits):
    """With few cells the screen proves little, and results are the same."""
    if bits:
        monkeypatch.setattr(prefix_trie, "_LEAST_BITS", bits)
        monkeypatch.setattr(prefix_trie, "_MOST_BITS", bits)
        monkeypatch.setattr(prefix_trie, "_ENDS", 2)
    rows = conversations()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos int, digest string")
    found = prefix_trie.prefix_trie(table.repartition(3))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = [tuple(r) for r in found.select(*names).collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    # conversations whose only turns are replaced by a base that is absent
    lone = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4][:3]
    rows = [(c, 0, "user", "gone") for c in lone]
    found = [tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()]
    assert set(found) == plain_trie(rows) and len(found) == 1
