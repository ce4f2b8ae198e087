"""Corpus operators against brute force on small tables with nulls, copies, ties and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fareway.llm import (
    decontaminate, language, licenses, mixing, near_dup, neighbours, quality, simple8b, substring_dedup, token_counts, token_ids,
)
from fareway.session import new_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, score double, n_words int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def texts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared, base = prose(40), prose(200).split()
    out = [None, "", " \n\t", "a", "a b", "Solo " * 400, prose(3000), prose(30), prose(30)]
    for _ in range(8):
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        out += [" ".join(copy), prose(25) + "\n" + shared + "  " + prose(rng.randint(0, 60))]
    return out + [out[9], out[9], out[7].upper(), "Released under the MIT License. " + prose(20), shared]


@pytest.fixture(scope="module")
def rows():
    found = [(i * 7 % 31, t, "fr" if i % 2 else "en", None if i % 5 == 0 else f"s{i % 4}", 0.5, 1) for i, t in enumerate(texts())]
    return found + [found[9], found[1], (None, "a b c d e f", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def unique(rows):
    return {r[0]: r[1] for r in rows if r[0] is not None}


def test_repeated_windows_go(docs, rows, empty):
    seen, want = set(), {}
    for d, t in sorted(unique(rows).items()):
        words, gone = WORD.findall(t or ""), set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        want[d] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    got = substring_dedup.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    assert {r[0]: tuple(r)[1:] for r in got if r[0] is not None} == want
    assert sum(v[1] for v in want.values()) > 500
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_hot_minimisers_go_by_window(docs, monkeypatch):
    want = sorted(map(tuple, substring_dedup.remove_repeats(docs, 8).collect()), key=str)
    monkeypatch.setattr(substring_dedup, "_HOT", 0)
    assert sorted(map(tuple, substring_dedup.remove_repeats(docs, 8).collect()), key=str) == want


def test_contained_items(spark, docs, rows, empty):
    items = [(1, texts()[-1]), (2, " ".join(texts()[6].upper().split()[500:560])), (3, "nothing of this stands anywhere at all"),
             (4, "mit License"), (5, None), (6, "..."), (None, texts()[-1])]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def grams(text, n=5):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    want = set()
    for d, t, *_ in rows:
        for i, item in items:
            own = grams(item) or (grams(item, 2) if i == 4 else set())
            found = own & grams(t, 2 if i == 4 else 5)
            if own and len(found) >= 0.8 * len(own):
                want.add((d, i, len(found), len(own)))
    got = decontaminate.contained_items(docs, bench)
    assert {tuple(r)[:4] for r in got.collect()} == want and len(want) > 15
    left = decontaminate.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == sum(r[0] not in {w[0] for w in want} for r in rows)
    assert decontaminate.contained_items(empty, bench).count() == 0
    assert decontaminate.contained_items(docs, bench.limit(0)).count() == 0


def test_language(spark, docs, rows, empty, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held", language.is_held_out(4, 2))
    profiles = language.load_profiles(language.learn_profiles(table.filter("NOT held")))
    found = language.identify(table.filter("held"), profiles).select("lang", "lang_pred").collect()
    assert found and sum(r[0] == r[1] for r in found) >= 0.97 * len(found)
    odd = language.identify(docs, profiles)
    assert odd.columns[-2:] == ["lang_pred", "score"] and odd.count() == len(rows)
    assert {r["lang_pred"] for r in odd.collect() if not (r["text"] or "").strip()} == {"und"}
    assert language.identify(empty, profiles).count() == 0
    nothing = language.load_profiles(language.learn_profiles(empty))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}


def test_gram_counts_match_a_plain_count():
    want: dict[str, int] = {}
    text = "L'Été, 2 fois l'été\n\nЯ"
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != " " and not (n == 3 and gram[1] == " "):
                    want[gram] = want.get(gram, 0) + 1
    codes, counts = language.gram_counts(text)
    assert {language.decode(c): n for c, n in zip(codes.tolist(), counts.tolist(), strict=True)} == want


def test_quality(spark, docs, rows, empty, sf_dir):
    table, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit_quality(table, labels.filter(~language.is_held_out(3, 1)))
    held = labels.filter(language.is_held_out(3, 1)).select("doc_id", "quality")
    found = quality.score_quality(table, model).join(held, "doc_id").select("score", "quality").collect()
    good, bad = ([r[0] for r in found if r[1] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    odd = quality.score_quality(docs, model).collect()
    assert len(odd) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in odd)
    assert quality.score_quality(empty, quality.fit_quality(empty, labels)).count() == 0


def test_attention_gradients_match_differences():
    rng = np.random.default_rng(0)
    model, bags, y = quality.AttentionModel(), [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2)], np.array([1.0, 0, 1])
    starts, bag = np.array([0, 1, 4]), np.array([0, 1, 1, 1, 2, 2])
    z = model._inputs(np.concatenate(bags))
    grads = model._gradients(z, starts, bag, y)

    def loss():
        p = model._forward(z, starts, bag)[-1]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, grad in grads.items():
        at = (0, 0)
        model.p[name][at] += 1e-5
        up = loss()
        model.p[name][at] -= 2e-5
        down = loss()
        model.p[name][at] += 1e-5
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-6


def test_license_phrases_and_templates(docs, rows, empty):
    got = licenses.scan_licenses(docs).collect()
    assert len(got) == len(rows)
    hits = [r for r in got if r["n_base"]]
    assert [(r["n_base"], r["first_word"], r["base_labels"], r["labels"], r["score"]) for r in hits] == [(1, 1, "mit", "mit", 1.0)]
    assert licenses.scan_licenses(empty).count() == 0
    scan = licenses.LicenseScanner().scan
    assert scan("X! under THE mit license under the MIT-license")["n_base"] == 2
    assert scan("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by-nc"
    assert scan("This work is licensed under the GNU General Public License, version 3.")["labels"] == "gpl-3"
    assert scan("Copyright 2020 A B. All rights reserved")["labels"] == "reserved"
    assert scan("Copyright " + "x " * 9 + "All rights reserved")["labels"] == ""
    auto = licenses.Automaton("a <<optional>>b c<</optional>> <<replace 2>> d")
    accepted = {w: auto.accepts_at(w.split(), 0) for w in ("a d", "a b c d", "a b c x y d", "a x y z d", "a b x d")}
    assert list(accepted.values()) == [True, True, True, False, True]
    for wrong in ("<<replace 1>> a", "<<optional>>a<</optional>>", "a <<optional>>b"):
        with pytest.raises(ValueError):
            licenses.Automaton(wrong)


def test_simple8b_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 119, 1024, 1025, 5000):
        for top in (0, 1, 9, 16, 33, 61, 64):
            ids = np.array([rng.integers(0, 2**32) << 32 | rng.integers(0, 2**32) for _ in range(n)], np.uint64) >> np.uint64(64 - top) if top else np.zeros(n, np.uint64)
            words, offsets = simple8b.encode(ids)
            assert (simple8b.decode(words, offsets, n) == ids).all()


def test_token_files(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, at, want = Tokenizer.from_file(file), 0, []
    for d, t, *_ in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    path = new_folder(spark, "ids")
    token_ids.write_token_ids(docs, path, file, 2)
    assert sorted(map(tuple, token_ids.read_token_ids(spark, path).collect()), key=str) == sorted(want, key=str)
    path = new_folder(spark, "ids")
    token_ids.write_token_ids(empty, path, file, 2)
    assert token_ids.read_token_ids(spark, path).count() == 0


def test_word_ids_equal_whole_text_ids():
    from tokenizers import Tokenizer

    file, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(5)
    marks = ["a", "B", "é", "É", "ß", "İ", "̌", "J", "日", "1", "'s", "'T", ",", ".", "$$", "<|endoftext|>", " ", "  ", "\n", "\t", "²", "ª"]
    some = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    ids, counts = token_ids.WordIds(file, 2).texts(some)
    ends = np.cumsum(counts)
    for encoded, end, n in zip(Tokenizer.from_file(file).encode_batch(some, add_special_tokens=False), ends, counts, strict=True):
        assert ids[end - n : end].tolist() == [*encoded.ids, 2]


def test_forgotten_pieces_are_learnt_again(monkeypatch):
    from tokenizers import Tokenizer

    file, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(6)
    parts = ["ab", "Cd", "É", "÷", "ª", "e\u0301", "J\u030c", "don't", "<|endoftext|>", "a<b", "...", "x-y", "7", "\xa0", " ", " ", "\n"]
    some = ["", *("".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(400)), " \n", ""]
    monkeypatch.setattr(token_ids, "_REMEMBERED", 300)
    words = token_ids.WordIds(file, 2)
    for begin in range(0, len(some), 50):
        texts = some[begin : begin + 50]
        ids, counts = words.texts(texts)
        want = [[*e.ids, 2] for e in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
        assert len(words.index) <= 300


def test_tasks_of_a_worker_share_a_tokenizer(spark, docs, monkeypatch):
    from pyspark import cloudpickle

    file, tasks, loads, key = public_tokenizers.path("word_bpe_49k.json"), [], [], "spark.sql.execution.arrow.maxBytesPerBatch"
    before, map_rows, load = spark.conf.get(key), token_ids.map_rows, token_ids.WordIds.__init__
    monkeypatch.setattr(token_ids, "map_rows", lambda df, schema, fn: tasks.append(cloudpickle.dumps(fn)) or map_rows(df, schema, fn))
    token_ids.write_token_ids(docs, new_folder(spark, "ids"), file, 2)
    assert spark.conf.get(key) == before
    monkeypatch.setattr(token_ids, "_TOKENIZERS", {})
    monkeypatch.setattr(token_ids.WordIds, "__init__", lambda self, *args: loads.append(args) or load(self, *args))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a b"]})
    for _ in range(3):
        assert len(list(cloudpickle.loads(tasks[0])([batch]))) == 1
    assert loads == [(file, 2)]


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 20)).astype("float32")
    x[100:400] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(1000, None, 0), (1001, [0.0] * 20, 0), (1002, [None] * 20, 0), (1003, [float("nan")] * 20, 0), (1004, [1.0], 0), (None, x[0].tolist(), 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(4)
    got: dict[int, list] = {}
    for r in sorted(neighbours.nearest(table, table.filter("vec_id % 100 = 0")).collect()):
        got.setdefault(r[0], []).append(r)
    hits = 0
    for q in range(0, 900, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(900), d)) if i != q][:10]
        assert [r["rank"] for r in got[q]] == list(range(1, 11))
        assert all(abs(d[r["vec_id"]] - r["score"]) < 1e-12 for r in got[q])
        hits += len({r["vec_id"] for r in got[q]} & set(order))
    assert [r["vec_id"] for r in got[200]] == list(range(100, 110)) and len(got) == 9 and hits >= 81
    assert neighbours.nearest(table.limit(0), table.limit(0)).count() == 0


@pytest.mark.parametrize("few", [32, 0])
def test_near_duplicates(docs, rows, empty, monkeypatch, few):
    monkeypatch.setattr(near_dup, "_FEW", few)
    sets = {}
    for d, t in unique(rows).items():
        words = WORD.findall(lower(t or ""))
        sets[d] = {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()
    root = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = near_dup.near_duplicates(docs, n=4).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), root[r["doc_id"]], root[r["doc_id"]] == r["doc_id"])
    assert near_dup.near_duplicates(empty).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "u long, v long")
    found = {r["node"]: r["component"] for r in near_dup.components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_token_counts(docs, rows, empty):
    import sentencepiece

    file, rng = public_tokenizers.path("piece_bpe_32k.model"), random.Random(6)
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    got = token_counts.count_tokens(docs, file, limit=100).collect()
    want = [(d, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 100) for d, t, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(empty, file).count() == 0
    marks = ["a", "th", "e", "in", "é", "日", " ", "  ", "\n", "\t", "<s>", "1", "=", "-", "▁", "\U0001f600"]
    some = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["a" * 5000, " " * 300]
    assert token_counts.PieceMerger(file).count(some) == [len(x) for x in model.encode(some)]


def test_mix(docs, rows, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size, names = {}, sorted({r[3] for r in rows if r[3]}) + [None]
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, sum(size.values()), list(names)
    while True:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            break
        target |= {s: 3 * size[s] for s in over}
        left -= sum(3 * size[s] for s in over)
        free = [s for s in free if s not in over]
    target |= share
    for s in names:
        mine = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == size[s] and r["taken"] <= 3 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= max(r["size"] for r in mine) / 2 + 1e-6
    assert sorted(map(tuple, mixing.mix(docs.repartition(2)).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != "token_ids":
            assert docs.columns == columns
            path = new_folder(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            mixed = docs.count()
    found = docs.orderBy("start").collect()
    assert len(found) == mixed and [r["start"] for r in found] == np.r_[0, np.cumsum([r["n_tokens"] for r in found])[:-1]].tolist()


def test_workers_do_not_grow_from_task_to_task(spark):
    """What a task of the pipeline's stages leaves behind in its worker, and what reaches it at once, stay small."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(120_000)]
    texts = [" ".join(words[i : i + 400]) for i in range(0, len(words), 400)]
    known = token_ids.WordIds(public_tokenizers.path("word_bpe_49k.json"), 2)
    for begin in range(0, len(texts), 20):
        known.texts(texts[begin : begin + 20])
    known.rest()
    assert len(known.index) == len(set(" ".join(texts[-20:]).split()))
    ids, counts = known.texts([texts[0], texts[-1]])
    want = [[*e.ids, 2] for e in known.tokenizer.encode_batch([texts[0], texts[-1]], add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]

    docs = spark.createDataFrame([(i, "xy " * 40_000, "en") for i in range(40)], "doc_id long, text string, lang string").repartition(1)
    for learnt in (language.identify(docs, language.load_profiles(language.learn_profiles(docs))), decontaminate.without_contaminated(docs, docs.selectExpr("doc_id item_id", "'a b c d e f g h' text"))):
        sizes = learnt.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert sum(r["n"] for r in sizes) == 40 and max(r["n"] for r in sizes) <= 12
