"""Documents the language stage of the pipeline refuses and keeps."""

from __future__ import annotations

import base64
import random

import pytest

from pyspark.sql import functions as F

from fareway.llm import language

pytest.importorskip("public_tokenizers")


def test_language_stage_refuses_other_languages_and_noise(spark, sf_dir):
    import corpus_pipeline

    rng = random.Random(7)
    odd = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 9))) for _ in range(300)),
        base64.b64encode(rng.randbytes(2000)).decode(), " ".join(rng.randbytes(20).hex() for _ in range(40)), "123 456", "", None,
    ]
    clean = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(-1 - i, t, "en", "odd", 0) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = clean.unionByName(extra.select([F.col(f.name).cast(f.dataType) for f in clean.schema]))
    kept = corpus_pipeline.language_stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    worded = [r["doc_id"] for r in clean.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(worded) and len(worded) > 150
    assert corpus_pipeline.language_stage(spark, docs.limit(0), sf_dir).count() == 0


def test_least_scores_of_rare_languages(spark):
    some = spark.createDataFrame([("one two three four five", "en"), ("un deux trois quatre", "fr"), ("un deux", None), (None, "fr")], "text string, lang string")
    profiles = language.load_profiles(language.learn_profiles(some))
    found = {r["lang_pred"]: r["least"] for r in language.least_scores(some, profiles).collect()}
    scores = {r["lang"]: r["score"] for r in language.identify(some, profiles).collect() if r["lang"] and r["text"]}
    assert set(found) == {"en", "fr"} and all(found[lang] <= scores[lang] for lang in found)


def test_copies_do_not_narrow_a_language(spark, sf_dir):
    import corpus_pipeline

    clean = spark.read.parquet(f"{sf_dir}/documents.parquet")
    longest = clean.filter("lang = 'en'").orderBy(F.desc(F.length("text")), "doc_id").limit(1)
    copies = longest.withColumn("doc_id", F.explode(F.sequence(F.lit(10_000).cast("long"), F.lit(10_999).cast("long"))))
    docs = clean.unionByName(copies.select(*clean.columns))
    assert corpus_pipeline.language_stage(spark, docs, sf_dir).count() == corpus_pipeline.language_stage(spark, clean, sf_dir).count() + 1000
