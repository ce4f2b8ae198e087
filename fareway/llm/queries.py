"""Registered queries of the corpus operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.llm import (
    decontaminate,
    language,
    licenses,
    mixing,
    near_dup,
    neighbours,
    prefix_trie,
    quality,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
    token_ids,
)
from fareway.llm.common import table
from fareway.session import new_folder

END_ID = 2


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Words left after every repeat of a 20-word window is removed."""
    return substring_dedup.remove_repeats(table(spark, sf, "documents"), window=20).drop("kept")


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items contained in documents."""
    return decontaminate.contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language of every document; a quarter of them is held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.is_held_out(4, 2))
    profiles = language.load_profiles(language.learn_profiles(docs.filter("NOT held_out")))
    return language.identify(docs.select("doc_id", "text", "held_out"), profiles).drop("text")


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document; a third of them is held out."""
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    model = quality.fit_quality(docs, labels.filter(~language.is_held_out(3, 1)))
    scored = quality.score_quality(docs.withColumn("held_out", language.is_held_out(3, 1)), model)
    return scored.drop("text")


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.scan_licenses(table(spark, sf, "documents"))


def op6_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids written to files and read back."""
    path = new_folder(spark, "token-ids")
    token_ids.write_token_ids(table(spark, sf, "documents"), path, tokenizer_file("word_bpe_49k.json"), END_ID)
    return token_ids.read_token_ids(spark, path)


def op7_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector."""
    rows = table(spark, sf, "embeddings")
    return neighbours.nearest(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10)


def op8_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate group of every document, by four-word shingles."""
    return near_dup.near_duplicates(table(spark, sf, "documents"), n=4)


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.count_tokens(table(spark, sf, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Words each document adds to the mix."""
    return mixing.mix(table(spark, sf, "documents"))


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the corpus with their commoner spellings."""
    return spelling.spelling_variants(table(spark, sf, "documents"))


def op12_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """SimHash group of every document, by four-word shingles and four differing bits."""
    return simhash.simhash_groups(table(spark, sf, "documents"), n=4, budget=4)


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations."""
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_substring_dedup, op2_decontamination, op3_language_id, op4_quality, op5_license_scan, op6_token_ids,
        op7_nearest_neighbours, op8_near_duplicates, op9_token_counts, op10_source_mix, op11_spelling_variants, op12_simhash, op13_prefix_trie,
    ]
    return {fn.__name__: fn for fn in found}
