"""Corpus pipeline: five stages from raw documents to token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.llm import decontaminate, language, mixing, near_dup, token_ids
from fareway.llm.common import table
from fareway.llm.queries import END_ID, tokenizer_file
from fareway.session import new_folder


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is found; profiles and least scores are learned from the documents themselves.

    Each row is judged by its text alone, so repeated rows stay or go together; null texts
    and texts without letters go, and so does everything if no row has a language. All
    columns pass through, whatever their names; an empty table stays empty.
    """
    profiles = language.load_profiles(language.learn_profiles(docs))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = language.identify(docs.select(whole.alias("row"), "text"), profiles)
    # at most one row a language, and no row for an undetermined one
    found = found.join(F.broadcast(language.least_scores(docs, profiles)), "lang_pred").filter("score >= least")
    return found.select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by five-word shingles (see ``without_near_duplicates``)."""
    return near_dup.without_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (see ``without_contaminated``)."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (see ``mixed_documents``)."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: a row for each copy of a document.

    Null and empty texts hold the end id alone; of the columns only doc_id and text are
    read; an empty table gives no rows.
    """
    path = new_folder(spark, "corpus-token-ids")
    token_ids.write_token_ids(docs, path, tokenizer_file("word_bpe_49k.json"), END_ID)
    return token_ids.read_token_ids(spark, path)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: Rank profiles, minima and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
