"""From raw documents to token files: each stage works on what the stage before it kept.

1. language: documents without a language go (no letter, or long and unlike every known language);
2. near_copies: one document of each group of similar documents stays;
3. contamination: documents that overlap an item of the benchmark go;
4. mix: sources are mixed to their target weights, by blocks of words;
5. token_output: the corpus as token files; per document its place in them.

Every stage but the last returns the columns of ``documents``.

Defined cases: a null or empty text, or one without letters, goes in the first stage; texts of any length pass whole. Rows
of one identifier, and rows without one, are documents of their own: equal texts among them leave one document, and a
contaminated row takes the other rows of its identifier with it. Null languages and sources count as values of their own.
Extra columns stay as they are, whatever their names. Empty tables give an empty corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import decontaminate, jaccard, language, mixing
from tallyframe.llm import queries as q
from tallyframe.llm.common import store


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, q.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return q.token_files_of(spark, docs)


STAGES = [
    ("language", language_filter), ("near_copies", near_copies), ("contamination", contamination), ("mix", mix),
    ("token_output", token_output),
]

# language profiles, hashed draws and the tokenizer have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next one reads it."""
    docs = q.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
