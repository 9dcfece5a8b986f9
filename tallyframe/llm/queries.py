"""The registered queries of this package, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import class_model, collocations, decontaminate, embeddings, jaccard, language, licenses, mixing, prefix_trie, substrings, suffix_sort, token_counts, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
# an id that no text of this vocabulary yields when special strings are ordinary text
SEPARATOR_ID = 50256


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_files_of(spark: SparkSession, docs: DataFrame) -> DataFrame:
    made = token_files.write_tokens(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_tokens(spark, made)


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_of(spark, table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), SEPARATOR_ID
    )


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


@query
def op5_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op8_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


ORACLES["op8_license_sentences"] = licenses.oracle_sql()


@query
def op1_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_class_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_model.score_documents(table(spark, sf_dir, "documents"))


@query
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


@query
def op12_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_sort.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
