"""The queries of this folder's operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagwright.llm.checks import CHECKS as CHECKS
from tagwright.llm.common import documents
from tagwright.llm.encoding import document_encoding
from tagwright.llm.langid import document_languages
from tagwright.llm.lm import document_scores
from tagwright.llm.lz import successor_fingerprints
from tagwright.llm.mixing import document_mix
from tagwright.llm.packing import document_packing
from tagwright.llm.prefix_trie import conversation_trie
from tagwright.llm.quality import document_quality
from tagwright.llm.sharding import document_shards
from tagwright.llm.simhash import near_duplicates
from tagwright.llm.token_files import document_tokens
from tagwright.llm.toxicity import document_toxicity
from tagwright.llm.vector_codes import compressed_vectors
from tagwright.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(documents(spark, sf_dir), 16)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_mix(documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_languages(documents(spark, sf_dir))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_scores(documents(spark, sf_dir))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_encoding(documents(spark, sf_dir), TOKENIZER)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_quality(documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(documents(spark, sf_dir), new_folder(spark, "token-files"), TOKENIZER)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return document_toxicity(documents(spark, sf_dir), labels)


def op10_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return successor_fingerprints(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_packing(documents(spark, sf_dir), TOKENIZER)


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_lm_score": op4_lm_score,
    "op5_bpe": op5_bpe,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_lz_fingerprint": op10_lz_fingerprint,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_packing": op13_packing,
}
