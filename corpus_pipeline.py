"""A pipeline over the documents, made of the operators of ``tagwright.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagwright.llm.encoding import document_encoding
from tagwright.llm.langid import in_known_language
from tagwright.llm.mixing import mixed_documents
from tagwright.llm.quality import passing
from tagwright.llm.queries import TOKENIZER
from tagwright.llm.simhash import one_of_each
from tagwright.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones of ``docs`` teach; others go."""
    return in_known_language(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule; others go."""
    return passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    return one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document."""
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the ids, and of the text decoded from them, for each row of the mix."""
    return document_encoding(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("language id", language_id),
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("source mix", source_mix),
    ("bpe", bpe),
]

# SQL cannot express the language filters, SimHash or byte pairs; tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of each are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
