"""The posts, tags, submissions and updates that the given tables stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.operators.labels import class_list, class_table, label_vocab, unpivot_tags
from tagwright.session import spread

VOCAB_SIZE = 100  # of the models
TOP_TAGS = 10  # of the queries that show the cut itself

SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(Id, Body)``, spread over the cores as texts are costly to work on."""
    documents = table(spark, sf_dir, "documents")
    return spread(documents.select(F.col("doc_id").alias("Id"), F.col("text").alias("Body")), "Id")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(Id, Tag)``: language, source and the two judgements, where they hold."""
    described = unpivot_tags(table(spark, sf_dir, "documents"), "doc_id", ["lang", "source"])
    judged = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "quality").alias("quality"),
        F.when(F.col("toxic") == 1, "toxic").alias("toxic"),
    )
    return described.unionByName(unpivot_tags(judged, "doc_id", ["quality", "toxic"]))


def vocab(spark: SparkSession, sf_dir: str, size: int = VOCAB_SIZE) -> DataFrame:
    """``(catId, Tag)`` of the most frequent tags, counted once and then a local table."""
    return class_table(class_list(label_vocab(tags(spark, sf_dir), size)), spark)


def full_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as text fields, titled in English only, so that one field can be absent."""
    documents = table(spark, sf_dir, "documents")
    return spread(documents.select(
        F.col("doc_id").cast("string").alias("Id"),
        F.when(F.col("lang") == "en", F.concat(F.lit("post "), F.col("doc_id"))).alias("Title"),
        F.col("text").alias("Body"),
        F.col("source").alias("OwnerUserId"),
        F.lit("2024-01-01T00:00:00Z").alias("CreationDate"),
        F.lit("NA").alias("ClosedDate"),
        F.col("n_chars").cast("string").alias("Score"),
    ), "Id")


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms from the turns of conversations; only users fill them in."""
    return table(spark, sf_dir, "conversations").select(
        F.when(F.col("role") == "user", F.col("text")).alias("posts"),
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.col("conv_id").cast("string").alias("userid"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads: users' turns as JSON posts, all others as bare text."""
    turns = table(spark, sf_dir, "conversations")
    post = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("Id"),
        F.col("text").alias("Body"),
        F.col("conv_id").cast("string").alias("OwnerUserId"),
    )
    return turns.select(F.when(F.col("role") == "user", F.to_json(post)).otherwise(F.col("text")).alias("value"))


def post_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged posts that are written again with each turn of a conversation; each turn fills some fields."""
    said = lambda role: F.when(F.col("role") == role, F.col("text"))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("Id"),
        said("system").alias("Title"),
        said("user").alias("Body"),
        F.col("role").alias("OwnerUserId"),
        F.lit("2024-01-01T00:00:00Z").alias("CreationDate"),
        F.lit("NA").alias("ClosedDate"),
        F.length("text").cast("string").alias("Score"),
        F.when(F.col("role") == "assistant", F.lit("answered")).alias("tags"),
        "turn",
    )


def event_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User states that are written again with each event; some events lack a value or properties."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        "ts",
        "event_id",
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("props"),
    )


def stored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(Id, tag)`` of the stored posts, tagged with their language."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("Id"), F.col("lang").alias("tag"))
