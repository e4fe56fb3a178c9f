"""Files of posts, tags and labels, read with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from tagwright import schemas
from tagwright.session import fits_broadcast, written


def read_posts(spark: SparkSession, path: str, schema: StructType = schemas.POST) -> DataFrame:
    """Posts from JSON lines; a line that is not a post has null fields and its text in ``_corrupt_record``."""
    with_corrupt = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType())])
    return spark.read.schema(with_corrupt).option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path)


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """``(Id, Tag)`` from CSV with a header; an empty cell is null, the text NA stays."""
    return spark.read.schema(schemas.TAG).option("header", True).option("escape", '"').csv(path)


def read_label_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``(catId, Tag)`` from a CSV column without a header, numbered from 0 by line.

    A repeated tag counts with its last line. Of several files the one named first comes first. Lines are counted
    within the blocks that tasks read, and only the counts, one row per block, are summed up in one task. A vocabulary within
    the library's bound is broadcast where it is joined.
    """
    lines = spark.read.schema(schemas.LABEL).option("escape", '"').csv(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    read = written(lines.select("Tag", *place, F.monotonically_increasing_id().alias("at")), "label-lines")
    blocks = read.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    line = F.col("start") + F.col("at") - F.col("first")
    numbered = read.where("Tag IS NOT NULL").join(F.broadcast(starts), ["file", "block"]).select("Tag", line.alias("line"))
    vocab = numbered.groupBy("Tag").agg(F.max("line").cast("int").alias("catId")).select("catId", "Tag")
    vocab = written(vocab, "label-vocab")
    return F.broadcast(vocab) if fits_broadcast(vocab, 32 + F.octet_length("Tag")) else vocab
