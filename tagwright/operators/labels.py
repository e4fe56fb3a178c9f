"""Tags, the label vocabulary and labelled training rows.

A vocabulary made here is measured. Within the library's bound it is broadcast wherever it is joined, so that the
rows of a frequent tag never meet in one task; a larger one, as any other table, is joined as Spark sees fit.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwright.fixed_values import BROADCAST_BYTES, TRAIN_SHARE
from tagwright.functions.keys import in_training, key_part
from tagwright.functions.rows import filled
from tagwright.session import fits_broadcast, written


def unpivot_tags(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One ``(Id, Tag)`` row per filled tag column, in one scan."""
    tags = F.explode_outer(F.array(*[F.col(name).cast("string") for name in columns]))
    return df.select(F.col(key).alias("Id"), tags.alias("Tag")).where("Tag IS NOT NULL")


def tag_counts(tags: DataFrame) -> DataFrame:
    return tags.where("Tag IS NOT NULL").groupBy("Tag").agg(F.count("*").alias("n"))


def label_vocab(tags: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent tags with class ids 0..k-1, ties by name."""
    top = tag_counts(tags).orderBy(F.desc("n"), "Tag").limit(k)
    # The window sees k rows only.
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "Tag"))
    vocab = written(top.select((rank - 1).alias("catId"), "Tag", "n"), "label-vocab")
    return F.broadcast(vocab) if fits_broadcast(vocab, 32 + F.octet_length("Tag")) else vocab


def class_list(vocab: DataFrame) -> list[tuple[int, str]]:
    """The vocabulary as (class id, tag) pairs; a model holds a few numbers for each of them."""
    rows = vocab.select(F.col("catId").cast("int").alias("catId"), "Tag").orderBy("catId").collect()
    return [(row["catId"], row["Tag"]) for row in rows]


def class_table(classes: list[tuple], spark: SparkSession, schema: str = "catId INT, Tag STRING") -> DataFrame:
    """``(catId, Tag)`` from (class id, tag) pairs, or other columns from longer rows."""
    names = [field.split()[0] for field in schema.split(", ")]
    listed = json.dumps([dict(zip(names, row)) for row in classes])
    rows = F.from_json(F.lit(listed), f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    table = spark.range(1, numPartitions=1).select(F.inline(rows))
    # the list itself is at hand, so its size is known
    return F.broadcast(table) if len(listed) <= BROADCAST_BYTES else table


def select_tags(tags: DataFrame, vocab: DataFrame) -> DataFrame:
    """The tag rows whose tag is in the vocabulary, without rows that have a null."""
    return filled(tags).join(vocab.select("Tag"), "Tag", "left_semi").select("Id", "Tag")


def training_rows(tags: DataFrame, posts: DataFrame, vocab: DataFrame) -> DataFrame:
    """One ``(Tag, Body, Id)`` row for each selected tag of each post, without nulls.

    A post meets its gathered tags once, and is repeated for each of them after that.
    """
    labelled = labelled_posts(filled(posts.select("Id", "Body")), tags, vocab)
    return with_tag(class_rows(labelled, "Id", "Body"), vocab, tag_column="Tag").select("Tag", "Body", "Id")


def with_class(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add the class id of each row's tag; rows with an unknown tag go."""
    ids = vocab.select("Tag", F.col("catId").cast("double").alias("CatId"))
    return rows.join(ids, "Tag")


def with_tag(rows: DataFrame, vocab: DataFrame, class_column: str = "CatId", tag_column: str = "tags") -> DataFrame:
    """Add the tag of each row's class id, null where the id is unknown."""
    names = vocab.select(F.col("catId").cast("int").alias("_class"), F.col("Tag").alias(tag_column))
    matched = rows.join(names, rows[class_column].cast("int") == F.col("_class"), "left")
    return matched.drop("_class")


def post_classes(tags: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(Id, classes)``: the class ids of a post, each with the number of its tag rows.

    The list has at most as many entries as the vocabulary, whatever the number of tag rows.
    """
    ids = vocab.select("Tag", F.col("catId").cast("int").alias("CatId"))
    pairs = filled(tags).join(ids, "Tag").groupBy("Id", "CatId").agg(F.count("*").alias("n"))
    return pairs.groupBy("Id").agg(F.collect_list(F.struct("CatId", "n")).alias("classes"))


def labelled_posts(posts: DataFrame, tags: DataFrame, vocab: DataFrame) -> DataFrame:
    """``posts`` that have a tag of the vocabulary, once each, with their ``classes``.

    The classes are written and measured: if they are small they are broadcast and the texts stay in place,
    else both sides are partitioned and sorted by post, in memory that can spill.
    """
    classes = written(post_classes(tags, vocab), "post-classes")
    row_bytes = 64 + F.octet_length(F.col("Id").cast("string")) + 32 * F.size("classes")
    if fits_broadcast(classes, row_bytes):
        return posts.join(F.broadcast(classes), "Id")
    return posts.join(classes, "Id")


def class_rows(labelled: DataFrame, *keep: str) -> DataFrame:
    """One row ``(*keep, CatId)`` per tag row of each post.

    Repeats of a tag row are unfolded in two steps, so that no list of them gets long.
    """
    step = 4096
    part_numbers = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("c.n") - 1) / step))
    left = F.least(F.lit(step).cast("bigint"), F.col("c.n") - F.col("part") * step)
    repeats = F.sequence(F.lit(1).cast("bigint"), left)
    pairs = labelled.select(*keep, F.explode_outer("classes").alias("c"))
    parts = pairs.select(*keep, "c", F.explode_outer(part_numbers).alias("part"))
    rows = parts.select(*keep, F.col("c.CatId").alias("CatId"), F.explode_outer(repeats).alias("repeat"))
    return rows.drop("repeat")


def split_by_key(df: DataFrame, key: str = "Id", share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows; all rows of a key fall on the same side."""
    chosen = in_training(F.col(key), share)
    return df.where(chosen), df.where(~chosen)


def split_parts(df: DataFrame, shares: list[float], key: str = "Id") -> list[DataFrame]:
    """The rows of each of ``shares`` and the rest, one after the other; all rows of a key fall into one part."""
    parted = df.withColumn("_part", key_part(F.col(key), shares))
    return [parted.where(F.col("_part") == at).drop("_part") for at in range(len(shares) + 1)]


def tag_sets(tags: DataFrame) -> DataFrame:
    """``(Id, tags)``: the distinct tags of each post in order."""
    return filled(tags).groupBy("Id").agg(F.sort_array(F.collect_set("Tag")).alias("tags"))
