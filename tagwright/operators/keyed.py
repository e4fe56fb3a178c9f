"""Tables with one row per key, where later rows replace or complete earlier ones.

Both merges are a maximum over (order, values). They can be taken in any grouping and repeated without
change, so each task reduces its rows to one per key before the shuffle, however often a key occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.schemas import STORED_POST


def stored_layout(tagged: DataFrame, *extra: str) -> DataFrame:
    """The columns of the stored post, with ``tags`` renamed to ``tag``."""
    return tagged.withColumnRenamed("tags", "tag").select(*STORED_POST.names, *extra)


def newest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``(key, newest)``: the latest row of each key as one struct; rows without a key go.

    Of rows with equal ``order`` the one with the greatest values wins, so the result never varies.
    """
    values = [name for name in df.columns if name != key and name not in order]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*order, *values)).alias("newest"))
    )


def latest_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The latest row of each key as a whole: a field that it lacks becomes null."""
    return newest(df, key, order).select(key, "newest.*").select(*df.columns)


def newest_fields(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``(key, <field>...)``: for each field a struct of its latest filled value and that row's order."""
    fields = [name for name in df.columns if name != key and name not in order]
    latest = [
        F.max(F.when(F.col(name).isNotNull(), F.struct(*order, name))).alias(name) for name in fields
    ]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*latest)


def merge_newest_fields(states: DataFrame, key: str) -> DataFrame:
    """Combine results of ``newest_fields``."""
    return states.groupBy(key).agg(*[F.max(name).alias(name) for name in states.columns if name != key])


def plain_fields(state: DataFrame, key: str) -> DataFrame:
    """The values of a ``newest_fields`` result without their orders."""
    return state.select(key, *[F.col(f"{name}.{name}").alias(name) for name in state.columns if name != key])


def merge_fields(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """For each key and field the latest filled value: a field that a row lacks keeps its old value."""
    return plain_fields(newest_fields(df, key, order), key)


def lookup_tag(stored: DataFrame, post_id) -> DataFrame:
    """The tag of one post, no row if it is not stored. The id is a parameter, never part of the text."""
    return stored.sparkSession.sql(
        "SELECT tag FROM {stored} WHERE Id = :id", args={"id": post_id}, stored=stored
    )


def lookup_tags(stored: DataFrame, requests: DataFrame) -> DataFrame:
    """``(Id, tag)`` for each distinct requested id, null where the post is not stored."""
    return requests.select("Id").distinct().join(stored.select("Id", "tag"), "Id", "left")
