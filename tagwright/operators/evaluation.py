"""How often a prediction is right."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.fixed_values import BASELINE_ACCURACY


def accuracy(rows: DataFrame, label: str = "CatId", prediction: str = "prediction") -> DataFrame:
    """``(n, accuracy)`` over (post, tag) rows."""
    right = (F.col(prediction) == F.col(label)).cast("double")
    return rows.agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))


def accuracy_vs_baseline(rows: DataFrame, baseline: float = BASELINE_ACCURACY, **columns: str) -> DataFrame:
    """``accuracy`` together with its ratio to ``baseline``, which can exceed 1."""
    measured = accuracy(rows, **columns)
    return measured.withColumn("baseline", F.lit(baseline)).withColumn("relative", F.col("accuracy") / baseline)


def accuracy_any(predicted: DataFrame, true_tags: DataFrame) -> DataFrame:
    """``(n, accuracy)`` over posts: a prediction is right if it is one of the post's tags.

    ``predicted`` has ``(Id, tags)``, ``true_tags`` one ``(Id, Tag)`` row per tag. Posts without a true
    tag are not counted.
    """
    checked = true_tags.join(predicted.select("Id", "tags"), "Id")
    per_post = checked.groupBy("Id").agg(F.max((F.col("Tag") == F.col("tags")).cast("double")).alias("hit"))
    return per_post.agg(F.count("*").alias("n"), F.avg("hit").alias("accuracy"))
