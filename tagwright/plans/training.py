"""Training and scoring with MLlib over hashed term slots, whose model has a fixed size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.fixed_values import HASH_SLOTS, MODEL_BYTES, SMOOTHING
from tagwright.functions.rows import filled
from tagwright.operators.labels import class_list, class_rows, class_table, labelled_posts, select_tags, with_class
from tagwright.session import temporary, written


@dataclass(frozen=True)
class HashedModel:
    """A fitted MLlib pipeline, and the (class id, tag) behind each of its predictions 0, 1, 2..."""

    pipeline: PipelineModel
    classes: list[tuple[int, str]]

    def transform(self, posts: DataFrame) -> DataFrame:
        """The posts with all columns of the pipeline; posts without a text go. Works on streams too."""
        return self.pipeline.transform(filled(posts, "Body"))

    def predict(self, posts: DataFrame, confidence: bool = False) -> DataFrame:
        """The posts with their predicted ``tags``, and on request the class's ``confidence``."""
        scored = self.transform(posts)
        tag = F.try_element_at(F.lit([tag for _, tag in self.classes]), F.col("prediction").cast("int") + 1)
        columns = [*posts.columns, tag.alias("tags")]
        if confidence:
            columns.append(F.array_max(vector_to_array("probability")).alias("confidence"))
        return scored.select(*columns)


def train_hashed(
    posts: DataFrame,
    tags: DataFrame,
    vocab: DataFrame,
    slots: int = HASH_SLOTS,
    smoothing: float = SMOOTHING,
) -> HashedModel:
    """Fit tokenizer, hashed term frequency, IDF and Naive Bayes on the (post, tag) rows."""
    classes = class_list(vocab)
    known = class_table(classes, posts.sparkSession)
    with temporary(posts.sparkSession):
        return fit_hashed(labelled_posts(filled(posts.select("Id", "Body")), tags, known), classes, slots, smoothing)


def fit_hashed(
    labelled: DataFrame,
    classes: list[tuple[int, str]],
    slots: int = HASH_SLOTS,
    smoothing: float = SMOOTHING,
    max_bytes: int = MODEL_BYTES,
) -> HashedModel:
    """Fit on posts ``(Body, classes)``, where ``classes`` lists each ``CatId`` with its number of tag rows.

    Texts are hashed once per post, and the fits read the written result. MLlib predicts the
    position of a class among those it saw, so classes are numbered densely over those with training rows.

    The model is dense: a number for each class and slot, on the driver and on every executor. If that takes over
    ``max_bytes``, the fit is refused; the exact model has no such bound.
    """
    with temporary(labelled.sparkSession):
        return _fit_hashed(labelled, classes, slots, smoothing, max_bytes)


def _fit_hashed(
    labelled: DataFrame, classes: list[tuple[int, str]], slots: int, smoothing: float, max_bytes: int
) -> HashedModel:
    tokenizer = Tokenizer(inputCol="Body", outputCol="Words")
    hashing = HashingTF(inputCol="Words", outputCol="Features", numFeatures=slots)
    hashed = hashing.transform(tokenizer.transform(labelled)).select("Features", "classes")
    hashed = written(hashed, "hashed-posts")
    rows = class_rows(hashed, "Features")
    seen = {row["CatId"] for row in rows.groupBy("CatId").count().collect()}
    if not seen:
        raise ValueError("no post has a tag of the vocabulary")
    if len(seen) * slots * 8 > max_bytes:
        raise ValueError(f"a hashed model of {len(seen)} classes and {slots} slots takes over {max_bytes} bytes")
    present = [(cat_id, tag) for cat_id, tag in classes if cat_id in seen]
    place = F.array_position(F.lit([cat_id for cat_id, _ in present]), F.col("CatId")) - 1
    dense = rows.select("Features", place.cast("double").alias("label"))
    idf = IDF(inputCol="Features", outputCol="IDF_features").fit(dense)
    bayes = NaiveBayes(
        smoothing=smoothing, modelType="multinomial", labelCol="label", featuresCol="IDF_features"
    ).fit(idf.transform(dense))
    return HashedModel(PipelineModel([tokenizer, hashing, idf, bayes]), present)


def true_rows(predicted: DataFrame, tags: DataFrame, vocab: DataFrame) -> DataFrame:
    """One row per (post, selected tag) with the true ``CatId`` and the ``prediction`` as class ids."""
    known = class_table(class_list(vocab), tags.sparkSession)
    truth = with_class(filled(tags), known).select("Id", "CatId")
    named = predicted.select("Id", F.col("tags").alias("Tag"))
    return with_class(named, known).select("Id", F.col("CatId").alias("prediction")).join(truth, "Id")


def evaluate(predicted: DataFrame, tags: DataFrame, vocab: DataFrame, baseline: float) -> DataFrame:
    """One row with the accuracy over (post, tag) rows, over posts, and relative to ``baseline``.

    ``predicted`` has ``(Id, tags)`` for held-out posts. Posts are scored once for all measures.
    """
    truth = select_tags(tags, class_table(class_list(vocab), tags.sparkSession))
    hit = (F.col("Tag") == F.col("tags")).cast("int")
    per_post = truth.join(predicted.select("Id", "tags"), "Id").groupBy("Id").agg(
        F.count("*").alias("n"), F.sum(hit).alias("hits")
    )
    right = F.sum("hits") / F.sum("n")
    return per_post.agg(
        F.sum("n").alias("n_rows"),
        right.alias("accuracy"),
        (right / baseline).alias("relative"),
        F.count("*").alias("n_posts"),
        F.avg((F.col("hits") > 0).cast("double")).alias("accuracy_any"),
    )
