"""What training needs of all posts so far, kept as sums to which each batch of new posts adds its own.

The counts of a term in the rows of a tag are whole numbers that add up, so a nightly run reads the new posts alone. A batch
is a folder of sums, and a base has the sums of all batches up to some one; a batch is in the base or beside
it, never both, so no post counts twice whatever is run again. The sums are kept for every tag, as the
vocabulary of a model is chosen when it is made.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.fixed_values import SMOOTHING
from tagwright.functions.rows import filled
from tagwright.functions.text import class_sums
from tagwright.operators.bayes import BayesModel, by_term, model_of
from tagwright.operators.labels import class_list, class_table
from tagwright.plans.model_store import ModelStore
from tagwright.session import delete, exists, fits_broadcast, new_folder, subfolders, temporary, written

SUMS = "term STRING, Tag STRING, df BIGINT, n BIGINT"
MANIFEST = "through BIGINT"


def tag_term_counts(posts: DataFrame, tags: DataFrame) -> DataFrame:
    """``(term, Tag, df, n)``: rows of the tag whose post has the term, and how often it occurs in them.

    One pass over the texts; counts are summed in the tasks before they are shuffled. The null term counts rows. A post
    meets its tags once: they are broadcast while they are small, as texts are large. A list has the distinct tags of one post.
    """
    pairs = filled(tags).groupBy("Id", "Tag").agg(F.count(F.lit(1)).alias("times"))
    listed = pairs.groupBy("Id").agg(F.collect_list(F.struct("Tag", "times")).alias("tags"))
    listed = written(listed, "post-tags")
    tag_bytes = F.aggregate("tags", F.lit(0), lambda total, tag: total + 24 + F.octet_length(tag["Tag"]))
    if fits_broadcast(listed, 64 + F.octet_length(F.col("Id").cast("string")) + tag_bytes):
        listed = F.broadcast(listed)
    labelled = filled(posts.select("Id", "Body")).join(listed, "Id")
    sums = class_sums(labelled, "tags")
    return sums.groupBy("term", F.col("class").alias("Tag")).agg(F.sum("df").alias("df"), F.sum("n").alias("n"))


class TrainingState:
    """Sums below one folder of a file system that the cluster shares. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def through(self) -> int:
        """The last batch in the base, -1 while there is none. A base counts once its manifest row is written."""
        if not exists(self.spark, f"{self.path}/manifest"):
            return -1
        manifest = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest")
        return manifest.agg(F.coalesce(F.max("through"), F.lit(-1))).first()[0]

    def _beside(self, done: int, last: int | None = None) -> list[int]:
        """The batches that the base lacks, up to ``last``."""
        names = [name for name, _ in subfolders(self.spark, f"{self.path}/batches") if name.startswith("batch_id=")]
        batches = sorted(int(name.split("=")[1]) for name in names)
        return [batch for batch in batches if batch > done and (last is None or batch <= last)]

    def add(self, posts: DataFrame, tags: DataFrame, batch_id: int) -> bool:
        """Add the sums of a batch of new posts and all their tags. Adding it again changes nothing.

        A batch that the base already holds is refused, and False is returned.
        """
        if batch_id <= self.through():
            return False
        with temporary(self.spark):
            tag_term_counts(posts, tags).write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")
        return True

    def _sums(self, last: int | None = None) -> DataFrame:
        """The sums of all batches, up to ``last``, one row per term and tag."""
        done = self.through()
        folders = [f"{self.path}/batches/batch_id={batch}" for batch in self._beside(done, last)]
        if done >= 0:
            folders.append(f"{self.path}/base/through={done}")
        if not folders:
            return self.spark.createDataFrame([], SUMS)
        sums = self.spark.read.schema(SUMS).parquet(*folders)
        if len(folders) == 1:
            return sums
        return sums.groupBy("term", "Tag").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))

    def counts(self) -> DataFrame:
        return self._sums()

    def compact(self) -> int | None:
        """Sum all batches but the newest, which a restart may write again, into a new base; its last batch is returned."""
        beside = self._beside(self.through())
        if len(beside) < 2:
            return None
        last = beside[-2]
        self._sums(last).write.mode("overwrite").parquet(f"{self.path}/base/through={last}")
        entry = self.spark.range(1).select(F.lit(last).cast("bigint").alias("through"))
        entry.coalesce(1).write.mode("append").json(f"{self.path}/manifest")
        return last

    def clean(self, older_than: float) -> list[str]:
        """Delete batches in the base and the bases before it, if they were changed over ``older_than`` seconds ago."""
        done, before, gone = self.through(), time.time() - older_than, []
        for kind, last in (("batches", done), ("base", done - 1)):
            for name, changed in subfolders(self.spark, f"{self.path}/{kind}"):
                if "=" in name and int(name.split("=")[1]) <= last and changed < before:
                    delete(self.spark, f"{self.path}/{kind}/{name}")
                    gone.append(f"{kind}/{name}")
        return gone

    def tag_rows(self) -> DataFrame:
        """``(Tag, n)``: the rows of each tag, from which a vocabulary can be chosen."""
        return self.counts().where("term IS NULL").select("Tag", F.col("n"))

    def model(self, vocab: DataFrame, smoothing: float = SMOOTHING) -> BayesModel:
        """The model of all posts so far, the same that a fit on all of them gives. No text is read."""
        classes = class_list(vocab)
        places = class_table([(at, tag) for at, (_, tag) in enumerate(classes)], self.spark, "place INT, Tag STRING")
        chosen = self.counts().join(places, "Tag").select("term", "place", "df", "n")
        return model_of(written(by_term(chosen), "class-terms", new_folder(self.spark, "class-terms")), classes, smoothing)


def retrain(
    state: TrainingState, store: ModelStore, posts: DataFrame, tags: DataFrame, vocab: DataFrame, batch_id: int
) -> int:
    """A nightly run: the new posts are added, a model of all posts is published, and older batches are summed up."""
    state.add(posts, tags, batch_id)
    version = store.publish(state.model(vocab))
    state.compact()
    return version
