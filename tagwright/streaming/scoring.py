"""Tag the posts of a stream."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tagwright.fixed_values import BROADCAST_BYTES, REFRESH_SECONDS, TRIGGER
from tagwright.functions.rows import filled
from tagwright.operators.bayes import BayesModel
from tagwright.plans.model_store import ModelStore
from tagwright.plans.training import HashedModel
from tagwright.session import fits_broadcast, temporary, written
from tagwright.sources.messages import write_tagged
from tagwright.sources.payload import with_reasons


def trigger(writer: DataStreamWriter, once: bool = False) -> DataStreamWriter:
    """Run every few seconds, or with ``once`` over what is there and then stop."""
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)


# Rows of a batch whose classes are listed together, as bits of their numbers.
RUN_BITS = 14
# The frequent terms of the models in use, held by the executors from batch to batch.
_IN_PLACE: dict[int, tuple[BayesModel, DataFrame]] = {}


def frequent_terms(model: BayesModel) -> DataFrame:
    """The frequent terms of ``model``, read once and then held for the next batches; of one model at a time."""
    if id(model) not in _IN_PLACE:
        for _, old in _IN_PLACE.values():
            old.unpersist()
        _IN_PLACE.clear()
        _IN_PLACE[id(model)] = model, model.kept_in_place().persist()
    return _IN_PLACE[id(model)][1]


def tag_posts(model: HashedModel | BayesModel, posts: DataFrame) -> DataFrame:
    """The posts of a batch with their predicted ``tags``. An id may come again with another text.

    For an exact model the rows are written with a number, and the places of their classes joined back by it, listed for
    runs of rows: texts are neither shuffled nor sorted while the lists, a few bytes a post, are small enough to be broadcast.
    Of a term table too large for that, the frequent terms stay in place between batches and the others are read from the
    buckets that they fall into; the texts are split once, and the tokens of other terms written packed.
    """
    if isinstance(model, HashedModel):
        return model.predict(posts)
    numbered = filled(posts, "Id", "Body").withColumn("_row", F.monotonically_increasing_id())
    texts = written(numbered, "batch")
    rows = model.rows_of(texts.select(F.col("_row").alias("Id"), "Body"), "Id")
    if model.terms.n_bytes <= BROADCAST_BYTES:
        scores = model.scores_of(rows)
    elif model.slots:
        # terms are looked up, attached in place and attached by shuffle: three reads
        rows = written(rows, "batch-terms")
        scores = model.only_of(rows, frequent_terms(model)).scores_of(rows)
    else:
        scores = model.looked_up(rows, frequent_terms(model))
    chosen = model.chosen(scores).select(F.col("Id").alias("_row"), "place")
    run = lambda row: F.shiftright(row, RUN_BITS).alias("_run")
    # rows are numbered without gaps in each partition, whose numbers begin with a new run
    ordered = F.array_sort(F.collect_list(F.struct("_row", "place")))
    number = "smallint" if max(model.places) < 1 << 15 else "int"
    places = F.transform(ordered, lambda row: row["place"].cast(number)).alias("places")
    listed = written(chosen.groupBy(run("_row")).agg(places), "batch-tags")
    if fits_broadcast(listed, 64 + (2 if number == "smallint" else 4) * F.size("places")):
        listed = F.broadcast(listed)
    place = F.get("places", F.col("_row").bitwiseAND((1 << RUN_BITS) - 1).cast("int")).cast("int")
    placed = texts.withColumn("_run", run("_row")).join(listed, "_run").select(*posts.columns, place.alias("_place"))
    tags = model.classes().select(F.col("place").alias("_place"), F.col("tags").alias("_tag"))
    return placed.join(tags, "_place").select(*posts.columns, F.col("_tag").alias("tags"))


class ModelFeed:
    """The newest published model, looked for at most once every ``refresh_seconds``."""

    def __init__(self, store: ModelStore, refresh_seconds: float = REFRESH_SECONDS):
        self.store = store
        self.refresh_seconds = refresh_seconds
        self.version: int | None = None
        self.model: HashedModel | BayesModel | None = None
        self.checked = float("-inf")

    def current(self) -> HashedModel | BayesModel:
        if time.monotonic() - self.checked >= self.refresh_seconds:
            newest = self.store.latest()
            if newest != self.version or self.model is None:
                self.model, self.version = self.store.load(newest), newest
            self.checked = time.monotonic()
        return self.model


def score_batches(
    posts: DataFrame,
    model: Callable[[], HashedModel | BayesModel],
    write: Callable[[DataFrame, int], None],
) -> DataStreamWriter:
    """A writer that tags each batch with the model of the moment and hands it to ``write``.

    ``write`` gets the batch id, so that it can overwrite what an interrupted run left of the batch.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            with temporary(batch.sparkSession):
                write(tag_posts(model(), batch), batch_id)

    return posts.writeStream.foreachBatch(score)


def score_messages(
    messages: DataFrame,
    model: Callable[[], HashedModel | BayesModel],
    write: Callable[[DataFrame, int], None],
    write_rejected: Callable[[DataFrame, int], None],
) -> DataStreamWriter:
    """As ``score_batches``, from undecoded messages: those that cannot be tagged go to ``write_rejected``.

    Rejected rows are ``(value, reason)``; every message is either tagged or rejected.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        with temporary(batch.sparkSession):
            fates = written(with_reasons(batch), "messages")
            write_rejected(fates.where("reason IS NOT NULL").select("value", "reason"), batch_id)
            write(tag_posts(model(), fates.where("reason IS NULL").drop("value", "reason")), batch_id)

    return messages.writeStream.foreachBatch(score)


def reject_folders(path: str) -> Callable[[DataFrame, int], None]:
    """Write the rejected messages of each batch into its own folder below ``path``."""

    def write(rejected: DataFrame, batch_id: int) -> None:
        rejected.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def batch_folders(path: str, sink: str = "text") -> Callable[[DataFrame, int], None]:
    """Write each batch as messages into its own folder below ``path``."""

    def write(tagged: DataFrame, batch_id: int) -> None:
        write_tagged(tagged, sink, {"path": f"{path}/batch_id={batch_id}"})

    return write


def appended(path: str, sink: str = "text") -> Callable[[DataFrame, int], None]:
    """Append each batch to the messages in ``path``, as a topic does; a repeated batch is told by its messages' identities."""

    def write(tagged: DataFrame, batch_id: int) -> None:
        write_tagged(tagged, sink, {"path": path}, batch_id, mode="append")

    return write
