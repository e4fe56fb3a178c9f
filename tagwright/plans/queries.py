"""Each operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tagwright import schemas
from tagwright.fixed_values import BASELINE_ACCURACY
from tagwright.functions.keys import in_training, key_part
from tagwright.operators import bayes, evaluation, keyed, labels, terms
from tagwright.plans import relations as given
from tagwright.plans.model_store import ModelStore
from tagwright.plans.training import HashedModel, evaluate, train_hashed, true_rows
from tagwright.plans.training_state import TrainingState
from tagwright.session import new_folder, spread, temporary
from tagwright.sources import files, messages, payload, tables
from tagwright.streaming.levels import LeveledTable
from tagwright.streaming.scoring import (
    ModelFeed,
    appended,
    batch_folders,
    reject_folders,
    score_batches,
    score_messages,
    trigger,
)
from tagwright.streaming.upsert import KeyedTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Compressed messages that a stream takes at once, besides the file that goes beyond it: what a batch writes for a while is bounded.
BATCH_BYTES = 512 << 20
SCORE_DIGITS = 4
WEIGHT_DIGITS = 6


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def rounded(name: str, digits: int = WEIGHT_DIGITS):
    return F.round(F.col(name), digits).alias(name)


# Scans and sources


@query
def posts_scan(spark, sf_dir):
    return given.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("Id"), F.col("text").alias("Body"))


@query
def json_posts(spark, sf_dir):
    """Posts written as JSON lines and read with the fixed schema."""
    path = new_folder(spark, "posts")
    given.full_posts(spark, sf_dir).write.json(path)
    return files.read_posts(spark, path).where(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)


@query
def csv_tags(spark, sf_dir):
    """Tags written as CSV and read with the fixed schema."""
    path = new_folder(spark, "tags")
    given.tags(spark, sf_dir).write.option("header", True).csv(path)
    return files.read_tags(spark, path)


@query
def csv_label_vocab(spark, sf_dir):
    """The vocabulary written as one column and numbered when read."""
    path = new_folder(spark, "labels")
    # One partition holds the few labels in order.
    given.vocab(spark, sf_dir, given.TOP_TAGS).coalesce(1).sortWithinPartitions("catId").select("Tag").write.csv(path)
    return files.read_label_vocab(spark, path)


@query
def decode_posts(spark, sf_dir):
    return payload.decode_posts(given.messages(spark, sf_dir)).select("Id", "Title", "Body", "OwnerUserId")


@query
def rejected_posts(spark, sf_dir):
    return payload.rejected_posts(given.messages(spark, sf_dir))


@query
def normalize_submissions(spark, sf_dir):
    arrival = F.lit("2024-01-01T10:20:30Z").cast("timestamp")
    return payload.normalize_submissions(given.submissions(spark, sf_dir), arrival)


# Tags and labels


@query
def post_tags(spark, sf_dir):
    return given.tags(spark, sf_dir)


@query
def tag_counts(spark, sf_dir):
    return labels.tag_counts(given.tags(spark, sf_dir))


@query
def label_vocab(spark, sf_dir):
    return labels.label_vocab(given.tags(spark, sf_dir), given.TOP_TAGS)


@query
def select_tags(spark, sf_dir):
    return labels.select_tags(given.tags(spark, sf_dir), given.vocab(spark, sf_dir, given.TOP_TAGS))


@query
def training_rows(spark, sf_dir):
    return labels.training_rows(given.tags(spark, sf_dir), given.posts(spark, sf_dir), given.vocab(spark, sf_dir))


@query
def labeled_rows(spark, sf_dir):
    vocab = given.vocab(spark, sf_dir)
    return labels.with_class(labels.select_tags(given.tags(spark, sf_dir), vocab), vocab)


@query
def tag_sets(spark, sf_dir):
    return labels.tag_sets(given.tags(spark, sf_dir)).select("Id", F.array_join("tags", ",").alias("tags"))


@query
def split_by_key(spark, sf_dir):
    ids = given.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("Id"))
    return ids.select("Id", in_training(F.col("Id")).alias("in_training"))


@query
def split_parts(spark, sf_dir):
    """Three parts at once, of shares that are no tenths."""
    ids = given.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("Id"))
    return ids.select("Id", key_part(F.col("Id"), [0.75, 0.04]).alias("part"))


@query
def preview_posts(spark, sf_dir):
    """The first four posts by id."""
    return posts_scan(spark, sf_dir).orderBy("Id").limit(4)


# Text


@query
def tokenize(spark, sf_dir):
    split = terms.tokenize(given.posts(spark, sf_dir))
    n_words = F.size("Words").cast("bigint")
    return split.select("Id", n_words.alias("n_words"), F.array_join("Words", " ").alias("words"))


@query
def term_frequency(spark, sf_dir):
    return terms.term_frequency(given.posts(spark, sf_dir))


@query
def document_frequency(spark, sf_dir):
    return terms.document_frequency(given.posts(spark, sf_dir)).where("term IS NOT NULL")


@query
def idf(spark, sf_dir):
    fitted = terms.inverse_document_frequency(given.posts(spark, sf_dir))
    return fitted.rows.select("term", "df", rounded("idf"))


@query
def tfidf(spark, sf_dir):
    posts = given.posts(spark, sf_dir)
    weighted = terms.tf_idf(posts, terms.inverse_document_frequency(posts))
    return weighted.select("Id", "term", rounded("weight"))


@query
def hashing_tf(spark, sf_dir):
    hashed = terms.hashed_features(given.posts(spark, sf_dir))
    entries = terms.vector_entries(hashed, "Features", "Id")
    return entries.select("Id", "slot", F.col("value").cast("bigint").alias("tf"))


# Models


def tags_and_vocab(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return given.tags(spark, sf_dir), given.vocab(spark, sf_dir)


def fit_exact(spark, sf_dir) -> tuple[bayes.BayesModel, DataFrame, DataFrame, DataFrame]:
    """A model of the training posts, the held-out posts, and all tags with the vocabulary."""
    training, held_out = labels.split_by_key(given.posts(spark, sf_dir))
    tags, vocab = tags_and_vocab(spark, sf_dir)
    return bayes.fit_bayes(training, tags, vocab), held_out, tags, vocab


def fit_hashed(spark, sf_dir) -> tuple[HashedModel, DataFrame, DataFrame, DataFrame]:
    training, held_out = labels.split_by_key(given.posts(spark, sf_dir))
    tags, vocab = tags_and_vocab(spark, sf_dir)
    return train_hashed(training, tags, vocab), held_out, tags, vocab


@query
def class_prior(spark, sf_dir):
    training, _ = labels.split_by_key(given.posts(spark, sf_dir))
    priors = bayes.class_priors(training, *tags_and_vocab(spark, sf_dir))
    return priors.select("CatId", "Tag", "n_rows", rounded("log_prior"))


@query
def class_term_weight(spark, sf_dir):
    model, *_ = fit_exact(spark, sf_dir)
    return model.log_likelihoods().select("CatId", "term", rounded("weight", SCORE_DIGITS), rounded("log_likelihood"))


@query
def class_term_weight_added(spark, sf_dir):
    """The weights of a model whose training posts came in three batches, the sums of the first two put together."""
    training, _ = labels.split_by_key(given.posts(spark, sf_dir))
    tags, vocab = tags_and_vocab(spark, sf_dir)
    state = TrainingState(spark, new_folder(spark, "training"))
    batch = F.pmod(F.xxhash64("Id"), F.lit(3))
    for batch_id in range(3):
        ids = tags.where(batch == batch_id)
        state.add(training.where(batch == batch_id), ids, batch_id)
    state.compact()
    likelihoods = state.model(vocab).log_likelihoods()
    return likelihoods.select("CatId", "term", rounded("weight", SCORE_DIGITS), rounded("log_likelihood"))


@query
def nb_scores(spark, sf_dir):
    model, held_out, *_ = fit_exact(spark, sf_dir)
    return model.score_rows(held_out).select("Id", "CatId", "tags", rounded("score", SCORE_DIGITS))


@query
def class_posterior(spark, sf_dir):
    model, held_out, *_ = fit_exact(spark, sf_dir)
    return model.score_rows(held_out).select("Id", "CatId", rounded("probability"))


@query
def predict_class(spark, sf_dir):
    model, held_out, *_ = fit_exact(spark, sf_dir)
    return model.predict(held_out).select("Id", "CatId", rounded("confidence"))


@query
def predicted_tag(spark, sf_dir):
    model, held_out, _, vocab = fit_exact(spark, sf_dir)
    predicted = model.predict(held_out).select("Id", "CatId")
    return labels.with_tag(predicted, vocab).select("Id", "tags")


@query
def nb_predict(spark, sf_dir):
    model, held_out, *_ = fit_hashed(spark, sf_dir)
    return model.predict(held_out).select("Id", "tags")


@query
def nb_predict_sparse(spark, sf_dir):
    """The tags of the hashed model, fitted over the seen pairs of slot and class only."""
    training, held_out = labels.split_by_key(given.posts(spark, sf_dir))
    model = bayes.fit_slots(training, *tags_and_vocab(spark, sf_dir))
    return model.predict(held_out).select("Id", "tags", rounded("confidence"))


@query
def nb_confidence(spark, sf_dir):
    model, held_out, *_ = fit_hashed(spark, sf_dir)
    return model.predict(held_out, confidence=True).select("Id", "tags", rounded("confidence"))


# Evaluation


def exact_rows(spark, sf_dir) -> DataFrame:
    model, held_out, tags, vocab = fit_exact(spark, sf_dir)
    return true_rows(model.predict(held_out), tags, vocab)


@query
def accuracy(spark, sf_dir):
    return evaluation.accuracy(exact_rows(spark, sf_dir)).select("n", rounded("accuracy"))


@query
def accuracy_vs_baseline(spark, sf_dir):
    measured = evaluation.accuracy_vs_baseline(exact_rows(spark, sf_dir))
    return measured.select("n", rounded("accuracy"), "baseline", rounded("relative"))


@query
def accuracy_any(spark, sf_dir):
    model, held_out, tags, vocab = fit_exact(spark, sf_dir)
    truth = labels.select_tags(tags, vocab)
    return evaluation.accuracy_any(model.predict(held_out), truth).select("n", rounded("accuracy"))


@query
def train_summary(spark, sf_dir):
    """Train, save, load and evaluate on held-out posts, with hashed terms."""
    fitted, held_out, tags, vocab = fit_hashed(spark, sf_dir)
    store = ModelStore(spark, new_folder(spark, "models"))
    version = store.publish(fitted)
    model = store.load(version)
    summary = evaluate(model.predict(held_out), tags, vocab, BASELINE_ACCURACY)
    return summary.select(
        F.lit(version).alias("version"),
        F.lit(len(model.classes)).alias("n_classes"),
        "n_rows",
        rounded("accuracy"),
        rounded("relative"),
        "n_posts",
        rounded("accuracy_any"),
    )


# Keyed tables and sinks


@query
def tagged_json(spark, sf_dir):
    tagged = given.full_posts(spark, sf_dir).select("Id", "Title", "Body", F.col("OwnerUserId").alias("tags"))
    return payload.encode(tagged)


@query
def tagged_sink(spark, sf_dir):
    """Tagged posts written as messages and read by a second reader."""
    path = new_folder(spark, "tagged")
    tagged = given.full_posts(spark, sf_dir).withColumn("tags", F.col("OwnerUserId"))
    messages.write_tagged(tagged, "text", {"path": path})
    return messages.read_tagged(spark, path).select("Id", "Title", "Body", "tags")


@query
def stored_table(spark, sf_dir):
    """Tagged posts inserted into a catalog table of the stored layout."""
    folder = new_folder(spark, "db")
    name = tables.ensure_table(spark, folder.rsplit("/", 1)[1].replace("-", "_"), "posts", location=folder)
    tagged = given.full_posts(spark, sf_dir).withColumn("tags", F.col("OwnerUserId"))
    keyed.stored_layout(tagged).write.insertInto(name)
    return spark.table(name).select("Id", "Title", "Score", "tag")


@query
def latest_post(spark, sf_dir):
    updates = keyed.stored_layout(given.post_updates(spark, sf_dir), "turn")
    return keyed.latest_by_key(updates, "Id", ["turn"])


@query
def merged_post(spark, sf_dir):
    updates = keyed.stored_layout(given.post_updates(spark, sf_dir), "turn")
    return keyed.merge_fields(updates, "Id", ["turn"])


@query
def lookup_tag(spark, sf_dir):
    """The stored tag of every post that a user id in the events asks for."""
    requests = given.table(spark, sf_dir, "events").select(F.col("user_id").alias("Id"))
    return keyed.lookup_tags(given.stored_posts(spark, sf_dir), requests)


# Streams


def json_lines(spark, posts: DataFrame, path: str | None = None) -> str:
    """A folder of posts as messages, for a stream to read."""
    path = path or new_folder(spark, "messages")
    payload.encode(posts).select("value").write.mode("append").options(**messages.TEXT_FILES).text(path)
    return path


def run_to_end(spark, writer, checkpoint: str | None = None) -> None:
    folder = checkpoint or new_folder(spark, "stream")
    started = trigger(writer.option("checkpointLocation", folder), once=True).start()
    started.awaitTermination()


def publish(spark, store: ModelStore, fit: Callable[..., tuple], sf_dir: str) -> int:
    """Publish the model of ``fit``, of which nothing is kept beside the store."""
    with temporary(spark):
        return store.publish(fit(spark, sf_dir)[0])


def stream_tags(spark, fit: Callable[..., tuple], sf_dir: str) -> DataFrame:
    """Publish the model of ``fit``, stream all posts through it, and read the tagged messages."""
    store = ModelStore(spark, new_folder(spark, "models"))
    publish(spark, store, fit, sf_dir)
    posts = given.posts(spark, sf_dir)
    source = messages.post_stream(spark, "text", {"path": json_lines(spark, posts), "maxBytesPerTrigger": str(BATCH_BYTES)})
    sink = new_folder(spark, "tagged")
    run_to_end(spark, score_batches(payload.decode_posts(source), ModelFeed(store).current, batch_folders(sink)))
    return messages.read_tagged(spark, sink).select(F.col("Id").cast("bigint").alias("Id"), "tags")


@query
def score_stream(spark, sf_dir):
    return stream_tags(spark, fit_exact, sf_dir)


class Stopped(RuntimeError):
    """The fault of the recovery queries."""


def stopping_once(write: Callable[[DataFrame, int], None], at: int = 0) -> Callable[[DataFrame, int], None]:
    """``write``, but the first time that batch ``at`` is written it stops then, before the stream commits the batch."""
    stopped = []

    def write_and_stop(rows: DataFrame, batch_id: int) -> None:
        write(rows, batch_id)
        if batch_id == at and not stopped:
            stopped.append(batch_id)
            raise Stopped("between the write and the commit")

    return write_and_stop


def run_and_recover(spark, start: Callable[[], DataStreamWriter]) -> None:
    """Run a stream to its end, starting it again from its checkpoint after a fault."""
    checkpoint = new_folder(spark, "stream")
    try:
        run_to_end(spark, start(), checkpoint)
    except StreamingQueryException as fault:
        if Stopped.__name__ not in str(fault):
            raise
        run_to_end(spark, start(), checkpoint)


def recovered_tags(spark, sf_dir, write: Callable[[DataFrame, int], None]) -> None:
    """All posts tagged by a stream of several batches that stops once after a write and is started again."""
    model, *_ = fit_hashed(spark, sf_dir)
    path = json_lines(spark, given.posts(spark, sf_dir))
    options = {"path": path, "maxFilesPerTrigger": str(spark.sparkContext.defaultParallelism)}
    stopping = stopping_once(write)
    posts = lambda: payload.decode_posts(messages.post_stream(spark, "text", options))
    run_and_recover(spark, lambda: score_batches(posts(), lambda: model, stopping))


@query
def score_stream_recovered(spark, sf_dir):
    """A folder per batch: the batch that ran twice is written over."""
    sink = new_folder(spark, "tagged")
    recovered_tags(spark, sf_dir, batch_folders(sink))
    return messages.read_tagged(spark, sink).select(F.col("Id").cast("bigint").alias("Id"), "tags")


@query
def score_stream_once(spark, sf_dir):
    """A sink that only appends: the batch that ran twice is there twice, and read once by the identities of its messages."""
    sink = new_folder(spark, "tagged")
    recovered_tags(spark, sf_dir, appended(sink))
    return messages.read_once(spark.read.text(sink)).select(F.col("Id").cast("bigint").alias("Id"), "tags")


@query
def upsert_recovered(spark, sf_dir):
    """A keyed table in levels, fed by a stream that stops once after it has written a batch and is started again."""
    updates = given.event_updates(spark, sf_dir)
    path = new_folder(spark, "updates")
    spread(updates, "user_id").write.parquet(path)
    table = LeveledTable(spark, new_folder(spark, "levels"), updates.schema, "user_id", ["ts", "event_id"], buckets=8)
    stopping = stopping_once(table.write_batch)
    reader = spark.readStream.schema(updates.schema).option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism)
    run_and_recover(spark, lambda: reader.parquet(path).writeStream.foreachBatch(stopping))
    table.compact()
    return table.read()


@query
def score_stream_hashed(spark, sf_dir):
    return stream_tags(spark, fit_hashed, sf_dir)


@query
def score_stream_refresh(spark, sf_dir):
    """A hashed model tags the training posts; an exact one, published while the stream rests, tags the held-out ones."""
    store = ModelStore(spark, new_folder(spark, "models"))
    feed = ModelFeed(store, refresh_seconds=0)
    sink, path, state = [new_folder(spark, purpose) for purpose in ("tagged", "messages", "stream")]
    for fit, posts in zip((fit_hashed, fit_exact), labels.split_by_key(given.posts(spark, sf_dir))):
        publish(spark, store, fit, sf_dir)
        options = {"path": json_lines(spark, posts, path), "maxBytesPerTrigger": str(BATCH_BYTES)}
        source = messages.post_stream(spark, "text", options)
        run_to_end(spark, score_batches(payload.decode_posts(source), feed.current, batch_folders(sink)), state)
    return messages.read_tagged(spark, sink).select(F.col("Id").cast("bigint").alias("Id"), "tags")


@query
def stream_fates(spark, sf_dir):
    """Each message of a stream, tagged or rejected with a reason."""
    model, *_ = fit_hashed(spark, sf_dir)
    path, tagged, rejected = [new_folder(spark, purpose) for purpose in ("messages", "tagged", "rejected")]
    given.messages(spark, sf_dir).write.parquet(path)
    source = spark.readStream.schema("value STRING").parquet(path)
    run_to_end(spark, score_messages(source, lambda: model, batch_folders(tagged), reject_folders(rejected)))
    good = messages.read_tagged(spark, tagged).where("tags IS NOT NULL").select("Id", "Body")
    bad = spark.read.schema("value STRING, reason STRING").parquet(rejected)
    return good.unionByName(
        bad.select(F.col("value").alias("rejected"), "reason"), allowMissingColumns=True
    )


@query
def score_stream_plan(spark, sf_dir):
    """A fixed model inside the plan of the stream, without a batch function."""
    model, *_ = fit_hashed(spark, sf_dir)
    source = messages.post_stream(spark, "text", {"path": json_lines(spark, given.posts(spark, sf_dir))})
    sink = new_folder(spark, "tagged")
    tagged = model.predict(payload.decode_posts(source))
    run_to_end(spark, messages.tagged_writer(tagged, "text", {"path": sink}))
    return messages.read_tagged(spark, sink).select(F.col("Id").cast("bigint").alias("Id"), "tags")


def keyed_stream(spark, updates: DataFrame, key: str, order: list[str], merge: bool) -> DataFrame:
    """Feed ``updates`` to a keyed table as a stream of files, compact it, and read it."""
    path = new_folder(spark, "updates")
    spread(updates, key).write.parquet(path)
    at_once = spark.sparkContext.defaultParallelism
    stream = spark.readStream.schema(updates.schema).option("maxFilesPerTrigger", at_once).parquet(path)
    table = KeyedTable(spark, new_folder(spark, "table"), updates.schema, key, order, merge)
    run_to_end(spark, table.upsert(stream))
    table.compact()
    return table.read()


@query
def upsert_stream(spark, sf_dir):
    return keyed_stream(spark, given.event_updates(spark, sf_dir), "user_id", ["ts", "event_id"], merge=False)


@query
def upsert_replay(spark, sf_dir):
    """Two batches in any order of time, each written again: the first after the second, the second after a snapshot."""
    updates = given.event_updates(spark, sf_dir)
    table = KeyedTable(spark, new_folder(spark, "table"), updates.schema, "user_id", ["ts", "event_id"])
    batches = labels.split_by_key(updates, "event_id")
    for batch_id in (0, 1, 0):
        table.write_batch(batches[batch_id], batch_id)
    table.compact()
    table.write_batch(batches[1], 1)
    return table.read()


@query
def message_fates(spark, sf_dir):
    """Every message with the reason why it cannot be tagged, null for those that can."""
    fates = payload.with_reasons(given.messages(spark, sf_dir))
    return fates.select("Id", "Body", F.when(F.col("reason").isNotNull(), F.col("value")).alias("rejected"), "reason")


@query
def upsert_ties(spark, sf_dir):
    """Posts whose dates all tie, written in two batches, of which each has several writes of a post: the last stays."""
    updates = given.post_updates(spark, sf_dir)
    stored = keyed.stored_layout(updates, "turn")
    table = KeyedTable(spark, new_folder(spark, "table"), schemas.STORED_POST, "Id", ["CreationDate"])
    early = F.col("turn") < 2
    for batch_id, batch in enumerate((stored.where(early), stored.where(~early))):
        # as a topic gives them: a post in one partition, in order
        table.write_batch(batch.repartition("Id").sortWithinPartitions("turn").drop("turn"), batch_id)
    return table.read()


@query
def merge_stream(spark, sf_dir):
    return keyed_stream(spark, given.event_updates(spark, sf_dir), "user_id", ["ts", "event_id"], merge=True)


def leveled_table(spark, updates: DataFrame, key: str, order: list[str], merge: bool = False) -> LeveledTable:
    """A table fed by five batches and compacted after three of them; the last two batches touch half of the buckets.

    The levels are small, so that they fill up and are merged at any number of rows.
    """
    table = LeveledTable(
        spark, new_folder(spark, "levels"), updates.schema, key, order, merge, buckets=8, fanout=4, level_rows=64
    )
    low = table.bucket_of(F.col(key)) < 4
    place = F.pmod(F.xxhash64(*order), F.lit(3)).cast("int")
    numbered = updates.withColumn("_batch", F.when(low, place).otherwise(F.lit(3) + place % 2))
    for batch_id in range(5):
        table.write_batch(numbered.where(F.col("_batch") == batch_id).drop("_batch"), batch_id)
        if batch_id != 2:
            table.compact()
    return table


@query
def upsert_levels(spark, sf_dir):
    return leveled_table(spark, given.event_updates(spark, sf_dir), "user_id", ["ts", "event_id"]).read()


@query
def merge_levels(spark, sf_dir):
    return leveled_table(spark, given.event_updates(spark, sf_dir), "user_id", ["ts", "event_id"], merge=True).read()


def stored_in_levels(spark, sf_dir) -> LeveledTable:
    """The stored posts; each was stored without a tag before."""
    posts = given.stored_posts(spark, sf_dir)
    twice = posts.withColumn("seq", F.lit(1)).unionByName(posts.select("Id", F.lit(None).cast("string").alias("tag"), F.lit(0).alias("seq")))
    return leveled_table(spark, twice, "Id", ["seq"])


@query
def lookup_in_levels(spark, sf_dir):
    """The stored tag of every post that a user id in the events asks for, from the buckets that hold them."""
    requests = given.table(spark, sf_dir, "events").select(F.col("user_id").alias("Id"))
    return stored_in_levels(spark, sf_dir).lookup(requests).select("Id", "tag")


@query
def lookup_newest_user(spark, sf_dir):
    """The stored tag of the one post that the newest event asks for, by its id alone."""
    newest = given.table(spark, sf_dir, "events").orderBy(F.desc("ts"), F.desc("event_id")).select("user_id").first()
    return stored_in_levels(spark, sf_dir).get(newest["user_id"] if newest else None).select("Id", "tag")
