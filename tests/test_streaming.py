import random

import pytest
from pyspark.sql import functions as F

from tagwright import session
from tagwright.operators import bayes, keyed, labels
from tagwright.plans.model_store import ModelStore
from tagwright.plans.training import train_hashed
from tagwright.schemas import STORED_POST, TAGGED_POST
from tagwright.sources import messages, payload
from tagwright.streaming.scoring import (
    ModelFeed,
    batch_folders,
    reject_folders,
    score_batches,
    score_messages,
    tag_posts,
    trigger,
)
from tagwright.streaming.upsert import KeyedTable

POSTS = [(str(n), text) for n, text in enumerate(["red apple", "red rose", "blue sky", "blue sea"])]
SWAPPED = [("0", "b"), ("1", "b"), ("2", "r"), ("3", "r")]
TAGS = [("0", "r"), ("1", "r"), ("2", "b"), ("3", "b")]
CLASSES = [(0, "r"), (1, "b")]


def fit(spark, tags, exact=False):
    posts = spark.createDataFrame(POSTS, "Id STRING, Body STRING")
    rows = spark.createDataFrame(tags, "Id STRING, Tag STRING")
    return (bayes.fit_bayes if exact else train_hashed)(posts, rows, labels.class_table(CLASSES, spark))


def run(writer, tmp_path):
    query = trigger(writer.option("checkpointLocation", str(tmp_path / "checkpoint")), once=True).start()
    query.awaitTermination()


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def lines_of(ids):
    return [f'{{"Id":"{post}","Body":"{text}"}}' for post, text in POSTS if post in ids]


def stream(spark, folder, **options):
    return payload.decode_posts(messages.post_stream(spark, "text", {"path": str(folder), **options}))


def tagged(spark, folder):
    return sorted((row["Id"], row["tags"]) for row in messages.read_tagged(spark, str(folder)).collect())


@pytest.mark.parametrize("exact", [False, True])
def test_stream_equals_batch_and_skips_bad_messages(spark, tmp_path, exact):
    model = fit(spark, TAGS, exact)
    for name, ids in (("a", "0"), ("b", "12"), ("c", "3")):
        put(tmp_path / "in", name, lines_of(ids) + ["nope", '{"Id":"77"}'])
    sink = tmp_path / "out"
    posts = stream(spark, tmp_path / "in", maxFilesPerTrigger="1")
    run(score_batches(posts, lambda: model, batch_folders(str(sink))), tmp_path)
    batch = tag_posts(model, spark.createDataFrame(POSTS, "Id STRING, Body STRING")).select("Id", "tags").collect()
    assert tagged(spark, sink) == sorted(map(tuple, batch)) == TAGS
    assert len(list(sink.glob("batch_id=*"))) == 3


@pytest.mark.parametrize("exact", [False, True])
def test_id_that_comes_again_in_a_batch(spark, exact):
    rows = [("7", "red apple"), ("7", "blue sky"), ("7", "blue sky"), ("8", None)]
    tagged_rows = tag_posts(fit(spark, TAGS, exact), spark.createDataFrame(rows, "Id STRING, Body STRING")).collect()
    assert sorted((row["Body"], row["tags"]) for row in tagged_rows) == [
        ("blue sky", "b"), ("blue sky", "b"), ("red apple", "r")
    ]


def test_plain_sink(spark, tmp_path):
    put(tmp_path / "in", "a", lines_of("0123"))
    rows = fit(spark, TAGS).predict(stream(spark, tmp_path / "in"))
    run(messages.tagged_writer(rows, "text", {"path": str(tmp_path / "out")}), tmp_path)
    assert tagged(spark, tmp_path / "out") == TAGS


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    model = fit(spark, TAGS)
    for name, ids in (("a", "01"), ("b", "23")):
        put(tmp_path / "in", name, lines_of(ids))
        run(score_batches(stream(spark, tmp_path / "in"), lambda: model, batch_folders(str(tmp_path / "out"))), tmp_path)
    assert tagged(spark, tmp_path / "out") == TAGS


def test_batch_run_again_leaves_one_copy(spark, tmp_path):
    """The commit of the last batch is missing, as after a crash, so a restart runs it again."""
    model = fit(spark, TAGS)
    put(tmp_path / "in", "a", lines_of("0123"))
    for _ in range(2):
        run(score_batches(stream(spark, tmp_path / "in"), lambda: model, batch_folders(str(tmp_path / "out"))), tmp_path)
        for commit in (tmp_path / "checkpoint" / "commits").iterdir():
            commit.unlink()
    assert tagged(spark, tmp_path / "out") == TAGS


def test_model_is_swapped_between_batches(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    store.publish(fit(spark, TAGS))
    swapped = fit(spark, SWAPPED)
    for name in ("a", "b"):
        put(tmp_path / "in", name, lines_of("0123"))
    keep = batch_folders(str(tmp_path / "out"))

    def write(rows, batch_id):
        keep(rows, batch_id)
        if batch_id == 0:
            store.publish(swapped)

    feed = ModelFeed(store, refresh_seconds=0)
    run(score_batches(stream(spark, tmp_path / "in", maxFilesPerTrigger="1"), feed.current, write), tmp_path)
    assert tagged(spark, tmp_path / "out" / "batch_id=0") == TAGS
    assert tagged(spark, tmp_path / "out" / "batch_id=1") == SWAPPED
    assert feed.version == 2


def test_feed_looks_only_after_the_interval(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    store.publish(fit(spark, TAGS))
    feed = ModelFeed(store)
    first = feed.current()
    store.publish(fit(spark, SWAPPED))
    assert feed.current() is first and feed.version == 1


SCHEMA = "Id STRING, Title STRING, tag STRING, seq BIGINT"


def random_updates(n=300):
    source = random.Random(3)
    return [
        (
            "hot" if at % 3 == 0 else str(source.randrange(20)),
            source.choice([None, f"t{at}"]),
            source.choice([None, f"x{at}"]),
            at,
        )
        for at in range(n)
    ]


def keyed_table(spark, tmp_path, merge):
    schema = spark.createDataFrame([], SCHEMA).schema
    return KeyedTable(spark, str(tmp_path / f"table-{merge}"), schema, "Id", ["seq"], merge)


@pytest.mark.parametrize("merge, few_keys", [(False, True), (True, True), (True, False)])
def test_batches_in_any_order_with_compaction(spark, tmp_path, monkeypatch, merge, few_keys):
    """Batches out of order, one written twice, and snapshots in between: the result is the batch operator's."""
    if not few_keys:
        monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    rows = random_updates()
    table = keyed_table(spark, tmp_path, merge)
    assert table.read().count() == 0 and table.compact() is None
    chunks = [rows[at::5] for at in (3, 0, 4, 1, 2)]
    for batch_id, chunk in enumerate(chunks):
        table.write_batch(spark.createDataFrame(chunk, SCHEMA), batch_id)
        if batch_id == 2:
            assert table.compact() == 1 and table.snapshot() == 1
    table.write_batch(spark.createDataFrame(chunks[-1], SCHEMA), 4)
    whole = spark.createDataFrame(rows, SCHEMA)
    expected = (keyed.merge_fields if merge else keyed.latest_by_key)(whole, "Id", ["seq"])
    assert sorted(table.read().collect(), key=str) == sorted(expected.collect(), key=str)
    assert table.compact() == 3 and table.compact() is None
    assert sorted(table.read().collect(), key=str) == sorted(expected.collect(), key=str)


def test_clean_removes_what_a_snapshot_covers(spark, tmp_path):
    table = keyed_table(spark, tmp_path, False)
    for batch_id in range(4):
        table.write_batch(spark.createDataFrame([(str(batch_id), "t", None, 1)], SCHEMA), batch_id)
        if batch_id:
            table.compact()
    before = sorted(table.read().collect())
    reading = table.read()
    assert table.clean(older_than=3600) == [] and sorted(reading.collect()) == before
    assert sorted(table.clean(older_than=-60)) == [
        "log/batch_id=0", "log/batch_id=1", "log/batch_id=2", "snapshot/through=0", "snapshot/through=1"
    ]
    assert sorted(table.read().collect()) == before and len(before) == 4


def test_texts_stay_in_place(spark):
    """Neither the scores nor the tagged batch shuffle or sort the texts."""
    rows = tag_posts(fit(spark, TAGS, exact=True), spark.createDataFrame(POSTS, "Id STRING, Body STRING"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Sort" not in plan


def test_terms_looked_up_for_the_batch(spark, monkeypatch):
    from tagwright.streaming import scoring

    monkeypatch.setattr(scoring, "BROADCAST_BYTES", 0)
    rows = tag_posts(fit(spark, TAGS, exact=True), spark.createDataFrame(POSTS, "Id STRING, Body STRING"))
    assert sorted((row["Id"], row["tags"]) for row in rows.collect()) == TAGS


def test_every_message_is_tagged_or_rejected(spark, tmp_path):
    model = fit(spark, TAGS, exact=True)
    put(tmp_path / "in", "a", lines_of("02") + ["nope", '{"Id":"77"}', '{"Body":"sky"}'])
    source = messages.post_stream(spark, "text", {"path": str(tmp_path / "in")})
    bad = tmp_path / "bad"
    run(score_messages(source, lambda: model, batch_folders(str(tmp_path / "out")), reject_folders(str(bad))), tmp_path)
    assert tagged(spark, tmp_path / "out") == [TAGS[0], TAGS[2]]
    reasons = sorted(map(tuple, spark.read.parquet(str(bad)).select("value", "reason").collect()))
    assert reasons == [("nope", "not a JSON object"), ('{"Body":"sky"}', "no Id"), ('{"Id":"77"}', "no Body")]


def test_empty_batch_leaves_nothing(spark, tmp_path):
    table = keyed_table(spark, tmp_path, False)
    table.write_batch(spark.createDataFrame([], SCHEMA), 0)
    assert not (tmp_path / "table-False" / "log").exists()


def test_tagged_stream_into_both_tables(spark, tmp_path):
    """A second reader keeps whole rows, a third merges fields: they differ where a field is absent."""
    put(tmp_path / "in", "a", ['{"Id":"1","Title":"t1","CreationDate":"1"}', '{"Id":"1","tags":"x","CreationDate":"2"}', "bad"])
    source = messages.tagged_post_stream(spark, "text", {"path": str(tmp_path / "in")})
    rows = keyed.stored_layout(source)
    assert source.columns == TAGGED_POST.names
    found = {}
    for merge in (False, True):
        table = KeyedTable(spark, str(tmp_path / f"posts-{merge}"), STORED_POST, "Id", ["CreationDate"], merge)
        run(table.upsert(rows), tmp_path / f"{merge}")
        found[merge] = table.read().select("Id", "Title", "tag").first()
    assert found == {False: ("1", None, "x"), True: ("1", "t1", "x")}


def test_unchanged_keys_are_read_without_a_shuffle(spark, tmp_path):
    table = keyed_table(spark, tmp_path, False)
    for batch_id in range(3):
        table.write_batch(spark.createDataFrame([(str(batch_id), "t", None, 1), ("9", "t", None, batch_id)], SCHEMA), batch_id)
    table.compact()
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    above_the_keys = plan[: plan.index("BroadcastExchange")]
    assert "LeftAnti" in above_the_keys and "Exchange" not in above_the_keys
    assert sorted((row["Id"], row["seq"]) for row in table.read().collect()) == [("0", 1), ("1", 1), ("2", 1), ("9", 2)]


def test_reader_sees_only_filled_log(spark, tmp_path):
    table = keyed_table(spark, tmp_path, False)
    table.write_batch(spark.createDataFrame([("1", "t", None, 1)], SCHEMA), 7)
    assert table.read().select("Id", "Title", "tag", "seq").collect() == [("1", "t", None, 1)]
    assert table.read().where(F.col("Id") == "2").count() == 0


def test_columns_of_the_source_order_writes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    # the file that is named later has the last write, whichever is read first
    (folder / "b.txt").write_text('{"Id":"1","tags":"java"}\nnope\n')
    (folder / "a.txt").write_text('{"Id":"1","tags":"python"}\n{"Id":"2","tags":"c"}\n')
    stream = messages.post_stream(spark, "text", {"path": str(folder)}, keep=("_metadata.file_name",))
    decoded = payload.decode_posts(stream, TAGGED_POST).select("file_name", "Id", "tags")
    assert messages.post_stream(spark, "text", {"path": str(folder)}).columns == ["value"]
    table = KeyedTable(spark, str(tmp_path / "table"), decoded.schema, "Id", ["file_name"])
    query = trigger(table.upsert(decoded).option("checkpointLocation", str(tmp_path / "state")), once=True).start()
    assert query.awaitTermination(60)
    assert sorted((row["Id"], row["tags"]) for row in table.read().collect()) == [("1", "java"), ("2", "c")]


def test_trigger_runs_every_few_seconds(spark, tmp_path):
    """The writer asks for batches ten seconds apart, and holds no frequent terms of an older model."""
    rows = spark.readStream.format("rate").load().writeStream.format("noop")
    started = trigger(rows.option("checkpointLocation", str(tmp_path / "state"))).start()
    try:
        described = started._jsq.sparkSession().streams().get(started.id)
        assert "ProcessingTimeTrigger(10000)" in described.streamingQuery().trigger().toString()
    finally:
        started.stop()
        started.awaitTermination(60)


def test_frequent_terms_stay_between_batches(spark):
    from tagwright.streaming import scoring

    first, second = fit(spark, TAGS, exact=True), fit(spark, SWAPPED, exact=True)
    held = scoring.frequent_terms(first)
    assert scoring.frequent_terms(first) is held and held.is_cached
    assert scoring.frequent_terms(second) is not held and not held.is_cached


def test_texts_of_a_batch_are_split_once(spark, monkeypatch):
    """Of a model beyond the bound for broadcasts the terms are looked up, attached and shuffled, but the texts split once."""
    from tagwright.streaming import scoring

    splits = []
    whole = bayes.term_rows
    monkeypatch.setattr(bayes, "term_rows", lambda *given: splits.append(given) or whole(*given))
    model, posts = fit(spark, TAGS, exact=True), spark.createDataFrame(POSTS, "Id STRING, Body STRING")
    expected = sorted((row["Id"], row["tags"]) for row in tag_posts(model, posts).collect())
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", 0)
    splits.clear()
    found = sorted((row["Id"], row["tags"]) for row in tag_posts(model, posts).collect())
    assert found == expected == TAGS and len(splits) == 1
