import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagwright import session
from tagwright.functions import packed, text
from tagwright.operators import bayes, labels, terms
from tagwright.plans import queries, relations
from tagwright.plans.model_store import ModelStore
from tagwright.session import new_folder, temporary, written
from tagwright.sources import messages
from tagwright.streaming import scoring
from tests.conftest import MIDDLE, SMALL

WORDS = ["", "a", "straße", "日本", "x" * 300, "-", "tab\x00"] + [f"w{at}" for at in range(50)]


def shuffle_files(spark) -> dict[str, int]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(at) for at in range(files.size())]
    return {file.getName(): file.length() for file in found if "shuffle_" in file.getName()}


def added_bytes(spark, before: dict[str, int]) -> int:
    """Of shuffle files that were not there before; older ones may go meanwhile."""
    return sum(size for name, size in shuffle_files(spark).items() if name not in before)


def folder_bytes(spark, path) -> int:
    files, name = session._folder(spark, path)
    return files.getContentSummary(name).getLength()


def test_columns_come_back():
    columns = [np.array([3, 70_000, 0]), np.array([]), np.array([0.5, -1.0]), pa.array(WORDS), pa.array(WORDS).slice(2, 3)]
    columns += [pa.array([], pa.string()), pa.array([""]), np.array([1 << 40])]
    back = packed.unpack(packed.pack(*columns))
    assert [column.tolist() for column in back] == [column.tolist() for column in columns]


def test_buckets_are_those_of_spark(spark):
    rows = spark.createDataFrame([(word,) for word in WORDS], "term STRING")
    theirs = [row["b"] for row in rows.select(terms.term_bucket(F.col("term"), 37).alias("b")).collect()]
    assert packed.buckets_of(pa.array(WORDS), 37).tolist() == theirs


@pytest.mark.parametrize("pairs, buckets", [(1 << 20, 3), (20, 16), (1, 1)])
def test_listed_counts(spark, monkeypatch, pairs, buckets):
    """Counts by term and class, in whatever parts the tasks hand them on; a post without classes adds no term."""
    monkeypatch.setattr(text, "PAIRS", pairs)
    monkeypatch.setattr(text, "BLOCK_BYTES", 64)
    source = random.Random(5)
    posts = [(" ".join(source.choices(WORDS[1:], k=source.randrange(9))), [(place, 1 + place) for place in source.sample(range(9), source.randrange(4))]) for _ in range(60)]
    posts += [("  ", [(2, 1)]), ("", [(2, 1)]), ("nowhere", [])]
    df, n = Counter(), Counter()
    for body, classes in posts:
        found = Counter([] if body and not body.strip(" ") else body.split(" "))
        for place, times in classes:
            for term, tf in [*found.items(), (None, 1)]:
                df[term] += times
                n[term, place] += times * tf
    rows = spark.createDataFrame(posts, "Body STRING, classes ARRAY<STRUCT<CatId:INT,n:BIGINT>>")
    listed = text.class_lists(rows, "classes", buckets).collect()
    assert {row["term"]: row["df"] for row in listed} == dict(df) and len(listed) == len(df)
    assert {(row["term"], seen["place"]): seen["n"] for row in listed for seen in row["seen"]} == dict(n)


@pytest.mark.parametrize("max_bytes, stored", [(0, True), (20_000, True), (20_000, False), (1 << 30, True)])
def test_terms_looked_up_packed(spark, tmp_path, max_bytes, stored):
    """Some or all terms looked up by bucket: every post has the scores that the whole table gives it."""
    training, held = labels.split_by_key(relations.posts(spark, MIDDLE))
    model = bayes.fit_bayes(training, relations.tags(spark, MIDDLE), relations.vocab(spark, MIDDLE))
    held = held.unionByName(spark.createDataFrame([(-1 & (1 << 40), "  "), (1 << 41, "never seen"), (1 << 42, "")], held.schema))
    whole = {row["Id"]: row["scores"] for row in model.scores(held).collect()}
    if stored:
        store = ModelStore(spark, str(tmp_path / "models"), bucket_bytes=1 << 18)
        model = store.load(store.publish(model))
        assert model.terms.buckets > 4
    with temporary(spark):
        rows = model.rows_of(held, "Id")
        found = model.looked_up(rows, model.kept_in_place(max_bytes), max_bytes).collect()
    assert len(found) == len(whole) and {row["Id"] for row in found} == whole.keys()
    for row in found:
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(row["scores"], whole[row["Id"]], strict=True))


def test_shuffles_go_with_what_is_written(spark):
    """Within a temporary block the shuffle files of a step are gone when it is written, and outside nothing changes."""
    numbers = spark.range(50_000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("ids"))
    before = spark.conf.get(session.CLEANUP)
    with temporary(spark):
        held = shuffle_files(spark)
        kept = written(numbers, "numbers")
        assert added_bytes(spark, held) == 0 and kept.count() == 7
    assert spark.conf.get(session.CLEANUP) == before


def test_a_fit_moves_fewer_bytes_than_its_texts(spark):
    """Terms leave a task packed, each once with all its classes."""
    training = written(labels.split_by_key(relations.posts(spark, MIDDLE))[0].coalesce(2), "training")
    counts = bayes.class_term_counts(training, relations.tags(spark, MIDDLE), relations.vocab(spark, MIDDLE))
    held = shuffle_files(spark)
    counts.write.format("noop").mode("overwrite").save()
    n_bytes = training.agg(F.sum(F.octet_length("Body"))).first()[0]
    assert 0 < added_bytes(spark, held) < n_bytes / 2


def test_messages_take_less_than_their_texts(spark):
    posts = relations.posts(spark, SMALL)
    n_bytes = posts.agg(F.sum(F.octet_length("Body"))).first()[0]
    path, sink = queries.json_lines(spark, posts), new_folder(spark, "tagged")
    messages.write_tagged(posts, "text", {"path": sink})
    assert folder_bytes(spark, path) < 0.6 * n_bytes and folder_bytes(spark, sink) < 0.6 * n_bytes
    assert messages.read_tagged(spark, sink).count() == posts.count() == spark.read.text(path).count()


def test_stream_in_bounded_batches(spark, monkeypatch):
    """A stream of many files is tagged in several batches, with a term table beyond the bound, as all posts at once are."""
    expected = sorted(map(tuple, queries.score_stream(spark, SMALL).collect()))
    batches = []
    tag_posts = scoring.tag_posts
    monkeypatch.setattr(scoring, "tag_posts", lambda *given: batches.append(given) or tag_posts(*given))
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(queries, "BATCH_BYTES", 60_000)
    assert sorted(map(tuple, queries.score_stream(spark, SMALL).collect())) == expected
    assert len(batches) > 2 and len(expected) == relations.posts(spark, SMALL).count()


@pytest.mark.parametrize("bits", [1, 14])
def test_classes_of_a_batch_come_back_to_their_rows(spark, monkeypatch, bits):
    """Classes are listed by runs of rows, in partitions of any size, and no text changes places with another."""
    monkeypatch.setattr(scoring, "RUN_BITS", bits)
    posts = [(str(at), None if at % 7 == 3 else f"{'red' if at % 3 else 'blue'} {at}") for at in range(90)]
    fitted = bayes.fit_bayes(
        spark.createDataFrame([("r", "red"), ("b", "blue")], "Id STRING, Body STRING"),
        spark.createDataFrame([("r", "r"), ("b", "b")], "Id STRING, Tag STRING"),
        labels.class_table([(0, "r"), (1, "b")], spark),
    )
    frame = spark.createDataFrame(posts, "Id STRING, Body STRING").repartition(5, "Id")
    found = sorted(map(tuple, scoring.tag_posts(fitted, frame).select("Id", "Body", "tags").collect()))
    assert found == sorted((at, body, body[0]) for at, body in posts if body)
