import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from tagwright import session
from tagwright.operators import bayes, labels
from tagwright.plans import relations, training
from tagwright.plans.model_store import ModelStore
from tests.conftest import MIDDLE

POSTS = [(str(n), text) for n, text in enumerate(["red apple", "red rose", "blue sky", "blue sea", "green leaf", "green tree"])]
TAGS = [("0", "r"), ("1", "r"), ("2", "b"), ("3", "b"), ("4", "g"), ("5", "g")]
GAPS = [(0, "r"), (1, "unused"), (2, "b"), (5, "g")]


def train(spark, tags=TAGS):
    return training.train_hashed(
        spark.createDataFrame(POSTS, "Id STRING, Body STRING"),
        spark.createDataFrame(tags, "Id STRING, Tag STRING"),
        labels.class_table(GAPS, spark),
    )


def tags_of(model, posts):
    return {row["Id"]: row["tags"] for row in model.predict(posts).collect()}


@pytest.fixture
def posts(spark):
    return spark.createDataFrame(POSTS, "Id STRING, Body STRING")


def test_gaps_between_class_ids(spark, posts):
    """Each post gets its own tag, although two class ids have no rows."""
    model = train(spark)
    assert model.classes == [(0, "r"), (2, "b"), (5, "g")]
    assert tags_of(model, posts) == dict(TAGS)


def test_posts_without_a_text_go(spark):
    rows = spark.createDataFrame([("1", None), ("2", "red")], "Id STRING, Body STRING")
    assert tags_of(train(spark), rows) == {"2": "r"}


def test_fits_leave_only_what_models_need(spark, posts):
    folder = f"{session.shared_folder(spark)}/tagwright"
    names = lambda: {name for name, _ in session.subfolders(spark, folder)}
    before = names()
    train(spark)
    assert names() == before
    bayes.fit_bayes(posts, spark.createDataFrame(TAGS, "Id STRING, Tag STRING"), labels.class_table(GAPS, spark))
    assert [name.rsplit("-", 1)[0] for name in names() - before] == ["class-terms"]


def test_dense_model_that_is_too_large(spark):
    rows = spark.createDataFrame([("red", [(0, 1)])], "Body STRING, classes ARRAY<STRUCT<CatId: INT, n: BIGINT>>")
    with pytest.raises(ValueError):
        training.fit_hashed(rows, [(0, "r")], slots=100, max_bytes=799)


def test_no_rows_to_train_on(spark):
    with pytest.raises(ValueError):
        train(spark, [("0", "other")])


def test_repeated_tag_rows_weigh_more(spark):
    prior = lambda tags: train(spark, tags).pipeline.stages[-1].pi.toArray()
    once, often = prior(TAGS), prior(TAGS + [("0", "r")] * 10)
    assert often[0] > once[0] and often[1] < once[1]


def test_confidence(spark, posts):
    rows = train(spark).predict(posts, confidence=True).collect()
    assert all(1 / 3 < row["confidence"] <= 1 for row in rows)


def test_store_round_trip(spark, posts, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    assert store.latest() is None
    with pytest.raises(LookupError):
        store.load()
    model = train(spark)
    assert store.publish(model) == 1
    swapped = train(spark, [(post, "b" if tag == "r" else "r" if tag == "b" else tag) for post, tag in TAGS])
    assert store.publish(swapped) == 2
    assert tags_of(store.load(1), posts) == tags_of(model, posts)
    assert tags_of(store.load(), posts) == tags_of(swapped, posts) != tags_of(model, posts)


def test_exact_model_round_trip(spark, posts, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    tags = spark.createDataFrame(TAGS, "Id STRING, Tag STRING")
    model = bayes.fit_bayes(posts, tags, labels.class_table(GAPS, spark), smoothing=0.5)
    loaded = store.load(store.publish(model))
    assert sorted(loaded.score_rows(posts).collect()) == sorted(model.score_rows(posts).collect())


def test_unfinished_version_is_ignored(spark, posts, tmp_path):
    """A folder without its manifest row is overwritten by the next version."""
    store = ModelStore(spark, str(tmp_path / "models"))
    store.publish(train(spark))
    train(spark).pipeline.write().save(f"{store.path}/v=2/stages")
    assert store.latest() == 1
    assert store.publish(train(spark)) == 2 and tags_of(store.load(2), posts) == dict(TAGS)


def test_evaluation_equals_mllib(spark):
    """The accuracy over rows is that of MLlib's evaluator on the same rows."""
    training_posts, held = labels.split_by_key(relations.posts(spark, MIDDLE))
    tags, vocab = relations.tags(spark, MIDDLE), relations.vocab(spark, MIDDLE)
    model = training.train_hashed(training_posts, tags, vocab)
    measured = training.evaluate(model.predict(held), tags, vocab, baseline=0.5).first()
    rows = labels.with_class(labels.training_rows(tags, held, vocab), vocab)
    scored = model.transform(rows.select("Id", "Body", "CatId")).select("CatId", "prediction")
    theirs = MulticlassClassificationEvaluator(labelCol="CatId", metricName="accuracy").evaluate(scored)
    assert measured["accuracy"] == pytest.approx(theirs) and measured["relative"] == pytest.approx(theirs / 0.5)
    assert measured["n_rows"] == rows.count() and measured["accuracy_any"] > measured["accuracy"]


def test_texts_are_not_shuffled_for_scoring(spark, posts):
    plan = train(spark).predict(posts)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
