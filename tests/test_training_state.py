import pytest
from pyspark.sql import functions as F

from tagwright.operators import bayes, labels
from tagwright.plans.model_store import ModelStore
from tagwright.plans.training_state import TrainingState, retrain
from tests.test_bayes import CLASSES, NEW, POSTS, TAGS, frame


def parts(spark):
    """The posts in three batches; each has all tags of its posts."""
    for ids in ("14", "25", "36"):
        posts = [row for row in POSTS if row[0] in ids]
        yield frame(spark, posts), frame(spark, [row for row in TAGS if row[0] in ids], "Id STRING, Tag STRING")


def facts(model, spark):
    """All that a model is made of."""
    likelihoods = sorted(model.log_likelihoods().collect(), key=str)
    return model.class_ids, model.tags, model.class_rows, likelihoods, sorted(model.score_rows(frame(spark, NEW)).collect())


def test_added_batches_equal_one_fit(spark, tmp_path):
    vocab = labels.class_table(CLASSES, spark)
    whole = bayes.fit_bayes(frame(spark, POSTS), frame(spark, TAGS, "Id STRING, Tag STRING"), vocab)
    state = TrainingState(spark, str(tmp_path / "state"))
    assert state.counts().count() == 0 and state.compact() is None
    for batch_id, (posts, tags) in enumerate(parts(spark)):
        assert state.add(posts, tags, batch_id) and state.add(posts, tags, batch_id)
        state.compact()
    assert state.through() == 1
    # the base holds batch 0; adding it again must not count its posts twice
    assert state.add(*next(parts(spark)), 0) is False
    ours, theirs = facts(state.model(vocab), spark), facts(whole, spark)
    assert ours[:3] == theirs[:3]
    for mine, other in zip(ours[3] + ours[4], theirs[3] + theirs[4]):
        assert mine[:2] == other[:2] and mine[-1] == pytest.approx(other[-1], abs=1e-9)
    assert {row["Tag"]: row["n"] for row in state.tag_rows().collect()} == {"cat": 4, "dog": 2, "bird": 1}


def test_a_run_reads_the_new_posts_alone(spark, tmp_path):
    state, store = TrainingState(spark, str(tmp_path / "state")), ModelStore(spark, str(tmp_path / "models"))
    vocab = labels.class_table(CLASSES, spark)
    for batch_id, (posts, tags) in enumerate(parts(spark)):
        folder = tmp_path / f"posts-{batch_id}"
        posts.write.parquet(str(folder))
        assert retrain(state, store, spark.read.parquet(str(folder)), tags, vocab, batch_id) == batch_id + 1
        for file in folder.iterdir():
            file.unlink()
    assert store.load().class_rows == [4, 2, 1]
    assert all("/state/" in name for name in state.counts().inputFiles())


def test_a_class_may_come_later(spark, tmp_path):
    """Sums are kept for all tags, so a model may be made for any vocabulary."""
    state = TrainingState(spark, str(tmp_path / "state"))
    for batch_id, (posts, tags) in enumerate(parts(spark)):
        state.add(posts, tags, batch_id)
    late = state.model(labels.class_table([(7, "bird"), (9, "cat")], spark))
    assert late.class_ids == [7, 9] and late.class_rows == [1, 4]
    with pytest.raises(ValueError):
        state.model(labels.class_table([(0, "none")], spark))


def test_clean_keeps_the_sums(spark, tmp_path):
    state = TrainingState(spark, str(tmp_path / "state"))
    for batch_id, (posts, tags) in enumerate(parts(spark)):
        state.add(posts, tags, batch_id)
        state.compact()
    before = sorted(state.counts().collect(), key=str)
    assert state.clean(older_than=3600) == []
    assert sorted(state.clean(older_than=-60)) == ["base/through=0", "batches/batch_id=0", "batches/batch_id=1"]
    assert sorted(state.counts().collect(), key=str) == before
    assert state.counts().where(F.col("term") == "far").agg(F.sum("n")).first()[0] == 3
