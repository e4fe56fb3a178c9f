import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tagwright import session
from tagwright.functions.keys import in_training, key_bucket
from tagwright.operators import evaluation, labels

TAGS = [("1", "x"), ("1", "y"), ("2", "x"), ("3", "z"), ("3", None), (None, "x"), ("4", "z"), ("5", "rare")]


def tags(spark, rows=TAGS):
    return spark.createDataFrame(rows, "Id STRING, Tag STRING")


def vocab(spark):
    return labels.class_table([(0, "x"), (1, "z"), (2, "y")], spark)


def test_vocabulary_breaks_ties_by_name(spark):
    top = labels.label_vocab(tags(spark, [("1", t) for t in "bbaaccd"]), 3).collect()
    assert [(row["catId"], row["Tag"]) for row in sorted(top)] == [(0, "a"), (1, "b"), (2, "c")]


def test_select_tags_is_case_sensitive_and_drops_nulls(spark):
    chosen = labels.select_tags(tags(spark, TAGS + [("6", "X")]), vocab(spark))
    assert sorted(map(tuple, chosen.collect())) == [("1", "x"), ("1", "y"), ("2", "x"), ("3", "z"), ("4", "z")]


def test_training_rows_need_a_text(spark):
    posts = spark.createDataFrame([("1", "one"), ("2", None), ("3", "three"), ("9", "nine")], "Id STRING, Body STRING")
    rows = labels.training_rows(tags(spark), posts, vocab(spark))
    assert rows.columns == ["Tag", "Body", "Id"]
    assert sorted(map(tuple, rows.collect())) == [("x", "one", "1"), ("y", "one", "1"), ("z", "three", "3")]


def test_unknown_class_has_no_tag(spark):
    rows = spark.createDataFrame([(0.0,), (2.0,), (7.0,)], "CatId DOUBLE")
    assert sorted((row["CatId"], row["tags"]) for row in labels.with_tag(rows, vocab(spark)).collect()) == [
        (0.0, "x"), (2.0, "y"), (7.0, None)
    ]


def test_repeated_tag_rows_are_kept(spark):
    posts = spark.createDataFrame([("1", "one"), ("3", "three")], "Id STRING, Body STRING")
    many = tags(spark, TAGS + [("3", "z")] * 9000)
    rows = labels.class_rows(labels.labelled_posts(posts, many, vocab(spark)), "Id")
    counts = {(row["Id"], row["CatId"]): row["count"] for row in rows.groupBy("Id", "CatId").count().collect()}
    assert counts == {("1", 0): 1, ("1", 2): 1, ("3", 1): 9001}


def test_labelled_posts_by_shuffle_are_the_same(spark, monkeypatch):
    posts = spark.createDataFrame([(str(n), f"text {n}") for n in range(9)], "Id STRING, Body STRING")
    listed = lambda: sorted(
        (row["Id"], row["Body"], sorted(map(tuple, row["classes"])))
        for row in labels.labelled_posts(posts, tags(spark), vocab(spark)).collect()
    )
    by_broadcast = listed()
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    assert listed() == by_broadcast and len(by_broadcast) == 4


def test_split_depends_on_the_key_only(spark):
    ids = spark.range(1000).withColumnRenamed("id", "Id")
    sides = []
    for parts in (1, 7):
        training, held = labels.split_by_key(ids.repartition(parts))
        first, second = {r[0] for r in training.collect()}, {r[0] for r in held.collect()}
        assert not first & second and len(first | second) == 1000
        sides.append(first)
    assert sides[0] == sides[1] and 650 < len(sides[0]) < 750
    as_text = spark.range(1000).select(F.col("id").cast("string").alias("Id")).where(in_training(F.col("Id")))
    assert {int(row[0]) for row in as_text.collect()} == sides[0]


def test_tag_sets(spark):
    sets = {row["Id"]: row["tags"] for row in labels.tag_sets(tags(spark, TAGS + [("1", "x")])).collect()}
    assert sets == {"1": ["x", "y"], "2": ["x"], "3": ["z"], "4": ["z"], "5": ["rare"]}


def test_accuracy_equals_the_evaluator(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 2.0), (1.0, 1.0)], "CatId DOUBLE, prediction DOUBLE")
    theirs = MulticlassClassificationEvaluator(labelCol="CatId", metricName="accuracy").evaluate(rows)
    assert evaluation.accuracy(rows).first() == (4, theirs)
    assert evaluation.accuracy_vs_baseline(rows, baseline=0.5).first()["relative"] == theirs / 0.5 > 1


def test_accuracy_any_accepts_each_true_tag(spark):
    predicted = spark.createDataFrame([("1", "y"), ("2", "y"), ("8", "x")], "Id STRING, tags STRING")
    assert evaluation.accuracy_any(predicted, tags(spark)).first() == (2, 0.5)


@pytest.mark.parametrize("share", [0.0, 0.04, 0.333, 0.7, 0.75, 1.0])
def test_any_share_is_met(spark, share):
    """Within four standard deviations of the share, and equal to the old buckets where they are enough."""
    n = 20000
    ids = spark.range(n).select(F.col("id").alias("Id"))
    found = ids.where(in_training(F.col("Id"), share)).count()
    assert abs(found - n * share) <= 4 * (n * share * (1 - share)) ** 0.5
    if share == 0.7:
        assert ids.where(in_training(F.col("Id"), share) != (key_bucket(F.col("Id")) < 7)).count() == 0


def test_parts_cover_all_keys_once(spark):
    rows = spark.range(5000).select((F.col("id") % 1000).alias("Id"), F.col("id").alias("n"))
    parts = labels.split_parts(rows, [0.75, 0.04])
    ids = [{row["Id"] for row in part.collect()} for part in parts]
    assert sum(part.count() for part in parts) == 5000 and [part.columns for part in parts] == [["Id", "n"]] * 3
    assert sum(map(len, ids)) == len(set.union(*ids)) == 1000
    assert ids[0] == {row["Id"] for row in rows.where(in_training(F.col("Id"), 0.75)).collect()}
    assert 20 <= len(ids[1]) <= 65
    for bad in ([-0.1], [0.8, 0.3]):
        with pytest.raises(ValueError):
            labels.split_parts(rows, bad)
