import random

from tagwright.operators import keyed
from tagwright.schemas import STORED_POST, TAGGED_POST

SCHEMA = "Id STRING, Title STRING, tag STRING, seq BIGINT"


def updates(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_replace_and_merge_differ_in_absent_fields(spark):
    rows = updates(spark, [("1", "t1", None, 1), ("1", None, "x", 2)])
    assert keyed.latest_by_key(rows, "Id", ["seq"]).collect() == [("1", None, "x", 2)]
    assert keyed.merge_fields(rows, "Id", ["seq"]).collect() == [("1", "t1", "x")]


def test_rows_without_a_key_go(spark):
    rows = updates(spark, [(None, "t", "x", 1), ("1", "t", "x", 1)])
    assert keyed.latest_by_key(rows, "Id", ["seq"]).count() == 1
    assert keyed.merge_fields(rows, "Id", ["seq"]).count() == 1


def test_equal_orders_give_one_result(spark):
    rows = [("1", "a", "x", 5), ("1", "b", None, 5), ("1", None, "y", 5)]
    for _ in range(3):
        random.shuffle(rows)
        assert keyed.latest_by_key(updates(spark, rows).repartition(3), "Id", ["seq"]).collect() == [("1", "b", None, 5)]


def test_against_a_plain_loop(spark):
    """Random updates, one key with a third of them."""
    source = random.Random(7)
    rows = []
    for seq in range(600):
        key = "hot" if seq % 3 == 0 else str(source.randrange(40))
        rows.append((key, source.choice([None, f"t{seq}"]), source.choice([None, f"x{seq}"]), seq))
    latest, merged = {}, {}
    for key, title, tag, seq in rows:
        latest[key] = (title, tag, seq)
        old = merged.get(key, (None, None))
        merged[key] = (old[0] if title is None else title, old[1] if tag is None else tag)
    source.shuffle(rows)
    frame = updates(spark, rows).repartition(5)
    assert {row[0]: tuple(row[1:]) for row in keyed.latest_by_key(frame, "Id", ["seq"]).collect()} == latest
    assert {row[0]: tuple(row[1:]) for row in keyed.merge_fields(frame, "Id", ["seq"]).collect()} == merged


def test_keys_are_reduced_before_the_shuffle(spark):
    rows = updates(spark, [("1", "t", "x", 1)])
    for frame in (keyed.latest_by_key(rows, "Id", ["seq"]), keyed.merge_fields(rows, "Id", ["seq"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "partial_max" in plan[plan.index("Exchange") :]


def test_stored_layout(spark):
    tagged = spark.createDataFrame([tuple("1234567") + ("x",)], TAGGED_POST)
    stored = keyed.stored_layout(tagged)
    assert stored.columns == STORED_POST.names and stored.first()["tag"] == "x"


def test_lookup(spark):
    stored = spark.createDataFrame([("1", "x"), ("2", "y")], "Id STRING, tag STRING")
    assert keyed.lookup_tag(stored, "2").collect() == [("y",)]
    assert keyed.lookup_tag(stored, "9").collect() == []
    assert keyed.lookup_tag(stored, "9' OR '1'='1").collect() == []
    requests = spark.createDataFrame([("1",), ("1",), ("9",)], "Id STRING")
    assert sorted(map(tuple, keyed.lookup_tags(stored, requests).collect())) == [("1", "x"), ("9", None)]


def test_lookup_filters_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "stored")
    spark.createDataFrame([("1", "x")], "Id STRING, tag STRING").write.parquet(path)
    plan = keyed.lookup_tag(spark.read.parquet(path), "1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Id,1)" in plan
