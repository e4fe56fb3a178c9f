import random

import pytest
from pyspark.sql import functions as F

from tagwright import session
from tagwright.operators import keyed
from tagwright.streaming.levels import LeveledTable

SCHEMA = "Id STRING, Title STRING, tag STRING, seq BIGINT"


def random_updates(n=400, seed=3):
    source = random.Random(seed)
    return [
        (
            "hot" if at % 3 == 0 else str(source.randrange(60)),
            source.choice([None, f"t{at}"]),
            source.choice([None, f"x{at}"]),
            at,
        )
        for at in range(n)
    ]


def leveled(spark, tmp_path, merge=False, **sizes):
    schema = spark.createDataFrame([], SCHEMA).schema
    sizes = {"buckets": 4, "fanout": 2, "level_rows": 4, "file_rows": 8, **sizes}
    return LeveledTable(spark, str(tmp_path / f"table-{merge}"), schema, "Id", ["seq"], merge, **sizes)


def folders(path):
    return {str(found.relative_to(path)) for found in path.glob("runs/run=*/level=*/bucket=*")}


def rows_of(frame):
    return sorted(frame.collect(), key=str)


@pytest.mark.parametrize("merge, few_keys", [(False, True), (True, True), (True, False)])
def test_levels_equal_the_batch_operator(spark, tmp_path, monkeypatch, merge, few_keys):
    """Batches out of order, one written twice, and compactions in between."""
    if not few_keys:
        monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    rows = random_updates()
    table = leveled(spark, tmp_path, merge)
    assert table.read().count() == 0 and table.compact() is None and table.snapshot() == -1
    chunks = [rows[at::6] for at in (3, 0, 5, 4, 1, 2)]
    done, expected = [], None
    for batch_id, chunk in enumerate(chunks):
        table.write_batch(spark.createDataFrame(chunk, SCHEMA), batch_id)
        done += chunk
        if batch_id in (2, 3, 5):
            assert table.compact() == batch_id - 1 and table.compact() is None
            assert table.snapshot() == batch_id - 1
            whole = spark.createDataFrame(done, SCHEMA)
            expected = rows_of((keyed.merge_fields if merge else keyed.latest_by_key)(whole, "Id", ["seq"]))
            assert rows_of(table.read()) == expected
    table.write_batch(spark.createDataFrame(chunks[-1], SCHEMA), 5)
    assert rows_of(table.read()) == expected
    by_id = {row["Id"]: row for row in expected}
    for post in ("hot", "0", "7", "nobody"):
        assert table.get(post).collect() == ([by_id[post]] if post in by_id else [])
    requests = spark.createDataFrame([("hot",), ("hot",), ("7",), ("nobody",), (None,)], "Id STRING")
    found = {row["Id"]: row for row in table.lookup(requests).collect()}
    assert found.pop("nobody")["tag"] is None and found == {post: by_id[post] for post in ("hot", "7")}
    assert len({level for _, level in table.contents().runs}) > 1


def test_a_batch_of_one_bucket_rewrites_that_bucket(spark, tmp_path):
    table = leveled(spark, tmp_path)
    path = tmp_path / "table-False"
    for batch_id in range(2):
        table.write_batch(spark.createDataFrame([(str(n), "t", None, batch_id) for n in range(40)], SCHEMA), batch_id)
    table.compact()
    before = folders(path)
    bucket = spark.range(1).select(table.bucket_of(F.lit("7"))).first()[0]
    for batch_id in (2, 3):
        table.write_batch(spark.createDataFrame([("7", "new", None, 9)], SCHEMA), batch_id)
    table.compact()
    # batch 1, left in the log by the first compaction, touched every bucket
    table.write_batch(spark.createDataFrame([("7", "newer", None, 10)], SCHEMA), 4)
    middle = folders(path)
    assert table.compact() == 3
    added = folders(path) - middle
    assert before < middle and len(added) == 1 and added.pop().endswith(f"bucket={bucket}")
    assert table.get("7").first()["Title"] == "newer" and table.read().count() == 40


def test_small_batches_do_not_rewrite_the_lower_levels(spark, tmp_path):
    table = leveled(spark, tmp_path, buckets=1, fanout=4, level_rows=16)
    table.write_batch(spark.createDataFrame([(str(n), "t", None, 0) for n in range(400)], SCHEMA), 0)
    for batch_id in range(1, 8):
        table.write_batch(spark.createDataFrame([(str(n), "u", None, batch_id) for n in range(5)], SCHEMA), batch_id)
        table.compact()
    contents = table.contents()
    assert max(rows for _, rows in contents.runs.values()) == 400
    written_rows = spark.read.schema("n_rows BIGINT").json(f"{table.path}/edits").agg(F.sum("n_rows")).first()[0]
    assert 400 < written_rows < 500  # rewriting all would be 7 x 400
    assert table.read().where("Title = 'u'").count() == 5 and table.read().count() == 400


def test_a_run_without_its_edits_does_not_count(spark, tmp_path):
    table = leveled(spark, tmp_path)
    for batch_id in range(3):
        table.write_batch(spark.createDataFrame([(str(n), f"t{batch_id}", None, batch_id) for n in range(9)], SCHEMA), batch_id)
    # what a compaction leaves that was stopped before its edits
    lost = spark.createDataFrame([("1", ("x", "y", 99, 0, 0))], "Id STRING, newest STRUCT<Title:STRING,tag:STRING,seq:BIGINT,a:BIGINT,b:BIGINT>")
    lost.withColumn("level", F.lit(1)).withColumn("bucket", F.lit(0)).write.partitionBy("level", "bucket").parquet(f"{table.path}/runs/run=1")
    expected = [(str(n), "t2", None, 2) for n in range(9)]
    assert rows_of(table.read()) == expected
    assert table.clean(older_than=-60) == []
    table.compact()
    assert rows_of(table.read()) == expected


def test_clean_leaves_what_counts(spark, tmp_path):
    table = leveled(spark, tmp_path, buckets=2)
    for batch_id in range(5):
        table.write_batch(spark.createDataFrame([(str(n), "t", None, batch_id) for n in range(batch_id, batch_id + 9)], SCHEMA), batch_id)
        table.compact()
    before = rows_of(table.read())
    reading = table.read()
    assert table.clean(older_than=3600) == [] and rows_of(reading) == before
    gone = table.clean(older_than=-60)
    assert {name.split("/")[0] for name in gone} == {"log", "runs"}
    assert rows_of(table.read()) == before and len(before) == 13
    live = {f"runs/run={run}/level={level}/bucket={bucket}" for (bucket, level), (run, _) in table.contents().runs.items()}
    assert folders(tmp_path / "table-False") == live


def scanned(frame) -> int:
    """Rows that the scans of ``frame`` gave out, after row groups were skipped."""
    frame.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame.collect()
    finally:
        frame.sparkSession.conf.unset("spark.sql.adaptive.enabled")
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(at).metrics().apply("numOutputRows").value() for at in range(leaves.size()))


def test_lookup_reads_one_row_group_of_many(spark, tmp_path):
    n = 20000
    options = {"parquet.block.size": "16384", "parquet.block.size.row.check.min": "100", "parquet.page.size": "4096"}
    table = leveled(spark, tmp_path, buckets=2, level_rows=10 * n, file_rows=10 * n, writer_options=options)
    for batch_id in range(2):
        rows = spark.range(n).selectExpr("CAST(id * 2 AS STRING) AS Id", "uuid() AS Title", "'x' AS tag", f"{batch_id}L AS seq")
        table.write_batch(rows, batch_id)
        table.write_batch(rows.limit(1), batch_id + 1)
        table.compact()
    assert table.read().count() == n
    found = table.get("5000")
    assert scanned(found) < n / 20 and found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Id,5000)" in plan
    # an id between stored ones: the Bloom filter leaves no row group
    assert scanned(table.get("5001")) == 0


def test_unchanged_buckets_are_read_without_a_shuffle(spark, tmp_path):
    table = leveled(spark, tmp_path, level_rows=1000)
    for batch_id in range(2):
        table.write_batch(spark.createDataFrame([(str(n), "t", None, batch_id) for n in range(40)], SCHEMA), batch_id)
    table.write_batch(spark.createDataFrame([("7", "t", None, 2)], SCHEMA), 2)
    table.compact()
    settled, lowest, upper = table._parts()
    assert len(settled) == 3 and len(lowest) == 1 and len(upper) == 1
    assert table.read().count() == 40
