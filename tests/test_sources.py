import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from tagwright import schemas
from tagwright.sources import files, messages, payload, tables


def write(path, text):
    path.write_text(text)
    return str(path)


def test_posts_from_json_lines(spark, tmp_path):
    path = write(tmp_path / "posts.json", '{"Id":"1","Body":"b"}\nnope\n{"Id":7,"Body":{"a":1}}\n')
    rows = {row["Id"]: row for row in files.read_posts(spark, path).cache().collect()}
    assert rows["1"]["Body"] == "b" and rows["1"]["Title"] is None
    assert rows["7"]["Body"] == '{"a":1}'
    assert rows[None][schemas.CORRUPT] == "nope"


def test_tags_from_csv(spark, tmp_path):
    path = write(tmp_path / "tags.csv", 'Id,Tag\n1,NA\n2,\n3,""\n4,null\n5,c++\n')
    rows = [tuple(row) for row in files.read_tags(spark, path).orderBy("Id").collect()]
    assert rows == [("1", "NA"), ("2", None), ("3", None), ("4", "null"), ("5", "c++")]


def test_label_vocabulary_from_csv(spark, tmp_path):
    path = write(tmp_path / "labels.csv", "java\nNA\nc#\njava\nnull\n")
    rows = sorted(map(tuple, files.read_label_vocab(spark, path).collect()))
    assert rows == [(1, "NA"), (2, "c#"), (3, "java"), (4, "null")]


def test_good_and_bad_messages(spark):
    values = ['{"Id":"1","Body":"b"}', "nope", "", "  ", None, "7", '"text"', '[{"Id":"2"},{"Id":"3"}]', ' {"Id":4}', '{"Id":']
    frame = spark.createDataFrame([(value,) for value in values], "value STRING")
    good = payload.decode_posts(frame)
    assert good.columns == schemas.POST.names
    assert sorted(row["Id"] for row in good.collect()) == ["1", "4"]
    bad = [row["value"] for row in payload.rejected_posts(frame).collect()]
    assert sorted(bad, key=str) == sorted((v for v in values if v not in (values[0], values[8])), key=str)


def test_messages_drop_absent_fields(spark):
    frame = spark.createDataFrame([("1", None)], "Id STRING, Title STRING")
    assert payload.encode(frame).first() == ("1", '{"Id":"1"}')
    assert payload.encode(frame, keep_nulls=True).first()["value"] == '{"Id":"1","Title":null}'


def test_encode_and_decode(spark):
    rows = [("1", 'say "hi"\n\\ tab\t', "é ☃"), ("2", None, "")]
    frame = spark.createDataFrame(rows, "Id STRING, Title STRING, Body STRING")
    back = payload.decode_posts(payload.encode(frame)).select("Id", "Title", "Body")
    assert sorted(map(tuple, back.collect())) == rows


def test_submissions_become_posts(spark):
    forms = spark.createDataFrame([("text", "9", "u1"), (None, None, None), ("text", None, "u2")], schemas.SUBMISSION)
    now = F.lit(datetime.datetime(2008, 8, 3, 11, 12, 52, tzinfo=datetime.timezone.utc))
    rows = payload.normalize_submissions(forms, now)
    assert rows.columns == schemas.POST.names
    assert [tuple(row) for row in rows.collect()] == [("9", "NA", "text", "u1", "2008-08-03T11:12:52Z", "NA", "NA")]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert payload.normalize_submissions(forms, now).first()["CreationDate"] == "2008-08-03T11:12:52Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert payload.normalize_submissions(forms).first()["CreationDate"][:2] == "20"


def test_dates_in_hours_that_a_local_zone_skips(spark):
    moments = ["2024-03-10T02:30:00Z", "2024-11-03T01:30:00Z", "2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.createDataFrame([(moment,) for moment in moments], "at STRING")
        texts = frame.select(payload.utc_text(F.col("at").cast("timestamp"))).collect()
        assert [row[0] for row in texts] == moments
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_kafka_is_an_option_of_the_source(spark):
    """The connector is not part of this installation; with it the same call gives the stream."""
    options = messages.kafka("broker:9092", "posts", maxOffsetsPerTrigger="1000")
    assert options["subscribe"] == "posts" and options["maxOffsetsPerTrigger"] == "1000"
    with pytest.raises(AnalysisException):
        messages.post_stream(spark, "kafka", options)


def test_writing_again_leaves_one_copy(spark, tmp_path):
    frame = spark.createDataFrame([("1", "x")], "Id STRING, tags STRING")
    for _ in range(2):
        messages.write_tagged(frame, "text", {"path": str(tmp_path / "out")})
    assert messages.read_tagged(spark, str(tmp_path / "out")).select("Id", "tags").collect() == [("1", "x")]


def test_table_is_reset_on_request_only(spark, tmp_path):
    make = lambda reset: tables.ensure_table(spark, "reset_test", "posts", reset, str(tmp_path / "db"))
    name = make(False)
    row = spark.range(1).select(*[F.lit(field).alias(field) for field in schemas.STORED_POST.names])
    row.write.insertInto(name)
    assert spark.table(make(False)).count() == 1
    assert spark.table(make(True)).count() == 0
    assert spark.table(name).columns == schemas.STORED_POST.names


@pytest.mark.parametrize("n_files", [1, 3])
def test_label_lines_are_counted_across_blocks(spark, tmp_path, n_files):
    """A file of many blocks, read by several tasks: the line numbers are those of the file."""
    lines = [f"tag {at % 700}" if at % 5 else f'"a ""quoted"" {at}"' for at in range(3000)]
    folder = tmp_path / "labels"
    folder.mkdir()
    step = len(lines) // n_files
    for at in range(n_files):
        write(folder / f"part-{at}.csv", "\n".join(lines[at * step : (at + 1) * step]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        vocab = files.read_label_vocab(spark, str(folder))
        found = {row["Tag"]: row["catId"] for row in vocab.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == {line.strip('"').replace('""', '"'): at for at, line in enumerate(lines)}


def test_label_lines_are_not_collected(spark, tmp_path, monkeypatch):
    """The driver sees the size of the vocabulary and none of its lines."""
    path = write(tmp_path / "labels.csv", "".join(f"tag {at}\n" for at in range(50)))
    plain, sizes = DataFrame.collect, []
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(found := plain(self)) or found)
    vocab = files.read_label_vocab(spark, path)
    assert all(len(rows) <= 1 for rows in sizes)
    assert vocab.count() == 50


def test_a_batch_written_twice_is_read_once(spark, tmp_path):
    rows = [(str(n % 7), f"text {n % 5}", "java") for n in range(40)]  # some posts are equal and must all stay
    frame = spark.createDataFrame(rows, "Id STRING, Body STRING, tags STRING").coalesce(2)
    path = str(tmp_path / "topic")
    for batch_id in (0, 1, 1):
        messages.write_tagged(frame, "text", {"path": path}, batch_id, mode="append")
    messages.write_tagged(frame.limit(2), "text", {"path": path}, mode="append")  # without identities
    topic = spark.read.text(path)
    assert topic.count() == 3 * 40 + 2
    once = messages.read_once(topic)
    assert once.columns == schemas.TAGGED_POST.names and once.count() == 2 * 40 + 2
    expected = sorted(rows * 2 + [tuple(row) for row in frame.limit(2).collect()])
    assert sorted(map(tuple, once.select("Id", "Body", "tags").collect())) == expected


def test_a_stream_takes_each_message_once(spark, tmp_path):
    frame = spark.createDataFrame([(str(n), "b", "java") for n in range(9)], "Id STRING, Body STRING, tags STRING")
    path, sink = str(tmp_path / "topic"), str(tmp_path / "out")
    for batch_id in (0, 0):
        messages.write_tagged(frame, "text", {"path": path}, batch_id, mode="append")
    messages.write_tagged(frame, "text", {"path": path}, mode="append")
    source = spark.readStream.schema("value STRING").option("maxFilesPerTrigger", "1").text(path)
    timed = source.select("value", F.col("_metadata.file_modification_time").alias("time"))
    writer = messages.stream_once(timed, "time", "1 hour").writeStream.format("parquet").option("path", sink)
    writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(sink).count() == 2 * 9
