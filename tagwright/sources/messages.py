"""Streams of messages with a ``value`` column, from Kafka or from files, and their sinks.

Kafka needs the connector package of the cluster; a folder of text files stands in for a topic in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tagwright import schemas
from tagwright.fixed_values import TAGGED_TOPIC
from tagwright.sources.payload import decode_posts, encode


# How messages are written to text files: a reader knows by their names that they are compressed.
TEXT_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def kafka(brokers: str, topic: str, **more: str) -> dict[str, str]:
    """Source options of a topic, read from its beginning unless the checkpoint says otherwise."""
    return {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": "earliest", **more}


def post_stream(spark: SparkSession, source: str, options: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``value`` texts of a stream; ``source`` is ``kafka`` or ``text`` (one message per line).

    ``keep`` names further columns of the source, such as ``partition``, ``offset`` and ``timestamp`` of a topic. Decoding
    carries them along, so they can be order columns of a keyed table; drop them before a row is written as a message.
    """
    reader = spark.readStream.format(source).options(**options)
    if source == "text":
        reader = reader.schema("value STRING")
    return reader.load().select(F.col("value").cast("string").alias("value"), *keep)


def tagged_post_stream(spark: SparkSession, source: str, options: dict[str, str]) -> DataFrame:
    """The tagged posts of a stream of messages."""
    return decode_posts(post_stream(spark, source, options), schemas.TAGGED_POST)


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """The tagged posts among message files, as a batch."""
    return decode_posts(spark.read.text(path), schemas.TAGGED_POST)


def with_identity(df: DataFrame, batch_id: int) -> DataFrame:
    """``df`` with the ``message`` that each row is: its batch, its place there and a hash of its content.

    A batch that runs again reads the same rows in the same order, so its messages get the same identities. Should a source
    break that, the hash differs and a message comes twice rather than being taken for another.
    """
    place = F.monotonically_increasing_id().cast("string")
    content = F.hex(F.xxhash64(F.to_json(F.struct(*df.columns))))
    return df.withColumn("message", F.concat_ws("-", F.lit(str(batch_id)), place, content))


def write_tagged(
    df: DataFrame, sink: str, options: dict[str, str], batch_id: int | None = None, mode: str = "overwrite"
) -> None:
    """Write rows as JSON messages from the executors; the post id is the message key in Kafka.

    For files, compressed if they are text, ``options`` has a ``path``, which is overwritten, so a repeated batch leaves one copy; with the
    ``mode`` append they keep all that was ever written, as a topic does. With a ``batch_id`` a message carries its
    identity, by which ``read_once`` and ``stream_once`` tell a repeated batch from new messages.
    """
    messages = encode(df if batch_id is None else with_identity(df, batch_id))
    if sink == "kafka":
        messages.write.format("kafka").options(**{"topic": TAGGED_TOPIC, **options}).save()
    else:
        files = TEXT_FILES if sink == "text" else {}
        messages.select("value").write.mode(mode).format(sink).options(**{**files, **options}).save()


def read_once(messages: DataFrame) -> DataFrame:
    """The tagged posts among ``messages`` (value), each identity once; messages without one all stay.

    Copies are equal, so it does not matter which one is taken.
    """
    posts = decode_posts(messages, schemas.IDENTIFIED_POST)
    named = posts.where("message IS NOT NULL").dropDuplicates(["message"])
    return named.unionByName(posts.where("message IS NULL")).drop("message")


def stream_once(messages: DataFrame, time: str, within: str) -> DataFrame:
    """As ``read_once`` on a stream of ``(value, time)``, if a batch is repeated ``within`` an interval of ``time``.

    Identities are remembered for that interval only, so the state does not grow with the topic.
    """
    posts = decode_posts(messages, schemas.IDENTIFIED_POST).withWatermark(time, within)
    # without an identity a message is a copy of nothing
    known = F.coalesce("message", F.expr("uuid()"))
    return posts.withColumn("message", known).dropDuplicatesWithinWatermark(["message"]).drop("message")


def tagged_writer(df: DataFrame, sink: str, options: dict[str, str]) -> DataStreamWriter:
    """A stream writer of JSON messages, to be given its trigger and started."""
    messages = encode(df)
    if sink == "kafka":
        return messages.writeStream.format("kafka").options(**{"topic": TAGGED_TOPIC, **options})
    return messages.select("value").writeStream.format(sink).options(**options)
