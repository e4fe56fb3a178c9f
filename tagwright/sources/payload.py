"""Posts as JSON payloads: decoding, encoding, and raw submissions made into posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagwright import schemas
from tagwright.fixed_values import ABSENT
from tagwright.functions.rows import filled


def parsed(messages: DataFrame, schema: StructType = schemas.POST) -> DataFrame:
    """The fields of each ``value``, with the text of a bad one in ``_corrupt_record``; other columns stay."""
    with_corrupt = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    others = [name for name in messages.columns if name != "value"]
    text = F.col("value").cast("string")
    # a list of one keeps Spark from parsing once for each place that names a field
    once = F.explode_outer(F.array(F.from_json(text, with_corrupt, options)))
    fields = messages.select(*others, text.alias("value"), once.alias("post"))
    return fields.select(*others, "value", "post.*")


def is_good() -> Column:
    """True for one JSON object; a list of objects would lose all but its first."""
    is_object = F.coalesce(F.ltrim("value").startswith("{"), F.lit(False))
    return F.col(schemas.CORRUPT).isNull() & is_object


def decode_posts(messages: DataFrame, schema: StructType = schemas.POST) -> DataFrame:
    """The posts among ``messages``. A value that is not text, such as 7, is read as its text."""
    return parsed(messages, schema).where(is_good()).drop("value", schemas.CORRUPT)


def rejected_posts(messages: DataFrame, schema: StructType = schemas.POST) -> DataFrame:
    """The messages that are not posts, as they came."""
    return parsed(messages, schema).where(~is_good()).select("value")


def with_reasons(messages: DataFrame, schema: StructType = schemas.POST) -> DataFrame:
    """The fields of each message with its ``value`` and the ``reason`` why it cannot be tagged, null if it can.

    Every message gives one row: a part of them is tagged and the rest rejected, and none goes without a trace.
    """
    reason = (
        F.when(~is_good(), "not a JSON object").when(F.col("Id").isNull(), "no Id").when(F.col("Body").isNull(), "no Body")
    )
    return parsed(messages, schema).withColumn("reason", reason).drop(schemas.CORRUPT)


def encode(df: DataFrame, keep_nulls: bool = False, key: str = "Id") -> DataFrame:
    """``(key, value)`` messages: the row as JSON, by default without its null fields."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns), options).alias("value"))


def utc_text(moment: Column) -> Column:
    """``moment`` to the second in UTC, such as 2008-08-03T11:12:52Z, in any session time zone.

    It is counted up from the epoch without a zone, as some UTC times do not exist in a local zone.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    wall = epoch + F.make_dt_interval(secs=F.unix_seconds(moment))
    return F.concat(F.translate(wall.cast("string"), " ", "T"), F.lit("Z"))


def normalize_submissions(forms: DataFrame, now: Column | None = None) -> DataFrame:
    """Posts from submitted forms ``(posts, id, userid)``; a form without all three is ignored.

    ``now`` is the time of arrival, by default the current time. Dates are written in UTC.
    """
    arrived = F.current_timestamp() if now is None else now
    absent = F.lit(ABSENT)
    return filled(forms, "posts", "id", "userid").select(
        F.col("id").cast("string").alias("Id"),
        absent.alias("Title"),
        F.col("posts").alias("Body"),
        F.col("userid").cast("string").alias("OwnerUserId"),
        utc_text(arrived).alias("CreationDate"),
        absent.alias("ClosedDate"),
        absent.alias("Score"),
    )
