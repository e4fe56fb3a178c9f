"""What several operators share: shipping the code, naming columns, numbering rows in order."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tagwright.session import fits_broadcast, spread, written

# The white space that separates words.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
SPARKS_BATCH_BYTES = 64 << 20
BATCH_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python can import it.

    Batches sent to Python are held by both sides at once, in every core; unless the session sets another bound
    than Spark's own, they get a smaller one.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_SETTING) == f"{SPARKS_BATCH_BYTES}b":
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    if context.applicationId in _shipped or not PACKAGE.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="tagwright-code-")) / "tagwright_code.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that the operator is about to add; case does not count, as in Spark."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{name}`") for name in df.columns if name.lower() not in taken])


def nested(df: DataFrame, *added: Column, apart: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``df`` as one struct ``given``, so that no added or helper column can clash with them.

    Those named ``apart`` stay outside.
    """
    inside = F.struct(*[F.col(f"`{name}`") for name in df.columns if name not in apart])
    return df.select(inside.alias("given"), *[F.col(f"`{name}`") for name in apart], *added)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def widened(schema: T.StructType, **added: str) -> T.StructType:
    """``schema`` and more columns, given as name and type."""
    more = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in added.items()]
    return T.StructType([*schema.fields, *more])


def texts(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns and the text, null read as empty, spread over the cores if there are few files."""
    return spread(docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias(text)))


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key written as text, modulo ``divisor``; null keys count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def in_order(df: DataFrame, *keys: str, purpose: str = "ordered") -> DataFrame:
    """``df`` written in the order of ``keys``, with the range ``part`` of each row and its place ``at`` in it.

    The rows are dealt out by ranges of all keys together, so a hot first key is split
    as long as later keys differ. Rows that tie in all keys must be equal: then any order is the same.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(ordered.withColumn("place", F.monotonically_increasing_id()), purpose)
    # the upper bits are the range, the lower 33 the place in it
    return placed.select(
        *df.columns,
        F.shiftright("place", 33).cast("int").alias("part"),
        F.col("place").bitwiseAND((1 << 33) - 1).alias("at"),
    )


def numbered(df: DataFrame, *keys: str, number: str = "row", purpose: str = "numbered") -> DataFrame:
    """``df`` with the number of each row from 0 in the order of ``keys``, without gaps.

    Only the row counts of the ranges, one row each, are summed up in one task and sent to all.
    """
    placed = in_order(df, *keys, purpose=purpose)
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").select(*df.columns, (F.col("start") + F.col("at")).alias(number))


MOST_HOT = 10_000


def attach(df: DataFrame, table: DataFrame, keys: list[str], count: str, row_bytes: int = 128) -> DataFrame:
    """``df`` with the other columns of ``table``, which has one row per key and in ``count`` how many rows ``df`` has of it.

    Null keys meet each other. Both must be written tables. A table within the library's bound is broadcast.
    Of a larger one the keys with more than one in ``MOST_HOT`` of all rows are, of which there are fewer than
    that many; the rest meets by shuffle, so no task gets a larger share of the rows through its key.
    """
    named = table.select(*[F.col(key).alias(f"_{key}") for key in keys], *[n for n in table.columns if n not in (*keys, count)], count)
    same = lambda: [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    added = [name for name in table.columns if name not in (*keys, count)]
    if fits_broadcast(table, F.lit(row_bytes)):
        return df.join(F.broadcast(named), same()).select(*df.columns, *added)
    total = table.agg(F.sum(count)).first()[0]
    hot = named.where(F.col(count) * MOST_HOT > total)
    cold = named.where(F.col(count) * MOST_HOT <= total)
    in_place = df.join(F.broadcast(hot), same()).select(*df.columns, *added)
    rest = df.join(F.broadcast(hot.select(*[f"_{key}" for key in keys])), same(), "left_anti")
    return in_place.unionByName(rest.join(cold.hint("merge"), same()).select(*df.columns, *added))


def hash_sample(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """About ``rows`` texts, at most, picked by a hash of each text alone; all if there are no more.

    The share of the hashes that is taken follows from the number of rows, so the texts are read once.
    """
    n = docs.count()
    if n <= rows:
        return docs.select(text)
    # hashes spread over all longs; copies of a text are taken together
    cut = int(2**64 * (rows / n)) - 2**63
    return docs.where(F.xxhash64(text) < F.lit(cut)).select(text).limit(rows)


def lean() -> None:
    """Give freed memory of a Python worker back; workers stay for later tasks, beside other workers of their executor."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


ROWS_AT_ONCE = 1024


def leanly(work):
    """``work`` over the batches of a task in slices of few rows, with freed memory given back before and after.

    A batch has some ten thousand texts; as Python objects they take several times the room that they have in it.
    """

    def run(batches):
        lean()
        yield from work(batch.slice(at, ROWS_AT_ONCE) for batch in batches for at in range(0, batch.num_rows, ROWS_AT_ONCE))
        lean()

    return run
