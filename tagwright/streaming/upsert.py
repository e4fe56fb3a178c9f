"""Keyed tables fed by streams, without a table format.

A table is a folder with a log, one folder per batch, and snapshots that hold the log up to some batch.
Both keep rows together with their order, and the merge is a maximum, so it does not matter how often
or in which grouping rows are merged: a batch written again overwrites its folder, and a snapshot only
saves work. Snapshots are complete once their manifest row is written.

The order of a row is that of the table's order columns, then its arrival: the batch, and the place among the
rows that the batch's tasks read. A topic keeps a post in one partition, which one task reads in order, so of two
writes that tie in the order columns the later one wins.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from tagwright.operators.keyed import merge_newest_fields, newest, newest_fields, plain_fields
from tagwright.session import delete, fits_broadcast, subfolders

MANIFEST = "through BIGINT"
ARRIVAL = ("arrived_batch", "arrived_at")


class KeyedTable:
    """Latest rows by ``key``. With ``merge``, fields that a row lacks keep their old value.

    Without ``order`` columns the order of arrival alone counts.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, key: str, order: list[str], merge: bool = False
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key = key
        self.order = order
        self.merge = merge

    @property
    def state_schema(self) -> StructType:
        """What log and snapshots hold: the key, and structs that start with the order."""
        fields = {field.name: field for field in self.schema.fields}
        arrival = [StructField(name, LongType()) for name in ARRIVAL]
        order = [*[fields[name] for name in self.order], *arrival]
        values = [field for field in self.schema.fields if field.name != self.key and field.name not in self.order]
        if self.merge:
            states = [StructField(field.name, StructType([*order, field])) for field in values]
        else:
            states = [StructField("newest", StructType([*order, *values]))]
        return StructType([fields[self.key], *states])

    def _reduce(self, rows: DataFrame, batch_id: int) -> DataFrame:
        places = [F.lit(batch_id).cast("bigint"), F.monotonically_increasing_id()]
        rows = rows.select(*self.schema.names, *[place.alias(name) for name, place in zip(ARRIVAL, places)])
        return (newest_fields if self.merge else newest)(rows, self.key, [*self.order, *ARRIVAL])

    def _exists(self, path: str) -> bool:
        try:
            self.spark.read.schema(self.state_schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Put the rows of a batch into the log, one per key. Writing a batch again changes nothing."""
        if not rows.isEmpty():
            self._reduce(rows, batch_id).write.mode("overwrite").parquet(f"{self.path}/log/batch_id={batch_id}")

    def upsert(self, stream: DataFrame) -> DataStreamWriter:
        """A writer that feeds this table; give it a checkpoint and a trigger."""
        return stream.writeStream.foreachBatch(self.write_batch)

    def snapshot(self) -> int:
        """The last batch of the newest complete snapshot, -1 if there is none."""
        try:
            manifest = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return -1
            raise
        return manifest.agg(F.coalesce(F.max("through"), F.lit(-1))).first()[0]

    def _log(self) -> DataFrame:
        with_batch = StructType([*self.state_schema.fields, *StructType.fromDDL("batch_id BIGINT").fields])
        return self.spark.read.schema(with_batch).option("basePath", f"{self.path}/log").parquet(f"{self.path}/log")

    def _state(self, through: int | None = None) -> DataFrame:
        """One state per key: the newest snapshot and the log after it, up to batch ``through``.

        While the keys of the log take little room, the rest of the snapshot is read as it is, without a shuffle.
        """
        done = self.snapshot()
        log = self.spark.createDataFrame([], self.state_schema)
        if self._exists(f"{self.path}/log"):
            after = self._log().where(F.col("batch_id") > done)
            log = (after if through is None else after.where(F.col("batch_id") <= through)).drop("batch_id")
        if done < 0:
            return merge_newest_fields(log, self.key)
        snapshot = self.spark.read.schema(self.state_schema).parquet(f"{self.path}/snapshot/through={done}")
        changed = log.select(self.key).distinct()
        if not fits_broadcast(changed, 64 + F.octet_length(F.col(self.key).cast("string"))):
            return merge_newest_fields(snapshot.unionByName(log), self.key)
        keys = F.broadcast(changed)
        old = snapshot.join(keys, self.key, "left_semi")
        same = snapshot.join(keys, self.key, "left_anti")
        return same.unionByName(merge_newest_fields(old.unionByName(log), self.key))

    def read(self) -> DataFrame:
        """The rows of the table now."""
        state = self._state()
        if self.merge:
            return plain_fields(state, self.key)
        return state.select(self.key, "newest.*").select(*self.schema.names)

    def compact(self) -> int | None:
        """Write a snapshot through the last batch in the log. Run it beside the stream, one at a time."""
        done = self.snapshot()
        if not self._exists(f"{self.path}/log"):
            return None
        last = self._log().where(F.col("batch_id") > done).agg(F.max("batch_id")).first()[0]
        # The newest batch may be one that a restart writes again, so it stays in the log.
        if last is None or last - 1 <= done:
            return None
        through = last - 1
        self._state(through).write.mode("overwrite").parquet(f"{self.path}/snapshot/through={through}")
        entry = self.spark.range(1).select(F.lit(through).cast("bigint").alias("through"))
        entry.coalesce(1).write.mode("append").json(f"{self.path}/manifest")
        return through

    def clean(self, older_than: float) -> list[str]:
        """Delete log folders that the newest snapshot covers, and the snapshots before it.

        Only folders that were last changed over ``older_than`` seconds ago go, so give more than the longest read takes.
        """
        done, before = self.snapshot(), time.time() - older_than
        gone = []
        for kind, last in (("log", done), ("snapshot", done - 1)):
            for name, changed in subfolders(self.spark, f"{self.path}/{kind}"):
                if "=" in name and int(name.split("=")[1]) <= last and changed < before:
                    delete(self.spark, f"{self.path}/{kind}/{name}")
                    gone.append(f"{kind}/{name}")
        return gone
