"""A keyed table in buckets and levels: a compaction rewrites, and a read or lookup touches, what has changed.

Keys are dealt out to buckets by a hash. A batch of the log has a folder for each bucket that it touches, and a bucket has
at most one run of files per level, each level some times larger than the one above. A compaction merges the log of a
bucket with its upper levels into the first level that holds the result; other buckets and the levels
below stay as they are, so a row is rewritten a bounded number of times per level instead of every time.

The edits are the table of contents: one row per bucket and level that a compaction has changed, all written as one
file when the run is complete. The newest edit of a level counts. Files of a run are sorted by key and
have a Bloom filter on it, so a lookup opens one bucket and reads the row groups that may hold the key.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagwright.operators.keyed import merge_newest_fields, plain_fields
from tagwright.session import delete, exists, fits_broadcast, subfolders, written
from tagwright.streaming.upsert import KeyedTable

BUCKETS = 64
FANOUT = 8
LEVEL_ROWS = 1 << 20  # of a bucket's first level
FILE_ROWS = 1 << 22
EDITS = "version BIGINT, bucket INT, level INT, run BIGINT, n_rows BIGINT, through BIGINT"


@dataclass(frozen=True)
class Contents:
    """What a table is made of: ``runs`` has run and rows of (bucket, level), ``through`` the last merged batch of a bucket."""

    version: int
    runs: dict[tuple[int, int], tuple[int, int]]
    through: dict[int, int]

    def levels(self, bucket: int) -> list[int]:
        return sorted(level for own, level in self.runs if own == bucket)


class LeveledTable(KeyedTable):
    """As ``KeyedTable``, in ``buckets`` and levels; a level holds ``fanout`` times the rows of the one above."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        key: str,
        order: list[str],
        merge: bool = False,
        buckets: int = BUCKETS,
        fanout: int = FANOUT,
        level_rows: int = LEVEL_ROWS,
        file_rows: int = FILE_ROWS,
        writer_options: dict[str, str] | None = None,
    ):
        super().__init__(spark, path, schema, key, order, merge)
        self.buckets = buckets
        self.fanout = fanout
        self.level_rows = level_rows
        self.file_rows = file_rows
        self.writer_options = {
            f"parquet.bloom.filter.enabled#{key}": "true",
            f"parquet.bloom.filter.expected.ndv#{key}": str(file_rows),
            f"parquet.enable.dictionary#{key}": "false",
            **(writer_options or {}),
        }

    # Writing

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, states: DataFrame, path: str, *folders: str) -> None:
        """Write states, one per key of a folder, in the order of the key."""
        ordered = states.sortWithinPartitions(*folders, self.key)
        options = {"partitionOverwriteMode": "static", **self.writer_options}
        ordered.write.mode("overwrite").options(**options).partitionBy(*folders).parquet(path)

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Put the rows of a batch into the log, one per key, below its bucket. Writing a batch again changes nothing."""
        if not rows.isEmpty():
            states = self._reduce(rows, batch_id).withColumn("bucket", self.bucket_of(F.col(self.key)))
            self._write(states.repartition("bucket"), f"{self.path}/log/batch_id={batch_id}", "bucket")

    # The table of contents

    def contents(self) -> Contents:
        """The runs that count now, at most one for each bucket and level."""
        if not exists(self.spark, f"{self.path}/edits"):
            return Contents(0, {}, {})
        edits = self.spark.read.schema(EDITS).json(f"{self.path}/edits")
        last = edits.groupBy("bucket", "level").agg(F.max(F.struct("version", "run", "n_rows", "through")).alias("last"))
        rows = last.select("bucket", "level", "last.*").collect()
        through: dict[int, int] = {}
        for row in rows:
            through[row["bucket"]] = max(row["through"], through.get(row["bucket"], -1))
        runs = {(row["bucket"], row["level"]): (row["run"], row["n_rows"]) for row in rows if row["run"] is not None}
        return Contents(max((row["version"] for row in rows), default=0), runs, through)

    def _batches(self) -> dict[int, list[int]]:
        """The buckets that each batch of the log has touched."""
        found = {}
        for name, _ in subfolders(self.spark, f"{self.path}/log"):
            if name.startswith("batch_id="):
                inside = subfolders(self.spark, f"{self.path}/log/{name}")
                found[int(name.split("=")[1])] = [int(own.split("=")[1]) for own, _ in inside if own.startswith("bucket=")]
        return found

    def _logged(self, contents: Contents, last: int | None = None) -> dict[int, list[int]]:
        """The batches of each bucket that are not merged yet, up to ``last``."""
        found: dict[int, list[int]] = {}
        for batch, buckets in sorted(self._batches().items()):
            for bucket in buckets:
                if batch > contents.through.get(bucket, -1) and (last is None or batch <= last):
                    found.setdefault(bucket, []).append(batch)
        return found

    # Reading

    def _run_folder(self, contents: Contents, bucket: int, level: int) -> str:
        return f"{self.path}/runs/run={contents.runs[bucket, level][0]}/level={level}/bucket={bucket}"

    def _log_folders(self, bucket: int, batches: list[int]) -> list[str]:
        return [f"{self.path}/log/batch_id={batch}/bucket={bucket}" for batch in batches]

    def _states(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.state_schema)
        return self.spark.read.schema(self.state_schema).parquet(*folders)

    def _parts(self, wanted: set[int] | None = None) -> tuple[list[str], list[str], list[str]]:
        """Folders of ``wanted`` buckets: those whose keys are nowhere else, lowest levels of the others, all above these."""
        contents = self.contents()
        logged = self._logged(contents)
        buckets = {bucket for bucket, _ in contents.runs} | set(logged)
        settled, lowest, upper = [], [], []
        for bucket in sorted(buckets if wanted is None else buckets & wanted):
            runs = [self._run_folder(contents, bucket, level) for level in contents.levels(bucket)]
            log = self._log_folders(bucket, logged.get(bucket, []))
            if len(runs) + len(log) == 1:
                settled += runs + log
            else:
                lowest += runs[-1:]
                upper += runs[:-1] + log
        return settled, lowest, upper

    def _state(self, through: int | None = None, wanted: set[int] | None = None, keep=lambda states: states) -> DataFrame:
        """One state per key of the ``wanted`` buckets; ``keep`` is applied to all files before they are merged.

        Buckets in one piece are read as they are. Of the others the lowest level, by far the largest, is read without a
        shuffle while the keys above it take little room.
        """
        settled, lowest, upper = map(lambda folders: keep(self._states(folders)), self._parts(wanted))
        changed = upper.select(self.key).distinct()
        if not fits_broadcast(changed, 64 + F.octet_length(F.col(self.key).cast("string"))):
            return settled.unionByName(merge_newest_fields(lowest.unionByName(upper), self.key))
        keys = F.broadcast(changed)
        same = lowest.join(keys, self.key, "left_anti")
        old = lowest.join(keys, self.key, "left_semi")
        return settled.unionByName(same).unionByName(merge_newest_fields(old.unionByName(upper), self.key))

    def _rows(self, states: DataFrame) -> DataFrame:
        if self.merge:
            return plain_fields(states, self.key)
        return states.select(self.key, "newest.*").select(*self.schema.names)

    def read(self) -> DataFrame:
        """The rows of the table now."""
        return self._rows(self._state())

    def get(self, value) -> DataFrame:
        """The row of one key, none if it is not stored. Only the files of its bucket are opened, with a filter on the key."""
        kind = self.schema[self.key].dataType
        literal = F.lit(value).cast(kind)
        bucket = self.spark.range(1).select(self.bucket_of(literal)).first()[0]
        settled, lowest, upper = self._parts({bucket})
        states = self._states(settled + lowest + upper).where(F.col(self.key) == literal)
        return self._rows(states if settled else merge_newest_fields(states, self.key))

    def lookup(self, requests: DataFrame) -> DataFrame:
        """The rows of the distinct keys of ``requests``; keys that are not stored have nulls. A null key is none.

        Only buckets with a requested key are read. While the keys fit a broadcast, all else is left out before rows
        are merged.
        """
        keys = requests.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        keys = written(keys.withColumn("bucket", self.bucket_of(F.col(self.key))), "requested")
        wanted = {row["bucket"] for row in keys.select("bucket").distinct().collect()}  # one number per bucket at most
        only = keys.select(self.key)
        if fits_broadcast(only, 64 + F.octet_length(F.col(self.key).cast("string"))):
            only = F.broadcast(only)
        rows = self._rows(self._state(wanted=wanted, keep=lambda found: found.join(only, self.key, "left_semi")))
        return only.join(rows, self.key, "left").select(*rows.columns)

    # Compaction

    def _target(self, contents: Contents, bucket: int, n_rows: int) -> int:
        """The level that a merge of ``n_rows`` of the log and all levels up to it ends in."""
        level, room = 1, self.level_rows
        while True:
            n_rows += contents.runs.get((bucket, level), (0, 0))[1]
            if n_rows <= room:
                return level
            level, room = level + 1, room * self.fanout

    def compact(self) -> int | None:
        """Merge the log of the buckets that have any, up to the last batch but one, and return that batch.

        Run it beside the stream, one at a time. The newest batch may be one that a restart writes again, so it stays
        in the log. A run that was not finished is written over.
        """
        contents = self.contents()
        batches = self._batches()
        if not batches:
            return None
        last = max(batches) - 1
        logged = self._logged(contents, last)
        if not logged:
            return None
        log = self._states([folder for bucket, own in logged.items() for folder in self._log_folders(bucket, own)])
        counts = log.groupBy(self.bucket_of(F.col(self.key)).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
        sizes = {row["bucket"]: row["n"] for row in counts}
        targets = {bucket: self._target(contents, bucket, sizes.get(bucket, 0)) for bucket in logged}
        merged = {(bucket, level) for bucket, level in contents.runs if level <= targets.get(bucket, 0)}
        version = contents.version + 1
        rows = {bucket: sizes.get(bucket, 0) + sum(contents.runs[at][1] for at in merged if at[0] == bucket) for bucket in targets}
        self._merge(
            log.unionByName(self._states([self._run_folder(contents, *at) for at in sorted(merged)])), targets, rows, version
        )
        run = self.spark.read.schema("level INT, bucket INT").parquet(f"{self.path}/runs/run={version}")
        kept = {row["bucket"]: row["n"] for row in run.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        edits = [(version, bucket, level, version, kept.get(bucket, 0), last) for bucket, level in targets.items()]
        edits += [(version, bucket, level, None, 0, last) for bucket, level in sorted(merged) if level != targets[bucket]]
        self.spark.createDataFrame(edits, EDITS).coalesce(1).write.mode("append").json(f"{self.path}/edits")
        return last

    def _merge(self, states: DataFrame, targets: dict[int, int], rows: dict[int, int], version: int) -> None:
        """Write one state per key to the target level of its bucket, in as many files as its rows need.

        Rows are dealt out once, by bucket and slice of it, and merged there.
        """
        # one number per bucket, as a constant
        of_bucket = lambda values: F.element_at(
            F.from_json(F.lit(json.dumps(values)), "map<string,int>"), F.col("bucket").cast("string")
        )
        slices = of_bucket({bucket: -(-n // self.file_rows) for bucket, n in rows.items()})
        placed = states.withColumn("bucket", self.bucket_of(F.col(self.key)))
        slice_of = F.pmod(F.xxhash64(F.lit(version), self.key), F.greatest(slices, F.lit(1)))
        placed = placed.withColumn("slice", slice_of.cast("int"))
        dealt = placed.repartition("bucket", "slice")
        values = [field.name for field in self.state_schema.fields if field.name != self.key]
        merged = dealt.groupBy("bucket", "slice", self.key).agg(*[F.max(name).alias(name) for name in values])
        levelled = merged.drop("slice").withColumn("level", of_bucket(targets))
        self._write(levelled, f"{self.path}/runs/run={version}", "level", "bucket")

    def snapshot(self) -> int:
        """The last batch that all buckets of the log have merged, -1 if there is none."""
        contents = self.contents()
        merged = -1
        for batch, buckets in sorted(self._batches().items()):
            if any(batch > contents.through.get(bucket, -1) for bucket in buckets):
                break
            merged = batch
        return max(merged, min(contents.through.values(), default=-1)) if contents.through else merged

    def clean(self, older_than: float) -> list[str]:
        """Delete merged log folders and the files of runs that no longer count.

        Only folders that were last changed over ``older_than`` seconds ago go, so give more than the longest read takes.
        """
        contents, before, gone = self.contents(), time.time() - older_than, []

        def drop(name: str, changed: float) -> None:
            if changed < before:
                delete(self.spark, f"{self.path}/{name}")
                gone.append(name)

        for batch, _ in subfolders(self.spark, f"{self.path}/log"):
            for own, changed in subfolders(self.spark, f"{self.path}/log/{batch}"):
                if "=" in own and int(batch.split("=")[1]) <= contents.through.get(int(own.split("=")[1]), -1):
                    drop(f"log/{batch}/{own}", changed)
        live = {(run, level, bucket) for (bucket, level), (run, _) in contents.runs.items()}
        for run, _ in subfolders(self.spark, f"{self.path}/runs"):
            number = int(run.split("=")[1])
            if number > contents.version:  # being written
                continue
            for level, _ in subfolders(self.spark, f"{self.path}/runs/{run}"):
                for own, changed in subfolders(self.spark, f"{self.path}/runs/{run}/{level}"):
                    if (number, int(level.split("=")[1]), int(own.split("=")[1])) not in live:
                        drop(f"runs/{run}/{level}/{own}", changed)
        return gone
