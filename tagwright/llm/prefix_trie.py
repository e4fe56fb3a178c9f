"""The trie of shared prefixes of conversations, with few of the prefixes shuffled.

A prefix has a digest of 128 bits. A count-min sketch over all digests is sent to the workers: a prefix
whose estimate is one belongs to one conversation alone, so its node is emitted where the prefix was read. Only
prefixes that may be shared are shuffled and grouped exactly, so a wrong estimate costs time, not results.

A conversation may have any number of turns and a prefix any number of conversations: along a
conversation values are summed in chunks, and rows meet their node by a join that keeps the hot nodes in place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagwright.llm.common import attach, numbered, ship, word_count
from tagwright.session import spread, written

STEP_BITS = 12  # a chunk of a conversation has 4,096 turns
SKETCH_ROWS = 4
CELLS_PER_PREFIX = 4  # in each row of the sketch
MOST_CELLS = 1 << 27  # in each row, so a sketch takes 64 MB at most
SLICE_BITS = 16
PREFIXES_AT_ONCE = 1 << 18
NODE = ["depth", "d1", "d2"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# Rebuilt conversations


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """``(conv, turn, t1, t2, words)``: two hashes of role and text, of which null ones are empty, and the words.

    Rows without a ``conv_id`` belong to no conversation and are left out.
    """
    filled = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    hashed = [F.xxhash64(F.lit(at), "role", "text").alias(f"t{at}") for at in (1, 2)]
    return spread(filled).select("conv", "turn", *hashed, word_count(F.col("text")).alias("words"))


def rebuilt(conversations: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: ``(conv, depth, length, t1, t2, words)`` and ``(conv, length)``.

    Conversation c takes the first h turns of the one numbered c - c mod ``every``, and then its own after its first
    h, where h is the crc32 of its decimal number modulo ``most``. Turns that tie are in the order of their hashes.
    A number below zero counts on to the next lower multiple.
    """
    ordered = numbered(conversation_turns(conversations), "conv", "turn", "t1", "t2", purpose="turns")
    convs = ordered.groupBy("conv").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    convs = convs.withColumns(
        {
            "h": F.crc32(F.col("conv").cast("string").cast("binary")) % most,
            "base": F.col("conv") - F.pmod("conv", F.lit(every)),
        }
    )
    lengths = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(lengths, "base", "left").withColumn("taken", taken)
    convs = written(convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    # rows meet their conversation chunk by chunk, so that a long one is spread
    chunk = lambda row: F.shiftright(row, STEP_BITS)
    chunks = F.explode(F.sequence(chunk(F.col("first")), chunk(F.col("first") + F.col("n") - 1))).alias("chunk")
    own = ordered.withColumn("chunk", chunk(F.col("row"))).join(convs.select("*", chunks), ["conv", "chunk"])
    own = own.withColumn("at", F.col("row") - F.col("first") + 1)
    values = ["t1", "t2", "words"]
    kept = own.where("at > h").select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "length", *values)
    heads = own.where((F.col("conv") == F.col("base")) & (F.col("at") < most)).select("base", "at", *values)
    borrowed = convs.select("conv", "base", "taken", "length").join(heads, "base").where("at <= taken")
    borrowed = borrowed.select("conv", F.col("at").alias("depth"), "length", *values)
    return written(kept.unionByName(borrowed), "rebuilt-turns"), convs.select("conv", "length")


# Values along a conversation


def along(
    rows: DataFrame,
    values: list[str],
    total: Callable[[str], Column],
    both: Callable[[Column, Column], Column],
    backwards: bool = False,
) -> DataFrame:
    """``rows`` with each of ``values`` replaced by its ``total`` over the conversation up to this row.

    ``both`` adds up two totals. Totals are taken within chunks and then over the chunks before, of which only
    conversations of more than one have any. ``rows`` must be a written table.
    """
    order = (lambda name: F.col(name).desc()) if backwards else F.col
    chunked = rows.withColumn("chunk", F.shiftright("depth", STEP_BITS))
    inside = Window.partitionBy("conv", "chunk").orderBy(order("depth")).rowsBetween(Window.unboundedPreceding, 0)
    summed = chunked.withColumns({name: total(name).over(inside) for name in values})
    many = chunked.where(F.col("length") >= 1 << STEP_BITS)
    sums = many.groupBy("conv", "chunk").agg(*[total(name).alias(name) for name in values])
    earlier = Window.partitionBy("conv").orderBy(order("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv", "chunk", *[total(name).over(earlier).alias(f"{name}_before") for name in values])
    joined = summed.join(offsets, ["conv", "chunk"], "left")
    added = {name: both(F.col(name), F.coalesce(f"{name}_before", F.lit(0))) for name in values}
    return joined.withColumns(added).select(*rows.columns)


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, depth, length, d1, d2, parent1, parent2, words)``: the digests of each prefix and of the one before.

    A digest is the exclusive or of a hash of each turn with its place, so it can be taken in parts.
    """
    placed = [F.xxhash64(F.lit(at), "depth", "t1", "t2").alias(f"x{at}") for at in (1, 2)]
    hashed = written(turns.select("conv", "depth", "length", *placed, "words"), "turn-hashes")
    doubled = hashed.withColumns({"d1": F.col("x1"), "d2": F.col("x2")})
    summed = along(doubled, ["d1", "d2"], F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    parents = [F.col(f"d{at}").bitwiseXOR(F.col(f"x{at}")).alias(f"parent{at}") for at in (1, 2)]
    return written(summed.select("conv", "depth", "length", "d1", "d2", *parents, "words"), "prefixes")


# Screening


class Sketch:
    """A count-min sketch whose counters stop at two: all that is asked is whether an estimate is one."""

    def __init__(self, cells: int, twice: np.ndarray):
        self.cells = cells  # in a row, a power of two
        self.twice = twice  # a bit for each counter that has reached two

    @staticmethod
    def places(d1: np.ndarray, d2: np.ndarray, cells: int) -> np.ndarray:
        """The counter of each digest in each row of the sketch."""
        rows = np.arange(SKETCH_ROWS, dtype=np.uint64)[:, None]
        found = (d1 + rows * (d2 | np.uint64(1))) & np.uint64(cells - 1)
        return (found + rows * np.uint64(cells)).astype(np.int64)

    def shared(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """Whether the estimate, the least counter of a digest, is over one."""
        places = self.places(d1, d2, self.cells)
        return ((self.twice[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=0)


def _digests(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for name in names]


def fit_sketch(digests: DataFrame) -> Sketch:
    """The sketch of all rows ``(d1, d2)``. It grows with them up to 64 MB.

    A task counts what it reads by slices of counters; the counts of a slice are added up as a stream of rows. Beyond the
    64 MB more counters are shared, so more prefixes count as possibly shared, and the nodes stay the same.
    """
    spark = digests.sparkSession
    wanted = max(1 << 10, digests.count() * CELLS_PER_PREFIX)
    cells = min(MOST_CELLS, 1 << (wanted - 1).bit_length())

    def counted(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        places, n = np.unique(np.concatenate(parts), return_counts=True)
        edges = np.flatnonzero(np.diff(places >> SLICE_BITS)) + 1
        for own, counts in zip(np.split(places, edges), np.split(np.minimum(n, 2).astype(np.uint8), edges)):
            offsets = (own & ((1 << SLICE_BITS) - 1)).astype("<u2")
            values = [[int(own[0] >> SLICE_BITS)], [offsets.tobytes()], [counts.tobytes()]]
            columns = [pa.array(x, kind) for x, kind in zip(values, (pa.int32(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "offsets", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(Sketch.places(*_digests(batch, "d1", "d2"), cells).ravel())
            size += batch.num_rows
            if size >= PREFIXES_AT_ONCE:
                yield from counted(held)
                held, size = [], 0
        if size:
            yield from counted(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for number, own in groupby(rows, key=lambda row: row["slice"]):
            counters = np.zeros(1 << SLICE_BITS, np.uint8)
            for row in own:
                offsets = np.frombuffer(row["offsets"], "<u2")
                counters[offsets] = np.minimum(counters[offsets] + np.frombuffer(row["counts"], np.uint8), 2)
            bits = np.packbits(counters == 2, bitorder="little").tobytes()
            columns = [pa.array([number], pa.int32()), pa.array([bits], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "bits"])

    partial = digests.select("d1", "d2").mapInArrow(count, "slice int, offsets binary, counts binary")
    slices = partial.repartition("slice").sortWithinPartitions("slice").mapInArrow(add, "slice int, bits binary")
    size = 1 << (SLICE_BITS - 3)
    twice = np.zeros(max(SKETCH_ROWS * cells // 8, size), np.uint8)
    for row in slices.collect():  # a bit for each counter, 64 MB at most
        twice[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return Sketch(cells, twice)


def screened(found: DataFrame, sketch: Sketch) -> DataFrame:
    """``found`` with ``shared`` and ``parent_shared``: whether the prefix, and the one before it, may be shared.

    The prefix without a turn, which all conversations have, counts as shared.
    """
    shared = found.sparkSession.sparkContext.broadcast(sketch)
    names = found.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, parents = _digests(batch, "d1", "d2"), _digests(batch, "parent1", "parent2")
            first = batch.column("depth").to_numpy(zero_copy_only=False) == 1
            flags = [shared.value.shared(*own), shared.value.shared(*parents) | first]
            columns = [*batch.columns, *[pa.array(flag.astype(bool), pa.bool_()) for flag in flags]]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "shared", "parent_shared"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in found.dtypes)
    return found.mapInArrow(work, f"{kinds}, shared boolean, parent_shared boolean")


# Nodes


def end_digests(ends: DataFrame) -> DataFrame:
    """``(*NODE, ends_sha256)`` from ``(*NODE, conv)``: the digest of a node's numbers in rising order.

    The rows are dealt out by ranges of node and number, so the numbers of a hot node are written out in many
    tasks; the digest then reads these texts one after the other, in memory that does not grow with them.
    """

    def write_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            node_columns = [batch.column(name).to_pylist() for name in NODE]
            rows = zip(zip(*node_columns), batch.column("conv").to_pylist())
            for node, run in groupby(rows, key=lambda row: row[0]):
                values = [*node, part, at, ",".join(str(conv) for _, conv in run)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
                columns = [pa.array([value], kind) for value, kind in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[*NODE, "part", "at", "ids"])
                at += 1

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns]))
        for node, run in groupby(rows, key=lambda row: row[:3]):
            state, between = hashlib.sha256(), b""
            for row in run:
                state.update(between + row[5].encode())
                between = b","
            columns = [pa.array([value], pa.int64()) for value in node] + [pa.array([state.hexdigest()], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*NODE, "ends_sha256"])

    kinds = "depth long, d1 long, d2 long"
    ordered = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    texts = ordered.mapInArrow(write_out, f"{kinds}, part int, at long, ids string")
    runs = texts.repartition(*NODE).sortWithinPartitions(*NODE, "part", "at")
    return runs.mapInArrow(digest, f"{kinds}, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations, from the one without a turn.

    ``turns`` has ``(conv, depth, length, t1, t2, words)``, depth from 1 without gaps, ``convs`` each ``(conv, length)``.
    ``conv_id`` is the least member of a node, ``n_convs`` its members, ``n_children`` the nodes one turn longer,
    ``n_leaves`` the nodes without children in its subtree, ``saved_tokens`` the words that the subtree's nodes
    need not be read again, ``ends_sha256`` the digest of the members that end here. No conversation, no node.
    """
    ship(turns.sparkSession)
    found = prefixes(turns)
    rows = written(screened(found, fit_sketch(found)), "screened")
    zero = F.lit(0).cast("long")
    root = convs.select("conv", zero.alias("depth"), F.col("length").cast("long"), *[zero.alias(n) for n in ("d1", "d2", "parent1", "parent2", "words")])
    roots = root.withColumns({"shared": F.lit(True), "parent_shared": F.lit(False)})
    maybe = written(rows.where("shared").unionByName(roots), "possibly-shared")
    alone = rows.where("NOT shared")
    tops = alone.where("parent_shared")

    ends_here = F.col("depth") == F.col("length")
    nodes = maybe.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv").alias("least"),
        F.max("words").alias("words"),
        F.max("parent1").alias("parent1"),
        F.max("parent2").alias("parent2"),
        F.max("parent_shared").alias("parent_shared"),
    )
    above = [(F.col("depth") - 1).alias("depth"), F.col("parent1").alias("d1"), F.col("parent2").alias("d2")]
    nodes = written(nodes, "nodes")
    below = nodes.where("parent_shared").select(*above, F.lit(1).alias("node"), F.lit(0).alias("top"))
    below = below.unionByName(tops.select(*above, F.lit(0).alias("node"), F.lit(1).alias("top")))
    children = below.groupBy(*NODE).agg(F.sum("node").alias("n_nodes"), F.sum("top").alias("n_tops"))
    full = nodes.join(children, NODE, "left").na.fill(0, ["n_nodes", "n_tops"])
    full = written(full.withColumn("n_children", F.col("n_nodes") + F.col("n_tops")), "full-nodes")

    # what a node adds to all nodes above it is summed along the path of its least member
    facts = full.select(*NODE, "least", "n_children", F.col("n"), F.col("n").alias("n_rows"))
    met = attach(maybe, facts, NODE, "n_rows")
    first = F.col("conv") == F.col("least")
    own = met.select(
        "conv",
        "length",
        *NODE,
        F.when(first & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("n_leaves"),
        F.when(first, (F.col("n") - 1) * F.col("words")).otherwise(0).alias("saved_tokens"),
        F.lit(True).alias("node"),
    )
    single_ends = alone.where(ends_here).select(
        "conv", "length", *NODE, F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), F.lit(False).alias("node")
    )
    summed = along(written(own.unionByName(single_ends), "node-sums"), ["n_leaves", "saved_tokens"], F.sum, lambda a, b: a + b, True)
    subtrees = summed.where("node").groupBy(*NODE).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    ends = end_digests(maybe.where(ends_here))
    full = full.join(subtrees, NODE).join(ends, NODE, "left")

    def out(nodes: DataFrame, conv: str, parent: Column, n: Column, children: Column, leaves: Column, saved: Column, end: Column):
        columns = dict(depth="depth", n_convs=n, n_children=children, n_leaves=leaves, saved_tokens=saved)
        named = [F.col(conv).alias("conv_id"), parent.cast("long").alias("parent_conv_id")]
        named += [(F.col(c) if isinstance(c, str) else c).cast("long").alias(name) for name, c in columns.items()]
        return nodes.select(*named, end.alias("ends_sha256"))

    # a parent is met by its key; if it belongs to one conversation alone, it is the child's own
    ups = lambda count: full_parents.select(*NODE, F.col("least").alias("parent"), F.col(count).alias("n_rows")).where("n_rows > 0")
    full_parents = written(full, "subtrees")
    below_shared = written(
        full_parents.where("parent_shared").select(
            *above, F.col("depth").alias("own_depth"), "least", "n", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
        ),
        "lower-nodes",
    )
    lower = attach(below_shared, ups("n_nodes"), NODE, "n_rows").drop("depth").withColumnRenamed("own_depth", "depth")
    upper = full_parents.where("NOT parent_shared").withColumn("parent", F.when(F.col("depth") > 0, F.col("least")))
    common = [F.col(c) for c in ("n", "n_children", "n_leaves", "saved_tokens")] + [F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))]
    grouped = [out(one, "least", F.col("parent"), *common) for one in (lower, upper)]

    alone_values = [
        F.lit(1),
        (~ends_here).cast("long"),
        F.lit(1),
        F.lit(0),
        F.when(ends_here, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(EMPTY_SHA256),
    ]
    top_rows = tops.select("conv", "length", *above, F.col("depth").alias("own_depth"))
    met_tops = attach(top_rows, ups("n_tops"), NODE, "n_rows").drop("depth").withColumnRenamed("own_depth", "depth")
    tails = alone.where("NOT parent_shared")
    local = [out(met_tops, "conv", F.col("parent"), *alone_values), out(tails, "conv", F.col("conv"), *alone_values)]
    return grouped[0].unionByName(grouped[1]).unionByName(local[0]).unionByName(local[1])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Turns are in the order of ``turn``, null first; a null role or text is empty; rows without a ``conv_id`` are left
    out. Repeated rows are turns like any other. An empty table gives no rows.
    """
    return prefix_trie(*rebuilt(conversations))
