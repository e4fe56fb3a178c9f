"""Documents packed into as few sequences of a fixed length as can be found.

Pieces are dealt out at random into blocks of bounded size. Each block is packed by a grouping genetic algorithm on some
islands, rows of a table: between two epochs the best packing of an island goes to the next one by
a join. Pieces of sequences that are left with room are pooled from all blocks and packed again.
"""

from __future__ import annotations

from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.bpe import tokenizer_file, word_table
from tagwright.llm.common import lean, ship, texts
from tagwright.llm.grouping import WELL_FILLED, Packing, evolve, first_packings, least_groups
from tagwright.llm.token_files import chunks
from tagwright.session import written

CAPACITY = 2048
END_ID = 0
BLOCK_PIECES = 2048  # on average
ISLANDS = 3
POPULATION = 4
GENERATIONS = 8  # of an epoch
EPOCHS = 3
GROUP_BITS = 20
ISLANDS_PER_TASK = 32  # rows are few and small, but each takes a fraction of a second
STATE = "block long, island int, sizes array<int>, least int, packings array<binary>, n_groups int, squares long"
ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("island", pa.int32()),
        ("sizes", pa.list_(pa.int32())),
        ("least", pa.int32()),
        ("packings", pa.list_(pa.binary())),
        ("n_groups", pa.int32()),
        ("squares", pa.int64()),
    ]
)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, piece, start, length, ids)``: the ids of every text and its end as pieces of at most ``capacity``.

    A longer document is cut so that all pieces but the first are full. A null text is an empty one, which
    has its end alone. ``ids`` are little-endian unsigned 32-bit numbers.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(tokenizer_file(tokenizer))
    ending = int(end_id).to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(shared.value)
        for batch in batches:
            at = 0
            for part in chunks(batch.column(1).to_pylist()):
                keys = batch.column(0).slice(at, len(part)).to_pylist()
                at += len(part)
                rows = []
                for own, ids in zip(keys, table.encode(part)):
                    ids += ending
                    n = len(ids) // 4
                    starts = [0, *range(n % capacity or capacity, n, capacity)]
                    for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], n])):
                        rows.append((own, piece, start, stop - start, ids[4 * start : 4 * stop]))
                kinds = (batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "piece", "start", "length", "ids"])
        lean()

    source = texts(docs, key, text=text)
    kind = dict(source.dtypes)[key]
    return source.mapInArrow(work, f"`{key}` {kind}, piece int, start long, length long, ids binary")


def _state(block: int, island: int, sizes: list[int], least: int, found: list[Packing]) -> pa.RecordBatch:
    groups, squares = found[0].fitness
    row = dict(zip(ARROW.names, (block, island, sizes, least, [one.to_bytes() for one in found], -groups, squares)))
    return pa.RecordBatch.from_pylist([row], schema=ARROW)


def _settled(blocks: DataFrame, n_blocks: int, capacity: int) -> DataFrame:
    """``(block, best)``: the packing of each block ``(block, sizes)`` after all epochs, from its best island."""
    n_tasks = 1 + n_blocks * ISLANDS // ISLANDS_PER_TASK

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, island, sizes = row["block"], row["island"], row["sizes"]
                least = least_groups(np.array(sizes), capacity)
                source = Random(f"{block} {island} 0")
                found = first_packings(sizes, capacity, POPULATION, source, plain=island == 0)
                yield _state(block, island, sizes, least, evolve(found, least, GENERATIONS, source))

    def go_on(epoch: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    block, island, sizes, least = row["block"], row["island"], row["sizes"], row["least"]
                    given = [*row["packings"][:-1], row["migrant"]] if len(row["packings"]) > 1 else row["packings"]
                    found = [Packing.from_bytes(sizes, capacity, one) for one in given]
                    source = Random(f"{block} {island} {epoch}")
                    yield _state(block, island, sizes, least, evolve(found, least, GENERATIONS, source))

        return work

    islands = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    islands = islands.select("block", "island", "sizes").repartition(n_tasks, "block", "island")
    state = written(islands.mapInArrow(start, STATE), "islands")
    for epoch in range(1, EPOCHS):
        # a block whose best island is proven best rests
        open_blocks = state.groupBy("block").agg(F.min(F.col("n_groups") - F.col("least")).alias("over")).where("over > 0")
        going = state.join(open_blocks.select("block"), "block")
        migrants = going.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("packings")[0].alias("migrant"))
        met = going.join(migrants, ["block", "island"]).repartition(n_tasks, "block", "island")
        moved = written(met.mapInArrow(go_on(epoch), STATE), "islands")
        if moved.isEmpty():
            break
        resting = state.join(open_blocks.select("block"), "block", "left_anti")
        state = written(resting.unionByName(moved), "islands")
    order = F.struct(-F.col("n_groups"), F.col("squares"), -F.col("island"))
    return state.groupBy("block").agg(F.max_by(F.col("packings")[0], order).alias("best"))


def _packed_once(items: DataFrame, n_items: int, capacity: int, first_block: int) -> tuple[DataFrame, int]:
    """``(number, size, sequence_id, offset, fill)`` of ``items`` (number, size), and how many blocks were used."""
    n_blocks = max(1, -(-n_items // BLOCK_PIECES))
    dealt = items.select((F.pmod(F.xxhash64("number", F.lit(first_block)), F.lit(n_blocks)) + first_block).alias("block"), "number", "size")
    listed = F.sort_array(F.collect_list(F.struct("number", F.col("size").cast("int").alias("size"))))
    blocks = dealt.groupBy("block").agg(listed.alias("items"))
    blocks = written(blocks.select("block", F.col("items.number").alias("numbers"), F.col("items.size").alias("sizes")), "blocks")
    best = _settled(blocks.select("block", "sizes"), n_blocks, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                groups = np.frombuffer(row["best"], "<u4").astype(np.int64)
                order = np.argsort(groups, kind="stable")
                ends = np.cumsum(sizes[order])
                firsts = np.concatenate([[0], np.flatnonzero(np.diff(groups[order])) + 1])
                starts = np.repeat(ends[firsts] - sizes[order][firsts], np.diff([*firsts, len(order)]))
                fills = np.bincount(groups, weights=sizes).astype(np.int64)
                columns = [
                    pa.array(np.array(row["numbers"], np.int64)[order]),
                    pa.array(sizes[order]),
                    pa.array((row["block"] << GROUP_BITS) + groups[order]),
                    pa.array(ends - sizes[order] - starts),
                    pa.array(fills[groups[order]]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["number", "size", "sequence_id", "offset", "fill"])

    schema = "number long, size long, sequence_id long, offset long, fill long"
    placed = blocks.join(best, "block").select("block", "numbers", "sizes", "best").mapInArrow(place, schema)
    return written(placed, "placed"), n_blocks


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(number, sequence_id, offset)`` of ``items`` (number, size), sizes from 1 to ``capacity``.

    ``number`` must be unique, and ``items`` a written table. Full items are sequences by themselves, with ids below
    zero. Offsets of a sequence follow each other from 0. An empty table gives no rows.
    """
    ship(items.sparkSession)
    whole = items.where(F.col("size") >= capacity)
    full = whole.select("number", (-F.col("number") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pool = items.where(F.col("size") < capacity)
    n_pool, used, done = pool.count(), 0, []
    if not n_pool:
        return full
    placed, n_blocks = _packed_once(pool, n_pool, capacity, used)
    while n_blocks > 1:
        used += n_blocks
        left = placed.where(F.col("fill") < WELL_FILLED * capacity)
        sequences = lambda df: df.select(F.count(F.lit(1)), F.sum((F.col("offset") == 0).cast("int"))).first()
        n_left, n_before = sequences(left)
        if not n_left or n_left == n_pool:
            break
        again, n_blocks = _packed_once(left.select("number", "size"), n_left, capacity, used)
        if sequences(again)[1] >= n_before:
            break
        done.append(placed.where(F.col("fill") >= WELL_FILLED * capacity))
        placed, n_pool = again, n_left
    found = full
    for part in [*done, placed]:
        found = found.unionByName(part.select("number", "sequence_id", "offset"))
    return found


def numbered_pieces(pieces: DataFrame) -> DataFrame:
    """``pieces`` written with a unique ``number`` each."""
    return written(pieces.withColumn("number", F.monotonically_increasing_id()), "pieces")


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``(sequence_id, ids, doc_ids, offsets)``: the sequences themselves, with the documents in each and where they begin."""
    pieces = numbered_pieces(token_pieces(docs, tokenizer, capacity))
    places = pack(pieces.select("number", F.col("length").alias("size")), capacity)
    row = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    # a sequence has no more pieces than tokens
    rows = pieces.join(places, "number").groupBy("sequence_id").agg(row.alias("rows"))
    joined = F.aggregate("rows.ids", F.lit(b""), lambda a, b: F.concat(a, b))
    return rows.select("sequence_id", joined.alias("ids"), F.col("rows.doc_id").alias("doc_ids"), F.col("rows.offset").alias("offsets"))


def document_packing(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Where each piece of every document is packed, with the checksum of its ids."""
    cut = token_pieces(docs.select("doc_id", "text"), tokenizer)
    pieces = numbered_pieces(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    places = pack(pieces.select("number", F.col("length").alias("size")))
    return pieces.join(places, "number").drop("number")
