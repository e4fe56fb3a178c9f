"""Documents as numbers of words, block by block, and values of words brought back to them.

A block is a bounded run of documents that one task has read. Within it each distinct word has a number, by
falling frequency, and a document is the array of the numbers of its words. The words of a block are
dealt out by ranges of their hash, packed into one row per range. So a word crosses a shuffle once per block
instead of once per occurrence, all blocks' copies of a word meet in one range, and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import lean

BLOCK_CHARACTERS = 1 << 23  # a longer text is a block of its own
SEGMENT_CHARACTERS = 1 << 24  # of text for each range of hashes
TOKENS_AT_ONCE = 1 << 18
ROWS = (
    "kind int, block long, at int, keys array<long>, flags array<boolean>, data binary, more binary, extra binary"
)
ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("block", pa.int64()),
        ("at", pa.int32()),
        ("keys", pa.list_(pa.int64())),
        ("flags", pa.list_(pa.bool_())),
        ("data", pa.binary()),
        ("more", pa.binary()),
        ("extra", pa.binary()),
    ]
)
KINDS = DOCUMENTS, WORDS, NGRAMS, HASHES = range(4)


class Numbers(dict):
    """Gives every new word the next number."""

    def __missing__(self, word) -> int:
        self[word] = number = len(self)
        return number


def row_of(kind: int, block: int, **columns) -> pa.RecordBatch:
    values = {"kind": kind, "block": block, **columns}
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in ARROW], schema=ARROW)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as planes of equal bytes, compressed; small numbers leave the upper planes empty."""
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def stretched(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def segments_for(source: DataFrame, text: str) -> int:
    """A power of two of ranges, each for a bounded part of the text."""
    size = source.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return 1 << max(4, (size // SEGMENT_CHARACTERS).bit_length())


def spans(groups: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and stop of each run of equal values."""
    edges = np.flatnonzero(np.diff(groups)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(groups)])


class Block:
    """The documents of a block; ``closed`` numbers its words by falling frequency."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.numbers = Numbers()
        self.keys: list[int | None] = []
        self.flags: list[bool] = []
        self.codes: list[np.ndarray] = []

    def add(self, key: int | None, flag: bool, words: list, size: int) -> None:
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.keys.append(key)
        self.flags.append(flag)
        self.size += size

    def closed(self) -> "Block":
        listed = list(self.numbers)
        order = np.argsort(-self._counted(self.codes, len(listed)), kind="stable")
        self.words: list[bytes] = [listed[at] for at in order.tolist()]
        self.numbers.clear()
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        self.codes = [rank[codes] for codes in self.codes]
        self.hashes = word_hashes(self.words)
        return self

    @staticmethod
    def _counted(codes: list[np.ndarray], words: int) -> np.ndarray:
        counts = np.zeros(words, np.int64)
        for part in batched(codes):
            counts += np.bincount(np.concatenate(part), minlength=words)
        return counts

    def flagged(self) -> list[np.ndarray]:
        return [codes for codes, flag in zip(self.codes, self.flags) if flag]

    def document_rows(self) -> Iterator[pa.RecordBatch]:
        """Documents by the hundred thousands of words, with their keys, flags and lengths."""
        at = 0
        for part in batched(self.codes):
            stop = at + len(part)
            lengths = np.array(list(map(len, part)), np.uint32)
            yield row_of(
                DOCUMENTS,
                self.number,
                keys=self.keys[at:stop],
                flags=self.flags[at:stop],
                data=packed(np.concatenate(part)),
                more=packed(lengths),
            )
            at = stop

    def word_rows(self, segments: int) -> Iterator[pa.RecordBatch]:
        """The words of each range of hashes with their numbers and their counts in flagged documents."""
        counts = self._counted(self.flagged(), len(self.words))
        part = (self.hashes >> np.uint64(64 - (segments.bit_length() - 1))).astype(np.int64)
        order = np.argsort(part, kind="stable")
        for start, stop in spans(part[order]) if len(order) else ():
            chosen = order[start:stop]
            own = [self.words[at] for at in chosen.tolist()]
            steps = np.diff(chosen, prepend=0).astype(np.uint32)
            yield row_of(
                WORDS,
                self.number,
                at=int(part[chosen[0]]),
                data=squeezed(b"".join(own)),
                more=packed(np.array(list(map(len, own)), np.uint32)),
                extra=packed(np.concatenate([steps, counts[chosen].astype(np.uint32)])),
            )


def batched(codes: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Documents in lists of a bounded number of words; a longer one is alone."""
    held, size = [], 0
    for one in codes:
        if held and size + len(one) > TOKENS_AT_ONCE:
            yield held
            held, size = [], 0
        held.append(one)
        size += len(one)
    if held:
        yield held


def words_in(row: dict) -> list[bytes]:
    """The words of a row of words."""
    blob, stops = stretched(row["data"]), np.cumsum(unpacked(row["more"], np.uint32)).tolist()
    return [blob[a:b] for a, b in zip([0, *stops[:-1]], stops)]


def numbers_and_counts(extra: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = np.split(unpacked(extra, np.uint32), 2)
    return np.cumsum(steps), counts


def coded(
    docs: DataFrame, split: Callable[[], Callable[[str], list[bytes]]], rows: Callable[[Block], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """The rows that ``rows`` gives for the blocks of ``docs`` (key long, flag boolean, text string).

    ``split()`` is made once per task and gives the words of a text. The number of a block follows from that of its
    task and all else from the order of the rows that it reads, which a scan gives again and again: so a task
    that runs again, or for other kinds of rows, gives the same blocks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        words_of = split()
        block = Block(TaskContext.get().partitionId() << 24)
        for batch in batches:
            for key, flag, text in zip(*batch.columns):
                content = text.as_py()
                if block.keys and block.size + len(content) > BLOCK_CHARACTERS:
                    yield from rows(block.closed())
                    block = Block(block.number + 1)
                    lean()
                block.add(key.as_py(), flag.as_py(), words_of(content), len(content))
        if block.keys:
            yield from rows(block.closed())
        del block
        lean()

    return docs.mapInArrow(work, ROWS)


def stored(rows: DataFrame, path: str) -> dict[int, DataFrame]:
    """The rows written once to ``path``, as one table per kind, each in a folder of its own."""
    spark = rows.sparkSession
    rows.write.partitionBy("kind").parquet(path)
    read = lambda kind: spark.read.schema(ROWS).parquet(path).where(F.col("kind") == kind)
    return {kind: read(kind) for kind in KINDS}


def by_range(words: DataFrame, value: Callable[[list[dict]], Iterator[tuple]], **columns: str) -> DataFrame:
    """``(block, extra, *columns)``: for every row of words its numbers and what ``value`` gives for it.

    ``value`` gets all rows of a range of hashes, so all blocks' copies of its words, and gives the columns, binary or
    long, of one row after the other. A range holds the words of a bounded part of the text.
    """
    kinds = {"binary": pa.binary(), "long": pa.int64()}

    def work(table):
        lean()
        rows = table.to_pylist()
        found = zip(*value(rows))
        given = {
            "block": pa.array([row["block"] for row in rows], pa.int64()),
            "extra": pa.array([row["extra"] for row in rows], pa.binary()),
        }
        return pa.table(given | {name: pa.array(x, kinds[kind]) for (name, kind), x in zip(columns.items(), found)})

    chosen = words.select(F.col("at").alias("segment"), "block", "data", "more", "extra")
    schema = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    return chosen.groupBy("segment").applyInArrow(work, f"block long, extra binary, {schema}")
