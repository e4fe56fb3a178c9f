"""Files of token ids: a shared dictionary, a compressed frame per document and an offset index."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagwright.llm.bpe import tokenizer_file, word_table
from tagwright.llm.common import hash_sample, ship, texts
from tagwright.session import written

END_ID = 2
LEVEL = 3
DICTIONARY_BYTES = 64 * 1024
SAMPLE_ROWS = 2000  # documents that the dictionary is trained on, picked by a hash of the text
SAMPLE_BYTES = 32 * 1024  # longest serialized array among them: short documents are what a dictionary is for
BLOCK_BYTES = 1 << 20  # compressed bytes of a row of the file
CHARACTERS_AT_ONCE = 1 << 21


def chunks(contents: list[str]) -> Iterator[list[str]]:
    """Texts in lists of bounded total length; a longer text is a list of its own."""
    held: list[str] = []
    size = 0
    for content in contents:
        if held and size + len(content) > CHARACTERS_AT_ONCE:
            yield held
            held, size = [], 0
        held.append(content)
        size += len(content)
    if held:
        yield held


def serialized(ids: bytes, width: int) -> bytes:
    """32-bit ids as little-endian numbers of ``width`` bytes."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def dictionary_hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def _ending(end_id: int | None) -> bytes:
    return b"" if end_id is None else int(end_id).to_bytes(4, "little")


def train_dictionary(docs: DataFrame, spec: str, width: int, end_id: int | None = END_ID, text: str = "text") -> bytes:
    """A dictionary of serialized id arrays, trained on at most ``SAMPLE_ROWS`` documents; empty if they are too few.

    It changes the size of the files and nothing else. The sample is picked by a hash of the text.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(spec)
    chosen = hash_sample(docs, text, SAMPLE_ROWS).dropna().dropDuplicates()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(shared.value)
        for batch in batches:
            for part in chunks(batch.column(0).to_pylist()):
                found = [serialized(ids + _ending(end_id), width) for ids in table.encode(part)]
                short = [ids for ids in found if len(ids) <= SAMPLE_BYTES]
                yield pa.RecordBatch.from_arrays([pa.array(short, pa.binary())], names=["ids"])

    samples = [bytes(row["ids"]) for row in chosen.mapInArrow(work, "ids binary").limit(SAMPLE_ROWS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples), k=256, d=8, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_dict_id=False)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


FILE = (
    "part int, block int, start long, dictionary_hash string, width int, "
    "doc_ids array<long>, counts array<long>, offsets array<long>, payload binary"
)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode every text and write the ids to ``path`` in ascending order of the key.

    ``path/dictionary`` has the dictionary and its hash, ``path/blocks`` one row per block of about a megabyte:
    the frames of its documents one after the other, and as index their keys, numbers of ids and offsets (one more
    than documents). ``start`` is the number of ids before the block within its part of the file.

    A null text is an empty one. Null keys come first; rows that tie in the key are ordered by their ids. The
    rows are dealt out by ranges of key and hash of the frame, so only rows equal in both must share a task.
    """
    spark = docs.sparkSession
    ship(spark)
    spec = tokenizer_file(tokenizer)
    width = 2 if word_table(spec).tokenizer.get_vocab_size() <= 1 << 16 else 4
    dictionary = train_dictionary(docs, spec, width, end_id, text)
    mark = dictionary_hash(dictionary)
    row = spark.createDataFrame([(mark, bytearray(dictionary))], "dictionary_hash string, dictionary binary")
    row.coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((spec, dictionary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, packer = word_table(shared.value[0]), _compressor(shared.value[1])
        for batch in batches:
            at = 0
            for part in chunks(batch.column(1).to_pylist()):
                ids = [one + _ending(end_id) for one in table.encode(part)]
                frames = [packer.compress(serialized(one, width)) for one in ids]
                columns = [
                    batch.column(0).slice(at, len(part)),
                    pa.array([len(one) // 4 for one in ids], pa.int64()),
                    pa.array(frames, pa.binary()),
                ]
                at += len(part)
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "frame"])

    source = texts(docs, key, text=text).withColumn(key, F.col(key).cast("long"))
    encoded = written(source.mapInArrow(encode, "key long, n long, frame binary"), "token-frames")
    ordered = encoded.withColumn("tie", F.xxhash64("frame")).repartitionByRange("key", "tie")
    ordered = ordered.sortWithinPartitions("key", "tie").select(
        F.spark_partition_id().alias("part"), "key", "n", "frame"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = block = start = size = 0
        held: list[tuple] = []

        def packed() -> pa.RecordBatch:
            keys, counts, frames = zip(*held)
            offsets = np.concatenate([[0], np.cumsum([len(frame) for frame in frames])]).tolist()
            values = [part, block, start, mark, width, list(keys), list(counts), offsets, b"".join(frames)]
            return pa.RecordBatch.from_pylist([dict(zip(names, values))], schema=FILE_ARROW)

        names = FILE_ARROW.names
        for batch in batches:
            for number, key_, n, frame in zip(*[column.to_pylist() for column in batch.columns]):
                part = number
                held.append((key_, n, frame))
                size += len(frame)
                if size >= BLOCK_BYTES:
                    yield packed()
                    block, start, size, held = block + 1, start + sum(one[1] for one in held), 0, []
        if held:
            yield packed()

    ordered.mapInArrow(pack, FILE).write.parquet(f"{path}/blocks")


FILE_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("start", pa.int64()),
        ("dictionary_hash", pa.string()),
        ("width", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def read_tokens(spark: SparkSession, path: str, keys: list[int] | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from files of ``write_tokens``; ``ids`` are 32-bit numbers.

    ``start`` is the number of ids of all documents before. With ``keys`` only blocks whose index holds one of
    them are read, and only their frames are unpacked. Only the totals of the parts, one number each, are summed
    up in one task and sent to all. A file whose dictionary is another one is refused.
    """
    ship(spark)
    saved = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(saved["dictionary"])
    if dictionary_hash(dictionary) != saved["dictionary_hash"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    mark = saved["dictionary_hash"]
    blocks = spark.read.schema(FILE).parquet(f"{path}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum(F.expr("aggregate(counts, 0L, (a, b) -> a + b)")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    wanted = None if keys is None else set(keys)
    if wanted is not None:
        blocks = blocks.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(int(k)) for k in wanted])))
    shared = spark.sparkContext.broadcast(dictionary)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _decompressor(shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_hash"] != mark:
                    raise ValueError("a block was written with another dictionary")
                payload, offsets, counts = row["payload"], row["offsets"], row["counts"]
                firsts = row["part_start"] + row["start"] + np.concatenate([[0], np.cumsum(counts)[:-1]])
                chosen = [at for at, key in enumerate(row["doc_ids"]) if wanted is None or key in wanted]
                ids = []
                for at in chosen:
                    raw = reader.decompress(payload[offsets[at] : offsets[at + 1]])
                    ids.append(raw if row["width"] == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes())
                columns = [
                    pa.array([row["doc_ids"][at] for at in chosen], pa.int64()),
                    pa.array([int(firsts[at]) for at in chosen], pa.int64()),
                    pa.array([len(one) // 4 for one in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    placed = blocks.join(F.broadcast(starts), "part")
    chosen_columns = placed.select(*FILE_ARROW.names, "part_start")
    return chosen_columns.mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary")


def document_tokens(docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Start, number and checksum of the ids of every document, as read back from the files."""
    write_tokens(docs.select("doc_id", "text"), path, tokenizer)
    found = read_tokens(docs.sparkSession, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
