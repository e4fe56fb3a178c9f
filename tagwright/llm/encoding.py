"""BPE encoding and decoding over a table of distinct words."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.llm.blocks import by_range, coded, numbers_and_counts, packed, segments_for, unpacked, words_in
from tagwright.llm.bpe import tokenizer_file, word_table
from tagwright.llm.common import lean, ship, without
from tagwright.session import spread


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces ``values[start : start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - lengths), lengths)
    return values[shift + np.arange(total)]


def word_values(worded: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of all words of a block one after the other, and where those of each number start and how many they are."""
    rows = worded.to_pylist()
    numbers = [numbers_and_counts(row["extra"])[0] for row in rows]
    sizes = [unpacked(row["more"], np.uint32) for row in rows]
    values = np.concatenate([np.empty(0, np.uint32), *[unpacked(row["data"], np.uint32) for row in rows]])
    order = np.concatenate([np.empty(0, np.int64), *numbers]).astype(np.int64)
    flat = np.concatenate([np.empty(0, np.uint32), *sizes]).astype(np.int64)
    starts, lengths = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    starts[order] = np.cumsum(flat) - flat
    lengths[order] = flat
    return values, starts, lengths


def word_ids(words: DataFrame, spec: str) -> DataFrame:
    """The ids of the words of each row, and how many each has; every distinct word is encoded once."""
    shared = words.sparkSession.sparkContext.broadcast(spec)

    def value(rows: list[dict]) -> Iterator[tuple[bytes, bytes]]:
        lists = [words_in(row) for row in rows]
        distinct = list(set().union(*lists))
        encoded = word_table(shared.value).encode_words([word.decode("utf-8", "surrogatepass") for word in distinct])
        ids = dict(zip(distinct, encoded))
        for own in lists:
            found = [ids[word] for word in own]
            lengths = np.array([len(one) // 4 for one in found], np.uint32)
            yield packed(np.frombuffer(b"".join(found), np.uint32)), packed(lengths)

    return by_range(words, value, data="binary", more="binary")


def encode(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", decoded: str | None = None
) -> DataFrame:
    """``(key, ids)`` of every text; ``ids`` are little-endian unsigned 32-bit numbers.

    With ``decoded`` there is a column of that name with the text that the ids stand for, as ``decode`` gives it.

    Texts are split where they are read. The distinct words of all blocks form one table, dealt out by their hash,
    in which each word is encoded once; its ids go back to the blocks that have it and there take the places of the
    numbers of the words. A null text counts as empty and has no ids; rows that repeat a key stay; an empty
    table gives no rows.

    The texts are read twice, once for the words and once for the documents, as storing the numbers
    between would cost more disk than the input itself.
    """
    spark = docs.sparkSession
    ship(spark)
    spec = tokenizer_file(tokenizer)
    shared = spark.sparkContext.broadcast((spec, piece_list(spec) if decoded else []))
    given = docs.select(
        F.col(key).cast("long").alias("key"), F.lit(False).alias("flag"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    source = spread(given, "key", "text")
    if source is not given:
        # both passes must read the rows of a task in one order, which a shuffle alone does not give
        source = source.sortWithinPartitions("key", F.xxhash64("text"))
    segments = segments_for(source, "text")

    def split():
        table = word_table(shared.value[0])
        return lambda content: [word.encode("utf-8", "surrogatepass") for word in table.words(content)]

    words = coded(source, split, lambda block: block.word_rows(segments))
    documents = coded(source, split, lambda block: block.document_rows())

    nothing = pa.schema(
        [(key, pa.int64()), ("ids", pa.binary()), *([(decoded, pa.string())] if decoded else [])]
    ).empty_table()

    def put(numbered: pa.Table, worded: pa.Table) -> pa.Table:
        lean()
        values, starts, lengths = word_values(worded)
        rows_of = lambda table: (row for batch in table.to_batches(max_chunksize=1) for row in batch.to_pylist())
        parts = []
        for row in rows_of(numbered):
            codes = unpacked(row["data"], np.uint32)
            own = lengths[codes]
            line = gathered(values, starts[codes], own).astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(own)])[np.cumsum(unpacked(row["more"], np.uint32))] * 4
            found = [line[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            columns = {key: pa.array(row["keys"], pa.int64()), "ids": pa.array(found, pa.binary())}
            if decoded:
                columns[decoded] = pa.array(texts_of(found, shared.value[1]), pa.string())
            parts.append(pa.record_batch(columns))
        del values, starts, lengths
        lean()
        return pa.Table.from_batches(parts) if parts else nothing

    left = documents.select("block", "keys", "data", "more")
    both = left.groupBy("block").cogroup(word_ids(words, spec).groupBy("block"))
    return both.applyInArrow(put, f"`{key}` long, ids binary" + (f", `{decoded}` string" if decoded else ""))


def pieces(spark: SparkSession, tokenizer: str) -> DataFrame:
    """``(id, piece)``: the bytes of every id of the tokenizer."""
    return spark.createDataFrame(
        [(at, bytearray(piece)) for at, piece in enumerate(piece_list(tokenizer_file(tokenizer)))], "id int, piece binary"
    )


def piece_list(spec: str) -> list[bytes]:
    """The bytes of each id, by the byte alphabet of byte-level tokenizers."""
    own = json.loads(spec)
    names = dict(own["model"]["vocab"])
    names.update({token["content"]: token["id"] for token in own["added_tokens"]})
    alphabet = byte_alphabet()
    listed = [b""] * (max(names.values()) + 1)
    for name, number in names.items():
        inside = all(mark in alphabet for mark in name)
        listed[number] = bytes(alphabet[mark] for mark in name) if inside else name.encode()
    return listed


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if it is printable, else one above 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + at): byte for at, byte in enumerate(hidden)}


def texts_of(ids: list[bytes], listed: list[bytes]) -> list[str]:
    """The texts of arrays of ids: a join of each id with its piece, by position."""
    values = np.frombuffer(b"".join(listed), np.uint8)
    lengths = np.array(list(map(len, listed)))
    starts = np.cumsum(lengths) - lengths
    numbers = (np.frombuffer(one, "<u4") for one in ids)
    return [gathered(values, starts[own], lengths[own]).tobytes().decode("utf-8", "replace") for own in numbers]


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids.

    The table of pieces has one row per id of the vocabulary, so every task gets all of it and joins the pieces to
    the ids by position. Bytes that are no UTF-8 become the replacement character. No ids give an empty text.
    A column of the input named like the added one is replaced.
    """
    encoded = without(encoded, text)
    spark = encoded.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(piece_list(tokenizer_file(tokenizer)))
    names = encoded.columns
    at = names.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = texts_of([one or b"" for one in batch.column(at).to_pylist()], shared.value)
            columns = [*batch.columns, pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, text])

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in encoded.schema)
    return encoded.mapInArrow(work, f"{kinds}, `{text}` string")


def document_encoding(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Number and digests of the ids and of the decoded text of every document."""
    both = encode(docs, tokenizer, decoded="text")
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
