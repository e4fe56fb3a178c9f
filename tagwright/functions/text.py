"""Tokens as column expressions and term counts as Arrow columns, made where the post is read."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tagwright.fixed_values import WHITESPACE
from tagwright.functions.packed import Tally, ranges
from tagwright.llm.common import lean, ship

BLOCK_BYTES = 8 << 20  # texts counted together
PAIRS = 1 << 20  # of terms and classes that a task adds up before it hands them on
LISTS = 1 << 16  # terms given back to Spark at once
NO_TERM = " "  # stands for the null term, as no word has a blank in it
Postings = tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, pa.Array]
_BLANKS = bytes.maketrans(WHITESPACE.encode(), b" " * len(WHITESPACE))


def words(text: Column) -> Column:
    """Lower-case ``text`` and split it at every whitespace character.

    Empty words between two separators stay and those at the end go, as in MLlib's Tokenizer.
    """
    blank, others = WHITESPACE[0], WHITESPACE[1:]
    lowered = F.translate(F.lower(text), others, blank * len(others))
    trimmed = F.rtrim(lowered, F.lit(blank))
    only_blanks = (trimmed == "") & (lowered != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(F.split(trimmed, blank))


def spaced(texts: pa.Array) -> pa.Array:
    """Lower-case texts as ``words`` splits them: all whitespace as blanks, none at the end, null for blanks alone."""
    valid, offsets, data = texts.buffers()
    data = pa.py_buffer(data.to_pybytes().translate(_BLANKS)) if data else data
    given = pa.Array.from_buffers(texts.type, len(texts), [valid, offsets, data], offset=texts.offset)
    trimmed = pc.utf8_rtrim(given, " ")
    only_blanks = pc.and_(pc.equal(trimmed, ""), pc.not_equal(given, ""))
    return pc.if_else(only_blanks, pa.scalar(None, texts.type), trimmed)


def postings(lowered: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """``(post, term, tf)`` for every distinct word of each text, posts in order, and the words behind the term numbers."""
    split = pc.split_pattern(spaced(lowered), " ")
    post = pc.list_parent_indices(split).to_numpy().astype(np.int64)
    found = pc.list_flatten(split).dictionary_encode()
    n_terms = max(1, len(found.dictionary))
    pairs, tf = np.unique(post * n_terms + found.indices.to_numpy(), return_counts=True)
    return pairs // n_terms, pairs % n_terms, tf, found.dictionary


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few MB, whose last column are the texts."""
    for batch in batches:
        n_rows = max(1, batch.num_rows * BLOCK_BYTES // max(BLOCK_BYTES, batch.columns[-1].nbytes))
        yield from (batch.slice(at, n_rows) for at in range(0, batch.num_rows, n_rows))


def term_rows(posts: DataFrame, *keep: str, body: str = "Body") -> DataFrame:
    """One row ``(*keep, term, tf)`` for every distinct word of a post, without a shuffle.

    One more row per post has a null term: it counts the post and keeps posts without words. Spark lower-cases the
    texts; they are split and counted block by block as Arrow columns, in several posts at once.
    """
    ship(posts.sparkSession)
    given = posts.select(*keep, F.lower(body).alias(body))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            post, term, tf, known = postings(batch.columns[-1])
            every = np.arange(batch.num_rows)
            kept = [column.take(pa.array(np.concatenate([post, every]))) for column in batch.columns[:-1]]
            nulls = lambda kind: pa.nulls(len(every), kind)
            terms = pa.concat_arrays([known.take(pa.array(term)), nulls(known.type)])
            counts = pa.concat_arrays([pa.array(tf, pa.int64()), nulls(pa.int64())])
            yield pa.RecordBatch.from_arrays([*kept, terms, counts], names=[*batch.schema.names[:-1], "term", "tf"])

    fields = [*given.schema.fields[:-1], StructField("term", StringType()), StructField("tf", LongType())]
    rows = given.mapInArrow(work, StructType(fields))
    rows.given = given  # for over_postings
    return rows


def over_postings(
    rows: DataFrame, work: Callable[[Iterator[Postings]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``work`` over the blocks behind ``rows``, which ``term_rows`` gave, in place of a row of Spark for each word.

    A block is the first kept column and the ``postings`` of its texts.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work((batch.column(0), *postings(batch.columns[-1])) for batch in _blocks(batches))

    return rows.given.mapInArrow(blocks, schema)


def _tallied(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """``(terms, classes, at, df, n)`` of a block of ``(classes, text)``: ``at`` is the place of a term times the number of
    classes, plus the place of a class. The null term, the last one, counts rows."""
    lists = batch.column(0)
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    entries = pc.list_flatten(lists)
    names = pc.struct_field(entries, [0]).dictionary_encode()
    of_entry, times = names.indices.to_numpy(), pc.struct_field(entries, [1]).to_numpy()
    post, term, tf, known = postings(batch.column(1))
    post = np.concatenate([post, np.arange(batch.num_rows)])
    term = np.concatenate([term, np.full(batch.num_rows, len(known))])
    tf = np.concatenate([tf, np.ones(batch.num_rows, np.int64)])
    # each posting meets the entries of its post's list
    n_met = size[post]
    row = np.repeat(np.arange(len(post)), n_met)
    entry = ranges((np.cumsum(size) - size)[post], n_met)
    n_names = max(1, len(names.dictionary))
    pair, weight = term[row] * n_names + of_entry[entry], times[entry]
    place, at = pair, None
    if (len(known) + 1) * n_names > 8 * len(pair):
        at, place = np.unique(pair, return_inverse=True)
    df = np.bincount(place, weights=weight)
    n = np.bincount(place, weights=weight * tf[row])
    if at is None:
        at = np.flatnonzero(df)
        df, n = df[at], n[at]
    return pa.concat_arrays([known, pa.nulls(1, known.type)]), names.dictionary, at, df.astype(np.int64), n.astype(np.int64)


def class_sums(labelled: DataFrame, classes: str, body: str = "Body") -> DataFrame:
    """``(term, class, df, n)`` of posts that list their ``classes``, each with how often: rows and words by term and class.

    The null term counts rows. Counts are whole numbers, summed in the blocks of texts that tasks read, so what leaves
    them is a row for each term and class of a block; sum them up by term and class.
    """
    ship(labelled.sparkSession)
    given = labelled.select(classes, F.lower(body).alias(body))
    name = given.schema[classes].dataType.elementType.fields[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            terms, names, at, df, n = _tallied(batch)
            n_names = max(1, len(names))
            columns = [terms.take(pa.array(at // n_names)), names.take(pa.array(at % n_names)), df, n]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=["term", "class", "df", "n"])

    longs = [StructField("df", LongType()), StructField("n", LongType())]
    return given.mapInArrow(
        work, StructType([StructField("term", StringType()), StructField("class", name.dataType), *longs])
    )


def class_lists(labelled: DataFrame, classes: str, buckets: int, body: str = "Body") -> DataFrame:
    """``(term, df, seen)``: what ``class_sums`` gives, summed up and listed by term; classes are whole numbers from 0.

    A task adds up its blocks and hands them on packed, by ``buckets`` of terms, so a term leaves it once for some
    million words with all its classes, in one shuffle.
    """
    ship(labelled.sparkSession)
    given = labelled.select(classes, F.lower(body).alias(body))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        held: list[Tally] = []
        for batch in _blocks(batches):
            terms, names, at, df, n = _tallied(batch)
            n_names = max(1, len(names))
            term, place = at // n_names, names.to_numpy(zero_copy_only=False)[at % n_names].astype(np.int64)
            df, size = (np.bincount(term, weights=by, minlength=len(terms)).astype(np.int64) for by in (df, None))
            met = np.flatnonzero(size)
            held.append(Tally(pc.fill_null(terms, NO_TERM).take(pa.array(met)), df[met], size[met], place, n))
            if sum(len(tally.n) for tally in held) >= PAIRS:
                held = [Tally.merged(held)]
                if len(held[0].n) >= PAIRS // 2:
                    yield _rows(Tally.packed(held.pop(), buckets))
        if held:
            yield _rows(Tally.packed(Tally.merged(held), buckets))
        lean()

    def add_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Tally.merged([Tally.unpacked(data.as_py()) for part in parts for data in part.column("data")])
        terms = pc.if_else(pc.equal(total.terms, NO_TERM), pa.scalar(None, pa.string()), total.terms)
        ends = np.concatenate([[0], np.cumsum(total.size)]).astype(np.int32)
        entries = pa.StructArray.from_arrays([pa.array(total.place, pa.int32()), pa.array(total.n)], ["place", "n"])
        seen = pa.ListArray.from_arrays(pa.array(ends), entries)
        whole = pa.RecordBatch.from_arrays([terms, pa.array(total.df), seen], names=["term", "df", "seen"])
        yield from (whole.slice(at, LISTS) for at in range(0, whole.num_rows, LISTS))

    packed = given.mapInArrow(work, "bucket BIGINT, data BINARY")
    seen = "array<struct<place:int,n:bigint>>"
    return packed.groupBy("bucket").applyInArrow(add_up, f"term STRING, df BIGINT, seen {seen}")


def _rows(packed: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    at, data = zip(*packed) if (packed := list(packed)) else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "data"])


def inverse_frequency(rows: Column, df: Column) -> Column:
    """Smoothed inverse document frequency, as MLlib's IDF."""
    return F.ln((rows + 1) / (df + 1))
