"""Columns of many rows packed into one value, for what tasks hand to each other or write for a while.

A row of Spark for each word takes several times the room of its numbers, in shuffles and in files.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

SEED = 42  # of Spark's xxhash64


def narrow(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in as few bytes as the largest one takes."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


def pack(*columns: np.ndarray | pa.Array) -> bytes:
    """Columns of whole numbers from 0, of doubles or of texts without nulls, each of any length."""
    held = []
    for column in columns:
        if isinstance(column, pa.Array):
            column = column.cast(pa.string())
            size = pc.binary_length(column).to_numpy(zero_copy_only=False)
            _, offsets, data = column.buffers()
            if len(column):
                edges = np.frombuffer(offsets, np.int32)[[column.offset, column.offset + len(column)]]
                data = data.slice(int(edges[0]), int(edges[1] - edges[0])).to_pybytes() if data else b""
            held.append((narrow(size), data if len(column) else b""))
        else:
            held.append(column if column.dtype.kind == "f" else narrow(column))
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(held, protocol=5))


def unpack(data: bytes) -> list[np.ndarray | pa.Array]:
    """What was packed: whole numbers as int64, doubles and texts."""
    columns = []
    for column in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
        if isinstance(column, tuple):
            size, texts = column
            offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int64)]).astype(np.int32)
            columns.append(pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(texts)))
        else:
            columns.append(column if column.dtype.kind == "f" else column.astype(np.int64))
    return columns


def buckets_of(terms: pa.Array, buckets: int) -> np.ndarray:
    """The bucket of each term, as ``operators.terms.term_bucket`` has it."""
    texts = terms.cast(pa.binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(text, SEED) for text in texts), np.uint64, len(texts))
    return hashes.view(np.int64) % buckets


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start``, ``start`` + 1... of each run of ``size``, one run after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(size.sum())


def cuts(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of equal ``keys``, which are in order."""
    edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]]) if len(keys) else [0]
    for first, last in zip(edges[:-1], edges[1:]):
        yield int(keys[first]), slice(int(first), int(last))


def pairs_summed(row: np.ndarray, place: np.ndarray, weights: np.ndarray, n_places: int) -> tuple[np.ndarray, ...]:
    """``(row, place, sum)`` for each pair that occurs, in order."""
    pair, cells = row * n_places + place, (int(row.max(initial=-1)) + 1) * n_places
    if cells <= 8 * len(pair):
        found, sums = np.flatnonzero(np.bincount(pair, minlength=cells)), np.bincount(pair, weights=weights, minlength=cells)
        return found // n_places, found % n_places, sums[found].astype(np.float64)  # numpy counts nothing as whole numbers
    pair, at = np.unique(pair, return_inverse=True)
    return pair // n_places, pair % n_places, np.bincount(at, weights=weights, minlength=len(pair))


def added_up(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """``pairs_summed`` of several ``(row, place, weights)``, or none."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    row, place, weights = map(np.concatenate, zip(none, *parts))
    return pairs_summed(row, place, weights, int(place.max(initial=0)) + 1)


class Tally:
    """Terms, each once, in how many rows each is, and its counts by class: ``size`` classes a term, one term after the other."""

    def __init__(self, terms: pa.Array, df: np.ndarray, size: np.ndarray, place: np.ndarray, n: np.ndarray):
        self.terms, self.df, self.size, self.place, self.n = terms, df, size, place, n

    @classmethod
    def merged(cls, tallies: list["Tally"]) -> "Tally":
        """The sums of several. Counts are whole numbers below 2^53, so their order does not matter."""
        if len(tallies) == 1:
            return tallies[0]
        found = pa.concat_arrays([tally.terms for tally in tallies]).dictionary_encode()
        term, n_terms = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
        place = np.concatenate([tally.place for tally in tallies])
        row = np.repeat(term, np.concatenate([tally.size for tally in tallies]))
        n_places = int(place.max(initial=0)) + 1
        of, place, n = pairs_summed(row, place, np.concatenate([tally.n for tally in tallies]), n_places)
        df = np.bincount(term, weights=np.concatenate([tally.df for tally in tallies]), minlength=n_terms)
        size = np.bincount(of, minlength=n_terms)
        return cls(found.dictionary, df.astype(np.int64), size, place, n.astype(np.int64))

    def packed(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """``(bucket, data)`` for every bucket that a term falls into."""
        bucket = buckets_of(self.terms, buckets)
        order = np.argsort(bucket, kind="stable")
        terms, df, size = self.terms.take(pa.array(order)), self.df[order], self.size[order]
        entry = ranges((np.cumsum(self.size) - self.size)[order], size)
        place, n, last = self.place[entry], self.n[entry], np.concatenate([[0], np.cumsum(size)])
        for at, some in cuts(bucket[order]):
            inside = slice(last[some.start], last[some.stop])
            part = terms.slice(some.start, some.stop - some.start)
            yield at, pack(part, df[some], size[some], place[inside], n[inside])

    @classmethod
    def unpacked(cls, data: bytes) -> "Tally":
        return cls(*unpack(data))
