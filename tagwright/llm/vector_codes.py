"""Compression of vectors: each part of a vector is replaced by the number of its nearest codebook entry.

The nearest entry is found by Orchard search. Every entry has the list of all others by rising distance from it. A
search holds the nearest entry found so far and walks through that entry's list: an entry seen before is
skipped, a nearer one takes over with its own list, and once the list is beyond twice the distance of
the point, the triangle inequality leaves nothing that is as near.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import attach, ship
from tagwright.session import spread, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Larger components count as this, so that the distance of two vectors fits a long.
LARGEST = 1 << 26
FAR = np.iinfo(np.int64).max


class Neighbours:
    """The entries of one codebook with their lists of neighbours."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        n = len(entries)
        apart = np.stack([squared(self.entries, one) for one in self.entries]) if n else np.empty((0, 0), np.int64)
        np.fill_diagonal(apart, -1)  # an entry leads its own list, from which it is taken out
        self.lists = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        ends = np.full((n, 1), FAR)
        self.distances = np.hstack([np.take_along_axis(apart, self.lists, axis=1), ends])
        self.lists = np.hstack([self.lists, np.zeros((n, 1), np.int64)])

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point its nearest entry, of equally near ones the first, and the squared distance.

        All points are searched at once, each with its own list, place in it and marks of visited entries.
        """
        n = len(points)
        best, owner, place = (np.zeros(n, np.int64) for _ in range(3))
        distance = squared(points, self.entries[0])
        visited = np.zeros((n, len(self.entries)), bool)
        visited[:, 0] = True
        active = np.arange(n)
        while len(active):
            reach = self.distances[owner[active], place[active]]
            # entries beyond twice the distance are farther than the nearest one; those at just twice may tie
            active = active[(reach != FAR) & (reach <= 4 * distance[active])]
            candidate = self.lists[owner[active], place[active]]
            place[active] += 1
            new = ~visited[active, candidate]
            at, entry = active[new], candidate[new]
            visited[at, entry] = True
            found = squared(points[at], self.entries[entry])
            first = (found == distance[at]) & (entry < best[at])
            best[at[first]] = entry[first]
            nearer = found < distance[at]
            at, entry = at[nearer], entry[nearer]
            best[at], owner[at], place[at], distance[at] = entry, entry, 0, found[nearer]
        return best, distance


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` from ``b``, or from its rows."""
    steps = a - b
    return (steps * steps).sum(axis=-1)


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]`` has the entries of a part as rows of whole numbers; ``width`` components are a whole vector."""

    entries: list[np.ndarray]
    width: int

    @property
    def sha256(self) -> str:
        """Digest of all components in order of part, entry and position."""
        return hashlib.sha256(",".join(str(x) for book in self.entries for x in book.ravel().tolist()).encode()).hexdigest()

    def pieces(self, vectors: np.ndarray) -> list[np.ndarray]:
        return np.split(vectors, len(self.entries), axis=1)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    numbers = vector.cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """Components in steps of 1 / 256, rounded down."""

    def step(x: Column) -> Column:
        scaled = F.least(F.greatest(x * SCALE, F.lit(float(-LARGEST))), F.lit(float(LARGEST)))
        return F.floor(scaled).cast("int")

    return F.transform(vector.cast("array<double>"), step)


def integer_vectors(vectors: DataFrame, *keep: str, vector: str = "embedding") -> DataFrame:
    """``(*keep, numbers)`` of the usable vectors."""
    whole = whole_numbers(F.col(vector)).alias("numbers")
    return spread(vectors.where(usable(F.col(vector))).select(*keep, whole))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists as rows of ``width`` numbers; shorter lists end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width), np.int64)
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows


def _first_books(numbers: DataFrame, key: str, parts: int, entries: int) -> Codebooks:
    """The first codebooks: the parts of the vectors with the least keys. At most ``entries`` rows are fetched."""
    longest = numbers.agg(F.max(F.size("numbers"))).first()[0] or 0
    width = -(-longest // parts) * parts
    chosen = numbers.orderBy(F.col(key).asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()
    rows = np.zeros((len(chosen), width), np.int64)
    for row, one in zip(rows, chosen):
        row[: len(one["numbers"])] = one["numbers"]
    return Codebooks(np.split(rows, parts, axis=1), width)


def _improved(numbers: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry moved to the mean of the parts nearest to it, rounded down. Entries without a part stay.

    A task sends one row of sums for each part and entry, whatever the number of its vectors.
    """
    wide = books.width // len(books.entries)
    shared = numbers.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        searches = [Neighbours(book) for book in own.entries]
        counts = [np.zeros(len(book), np.int64) for book in own.entries]
        totals = [np.zeros(book.shape, np.int64) for book in own.entries]
        for batch in batches:
            for search, n, total, points in zip(searches, counts, totals, own.pieces(matrix(batch.column(0), own.width))):
                nearest, _ = search.nearest(points)
                n += np.bincount(nearest, minlength=len(n))
                np.add.at(total, nearest, points)
        found = [
            {"part": part, "entry": entry, "n": int(n[entry]), "sums": total[entry].tolist()}
            for part, (n, total) in enumerate(zip(counts, totals))
            for entry in np.flatnonzero(n).tolist()
        ]
        kinds = [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_pylist(found, schema=pa.schema(kinds))

    partial = numbers.select("numbers").mapInArrow(sums, "part int, entry int, n long, sums array<long>")
    each = [F.sum(F.col("sums")[at]).alias(f"sum_{at}") for at in range(wide)]
    moved = [book.copy() for book in books.entries]
    for row in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():
        moved[row["part"]][row["entry"]] = [row[f"sum_{at}"] // row["n"] for at in range(wide)]
    return Codebooks(moved, books.width)


def train_codebooks(
    numbers: DataFrame, key: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks for ``numbers`` of ``integer_vectors``, fitted on all rows in some rounds of assignment and means.

    A codebook starts as its part of the vectors with the least keys (null keys last, ties by the vector); there are
    fewer entries if there are fewer vectors, and none for an empty table. The parts are equal: shorter
    vectors, and all of them if their length is no multiple of ``parts``, end in zeros.
    The driver holds the codebooks only, whose size is fixed by ``entries`` and the width of a vector.
    """
    if entries > 256:
        raise ValueError("two hex digits stand for 256 entries at most")
    ship(numbers.sparkSession)
    books = _first_books(numbers, key, parts, entries)
    if len(books.entries[0]):
        for _ in range(rounds):
            books = _improved(numbers, books)
    return books


def vector_codes(numbers: DataFrame, books: Codebooks) -> DataFrame:
    """``numbers`` of ``integer_vectors`` with ``code`` and ``error`` in place of the vector.

    ``code`` has two hex digits for each part, the place of the entry nearest to it (of equally near ones the first),
    ``error`` the squared distances of all parts summed up.
    """
    spark = numbers.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(books)
    kept = [name for name in numbers.columns if name != "numbers"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        searches = [Neighbours(book) for book in own.entries]
        for batch in batches:
            vectors = matrix(batch.column(len(kept)), own.width)
            found = [search.nearest(points) for search, points in zip(searches, own.pieces(vectors))]
            places = np.stack([nearest for nearest, _ in found], axis=1).astype(np.uint8)
            codes = [row.tobytes().hex() for row in places]
            error = np.sum([distance for _, distance in found], axis=0)
            columns = [*batch.columns[: len(kept)], pa.array(codes, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "code", "error"])

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in numbers.select(*kept).dtypes)
    return numbers.select(*kept, "numbers").mapInArrow(work, f"{kinds}, code string, error long")


def decoded_vectors(codes: DataFrame, books: Codebooks, code: str = "code", vector: str = "decoded") -> DataFrame:
    """``codes`` with the vector that a code stands for, from the middles of the steps of its entries.

    A null code has a null vector.
    """
    tables = [F.array(*[F.lit([(x + 0.5) / SCALE for x in entry]) for entry in book.tolist()]) for book in books.entries]
    place = lambda part: F.conv(F.substring(F.col(code), 2 * part + 1, 2), 16, 10).cast("int")
    return codes.withColumn(vector, F.concat(*[table[place(part)] for part, table in enumerate(tables)]))


def compressed_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, code, error, label_error, codebooks_sha256)`` of every usable vector of ``vectors``.

    Vectors that are null or hold a null or a component that is not finite are left out. Rows that repeat an id
    stay, and so do rows without an id or label. ``label_error`` is the error summed over the rows with that label,
    rows without one together; it is null if it exceeds a long. An empty table gives no rows.
    """
    numbers = integer_vectors(vectors, "vec_id", "label")
    books = train_codebooks(numbers)
    coded = written(vector_codes(numbers, books), "vector-codes")
    sums = coded.groupBy("label").agg(F.count("*").alias("n_rows"), F.try_sum("error").alias("label_error"))
    summed = attach(coded, written(sums, "label-errors"), ["label"], "n_rows")
    return summed.select("vec_id", "label", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
