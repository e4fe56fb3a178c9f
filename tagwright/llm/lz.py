"""Document fingerprints from the phrases of a Lempel-Ziv parse."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagwright.llm.common import ship, texts
from tagwright.session import written

SIGNATURE = 128  # least hashes kept of a phrase set
BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
RANGE_BYTES = 1 << 28  # of text, at most on average
RANGES_PER_CORE = 4  # at least

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse, from 0 to ``n`` at least."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * len(_powers[0]))
        for place, factor in enumerate((BASE, INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[place] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Parse:
    """An LZ78 parse that can be continued: each phrase is the shortest piece not yet in the dictionary.

    ``ends`` are the ends of the phrases. What is left at the end of a text is a phrase already and adds nothing.
    """

    __slots__ = ("known", "start", "ends", "usual")

    def __init__(self) -> None:
        self.known: set[str] = set()
        self.start = 0
        self.ends: list[int] = []
        self.usual = 32  # eight times the usual length of a phrase

    def run(self, text: str, stop: int) -> "Parse":
        """Read on to ``stop``.

        All shorter beginnings of a phrase are in the dictionary, so its length is found from the usual one, up or down.
        """
        known, start, usual = self.known, self.start, self.usual
        add, note = known.add, self.ends.append
        while True:
            end = start + (usual >> 3)
            if end > stop:
                break
            piece = text[start:end]
            if piece in known:
                end += 1
                while end <= stop:
                    piece = text[start:end]
                    if piece not in known:
                        break
                    end += 1
                else:
                    break  # what is left is a phrase
            else:
                end -= 1
                while end > start:
                    shorter = text[start:end]
                    if shorter in known:
                        break
                    piece = shorter
                    end -= 1
                end += 1
            add(piece)
            note(end)
            usual += end - start - (usual >> 3)  # stays at 8 or more
            start = end
        for end in range(start + 1, stop + 1):
            piece = text[start:end]
            if piece not in known:
                add(piece)
                note(end)
                start = end
        self.start, self.usual = start, usual
        return self

    def handed_on(self, copied: bool = False) -> "Parse":
        """A parse that reads on from here with this dictionary, or a copy of it; the phrases so far stay here."""
        other = Parse()
        other.known, other.start, other.usual = self.known.copy() if copied else self.known, self.start, self.usual
        return other


def phrase_hashes(text: str, begin: int, ends: list[int]) -> np.ndarray:
    """A hash of every phrase from ``begin`` on, from the prefix sums of a polynomial."""
    if not ends:
        return np.empty(0, np.uint64)
    part = text[begin : ends[-1]]
    points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
    powers, inverses = _powers_up_to(len(points))
    edges = np.empty(len(ends) + 1, np.int64)
    edges[0] = 0
    edges[1:] = array("q", ends)
    edges[1:] -= begin
    with np.errstate(over="ignore"):
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points + np.uint64(1)) * powers[: len(points)], out=sums[1:])
        sums = sums[edges]
        x = (sums[1:] - sums[:-1]) * inverses[edges[:-1]] + np.diff(edges).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def signature(hashes: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """The least hashes in order, of which the upper 32 bits are kept."""
    if len(hashes) > 4 * size:
        hashes = np.partition(hashes, 2 * size)[: 2 * size]
    ordered = np.sort(hashes)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return (ordered[new][:size] >> np.uint64(32)).astype(np.uint32)


def as_text(signed: np.ndarray) -> str:
    """A signature as hexadecimal digits, eight for each hash."""
    return signed.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(one: np.ndarray, other: np.ndarray, size: int = SIGNATURE) -> float:
    """Share of common phrases, estimated from two signatures; 1 for two empty texts, 0 if one is empty."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    # each has a hash once, so the common ones come twice
    ordered = np.sort(np.concatenate([one, other]))
    again = ordered[1:] == ordered[:-1]
    firsts = np.flatnonzero(np.concatenate([[True], ~again]))[:size]
    return float(np.concatenate([again, [False]])[firsts].mean())


def fingerprint(text: str) -> str:
    parse = Parse().run(text, len(text))
    return as_text(signature(phrase_hashes(text, 0, parse.ends)))


class _Seen:
    """What is kept of a document until its successor comes: its signature, and parse and hashes of its first half."""

    def __init__(self, key, text: str):
        self.key, self.text, self.n = key, text, len(text)
        self.cut = self.n - self.n // 2
        self.half = Parse().run(text, self.cut)
        self.hashes = phrase_hashes(text, 0, self.half.ends)
        self.signed = self._signed(self.half.handed_on(copied=True).run(text, self.n), text)

    def _signed(self, rest: Parse, text: str) -> np.ndarray:
        """The signature of a text whose first half this is, after ``rest`` has read on."""
        return signature(np.concatenate([self.hashes, phrase_hashes(text, self.half.start, rest.ends)]))

    def row(self, after: "_Seen") -> tuple:
        edited = self.text[: self.cut] + after.text[: self.n - self.cut]
        signed = self._signed(self.half.handed_on().run(edited, len(edited)), edited)
        return (
            self.key,
            self.n,
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            as_text(self.signed),
            as_text(signed),
            likeness(self.signed, signed),
            likeness(self.signed, after.signed),
        )


ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
ROW_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _part_of(key: str, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the key, by halving; 0 for a null key."""
    if not bounds:
        return F.lit(0)
    steps = [1 << bit for bit in reversed(range(len(bounds).bit_length()))]
    # one text, which Spark reads once, however many bounds there are
    array_of = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    reached = lambda at, step: (at + step <= len(bounds)) & (F.get(array_of, at + step - 1) <= F.col(key))
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(reached(at, step), at + step).otherwise(at)
    )


def successor_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its text edited with that of the next document, see ``ROW``.

    The next document is that with the next greater key, after the last the first; null keys come first and rows
    that tie are ordered by a hash of the text. The last half of a text is replaced by as many characters from the
    start of the next one. Both parses share the first half. A text of any length is parsed whole.

    Texts are shuffled once, to ranges of keys, of which each is a task and streams. The first document of each range
    is also sent to the range before: the driver keeps a bound, one number, for each range, and the table of
    first documents has a row for each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    source = texts(docs, key, text=text).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows, size = source.agg(F.count(F.lit(1)), F.sum(F.octet_length("text").cast("long"))).first()
    if not rows:
        return spark.createDataFrame([], ROW)
    count = max(RANGES_PER_CORE * spark.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))
    shares = [part / count for part in range(1, count)]
    found = source.agg(F.percentile_approx("key", shares, max(10_000, 4 * count))).first()[0] or []
    bounds = sorted(set(found))
    dealt = source.withColumn("part", _part_of("key", bounds)).withColumn("tie", F.xxhash64("text"))
    # one row per range: its first document, and the filled range before, of the first range the last
    heads = dealt.groupBy("part").agg(F.min(F.struct(F.col("key").isNotNull(), "key", "tie")).alias("first"))
    in_turn = Window.orderBy("part")
    last = F.last("part").over(in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = written(
        heads.select(
            F.col("first.key").alias("head_key"),
            F.col("first.tie").alias("head_tie"),
            F.coalesce(F.lag("part").over(in_turn), last).alias("head_part"),
        ),
        "range-heads",
    )
    marked = dealt.join(
        F.broadcast(firsts), F.col("key").eqNullSafe(F.col("head_key")) & (F.col("tie") == F.col("head_tie")), "left"
    )
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("follows"))
    other = F.struct(F.col("head_part").alias("part"), F.lit(True).alias("follows"))
    sent = marked.select(
        "key", "text", "tie", F.explode(F.when(F.col("head_part").isNull(), F.array(own)).otherwise(F.array(own, other))).alias("to")
    ).select("to.part", "to.follows", "key", "tie", "text")
    lined = sent.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "follows", "key", "tie")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: _Seen | None = None
        last_part = None
        for batch in batches:
            done = []
            for part, follows, key_, content in zip(*batch.columns):
                if part != last_part:
                    last, last_part = None, part
                if follows.as_py() and last is None:
                    continue  # a repeat of the first document of the next range
                seen = _Seen(key_.as_py(), content.as_py())
                if last is not None:
                    done.append(last.row(seen))
                last = None if follows.as_py() else seen
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(ROW_ARROW.names, one)) for one in done], schema=ROW_ARROW)

    return lined.select("part", "follows", "key", "text").mapInArrow(work, ROW)
