"""SimHash near-duplicates: candidates by pigeonring filtering, then Hamming distance and components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import leanly, nested, ship, texts, widened
from tagwright.llm.components import components
from tagwright.session import fits_broadcast, written

BITS = 64
SHINGLE = 3
DISTANCE = 2
HASH_SEED = 42
SEGMENTS = 16
PAIRED = 16  # fingerprints of a bucket that are compared pairwise; larger buckets are linked by neighbours
ROWS_AT_ONCE = 1 << 16


def shingle_hashes(text: str, width: int = SHINGLE) -> np.ndarray:
    """Hash of every shingle, repeats included; a text with fewer words is one shingle, without words none."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    digest, seed = xxhash.xxh64_intdigest, HASH_SEED
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is set if it is set in over half of the hashes; counted in blocks, so memory is bounded."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), ROWS_AT_ONCE):
        block = hashes[at : at + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``(key, fp)``: the 64-bit fingerprint of every text as a long with the same bits."""
    ship(docs.sparkSession)
    source = texts(docs, key, text=text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t, width)) for t in batch.column(1).to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=[key, "fp"])

    return source.mapInArrow(leanly(work), widened(source.select(key).schema, fp="long"))


def _turned(fp: str, start: str) -> str:
    """SQL: the fingerprint as a ring, turned left by ``start`` segments."""
    bits = BITS // SEGMENTS
    return f"(shiftleft({fp}, {start} * {bits}) | shiftrightunsigned({fp}, (64 - {start} * {bits}) % 64))"


def _viable(first: str, second: str, start: str, distance: int) -> str:
    """SQL: every chain of segments from ``start`` on stays within its proportional budget.

    The differences of the first ``l`` segments may be ``l * distance / SEGMENTS`` at most, for every ``l``.
    """
    bits = BITS // SEGMENTS
    differ = f"({_turned(first, start)} ^ {_turned(second, start)})"
    tests = [
        f"bit_count(shiftrightunsigned({differ}, {BITS - bits * chain})) <= {chain * distance // SEGMENTS}"
        for chain in range(1, SEGMENTS)
    ]
    return " AND ".join([*tests, f"bit_count({differ}) <= {distance}"])


def near_links(fps: DataFrame, distance: int = DISTANCE, paired: int = PAIRED) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of ``fps`` (distinct longs ``fp``) within ``distance`` bits.

    Pigeonring: of the ``SEGMENTS`` segments of two fingerprints within the distance, seen as a ring, there is
    one from which on each chain of ``l`` segments differs in ``l * distance / SEGMENTS`` bits at most. The chain of the
    longest length with budget zero must therefore be equal: it is the key of a bucket, one for each start. Within
    a bucket the longer chains are tested before the full distance.

    A bucket with more than ``paired`` fingerprints is not paired. Its fingerprints get the chain of full
    length instead: they are linked over the values that differ from them in ``distance // 2`` bits, or in one
    more on one side if the distance is odd. Two fingerprints share such a value just if they are within the distance,
    and no value has more than a fixed number of them, so this is exact and linear in the bucket.
    """
    exact = max(1, -(-SEGMENTS // distance) - 1) if distance else SEGMENTS
    if distance >= SEGMENTS:
        raise ValueError(f"the distance must be below {SEGMENTS} bits")
    keep = BITS - exact * (BITS // SEGMENTS)
    starts = F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)))
    spread_out = fps.select("fp", starts.alias("start"))
    keyed = spread_out.select("fp", "start", F.expr(f"shiftrightunsigned({_turned('fp', 'start')}, {keep})").alias("chain"))
    sizes = keyed.groupBy("start", "chain").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(keyed.join(sizes, ["start", "chain"]), "simhash-buckets")

    few = shared.where(F.col("n") <= paired).groupBy("start", "chain").agg(F.collect_list("fp").alias("fps"))
    firsts = few.select("start", "fps", F.explode("fps").alias("a"))
    pairs = firsts.select("start", "a", F.explode("fps").alias("b")).where("a < b")
    links = pairs.where(F.expr(_viable("a", "b", "start", distance))).select("a", "b").distinct()

    crowded = written(shared.where(F.col("n") > paired).select("fp").distinct(), "simhash-crowded")
    if crowded.isEmpty():
        return links
    return links.union(_neighbour_links(crowded, distance))


def _neighbour_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links over shared values near both fingerprints."""
    near, wide = fps.withColumn("value", F.col("fp")), None
    for step in range((distance + 1) // 2):
        flips = F.array(*[F.col("value").bitwiseXOR(F.lit(1 << bit if bit < 63 else -(1 << 63))) for bit in range(BITS)])
        grown = near.select("fp", F.explode(F.concat(F.array("value"), flips)).alias("value")).distinct()
        if step < distance // 2:
            near = grown
        else:
            wide = grown
    if wide is None:
        groups = near.groupBy("value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        stars = groups.select(F.array_min("fps").alias("b"), F.explode("fps").alias("a"))
        return stars.where("a != b").distinct()
    other = wide.select(F.col("fp").alias("b"), "value")
    return near.select(F.col("fp").alias("a"), "value").join(other, "value").where("a != b").select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row ``(key, fingerprint, component_id)`` per document.

    The component is the least key that can be reached over links of ``distance`` differing bits or fewer.
    Equal fingerprints are one node, so copies are never paired. A null or empty text has fingerprint zero, which
    links like any other; null keys count last, so a component has a null id only if it has no other key.
    Rows that repeat a key stay. An empty table gives no rows.
    """
    marked = written(fingerprints(docs, key, text, width), "simhash-fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min(key).alias("first")), "simhash-nodes")
    roots = components(near_links(nodes.select("fp"), distance))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(rooted.select("fp", "root").join(least, "root").select("fp", "component_id"), "simhash-components")
    return marked.join(named, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near-copies: of each component the row with the least ``doc_id`` and text hash stays.

    Rows are told apart by id and text, so rows that repeat an id with another text are judged each by its own text; rows without an
    id come last. Of rows equal in both the least row stays. The rows to drop are sent to all tasks if their
    measured size is within the library's bound, else joined by shuffle. An empty table gives no rows.
    """
    content = F.xxhash64(F.coalesce("text", F.lit("")))
    who = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), content.alias("content"))
    groups = written(near_duplicates(docs.select(who.alias("who"), "text"), "who"), "simhash-groups")
    dropped = groups.where(F.col("who") != F.col("component_id")).select("who").distinct()
    if fits_broadcast(dropped, F.lit(32)):
        dropped = F.broadcast(dropped)
    marked = nested(docs, who.alias("who"))
    kept = marked.join(dropped, "who", "left_anti")
    repeated = groups.groupBy("who").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = written(repeated.select("who"), "simhash-repeated")
    if repeated.isEmpty():
        return kept.select("given.*")
    if fits_broadcast(repeated, F.lit(32)):
        repeated = F.broadcast(repeated)
    alone = kept.join(repeated, "who", "left_anti").select("given")
    least = kept.join(repeated, "who", "left_semi").groupBy("who").agg(F.min("given").alias("given")).select("given")
    return alone.unionByName(least).select("given.*")
