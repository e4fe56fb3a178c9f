"""A reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import nested, numbered, ship, spread, without

ROUNDS = 6
SEED = 20240229


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """Well-mixed 64 bits of each value under a round key."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64), seed % 2**63)]


def _half_bits(n: int) -> int:
    """Bits of a half, so that both halves together number at least ``n`` and less than ``4 * n`` values."""
    return max(1, ((n - 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in keys:
        left, right = right, left ^ (_mixed(right, key) & mask)
    return (left << shift) | right


def _network_back(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    for key in reversed(keys):
        left, right = right ^ (_mixed(left, key) & mask), left
    return (left << shift) | right


def _walked(x, n: int, seed: int, step) -> np.ndarray:
    """Cycle walking: the network is applied until the value is a row number again."""
    half, keys = _half_bits(n), _keys(seed)
    with np.errstate(over="ignore"):
        out = step(np.asarray(x, dtype=np.uint64), half, keys)
        while len(outside := np.flatnonzero(out >= np.uint64(n))):
            out[outside] = step(out[outside], half, keys)
    return out.astype(np.int64)


def permute(rows, n: int, seed: int = SEED) -> np.ndarray:
    """The position of each of the row numbers in a shuffle of ``0..n-1``."""
    return _walked(rows, n, seed, _network)


def restore(positions, n: int, seed: int = SEED) -> np.ndarray:
    """The row number at each position: the inverse of ``permute``."""
    return _walked(positions, n, seed, _network_back)


def place_of(row: int, n: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of a row, computed from its number alone."""
    position = int(permute([row], n, seed)[0])
    return position % shards, position // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = SEED) -> int:
    """Number of the row at a slot of a shard."""
    return int(restore([slot * shards + shard], n, seed)[0])


def shard_rows(rows: DataFrame, shards: int, order: list[str], seed: int = SEED) -> DataFrame:
    """``rows`` with their global number ``row``, ``shard`` and ``slot``.

    Rows are numbered in the order of ``order`` and their number is permuted; position ``p`` of the
    shuffle is slot ``p // shards`` of shard ``p % shards``. So the counts of shards differ by one at
    most, slots have no gaps, and a row's place follows from its number, the row count and the seed.

    Nulls come first in the order. Equal rows get places of their own. An empty table gives no rows.
    Columns of the input named like an added one are replaced. All columns are moved once, so pass
    keys and references rather than texts.
    """
    ship(rows.sparkSession)
    given = without(rows, "row", "shard", "slot")
    # equal keys: the hash of the whole row decides, and rows equal in that too are the same
    tie = F.xxhash64(*[F.col(f"`{name}`") for name in given.columns])
    keys = [f"given.`{name}`" for name in order]
    keyed = numbered(nested(given, tie.alias("tie")), *keys, "tie", number="row", purpose="shard-rows")
    n = keyed.count()
    if n == 0:
        return keyed.select("given.*", "row", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    @F.pandas_udf("long")
    def position(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), n, seed))

    placed = keyed.withColumn("position", position("row"))
    shard, slot = (F.col("position") % shards).cast("int"), F.expr(f"position div {int(shards)}")
    return placed.select("given.*", "row", shard.alias("shard"), slot.alias("slot"))


def document_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Size, checksum and place of all documents under the law ``rows``; texts are read where they lie."""
    described = spread(docs.select("doc_id", "text")).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = shard_rows(described, shards, ["doc_id"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row",
    )
