"""Expressions on post keys."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagwright.fixed_values import TRAIN_SHARE

BUCKETS = 10
# Bits of the digest that tell places within a bucket apart.
PLACE_BITS = 56


def _digest(key: Column) -> Column:
    return F.md5(key.cast("string").cast("binary"))


def key_bucket(key: Column, buckets: int = BUCKETS) -> Column:
    """A bucket that depends on the key alone, whatever the partitioning."""
    return F.conv(F.substring(_digest(key), 1, 8), 16, 10).cast("bigint") % buckets


def key_place(key: Column) -> Column:
    """The place of a key between 0 and ``BUCKETS`` in steps of 2 to the power of -56: its bucket, and more digits."""
    more = F.conv(F.substring(_digest(key), 9, PLACE_BITS // 4), 16, 10).cast("bigint")
    return F.shiftleft(key_bucket(key), PLACE_BITS) + more


def _threshold(share: Fraction) -> int:
    """The first place beyond a share of all places."""
    if not 0 <= share <= 1:
        raise ValueError(f"{float(share)} is no share")
    return round(share * BUCKETS * 2**PLACE_BITS)


def in_training(key: Column, share: float = TRAIN_SHARE) -> Column:
    """True for the keys of the training side, whose part of all keys is ``share``, to any number of digits."""
    return key_place(key) < F.lit(_threshold(Fraction(str(share)))).cast("bigint")


def key_part(key: Column, shares: list[float]) -> Column:
    """The part, from 0, that a key falls into: ``shares`` of all keys one after the other, and a last part for the rest.

    The parts do not overlap, and a key is in the first parts of two lists if these begin alike.
    """
    total, part = Fraction(0), F.lit(len(shares))
    bounds = []
    for share in shares:
        if share < 0:
            raise ValueError(f"{share} is no share")
        total += Fraction(str(share))
        bounds.append(_threshold(total))
    place = key_place(key)
    for at in reversed(range(len(bounds))):
        part = F.when(place < F.lit(bounds[at]).cast("bigint"), at).otherwise(part)
    return F.when(key.isNotNull(), part)
