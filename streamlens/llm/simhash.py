"""SimHash fingerprints with built-in aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64


def lanes(h: Column, weight: Column | None = None) -> list[Column]:
    """32 sums over the hashes of a group; each holds the (weighted) counts of two bits, 32 apart, in
    32-bit lanes."""
    bits = [F.shiftrightunsigned(h, j).bitwiseAND(F.lit(0x0000000100000001)) for j in range(32)]
    return [F.sum(b if weight is None else b * weight).alias(f"s{j}") for j, b in enumerate(bits)]


def fingerprint(count: str) -> Column:
    """The 64-bit majority fingerprint from the columns of :func:`lanes` and the group's row count (or sum of
    weights): a bit is set where twice its count is above that. A lambda over an array of the lanes, as 64
    nested conditions would make a method too long to be compiled."""
    n = F.col(count)

    def above(lane: Column) -> Column:
        return F.shiftrightunsigned(n - 2 * lane, 63)  # the sign: 1 if negative

    def place(s: Column, j: Column) -> Column:
        low, high = above(s.bitwiseAND(F.lit(0xFFFFFFFF))), above(F.shiftrightunsigned(s, 32))
        return F.call_function("shiftleft", low, j).bitwiseOR(F.call_function("shiftleft", high, j + 32))

    each = F.transform(F.array(*[f"s{j}" for j in range(32)]), place)
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def distance(a: Column, b: Column) -> Column:
    """Hamming distance."""
    return F.bit_count(a.bitwiseXOR(b))
