"""Signed-bit votes of 64-bit term hashes, one fingerprint per document, in built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Two bits, 32 places apart, are counted in one 64-bit sum. A half holds four billion
# votes, more than a text of the largest size a cell can have can cast.
LANES = 0x0000000100000001
LOW = 0xFFFFFFFF


def fingerprints(
    terms: DataFrame, hashes: str, weights: str | None = None, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """`keys` and fingerprint (bigint) of every document, which the keys name.

    `terms` has the keys and an array of 64-bit hashes, and if named an array of equal
    length with positive whole weights. A bit is 1 if terms of more than half the weight set
    it; a document without terms has fingerprint 0.

    Votes are added up where the text was read, so one row per document is shuffled.
    """
    if weights is None:
        each = terms.select(*keys, F.explode_outer(hashes).alias("h"))
        weight: Column = F.when(F.col("h").isNull(), 0).otherwise(1).cast("bigint")
    else:
        both = F.explode_outer(F.arrays_zip(F.col(hashes).alias("h"), F.col(weights).alias("w")))
        each = terms.select(*keys, both.alias("t")).select(*keys, "t.h", "t.w")
        weight = F.coalesce(F.col("w"), F.lit(0)).cast("bigint")
    each = each.select(*keys, F.coalesce("h", F.lit(0)).alias("h"), weight.alias("w"))
    votes = [
        F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"v{k}")
        for k in range(32)
    ]
    counted = each.groupBy(*keys).agg(F.sum("w").alias("total"), *votes)
    bits = F.lit(0).cast("bigint")
    for k in range(32):
        low = F.col(f"v{k}").bitwiseAND(F.lit(LOW))
        high = F.shiftrightunsigned(F.col(f"v{k}"), 32)
        for count, place in ((low, k), (high, k + 32)):
            set_bit = F.lit(1 << place if place < 63 else -(1 << 63)).cast("bigint")
            bits = bits.bitwiseOR(F.when(count * 2 > F.col("total"), set_bit).otherwise(F.lit(0)))
    return counted.select(*keys, bits.alias("fingerprint"))


def as_hex(fingerprint: Column) -> Column:
    """16 lower-case hex digits of a 64-bit fingerprint."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def differing_bits(left: Column, right: Column) -> Column:
    return F.bit_count(left.bitwiseXOR(right))
