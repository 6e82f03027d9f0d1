"""Bitmaps of hashed keys: a small filter that rows pass before they are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key, and the bounds of a bitmap: 2^24 bits are 2 MB.  A key sets two of them, so that one row
#: in 1000 passes by chance, and one in 100 with 830 000 keys; the join behind it decides in any case.
BITS_A_KEY = 64
LEAST_BITS, MOST_BITS = 10, 24


def bits_for(keys: int) -> int:
    """The size of a bitmap for so many keys, a power of two."""
    return 1 << min(MOST_BITS, max(LEAST_BITS, (BITS_A_KEY * keys).bit_length()))


def hashed(*parts: Column | str) -> Column:
    """What a key of one or several parts is known by."""
    return F.xxhash64(*parts)


def _slots(key: Column, bits: int) -> list[Column]:
    """The two bits of a key, from the lower and the upper half of its hash."""
    size = F.lit(bits).cast("long")
    return [F.pmod(key, size), F.pmod(F.shiftrightunsigned(key, 32), size)]


def bitmap(hashes: DataFrame, name: str, bits: int) -> DataFrame:
    """One row with ``bitmap``: which hashes occur in the column, as ``bits / 64`` numbers.

    A task sends a number per 64 slots at most, however many keys it has.
    """
    slot = F.col("slot")
    slots = hashes.select(F.explode(F.array(*_slots(F.col(name), bits))).alias("slot"))
    words = slots.select(F.shiftright(slot, 6).alias("id"), (slot % 64).cast("int").alias("b")) \
        .groupBy("id").agg(F.bit_or(F.expr("1L << b")).alias("w"))
    every = hashes.sparkSession.range(bits // 64).join(words, "id", "left").select(
        F.struct("id", F.coalesce("w", F.lit(0).cast("long")).alias("w")).alias("s"))
    return every.agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["w"])
                     .alias("bitmap"))


def may_contain(words: Column, key: Column, bits: int) -> Column:
    """False only for a hash that is not among those of the bitmap.

    ``key`` is evaluated anew for each look, which is cheaper for a hash than to bind it; the second
    bit is looked at only if the first is set.
    """
    def is_set(slot: Column) -> Column:
        word = F.get(words, F.shiftright(slot, 6).cast("int"))
        return F.bit_get(word, (slot % 64).cast("int")) == 1

    first, second = _slots(key, bits)
    return is_set(first) & is_set(second)
