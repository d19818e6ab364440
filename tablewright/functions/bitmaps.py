"""A set of keys as one bit per hashed key, in Spark's own bitmaps of 4 KB: a key whose bit is unset is surely not in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of one of Spark's bitmaps.
BITMAP = 32_768
#: Bits of a set that is broadcast: 64 MB.
MOST_BITS = 1 << 29
BITS_PER_KEY = 16


def bits_for(keys: int) -> int:
    """Bits for so many keys, at most ``MOST_BITS``: a fuller set lets more keys through, and stays right."""
    return min(MOST_BITS, (keys * BITS_PER_KEY // BITMAP + 1) * BITMAP)


def _place(key: Column | str, bits: int) -> Column:
    # Spark numbers bits from 1.
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def key_bits(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """``slot`` and ``bitmap``: the bits of all keys. Folded on the map side, at most ``bits`` / 8 bytes in all."""
    place = _place(key, bits)
    return keys.groupBy(F.bitmap_bucket_number(place).alias("_slot")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap")
    )


def flag_maybe(df: DataFrame, key: str, bitmaps: DataFrame, bits: int, flag: str) -> DataFrame:
    """``df`` with a flag: false where the key is surely not in the set. The bitmaps are broadcast; ``bits`` bounds them."""
    if bits > MOST_BITS:
        raise ValueError(f"{bits} bits are too many to broadcast")
    place = _place(key, bits)
    joined = df.withColumn("_slot", F.bitmap_bucket_number(place)).join(F.broadcast(bitmaps), "_slot", "left")
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (at % 8).cast("int")) == 1
    return joined.withColumn(flag, F.coalesce(bit, F.lit(False))).drop("_slot", "_bitmap")
