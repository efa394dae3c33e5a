"""Sets of whole-number keys as bitmaps: a row per range of keys, a bit per key, exact for every bigint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of Spark's bitmap functions: keys and bytes of one bitmap.
KEYS = 1 << 15
BYTES = KEYS // 8
# Keys of one slice of a bitmap. A row that is looked up is copied, so it should be short.
SLICE = 1 << 10
SLICES = KEYS // SLICE
# What a slice takes in a broadcast at most: its bits, two keys, and what a hashed row has around them.
SLICE_BYTES = SLICE // 8 + 96


def bucket_of(key: Column) -> Column:
    return F.call_function("bitmap_bucket_number", key)


def place_of(key: Column) -> Column:
    return F.call_function("bitmap_bit_position", key)


def has_bit(bits: Column, place: Column) -> Column:
    """Whether a bitmap, NULL if there is none, has a bit."""
    # A byte reads as the code of a character in Latin-1: no cast makes a number of one.
    byte = F.ascii(F.decode(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    bit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), place.bitwiseAND(F.lit(7)).cast("int")))
    return F.coalesce(bit != 0, F.lit(False))


def bitmaps(keys: DataFrame, key: str, *by: str) -> DataFrame:
    """``by``, bucket, bits: the keys that are not NULL, combined before the shuffle."""
    known = keys.filter(F.col(key).isNotNull())
    return known.groupBy(*by, bucket_of(F.col(key)).alias("bucket")).agg(
        F.bitmap_construct_agg(place_of(F.col(key))).alias("bits")
    )


def slice_of(key: Column) -> Column:
    return bucket_of(key) * SLICES + F.floor(place_of(key) / SLICE)


def place_in_slice(key: Column) -> Column:
    return place_of(key).bitwiseAND(F.lit(SLICE - 1).cast("bigint"))


def sliced(maps: DataFrame, *by: str) -> DataFrame:
    """``by``, slice, bits: bitmaps cut into slices, empty ones left out."""
    number = F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))
    size = F.lit(SLICE // 8)
    cut = maps.select(*by, "bucket", "bits", number.alias("number")).select(
        *by,
        (F.col("bucket") * SLICES + F.col("number")).alias("slice"),
        F.substring("bits", F.col("number") * size + 1, size).alias("bits"),
    )
    return cut.filter(F.bitmap_count("bits") > 0)


def most_bytes(keys: int, low: int | None, high: int | None) -> int:
    """What the slices of so many keys between two bounds can take at most."""
    if not keys or low is None or high is None:
        return 0
    return min(keys, high // SLICE - low // SLICE + 2) * SLICE_BYTES
