"""Bitmaps of hashes with a fixed size, to spare a join the rows that cannot match.

A bitmap has 2^23 bits in 256 rows of 4 KiB, whatever it is made from, so it may be
broadcast. A row passes if the bit of its hash is set; an exact join must follow. Where
a bitmap is full everything passes, and the join does the whole work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopgrid.llm.common import free_name
from stopgrid.session import stored

BITS = 23
#: Fixed value: the bits in one bitmap of Spark's bitmap functions.
ROW_BITS = 15


def _place(hash_: Column) -> tuple[Column, Column]:
    bit = hash_.bitwiseAND(F.lit((1 << BITS) - 1))
    return F.shiftright(bit, ROW_BITS), bit.bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def bitmap(df: DataFrame, hash_: Column) -> DataFrame:
    """(bucket, words): the bits of each bucket as numbers of 64, their bytes from the highest on."""
    bucket, place = _place(hash_)
    found = df.select(bucket.alias("bucket"), place.alias("place")).groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    word = "cast(conv(hex(substring(bits, 8 * w + 1, 8)), 16, -10) as bigint)"
    words = F.expr(f"transform(sequence(0, {(1 << ROW_BITS - 6) - 1}), w -> {word})")
    return stored(found.select("bucket", words.alias("words")).coalesce(1), "bitmap")


def may_match(df: DataFrame, hash_: Column, bits: DataFrame) -> DataFrame:
    """The rows of `df` whose hash may be in the bitmap."""
    bucket, place, row = (free_name(df, n) for n in ("bitmap_bucket", "bitmap_place", "bitmap_row"))
    b, p = _place(hash_)
    known = F.broadcast(bits.select(F.col("bucket").alias(bucket), F.col("words").alias(row)))
    found = df.withColumns({bucket: b, place: p}).join(known, bucket)
    word = F.col(row)[F.shiftright(place, 6).cast("int")]
    # bits are counted from the lowest of the first byte on, which is the highest of its word
    bit = F.col(place).bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)).cast("int")
    return found.filter(F.getbit(word, bit) == 1).select(*(f"`{c}`" for c in df.columns))
