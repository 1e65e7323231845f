"""Joins of rows to facts that are unique per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lawgrain.session import staged

# Bits of `likely_matches` at most, as a power of two: 16 MB.
MAX_BITS = 27


def attach(rows: DataFrame, facts: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join `rows` to `facts`, which has few rows per key, usually one.

    The key's hash is a join key too, and the first one, for two reasons.

    A key may be on very many rows. Spark splits such a partition at run time,
    but only where both sides come straight from an exchange; facts that were
    just aggregated by the key would be joined in place and the hot key left in
    one task. With the hash they are exchanged again, so the split applies.

    URIs share long prefixes, which makes sorting by them slow. By the hash
    first, nearly every comparison is one of two numbers.

    Small facts are broadcast instead, which Spark decides by their size.
    """
    tie = F.xxhash64(key)
    left, right = rows.withColumn("_tie", tie), facts.withColumn("_tie", tie)
    return left.join(right, ["_tie", key], how).drop("_tie")


def likely_matches(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among those of `facts`, and few others; `rows` do not move.

    For a join that keeps a small part of a table which would have to be exchanged for it.
    Each key of `facts` sets the bit at its hash. The bitmaps, of at least eight bits a key,
    are stored and broadcast: 16 MB at most, with many more keys more rows pass. No match is
    lost, and about every eighth other row stays, so a join by the key itself must follow.
    `facts` is read twice and had better be a stored table.
    """
    bits = 1 << max(15, min(MAX_BITS, (8 * facts.count() - 1).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1  # buckets count from 1
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    marks = facts.where(F.col(key).isNotNull()).select(bucket.alias("_bucket"), bit.alias("_bit"))
    bitmaps = marks.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))

    def word(number: Column) -> Column:
        """Eight bytes of the bitmap, the first one highest."""
        return F.conv(F.hex(F.substring("_bitmap", number * 8 + 1, F.lit(8))), 16, -10).cast("bigint")

    numbers = F.sequence(F.lit(0), F.lit(511))  # words of a bitmap, which has 4 KB
    words = staged(bitmaps.select("_bucket", F.transform(numbers, word).alias("_words")), "bitmaps")
    at = F.col("_at")
    in_word = F.lit(56) - at.bitwiseAND(F.lit(56)) + at.bitwiseAND(F.lit(7))
    is_set = F.bit_get(F.get("_words", F.shiftright(at, 6)), in_word) == 1
    return (
        rows.where(F.col(key).isNotNull())
        .select("*", bucket.alias("_bucket"), bit.cast("int").alias("_at"))
        .join(F.broadcast(words), "_bucket")
        .where(is_set)
        .select(*rows.columns)
    )
