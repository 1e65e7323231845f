"""Bounded samples of rows, the same whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def least_hashes(rows: DataFrame, key: Column, limit: int) -> DataFrame:
    """The `limit` rows with the least hash of `key`, or all where there are fewer.

    A cut at twice the wanted share leaves few rows before they are sorted, so that
    tasks do not send the driver their own `limit` rows each.
    """
    count = rows.count()
    share = min(1.0, (2.0 * limit + 100) / max(1, count))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 31))
    return rows.where(place < int(share * (1 << 31))).orderBy(place, key).limit(limit)


def least_distinct(rows: DataFrame, key: Column, limit: int) -> DataFrame:
    """One row of each of the `limit` distinct contents of `key` that hash lowest.

    Exact: where the first cut holds fewer contents than wanted, as with large groups of
    copies, it is widened until it holds enough or all. The driver gets hashes only, some
    sixteen times `limit` at most.
    """
    whole = 1 << 31
    placed = rows.withColumn("_place", F.pmod(F.xxhash64(key), F.lit(whole)))
    count = rows.count()
    cut = int(min(1.0, (2.0 * limit + 100) / max(1, count)) * whole)
    while True:
        found = placed.where(F.col("_place") < cut).select("_place").distinct().orderBy("_place").limit(limit).collect()
        if len(found) >= limit or cut >= whole:
            break
        cut = min(whole, 8 * cut)
    last = found[-1]["_place"] if found else -1
    return placed.where(F.col("_place") <= last).dropDuplicates(["_place"]).drop("_place")
