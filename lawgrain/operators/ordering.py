"""Ordinals within few, huge groups, and over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lawgrain.session import staged

# Rows a range should hold: small enough to give every listing work for many tasks,
# large enough that the ranges of a listing are few.
RANGE_ROWS = 1 << 15
# Cuts kept of a group, however large: 2 KB. Beyond RANGE_ROWS * CUTS rows its ranges
# grow instead.
CUTS = 256
# `monotonically_increasing_id` has the partition above these bits and the row below.
_ROW_BITS = 33


def _cuts_at_most(cuts: Column, value: Column) -> Column:
    """How many of the ascending `cuts` are at most `value`, by binary search."""
    steps = F.array(*[F.lit(CUTS >> step) for step in range(1, CUTS.bit_length())])

    def step(found: Column, width: Column) -> Column:
        return F.when(F.get(cuts, found + width - 1) <= value, found + width).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def ranged(rows: DataFrame, keys: Sequence[str], order: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add `_range`: the place of each row's range of `order` within its group.

    A group is cut at approximate quantiles of `order`, so that its ranges hold about
    `range_rows` rows however its values lie, evenly or in clusters; a group that needs
    fewer ranges than there are cuts takes every so many of them. The quantiles combine on
    the map side and make one small row a group.
    """
    shares = [k / CUTS for k in range(1, CUTS)]
    value = F.col(order)
    cuts = rows.groupBy(*keys).agg(
        # ten times as exact as the cuts are fine
        F.percentile_approx(value, shares, 10 * CUTS).alias("_cuts"),
        F.least(F.lit(CUTS), F.ceil(F.count("*") / F.lit(range_rows))).alias("_ranges"),
    )
    place = _cuts_at_most(F.col("_cuts"), value)
    range_no = F.floor(place * F.col("_ranges") / F.lit(CUTS)).alias("_range")
    return rows.join(cuts, list(keys)).select(*rows.columns, range_no)


def bucketed_ordinal(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """`row_number()` over `keys` by `order` (a unique BIGINT), spread over many tasks.

    A plain window would sort a whole group in one task, and a listing has a
    dozen groups however long it is. Here groups are cut into ranges of about
    `range_rows` rows. A counting pass, which combines on the map side, gives
    each range its offset, and the window runs within a range only. The rows are
    shuffled once, by (keys, range). Keys must not be NULL.
    """
    cut = ranged(rows, keys, order, range_rows)
    sizes = cut.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(*keys, "_range").orderBy(order)
    return (
        cut.withColumn("_local", F.row_number().over(local))
        .join(offsets, [*keys, "_range"])
        .withColumn(out, (F.col("_offset") + F.col("_local")).cast("bigint"))
        .drop("_range", "_offset", "_local")
    )


def total_ordinal(rows: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Place of each row (from 1) in the whole table by a total `order`.

    Spark sorts by ranges of the order. Each row is stored with its range and
    its place there, both made in the task that has sorted the range, and the
    ranges' offsets come from the stored table. What is read later never
    depends on partition numbers of a plan that is run again: a task that is
    repeated sorts the same range, whose bounds were drawn once, and a total
    order has one result. No task holds more than a range, whatever the ties.
    """
    at = F.monotonically_increasing_id()
    sorted_rows = rows.orderBy(*order).withColumn("_at", at)
    range_no, row = F.shiftright("_at", _ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    stored = staged(sorted_rows, "sorted").withColumn("_range", range_no)
    sizes = stored.groupBy("_range").agg(F.count("*").alias("_n"))
    # a row for each range, of which there are as many as shuffle partitions
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    placed = stored.join(offsets, "_range").withColumn(out, (F.col("_offset") + row + 1).cast("bigint"))
    return placed.drop("_range", "_offset", "_at")


def literal_rows(rows: DataFrame, names: Sequence[str], values: Sequence[Sequence[object]]) -> DataFrame:
    """A small constant table in the session of `rows`; its size is that of `values`."""
    structs: list[Column] = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, line)]) for line in values
    ]
    return rows.sparkSession.range(1).select(F.inline(F.array(*structs)))
