"""What is left to do: completed documents, documents in store, repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lawgrain.operators.joins import attach
from lawgrain.params import COMPLETED_STATUSES


def worklist(listing: DataFrame, completed: DataFrame, resume: bool = True, uri: str = "akn_uri") -> DataFrame:
    """Listing rows whose URI is not completed; all rows when not resuming.

    An anti join on the URI. Its left side may hold one URI very often (a
    missing URI, say): the join then splits that partition at run time. It does
    not matter whether `completed` holds a URI once or several times.
    """
    if not resume:
        return listing
    return attach(listing, completed.select(uri), uri, "left_anti").select(*listing.columns)


def worklist_bucketed(listing: DataFrame, completed: DataFrame, uri: str = "akn_uri") -> DataFrame:
    """`worklist` against completed URIs in buckets (`bucket_completed`), which do not move.

    The listed URIs, made distinct on the map side first, go to the buckets. What is found
    there is at most the listing's distinct URIs; the listing is joined with that, which
    splits a URI that is listed very often.
    """
    done = listing.select(uri).distinct().join(completed.select(uri), uri, "left_semi")
    return attach(listing, done, uri, "left_anti").select(*listing.columns)


def skip_completed(listing: DataFrame, completed: DataFrame, resume: bool = True, uri: str = "akn_uri") -> DataFrame:
    """Listing rows whose URI is completed already; none when not resuming."""
    if not resume:
        return listing.where(F.lit(False))
    return attach(listing, completed.select(uri), uri, "left_semi").select(*listing.columns)


def with_existing(rows: DataFrame, inventory: DataFrame, force: bool = False) -> DataFrame:
    """Add `exists`: whether the document's main XML is in store.

    `inventory` names stored folders by `folder_path`, one perhaps several times.
    With `force` the store is not consulted and `exists` is FALSE.
    """
    if force:
        return rows.withColumn("exists", F.lit(False))
    stored = inventory.select("folder_path").distinct().withColumn("exists", F.lit(True))
    return (
        attach(rows, stored, "folder_path")
        .select(*rows.columns, F.coalesce("exists", F.lit(False)).alias("exists"))
    )


def existing_documents(rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rows whose main XML is in store."""
    return attach(rows, inventory.select("folder_path"), "folder_path", "left_semi").select(*rows.columns)


def in_run_dedup(
    outcomes: DataFrame, uri: str = "akn_uri", order: str = "item_no", status: str = "status"
) -> DataFrame:
    """Per URI the rows up to and including the first success or skip.

    A running maximum over the copies of a URI would sort them in one task.
    The first completed copy is a minimum, which combines on the map side;
    joined back it is one row per URI, so a URI with very many copies is split
    by the join at run time. `order` must be unique per URI.
    """
    first_done = (
        outcomes.where(F.col(status).isin(*COMPLETED_STATUSES))
        .groupBy(uri)
        .agg(F.min(order).alias("_first_done"))
    )
    return (
        attach(outcomes, first_done, uri)
        .where(F.col("_first_done").isNull() | (F.col(order) <= F.col("_first_done")))
        .select(*outcomes.columns)
    )


def dry_run_plan(work: DataFrame, inventory: DataFrame, output_dir: str = "") -> DataFrame:
    """URI and target folder of every document that would be fetched.

    `work` has passed `worklist` and `with_paths`. Unparseable rows
    drop out; repeats of a URI stay, since a dry run completes nothing.
    """
    parsed = work.where(F.col("folder_path").isNotNull())
    missing = attach(parsed, inventory.select("folder_path"), "folder_path", "left_anti")
    target = F.concat(F.lit(f"{output_dir}/"), "folder_path") if output_dir else F.col("folder_path")
    return missing.select("item_no", "akn_uri", target.alias("target_folder"))
