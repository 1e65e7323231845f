"""Manifest, completed set and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lawgrain.params import COMPLETED_STATUSES
from lawgrain.schemas import MANIFEST_STATUSES


def _count_of(status: str):
    return F.count_if(F.col("status") == status)


def manifest_rows(outcomes: DataFrame, run_timestamp: str) -> DataFrame:
    """Manifest entries of decided documents, with the run order beside them.

    The time is that of a document's first request; documents without one
    carry the run's own time.
    """
    stamp = F.coalesce(F.col("first_ts"), F.to_timestamp_ntz(F.lit(run_timestamp)))
    return outcomes.where(F.col("outcome").isNotNull()).select(
        "item_no",
        "akn_uri",
        F.col("outcome").alias("status"),
        stamp.alias("timestamp"),
        "files",
        "error",
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Entries in all and per status; `dry-run` counts in the total only."""
    return manifest.agg(
        F.count("*").alias("total"),
        _count_of("success").alias("success"),
        _count_of("skipped").alias("skipped"),
        _count_of("error").alias("error"),
    )


def manifest_header(manifest: DataFrame) -> DataFrame:
    """Header of a manifest: the counts and the time of its last entry."""
    return manifest.agg(
        F.max("timestamp").alias("updated_at"),
        F.count("*").alias("total_entries"),
        _count_of("success").alias("success_count"),
        _count_of("skipped").alias("skipped_count"),
        _count_of("error").alias("error_count"),
    )


def run_verdict(manifest: DataFrame) -> DataFrame:
    """Exit code over the whole history: 0 without errors, else 1."""
    return manifest.agg(F.when(_count_of("error") == 0, 0).otherwise(1).alias("exit_code"))


def unknown_statuses(manifest: DataFrame) -> DataFrame:
    """Entries whose status is outside the domain; empty for a sound manifest."""
    known = F.coalesce(F.col("status").isin(*MANIFEST_STATUSES), F.lit(False))
    return manifest.where(~known)


def filter_completable(entries: DataFrame) -> DataFrame:
    """Entries that complete their document."""
    return entries.where(F.col("status").isin(*COMPLETED_STATUSES))


def completed_set(manifest: DataFrame) -> DataFrame:
    """Distinct URIs that were ever completed."""
    return filter_completable(manifest).select("akn_uri").distinct()


def stored_folders(entries: DataFrame, output_dir: str) -> DataFrame:
    """Distinct folders of the documents that entries report as stored.

    The first file of a success is its main XML.
    """
    main = F.get("files", F.lit(0))
    folder = F.expr(f"substring(main, {len(output_dir) + 2}, length(main) - {len(output_dir) + 1 + len('/main.xml')})")
    stored = entries.where("status = 'success'").select(main.alias("main"))
    return stored.where(F.endswith("main", F.lit("/main.xml"))).select(folder.alias("folder_path")).distinct()


def last_uri(manifest: DataFrame) -> DataFrame:
    """URI completed last, by time and then item number."""
    return filter_completable(manifest).agg(
        F.max_by("akn_uri", F.struct("timestamp", "item_no")).alias("last_uri")
    )


def session_times(manifest: DataFrame) -> DataFrame:
    """Time of the first and of the last entry."""
    return manifest.agg(F.min("timestamp").alias("started_at"), F.max("timestamp").alias("updated_at"))


def manifest_latest(manifest: DataFrame) -> DataFrame:
    """Latest entry per URI, by time and then item number.

    The rank is cut at 1, so Spark keeps one row per URI and task before the
    shuffle; a URI with very many entries arrives as one row per map task. The
    sort is by the URI's hash first, as URIs share long prefixes.
    """
    latest = Window.partitionBy(F.xxhash64("akn_uri"), "akn_uri").orderBy(F.desc("timestamp"), F.desc("item_no"))
    return manifest.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def set_add(completed: DataFrame, newly: DataFrame) -> DataFrame:
    """Completed URIs with the new ones added."""
    return completed.select("akn_uri").union(newly.select("akn_uri")).distinct()


def append_manifest(history: DataFrame, new: DataFrame) -> DataFrame:
    """History followed by the new entries."""
    return history.unionByName(new)


def progress_counter(items: DataFrame, order: str = "item_no", processed: str = "processed") -> DataFrame:
    """Per (category, type) the position of its last item that was not skipped.

    The position is the number of items up to that one, so two map-side
    combined aggregates do, without numbering a whole listing. The rows between
    them are one per stream; Spark broadcasts them by their size. Streams in
    which nothing was processed are left out.
    """
    keys = ["category", "document_type"]
    last = items.where(F.col(processed)).groupBy(*keys).agg(F.max(order).alias("last_item"))
    return (
        items.join(last, keys)
        .groupBy(*keys, "last_item")
        .agg(F.count_if(F.col(order) <= F.col("last_item")).alias("position"))
        .select(*keys, "last_item", "position")
    )


def resume_position(progress: DataFrame, category: str | None = None, document_type: str | None = None) -> DataFrame:
    """Stored position of the stream processed last, 1 for every other one.

    `progress` is `progress_counter`, counted by an order that runs through all
    streams, such as `run_order`: item numbers of pages start anew in each listing
    and would name the longest stream instead of the latest.
    """
    latest = progress.agg(F.max("last_item")).scalar()
    at = F.when(F.col("last_item") == latest, F.col("position")).otherwise(1)
    resumed = progress.select("category", "document_type", at.alias("resume_at"))
    if category is not None:
        resumed = resumed.where((F.col("category") == category) & (F.col("document_type") == document_type))
    return resumed
