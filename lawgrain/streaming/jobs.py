"""The path from listing to manifest as streams.

Every job runs on a checkpoint and may be stopped and started again without
loss or repetition. `availableNow` works off what has arrived and ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from lawgrain.operators.manifest import completed_set, stored_folders
from lawgrain.schemas import COMPLETED
from lawgrain.session import child_folders, path_exists, remove_path, staging_area
from lawgrain.sources.catalogue import write_manifest
from lawgrain.sources.landing import stream_list_pages
from lawgrain.streaming.state import EXPIRY_MS, add_to_state, drop_merged, state_before, until_done, without_empty_batches


def stream_listing(
    spark: SparkSession,
    landing: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive: str | None = None,
    max_age: str | None = None,
    packed: bool = False,
) -> DataFrame:
    """Listing rows of list pages as they arrive, so many files or bytes at a time.

    Pages that were worked off move to `archive`, so the landing folder holds, and each
    micro-batch lists, only what is new; `max_age` bounds the files remembered as seen.
    A micro-batch costs about a second however little it reads: where pages are many, land
    them `packed`, many to a file.
    """
    return stream_list_pages(spark, landing, max_files, max_bytes, archive, max_age, packed)


def stream_dedup(listing: DataFrame, completed: DataFrame) -> DataFrame:
    """Each URI once over the life of the checkpoint, completed ones never.

    The state grows with the distinct URIs, as a completed set does; keep it
    in RocksDB. A URI that fails is left out of `completed` and comes back in
    the next run with a new checkpoint; `stream_until_done` tries it again in the stream
    and forgets URIs that are no longer listed.
    """
    return listing.join(completed.select("akn_uri"), "akn_uri", "left_anti").dropDuplicates(["akn_uri"])


def stream_until_done(outcomes: DataFrame, completed: DataFrame, expiry_ms: int = EXPIRY_MS) -> DataFrame:
    """Rows of each URI up to its first success or skip, completed ones never; see `until_done`."""
    return until_done(outcomes.join(completed.select("akn_uri"), "akn_uri", "left_anti"), expiry_ms)


def stream_counts(manifest: DataFrame) -> DataFrame:
    """Entries per status so far."""
    return manifest.groupBy("status").agg(F.count("*").alias("entries"))


def stream_progress(listing: DataFrame) -> DataFrame:
    """Items seen so far per category and type."""
    return listing.groupBy("category", "document_type").agg(F.count("*").alias("items_seen"))


def append_to_table(rows: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Write new rows to a parquet table, each exactly once."""
    with without_empty_batches(rows.sparkSession):
        return (
            rows.writeStream.format("parquet")
            .outputMode("append")
            .option("path", root)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def keep_current(aggregate: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest state of a small aggregate; each batch is a version.

    Versions are written whole under their batch number, so that a reader
    never sees half of one and a replayed batch replaces itself. The version
    before stays for readers that have begun; older ones are removed.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
        for old in _versions(batch.sparkSession, root):
            if old < batch_id - 1:
                remove_path(batch.sparkSession, f"{root}/batch_id={old}")

    return (
        aggregate.writeStream.outputMode("complete")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions that are written completely."""
    names = [n for n in child_folders(spark, root) if n.startswith("batch_id=")]
    return sorted(int(n.split("=")[1]) for n in names if path_exists(spark, f"{root}/{n}/_SUCCESS"))


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """Latest version kept by `keep_current`; the folder names say which it is."""
    return spark.read.parquet(f"{root}/batch_id={_versions(spark, root)[-1]}")


def stream_manifest(entries: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Add the entries of each micro-batch to the manifest table.

    The batch number names the part: a replay replaces what the failed try may have
    published.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        write_manifest(batch, root, f"batch-{batch_id}")

    return (
        entries.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# What a batch adds to the state of `stream_crawl`.
STATE = StructType([*COMPLETED.fields, StructField("folder_path", StringType())])


def stream_crawl(
    listing: DataFrame,
    decide: Callable[[DataFrame, DataFrame, DataFrame], DataFrame],
    manifest_root: str,
    completed_root: str,
    checkpoint: str,
    output_dir: str = "corpus",
    snapshot_every: int = 20,
) -> StreamingQuery:
    """Work off a listing stream into manifest and completed tables.

    `decide(batch, completed, stored)` gives the manifest entries of a batch of
    listing rows; `stored` has the folders that earlier batches stored, so that a
    second URI of such a folder is skipped as it is within one batch. State is
    read back from the table, so that, unlike with a de-duplicating stream, a URI
    that failed is tried again when it is listed again, and none is kept in the
    stream. The table has a delta a batch and, every `snapshot_every` batches, a
    snapshot in place of all before, so a batch reads at most `snapshot_every` + 1
    folders. What a batch stages is removed with it.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        drop_merged(spark, completed_root, batch_id)
        before = state_before(spark, completed_root, STATE, batch_id)
        completed = before.where("akn_uri IS NOT NULL").select("akn_uri")
        stored = before.where("folder_path IS NOT NULL").select("folder_path")
        part = f"{manifest_root}/batch_id={batch_id}"
        with staging_area(spark):
            decide(batch, completed, stored).write.mode("overwrite").parquet(part)
        # Read back what was stored instead of deciding twice.
        entries = spark.read.parquet(part)
        done = completed_set(entries).withColumn("folder_path", F.lit(None).cast("string"))
        folders = stored_folders(entries, output_dir).withColumn("akn_uri", F.lit(None).cast("string"))
        add_to_state(done.unionByName(folders), completed_root, batch_id, snapshot_every)

    return (
        listing.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
