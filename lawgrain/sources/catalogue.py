"""Catalogue tables: manifest, completed set, progress, corpus."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lawgrain.operators.manifest import completed_set, manifest_summary
from lawgrain.schemas import (
    COMPLETED,
    CORPUS,
    MANIFEST_ENTRY,
    MANIFEST_FILE,
    MANIFEST_STATUSES,
    PROGRESS,
    STATE_FILE,
    SUMMARY,
)
from lawgrain.sources import commits


def read_manifest(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Entries of nested JSON manifests; an unreadable one has none.

    `multiline` is one manifest per file; otherwise one per line, which Spark
    can split.
    """
    files = spark.read.schema(MANIFEST_FILE).option("multiLine", multiline).json(path)
    return files.select(F.inline("entries"))


def write_manifest(entries: DataFrame, root: str, run_id: str) -> str:
    """Publish the entries of one run in the manifest table; returns their folder.

    Appends to the history; a run that is repeated replaces its own part, in one step
    after all is written. The run's counts are stored beside it. A status outside the
    domain fails the write, from within its one pass.
    """
    status = F.col("status")
    sound = F.coalesce(status.isin(*MANIFEST_STATUSES), F.lit(False))
    fail = F.raise_error(F.concat(F.lit("manifest entry with an unknown status: "), F.coalesce(status, F.lit("NULL"))))
    checked = entries.withColumn("status", F.when(sound, status).otherwise(fail.cast("string")))
    return commits.publish(checked, root, run_id, counts=manifest_summary)


def read_manifest_table(spark: SparkSession, root: str) -> DataFrame:
    """Manifest entries of all runs with their `run_id`, a STRING."""
    return commits.read(spark, root, MANIFEST_ENTRY)


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    """`manifest_summary` of the whole history from one stored row a run."""
    runs = commits.read(spark, root, SUMMARY, counts=True)
    return runs.agg(*[F.coalesce(F.sum(f.name), F.lit(0)).alias(f.name) for f in SUMMARY.fields])


def read_state(spark: SparkSession, path: str, multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """Completed set and progress from nested JSON state files; an unreadable one is empty.

    `multiline` is one state per file; otherwise one per line, which Spark can split.
    """
    state = spark.read.schema(STATE_FILE).option("multiLine", multiline).json(path)
    completed = state.select(F.explode("completed_uris").alias("akn_uri")).distinct()
    progress = state.where("current_category IS NOT NULL").select(
        F.col("current_category").alias("category"),
        F.col("current_document_type").alias("document_type"),
        F.coalesce("current_page", F.lit(1)).alias("position"),
        "updated_at",
    )
    return completed, progress


def write_completed(manifest_entries: DataFrame, root: str, run_id: str) -> None:
    """Publish what one run completed; repeating the run replaces its own part."""
    commits.publish(completed_set(manifest_entries), root, run_id)


def read_completed(spark: SparkSession, root: str, but_run: str | None = None) -> DataFrame:
    """Completed URIs of all runs; one completed by several runs is there as often.

    `but_run` leaves one run out: a run that is repeated, whose part is about to be
    replaced.
    """
    return commits.read(spark, root, COMPLETED, but=but_run).select("akn_uri")


def bucket_completed(spark: SparkSession, root: str, table: str, buckets: int) -> DataFrame:
    """Completed URIs of all runs, distinct, stored by URI hash as a catalogue table.

    A join by URI reads the buckets where they lie, so a completed set of many runs is
    moved once, here, and not with every worklist. Give as many buckets as a join should
    have tasks. A new call makes a new copy and points the table to it; copies before stay
    for readers that have begun.
    """
    path = f"{root}/_buckets/{uuid.uuid4().hex}"
    distinct = read_completed(spark, root).where("akn_uri IS NOT NULL").distinct()
    by_bucket = distinct.repartition(buckets, "akn_uri")  # one file a bucket
    by_bucket.write.bucketBy(buckets, "akn_uri").sortBy("akn_uri").option("path", path).mode("overwrite").saveAsTable(table)
    return spark.table(table)


def write_progress(progress: DataFrame, root: str, run_id: str) -> None:
    """Publish the positions reached by one run."""
    commits.publish(progress, root, run_id)


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """Positions of all runs with their `run_id`."""
    return commits.read(spark, root, PROGRESS)


def reset_state(spark: SparkSession, completed_root: str, progress_root: str) -> None:
    """Forget completed URIs and progress, each in one step; the manifest stays."""
    for root in (completed_root, progress_root):
        commits.forget(spark, root)


_PLACES = ("category", "document_type", "year")


def write_corpus(documents: DataFrame, root: str, run_id: str) -> None:
    """Publish the documents of one run, partitioned by category, type and year.

    `documents` has `info` and `xml`. Earlier runs stay as they are; a run that is
    repeated replaces its own part. One file per document does not scale, so
    documents share files. The rebalance hint gathers each partition's rows
    into tasks of the advisory size: small partitions are packed together and
    a partition with a third of all documents is split over many tasks.
    """
    keys = _PLACES
    placed = documents.where(F.col("info").isNotNull()).select(
        "*", *[F.col("info").getField(key).alias(key) for key in keys]
    )
    commits.publish(placed.hint("rebalance", *keys), root, run_id, keys)


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """Stored documents of all runs; filters on category, type and year prune folders.

    Partition values are STRINGs. A document that several runs have stored is there
    once for each; `latest_documents` keeps its last copy.
    """
    return commits.read(spark, root, CORPUS, _PLACES)


def latest_documents(corpus: DataFrame) -> DataFrame:
    """The copy of each document that the last run stored; run ids sort by time.

    The rank is cut at 1, so one row per document and task is shuffled.
    """
    last = Window.partitionBy(F.xxhash64("info"), "info").orderBy(F.desc("run_id"))
    return corpus.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def manifest_entries(rows: DataFrame) -> DataFrame:
    """Columns of a manifest entry, in order."""
    return rows.select(*[field.name for field in MANIFEST_ENTRY.fields])
