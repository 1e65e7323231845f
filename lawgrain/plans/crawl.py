"""The whole catalogue run, from listing to manifest and verdict."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lawgrain.operators import manifest as M
from lawgrain.operators import outcome as O
from lawgrain.operators import scope as S
from lawgrain.operators import worklist as W
from lawgrain.operators.joins import attach, likely_matches
from lawgrain.params import COMPLETED_STATUSES, CrawlParams
from lawgrain.session import staged, staging_area
from lawgrain.sources import catalogue as G
from lawgrain.sources import landing as L

# Pending URIs whose attempts one task reduces, where there are shuffle partitions enough.
URIS_A_TASK = 10_000


@dataclass(frozen=True)
class LandingTables:
    """Input tables of a run.

    `listing`: item_no, category, document_type, akn_uri, and `page` where
    pages are to be limited. `completed`: akn_uri, distinct. `inventory`: one
    folder_path per stored document. `attempts`: the attempt log.
    """

    listing: DataFrame
    completed: DataFrame
    inventory: DataFrame
    attempts: DataFrame


def scoped_listing(listing: DataFrame, params: CrawlParams) -> DataFrame:
    """Listing rows in scope, in run order.

    The source filtered by year and language when it was asked; rows whose URI
    cannot be parsed pass, as they must end as errors. One narrow stage.
    """
    paged = S.limit_pages(listing, params.max_pages) if "page" in listing.columns else listing
    scoped = S.with_document_key(S.expand_types(paged, params.categories), params.base_path)
    return S.filter_requested(scoped, params)


def listed_items(pages: DataFrame, params: CrawlParams) -> DataFrame:
    """Listing rows of the pages a paging loop would have read.

    `pages` is `pages_from_bodies`. Each listing ends at its first failed,
    unreadable, empty or short page or after `max_pages`; pages behind that,
    left over from another run, do not count. The log the stops come from does
    not carry the items.
    """
    stream = ("category", "document_type")
    stops = S.stop_points(L.page_log(pages), params.limit, params.max_pages, stream)
    page, stop = F.col("page"), F.col("stop_page")
    read = stop.isNull() | (page < stop) | ((page == stop) & (F.col("stop_reason") == "short"))
    return L.items_from_pages(pages.join(stops, list(stream)).where(read))


def pending_documents(tables: LandingTables, params: CrawlParams) -> DataFrame:
    """What a run would fetch and where to, per listed document."""
    parsed = scoped_listing(tables.listing, params).where(F.col("document_key").isNotNull())
    work = W.worklist(parsed, tables.completed, params.resume and not params.reset)
    inventory = tables.inventory if not params.force else tables.inventory.where(F.lit(False))
    return W.dry_run_plan(S.with_paths(work), inventory, params.output_dir)


def _staged_scope(tables: LandingTables, params: CrawlParams) -> DataFrame:
    """Listing rows in scope, read and parsed once; all that follows starts from here."""
    parsed = F.col("document_key").isNotNull().alias("parsed")
    scoped = scoped_listing(tables.listing, params)
    return staged(scoped.select("category", "document_type", "akn_uri", "run_order", parsed), "scope")


def document_outcomes(tables: LandingTables, params: CrawlParams, run_timestamp: str) -> DataFrame:
    """One row per listed URI that is parsed and not completed: what a run makes of it."""
    return _outcomes(_staged_scope(tables, params), tables, params, run_timestamp)


def _outcomes(scope: DataFrame, tables: LandingTables, params: CrawlParams, run_timestamp: str) -> DataFrame:
    """`document_outcomes` of a staged scope.

    Everything about a document hangs on its URI, so the joins run on one row
    per URI. That row comes from an aggregate that combines on the map side,
    which takes the weight off a URI listed very often, and leaves the rows
    partitioned by URI as the join with completed URIs wants them. What is left is
    stored. The attempt log is cut to it where it lies, but for few rows too many, and
    only then dealt out by URI, which its aggregates and the join with the listed URIs
    share. The tasks are as many as the pending URIs ask for, up to the shuffle
    partitions: rows are many times larger in a sort than in an exchange, by whose
    bytes Spark would choose. What hangs on the folder (documents in store, folders that
    several URIs share) comes last.

    Adds `first_item`, `n_items` (times listed) and `stored_from`: the item of
    this run that stored the document's folder first, where several URIs lead to
    one folder. The rows are stored in the shared folder, as more than one job
    reads them.
    """
    items = scope.where("parsed")
    work = items.groupBy("akn_uri").agg(F.min("run_order").alias("item_no"), F.count("*").alias("n_items"))
    if params.resume and not params.reset:
        work = work.join(tables.completed.select("akn_uri"), "akn_uri", "left_anti")
    work = staged(work, "pending")
    spark = work.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, work.count() // URIS_A_TASK)
    partitions = min(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = likely_matches(tables.attempts, work, "akn_uri").repartition(partitions, "akn_uri")
    by_document = O.responses_by_document(O.final_responses(asked, spread=False), params)
    joined = S.with_paths(S.with_document_key(work.join(by_document, "akn_uri", "left"), params.base_path))
    known = W.with_existing(joined, tables.inventory, params.force)
    outcomes = O.decided(known, params).select(
        "akn_uri",
        F.col("item_no").alias("first_item"),
        "n_items",
        "folder_path",
        F.col("outcome").alias("status"),
        F.coalesce("first_ts", F.to_timestamp_ntz(F.lit(run_timestamp))).alias("timestamp"),
        "files",
        "error",
    )
    outcomes = staged(outcomes, "outcomes")
    if params.force or params.dry_run:
        # The store is not looked at, or nothing is stored.
        return outcomes.withColumn("stored_from", F.lit(None).cast("bigint"))
    stored = F.when(F.col("status") == "success", F.col("first_item"))
    shared = (
        outcomes.groupBy("folder_path")
        .agg(F.count("*").alias("_uris"), F.min(stored).alias("stored_from"))
        .where("_uris > 1 AND stored_from IS NOT NULL")
        .drop("_uris")
    )
    # Few folders are shared: on its stored size Spark plans this as a broadcast.
    return attach(outcomes, staged(shared, "shared-folders"), "folder_path")


def crawl_manifest(tables: LandingTables, params: CrawlParams, run_timestamp: str) -> DataFrame:
    """Manifest entries of one run, by `item_no` in the order a loop would write them.

    Rows without a usable URI are errors each by itself and need no join. A
    completed URI gives one entry. Only URIs that fail and are listed several
    times go back to the listing: each time gives an entry, until another URI
    has stored the same folder, after which the next one is skipped.
    """
    return _entries(_staged_scope(tables, params), tables, params, run_timestamp)


def _entries(scope: DataFrame, tables: LandingTables, params: CrawlParams, run_timestamp: str) -> DataFrame:
    """`crawl_manifest` of a staged scope."""
    stamp = F.to_timestamp_ntz(F.lit(run_timestamp)).alias("timestamp")
    no_files = F.array().cast("array<string>").alias("files")
    unparsed = scope.where("NOT parsed").select(
        F.col("run_order").alias("item_no"),
        "akn_uri",
        F.lit("error").alias("status"),
        stamp,
        no_files,
        F.concat(F.lit("Failed to parse URI: "), F.coalesce("akn_uri", F.lit(""))).alias("error"),
    )

    outcomes = _outcomes(scope, tables, params, run_timestamp)
    main_file = F.array(F.concat(F.lit(f"{params.output_dir}/"), "folder_path", F.lit("/main.xml")))
    done = F.col("status").isin(*COMPLETED_STATUSES)

    def entries(rows: DataFrame, item: str, skipped: Column) -> DataFrame:
        return rows.select(
            F.col(item).alias("item_no"),
            "akn_uri",
            F.when(skipped, "skipped").otherwise(F.col("status")).alias("status"),
            "timestamp",
            F.when(skipped, main_file).otherwise(F.col("files")).alias("files"),
            F.when(~skipped, F.col("error")).alias("error"),
        ).where(F.col("status").isNotNull())

    late = F.coalesce(F.col("first_item") > F.col("stored_from"), F.lit(False))
    once = F.coalesce(done, F.lit(False)) | late | (F.col("n_items") == 1)
    single = entries(outcomes.where(once), "first_item", late)

    items = scope.where("parsed").select("akn_uri", "run_order")
    again = attach(items, outcomes.where(~once), "akn_uri", "inner")
    after = F.coalesce(F.col("run_order") > F.col("stored_from"), F.lit(False))
    failing = entries(again.where(~after), "run_order", F.lit(False))
    columns = ("akn_uri", "folder_path", "status", "timestamp", "error")
    first_after = again.where(after).groupBy(*columns).agg(F.min("run_order").alias("run_order"))
    found = entries(first_after.withColumn("files", no_files), "run_order", F.lit(True))
    return S.union_listings(unparsed, single, failing, found)


def _verdict(summary: DataFrame) -> DataFrame:
    return summary.withColumn("exit_code", F.when(F.col("error") == 0, 0).otherwise(1))


def run_report(manifest: DataFrame) -> DataFrame:
    """Summary and exit code over the whole manifest, in one pass."""
    return _verdict(M.manifest_summary(manifest))


def stored_report(spark: SparkSession, manifest_root: str) -> DataFrame:
    """`run_report` of a stored manifest, from one row of counts a run."""
    return _verdict(G.read_summary(spark, manifest_root))


@dataclass(frozen=True)
class CatalogueRoots:
    """Folders of the catalogue's tables."""

    manifest: str
    completed: str
    progress: str


def run_crawl(
    tables: LandingTables, roots: CatalogueRoots, params: CrawlParams, run_id: str, run_timestamp: str
) -> DataFrame:
    """A whole run: state read, entries made, state written, verdict over all history.

    `tables.completed` counts beside the completed URIs of earlier runs, unless the
    run resets: then both are forgotten and the manifest stays. Each table gets the
    run as a part of its own, published when it is written, so a repeated run replaces
    itself and one that is lost midway replaces nothing; what it had completed itself
    does not count. Run ids sort by time. Tables staged on the way
    are removed. Returns the summary with the exit code.
    """
    spark = tables.listing.sparkSession
    if params.reset:
        G.reset_state(spark, roots.completed, roots.progress)
    known = tables.completed.select("akn_uri")
    if params.reset:
        known = known.where(F.lit(False))
    else:
        known = known.unionByName(G.read_completed(spark, roots.completed, but_run=run_id))
    landed = LandingTables(tables.listing, known, tables.inventory, tables.attempts)
    with staging_area(spark):
        scope = _staged_scope(landed, params)
        written = G.write_manifest(_entries(scope, landed, params, run_timestamp), roots.manifest, run_id)
        entries = spark.read.parquet(written)
        G.write_completed(entries, roots.completed, run_id)
        done = known.select("akn_uri").distinct().withColumn("_done", F.lit(True))
        if not params.resume:
            done = done.where(F.lit(False))
        flagged = attach(scope.drop("parsed"), done, "akn_uri").withColumn("processed", F.col("_done").isNull())
        progress = M.progress_counter(flagged, order="run_order").select(
            "category", "document_type", "position", F.to_timestamp_ntz(F.lit(run_timestamp)).alias("updated_at")
        )
        G.write_progress(progress, roots.progress, run_id)
    return stored_report(spark, roots.manifest)
