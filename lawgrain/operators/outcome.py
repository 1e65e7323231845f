"""From fetch attempts to one outcome and file list per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lawgrain.functions import http as H
from lawgrain.functions import uri as U
from lawgrain.operators.joins import attach
from lawgrain.params import ASSET_KINDS, MAX_RETRIES, CrawlParams

# Request suffix, stored name and accept type of each kind.
ASSET_REQUESTS = {
    "xml": ("", "main.xml", "application/xml"),
    "pdf": ("/main.pdf", "main.pdf", "application/pdf"),
    "zip": ("/main.akn", "main.zip", "application/zip"),
}
MEDIA_ACCEPT = "application/xml"


def _kind_order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name in ASSET_KINDS]), kind).cast("int") - 1


def _file_name(kind: Column, link: Column) -> Column:
    name = F.when(kind == "media", F.concat(F.lit("media/"), U.media_basename(link)))
    for key, (_, stored, _) in ASSET_REQUESTS.items():
        name = name.when(kind == key, stored)
    return name


def asset_plan(documents: DataFrame, params: CrawlParams, media_links: str | None = None) -> DataFrame:
    """One row per request a document needs, in the order they are made.

    `documents` has `akn_uri`, `folder_path` and `api_path`; `media_links`
    names its array column of links. A narrow job: one explode, no shuffle.
    """
    folder = F.concat(F.lit(f"{params.output_dir}/"), "folder_path")

    def request(kind: str, link: Column, suffix: Column, stored: Column, accept: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(ASSET_KINDS.index(kind)).alias("ord"),
            link.alias("link"),
            U.request_url(params.base_url, F.concat(F.col("api_path"), suffix)).alias("request_url"),
            F.concat(folder, F.lit("/"), stored).alias("file_path"),
            F.lit(accept).alias("accept"),
        )

    no_link = F.lit(None).cast("string")
    fixed = F.array(
        *[
            request(kind, no_link, F.lit(suffix), F.lit(stored), accept)
            for kind, (suffix, stored, accept) in ASSET_REQUESTS.items()
            if kind in params.asset_kinds
        ]
    )
    requests = fixed
    if params.fetch_media and media_links is not None:
        media = F.transform(
            F.coalesce(F.col(media_links), F.array().cast("array<string>")),
            lambda link: request(
                "media",
                link,
                F.concat(F.lit("/"), link),
                F.concat(F.lit("media/"), U.media_basename(link)),
                MEDIA_ACCEPT,
            ),
        )
        requests = F.concat(fixed, media)
    return documents.where(F.col("folder_path").isNotNull()).select("akn_uri", F.inline(requests))


def filter_retryable(attempts: DataFrame) -> DataFrame:
    """Attempts whose HTTP status calls for another try."""
    return attempts.where(H.is_retryable(F.col("http_status")))


def classify_responses(attempts: DataFrame) -> DataFrame:
    """Attempts with their `response_class`."""
    return attempts.withColumn("response_class", H.response_class(F.col("http_status")))


def final_responses(
    attempts: DataFrame,
    max_retries: int = MAX_RETRIES,
    keys: Sequence[str] = ("akn_uri", "kind", "link"),
    spread: bool = True,
) -> DataFrame:
    """Per request what its newest run made of it.

    The last attempt of that run with its status or exception, the attempts used,
    whether they ran out (`exhausted`: every allowed attempt was made and each called
    for another) and whether there were more than allowed (`over_budget`). Earlier
    runs do not count: a document that failed in one and was fetched in the next is
    fetched. Aggregates combine on the map side, so no chain of attempts is gathered.
    The exception text makes them sorting aggregates: the hash of the keys goes
    first, so that the sort compares numbers and not URIs of one prefix.

    A file of URIs is many times larger in the memory of that sort. So the attempts are
    `spread` over the shuffle partitions first, a long chain over many of them, unless they
    come from a join that has dealt them out by URI.
    """
    if spread:
        partitions = int(attempts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        attempts = attempts.repartition(partitions, F.xxhash64(*keys, "run_id", "attempt", "start_ts"))
    attempt = F.col("attempt")
    retryable = H.is_retryable(F.col("http_status")) | F.col("exception").isNotNull()
    by_run = attempts.groupBy(F.xxhash64(*keys).alias("_hash"), *keys, "run_id").agg(
        F.max_by("http_status", attempt).cast("int").alias("http_status"),
        F.max_by("exception", attempt).alias("exception"),
        F.count("*").alias("attempts_used"),
        F.bool_and(retryable).alias("_all_retryable"),
        F.min("start_ts").alias("start_ts"),
    )
    result = F.struct("http_status", "exception", "attempts_used", "_all_retryable", "start_ts")
    newest = by_run.groupBy("_hash", *keys).agg(
        F.max_by(result, F.struct("run_id")).alias("_last"), F.max("run_id").alias("run_id")
    )
    used = F.col("_last.attempts_used")
    return newest.select(
        *keys,
        "run_id",
        "_last.http_status",
        "_last.exception",
        used.alias("attempts_used"),
        (F.col("_last._all_retryable") & (used >= max_retries + 1)).alias("exhausted"),
        (used > max_retries + 1).alias("over_budget"),
        "_last.start_ts",
    )


def asset_warned(kind: Column, http_status: Column, exception: Column) -> Column:
    """Whether the final response of an optional asset is worth a warning."""
    failed = exception.isNotNull()
    odd_status = ~F.coalesce(http_status.isin(200, 404), F.lit(True))
    return F.when(kind.isin("pdf", "zip"), failed | odd_status).when(kind == "media", failed).otherwise(False)


def asset_warnings(responses: DataFrame) -> DataFrame:
    """Number of warned assets per document and kind, where there are any."""
    warned = asset_warned(F.col("kind"), F.col("http_status"), F.col("exception"))
    return responses.where(warned).groupBy("akn_uri", "kind").agg(F.count("*").alias("n_warnings"))


def responses_by_document(responses: DataFrame, params: CrawlParams) -> DataFrame:
    """One row per document: XML result, first request time, stored files.

    `stored` holds one element per stored asset. The responses are one row per
    request by now, so its length is bounded by the links of one document.
    """
    kind = F.col("kind")
    is_xml = kind == "xml"
    stored = F.when(
        (F.col("http_status") == 200) & kind.isin(*params.asset_kinds),
        F.struct(_kind_order(kind).alias("ord"), _file_name(kind, F.col("link")).alias("name")),
    )
    return responses.groupBy("akn_uri").agg(
        F.bool_or(is_xml).alias("_fetched"),
        F.max(F.when(is_xml, F.col("http_status"))).alias("xml_status"),
        F.max(F.when(is_xml, F.col("exception"))).alias("xml_exception"),
        F.min("start_ts").alias("first_ts"),
        F.array_sort(F.collect_list(stored)).alias("stored"),
    )


def outcome_status(params: CrawlParams) -> Column:
    """Status from `folder_path`, `exists` and the XML result; the first rule decides.

    NULL for a document that has no XML attempt in the log yet.
    """
    status = F.when(F.col("folder_path").isNull(), "error").when(F.col("exists"), "skipped")
    if params.dry_run:
        return status.otherwise("dry-run")
    return (
        status.when(~F.coalesce("_fetched", F.lit(False)), F.lit(None).cast("string"))
        .when(F.col("xml_exception").isNotNull() | (F.col("xml_status") != 200), "error")
        .otherwise("success")
    )


def outcome_error(status: Column, uri: Column) -> Column:
    """Message of an `error` row, else NULL."""
    message = (
        F.when(F.col("folder_path").isNull(), F.concat(F.lit("Failed to parse URI: "), F.coalesce(uri, F.lit(""))))
        .when(
            F.col("xml_exception").isNotNull(),
            F.concat(F.lit("Failed to fetch XML: "), F.col("xml_exception")),
        )
        .otherwise(F.concat(F.lit("HTTP "), F.col("xml_status"), F.lit(" fetching XML")))
    )
    return F.when(status == "error", message)


def document_outcome(
    work: DataFrame, by_document: DataFrame, params: CrawlParams, uri: str = "akn_uri"
) -> DataFrame:
    """Status, error, first request time and files of each worklist row.

    `work` has passed `with_paths` and `with_existing`; `by_document`
    is `responses_by_document`, one row per URI. `files` are ordered XML, PDF,
    ZIP, media, then by path.
    """
    return decided(attach(work, by_document, uri), params, uri).select(
        *work.columns, "outcome", "error", "first_ts", "files"
    )


def decided(joined: DataFrame, params: CrawlParams, uri: str = "akn_uri") -> DataFrame:
    """`outcome`, `error` and `files` added to worklist rows with their responses."""
    folder = F.concat(F.lit(f"{params.output_dir}/"), "folder_path", F.lit("/"))
    joined = joined.withColumn("outcome", outcome_status(params))
    outcome = F.col("outcome")
    files = (
        F.when(outcome == "success", F.transform("stored", lambda file: F.concat(folder, file["name"])))
        .when(outcome == "skipped", F.array(F.concat(folder, F.lit("main.xml"))))
        .otherwise(F.array().cast("array<string>"))
    )
    return joined.withColumn("error", outcome_error(outcome, F.col(uri))).withColumn("files", files)


def document_files(outcomes: DataFrame) -> DataFrame:
    """One row per stored file, numbered from 0 within its document."""
    return outcomes.select("item_no", "akn_uri", F.posexplode("files").alias("file_no", "file_path"))


def pacing_audit(
    requests: DataFrame,
    sleep_seconds: float,
    client: str = "client_id",
    start: str = "start_ts",
    end: str = "end_ts",
    request: str = "request_id",
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Wait each request had to make after the previous one of its client.

    `wait_us` is max(0, sleep - (start - previous end)) and 0 for a client's
    first request. One client may have made most requests, so the look-back
    runs within (client, time bucket); the first request of a bucket takes the
    last end of the bucket before, which a map-side combined aggregate gives. A
    missing end stays missing, whatever the buckets: no wait follows it. A client works one request at a time, so a bucket is bounded by the
    requests it can make in `bucket_seconds`.
    """
    bucket = F.floor(F.unix_micros(F.col(start).cast("timestamp")) / F.lit(bucket_seconds * 1_000_000))
    cut = requests.withColumn("_bucket", bucket)
    order = F.struct(F.col(start), F.col(request))
    lasts = cut.groupBy(client, "_bucket").agg(F.max_by(F.col(end), order).alias("_last_end"))
    earlier = Window.partitionBy(client).orderBy("_bucket")
    carried = lasts.select(client, "_bucket", F.lag("_last_end").over(earlier).alias("_carried"))
    within = Window.partitionBy(client, "_bucket").orderBy(start, request)
    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_previous"))
    elapsed = F.timestamp_diff("MICROSECOND", previous, F.col(start))
    sleep_us = F.lit(round(sleep_seconds * 1_000_000)).cast("bigint")
    return (
        cut.withColumn("_previous", F.lag(end).over(within))
        .withColumn("_first", F.row_number().over(within) == 1)
        .join(carried, [client, "_bucket"])
        .withColumn("wait_us", F.coalesce(F.greatest(F.lit(0).cast("bigint"), sleep_us - elapsed), F.lit(0)))
        .select(*requests.columns, "wait_us")
    )
