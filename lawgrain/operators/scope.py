"""From list pages to the listing in scope: paging, stops, categories, years."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lawgrain.functions import uri as U
from lawgrain.operators.ordering import RANGE_ROWS, bucketed_ordinal, total_ordinal, literal_rows
from lawgrain.params import AUTHORITY_TYPE, CrawlParams, requested_types

# (pass, item) in one BIGINT: item numbers below MAX_ITEMS and up to MAX_PASSES passes.
MAX_ITEMS = 1 << 58
MAX_PASSES = 31


def with_document_key(listing: DataFrame, base_path: str, uri: str = "akn_uri") -> DataFrame:
    """Add `document_key`, NULL where the URI cannot be parsed.

    The key comes out of a one-element explode. A plain projection would be
    substituted into every later filter and join condition and the URI parsed
    again in each; a generated column is computed once per row, and the stage
    stays compiled as a whole.
    """
    return listing.select("*", F.explode(F.array(U.document_key(F.col(uri), base_path))).alias("document_key"))


def with_paths(keyed: DataFrame) -> DataFrame:
    """Add `folder_path` and `api_path` of the document key."""
    key = F.col("document_key")
    return keyed.withColumn("folder_path", U.key_folder(key)).withColumn("api_path", U.key_api_path(key))


def with_document_info(listing: DataFrame, base_path: str, uri: str = "akn_uri") -> DataFrame:
    """Add `document_key`, `info`, `folder_path`, `api_path` and `year_int`."""
    keyed = with_paths(with_document_key(listing, base_path, uri))
    key = F.col("document_key")
    return keyed.withColumn("info", U.document_info(key)).withColumn("year_int", U.key_year(key))


# -- scope ------------------------------------------------------------------


def expand_types(listing: DataFrame, categories: tuple[str, ...] | list[str]) -> DataFrame:
    """Listing rows of the requested categories, once per request that covers them.

    Adds `requested`, `pass_no` (order in which the types are worked off) and
    `run_order` (order of the rows over the whole run). The type list is a
    constant of at most a few dozen rows, so it is broadcast; the `IN` filter
    repeats it in a form that reaches the scan.
    """
    wanted = requested_types(categories)
    if len(wanted) > MAX_PASSES:
        raise ValueError(f"{len(wanted)} document types requested; a run takes {MAX_PASSES}")
    if not wanted:
        empty = listing.where(F.lit(False))
        return (
            empty.withColumn("requested", F.lit(""))
            .withColumn("pass_no", F.lit(0))
            .withColumn("run_order", F.lit(0).cast("bigint"))
        )
    types = literal_rows(listing, ("pass_no", "requested", "category", "document_type"), wanted)
    pruned = listing.where(
        F.col("category").isin(sorted({row[2] for row in wanted}))
        & F.col("document_type").isin(sorted({row[3] for row in wanted}))
    )
    item = F.col("item_no").cast("bigint")
    checked = F.when(item.isNull() | item.between(0, MAX_ITEMS - 1), item).otherwise(
        F.raise_error(F.concat(F.lit("item number out of range: "), item.cast("string"))).cast("bigint")
    )
    order = (F.col("pass_no").cast("bigint") * F.lit(MAX_ITEMS) + checked).alias("run_order")
    return pruned.join(F.broadcast(types), ["category", "document_type"]).select(
        *listing.columns, "requested", "pass_no", order
    )


def filter_category(listing: DataFrame, categories: tuple[str, ...] | list[str] = ("act",)) -> DataFrame:
    """Rows of the requested categories, each once; a plain pushed-down filter."""
    whole = [name for name in categories if name != AUTHORITY_TYPE]
    keep = F.col("category").isin(whole)
    if AUTHORITY_TYPE in categories:
        keep = keep | ((F.col("category") == "doc") & (F.col("document_type") == AUTHORITY_TYPE))
    return listing.where(keep)


def filter_year_window(
    scoped: DataFrame, params: CrawlParams, year: str | None = None, keep_unparsed: bool = False
) -> DataFrame:
    """Rows whose year lies in the window of the request that reached them.

    The year is that of the document key, or the column named: the widest
    window is a pair of constants, so on a listing stored by year it prunes
    partitions. Rows without a year go unless `keep_unparsed`.
    """
    column = U.key_year(F.col("document_key")) if year is None else F.col(year)
    windows = {name: params.year_window(name) for name in dict.fromkeys(params.categories)}
    if not windows:
        return scoped.where(F.lit(False))
    # A bound of 0 is not applied.
    starts = {name: start if start else None for name, (start, _) in windows.items()}
    ends = {name: end if end else None for name, (_, end) in windows.items()}

    def bound(by_request: dict[str, int | None]) -> Column:
        chosen = F
        for name, value in by_request.items():
            chosen = chosen.when(F.col("requested") == name, F.lit(value).cast("int"))
        return chosen.otherwise(F.lit(None).cast("int"))

    inside = F.lit(True)
    for by_request, constant, compare in (
        (starts, min, lambda limit: column >= limit),
        (ends, max, lambda limit: column <= limit),
    ):
        values = list(by_request.values())
        if None not in values:
            # One constant where the requests agree, else also the widest one.
            inside = inside & compare(F.lit(constant(values)))
            if len(set(values)) > 1:
                inside = inside & compare(bound(by_request))
        elif any(value is not None for value in values):
            inside = inside & (bound(by_request).isNull() | compare(bound(by_request)))
    if all(value is None for value in [*starts.values(), *ends.values()]):
        inside = column.isNotNull() if not keep_unparsed else F.lit(True)
    return scoped.where(F.coalesce(inside, F.lit(keep_unparsed)) if keep_unparsed else inside)


def filter_lang(scoped: DataFrame, lang_and_version: str = "fin@", keep_unparsed: bool = False) -> DataFrame:
    """Rows with the given decoded language and version marker."""
    keep = U.key_lang(F.col("document_key")) == lang_and_version
    return scoped.where(F.coalesce(keep, F.lit(True)) if keep_unparsed else keep)


def filter_requested(scoped: DataFrame, params: CrawlParams) -> DataFrame:
    """Rows in the year window and language, and all whose URI cannot be parsed.

    A parsed year that no INT can hold lies in no window; only rows without a
    key pass unjudged.
    """
    unparsed = F.col("document_key").isNull()
    year_known = U.key_year(F.col("document_key")).isNotNull()
    kept = filter_year_window(scoped.where(unparsed | year_known), params, keep_unparsed=True)
    return filter_lang(kept, params.lang_and_version, keep_unparsed=True)


def union_listings(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Listings one after the other, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), others, first)


# -- paging -----------------------------------------------------------------


def paginate(
    listing: DataFrame,
    limit: int = 10,
    keys: tuple[str, ...] = ("category", "document_type"),
    order: str = "item_no",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add the position of each item in its listing and its page number (from 1)."""
    placed = bucketed_ordinal(listing, keys, order, "position", range_rows)
    return placed.withColumn("page", (F.floor((F.col("position") - 1) / F.lit(limit)) + 1).cast("bigint"))


def take_page(paged: DataFrame, page: int) -> DataFrame:
    """Items of one page number of each listing."""
    return paged.where(F.col("page") == page)


def limit_pages(pages: DataFrame, max_pages: int | None) -> DataFrame:
    """First pages of each stream; 0 or None is no limit."""
    return pages.where(F.col("page") <= max_pages) if max_pages else pages


# Why a listing ends, in the order in which a page is tested.
STOP_REASONS = ("max_pages", "http_error", "bad_json", "empty", "short")


def stop_points(
    page_log: DataFrame, limit: int = 10, max_pages: int | None = None, stream: Sequence[str] = ("stream_id",)
) -> DataFrame:
    """One row per stream: the page its listing stops at, and why.

    Both are NULL for a stream that has not stopped yet. Only integers are
    aggregated, so the hash aggregate combines on the map side and one stream
    with most of the pages costs no more than the others.
    """
    page = F.col("page")
    reason = (
        F.when(~F.col("http_status").eqNullSafe(200), 1)
        .when(~F.coalesce(F.col("json_ok"), F.lit(False)), 2)
        .when(F.coalesce(F.col("n_items"), F.lit(0)) == 0, 3)
        .when(F.col("n_items") < limit, 4)
    )
    at = page
    if max_pages:
        # The page after the last allowed one is never asked for.
        past = F.lit(max_pages + 1).cast("bigint")
        reason = F.when(page > max_pages, 0).otherwise(
            F.coalesce(reason, F.when(page == max_pages, F.lit(0)))
        )
        at = F.when(reason == 0, past).otherwise(page)
    events = page_log.select(*stream, at.cast("bigint").alias("_at"), reason.alias("_reason"))
    stopped_at = F.when(F.col("_reason").isNotNull(), F.col("_at"))
    stops = events.groupBy(*stream).agg(
        F.min(stopped_at).alias("stop_page"), F.min_by("_reason", stopped_at).alias("_code")
    )
    names = F.array(*[F.lit(name) for name in STOP_REASONS])
    return stops.select(*stream, "stop_page", F.get(names, F.col("_code")).alias("stop_reason"))


def listing_stop(
    page_log: DataFrame, limit: int = 10, max_pages: int | None = None, stream: Sequence[str] = ("stream_id",)
) -> DataFrame:
    """Pages up to the stop of their stream, with the items each contributes.

    `items_kept` is the page's items before the stop and on a `short` stop
    page, else 0. Later pages are dropped. The stops are one small row per
    stream; Spark broadcasts them by their size.
    """
    stops = stop_points(page_log, limit, max_pages, stream)
    page, stop = F.col("page"), F.col("stop_page")
    kept = F.when(stop.isNull() | (page < stop) | (F.col("stop_reason") == "short"), F.col("n_items"))
    return (
        page_log.join(stops, list(stream))
        .where(stop.isNull() | (page <= stop))
        .where(~F.col("stop_reason").eqNullSafe("max_pages") | (page < stop))
        .withColumn("items_kept", F.coalesce(kept, F.lit(0)).cast("bigint"))
    )


# -- order ------------------------------------------------------------------

SORT_KEYS = ("number", "dateIssued", "modified")


def _sort_order(listing: DataFrame, sort_by: str, descending: bool) -> tuple[DataFrame, list[Column]]:
    """The listing with its sort keys as columns, and the order by them.

    The keys come out of a one-element explode: expressions in a sort are
    computed again at each comparison.
    """
    number = U.key_number(F.col("document_key")) if sort_by == "number" else None
    keys = {
        "number": lambda: [number.try_cast("bigint"), number],
        "dateIssued": lambda: [F.col("date_issued")],
        "modified": lambda: [F.col("modified")],
    }
    if sort_by not in keys:
        raise ValueError(f"sort_by must be one of {SORT_KEYS}")
    columns = keys[sort_by]()
    if sort_by == "number":
        made = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(columns)])
        listing = listing.withColumn("_sort", F.explode(F.array(made)))
        columns = [F.col(f"_sort._{i}") for i in range(len(columns))]
    direction = "desc_nulls_last" if descending else "asc_nulls_last"
    return listing, [*[getattr(c, direction)() for c in columns], F.col("item_no").asc()]


def listing_sort(
    listing: DataFrame, sort_by: str = "number", descending: bool = False, limit: int | None = None
) -> DataFrame:
    """Listing by number, issue date or modification time.

    Numbers sort as numbers, then as text; missing values come last and
    `item_no` breaks ties. The sort is distributed by ranges of the keys. With a
    limit Spark keeps the top rows of each task instead.
    """
    keyed, order = _sort_order(listing, sort_by, descending)
    ordered = keyed.orderBy(*order).drop("_sort")
    return ordered.limit(limit) if limit is not None else ordered


def listing_rank(listing: DataFrame, sort_by: str = "number", descending: bool = False, out: str = "place") -> DataFrame:
    """The whole listing with each row's place in the order of `listing_sort`.

    `item_no` must be unique. Stores the sorted listing once.
    """
    keyed, order = _sort_order(listing, sort_by, descending)
    return total_ordinal(keyed, order, out).drop("_sort")
