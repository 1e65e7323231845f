"""Scope, paging and order."""

import random

import pytest
from pyspark.sql import functions as F

from lawgrain.operators import scope as S
from lawgrain.operators.ordering import bucketed_ordinal
from lawgrain.params import DOCUMENT_TYPES, CrawlParams, requested_types

BASE = "/open/data/v1"


def params(**more):
    return CrawlParams(base_path=BASE, current_year=2024, **more)


LISTING = [
    (1, "act", "statute", "/akn/fi/act/statute/2024/1/fin@"),
    (2, "act", "statute", "/akn/fi/act/statute/2020/2/fin@"),
    (3, "doc", "treaty", "/akn/fi/doc/treaty/2023/3/swe@"),
    (4, "doc", "authority-regulation", "/akn/fi/doc/authority-regulation/a/2022/4/fin%40"),
    (5, "judgment", "kko", "/akn/fi/judgment/kko/2024/5/fin@"),
    (6, "act", "statute", "broken"),
]


@pytest.fixture(scope="module")
def listing(spark):
    return spark.createDataFrame(LISTING, "item_no long, category string, document_type string, akn_uri string")


def ids(frame):
    return sorted(row.item_no for row in frame.select("item_no").collect())


def test_defaults():
    p = params()
    assert (p.categories, p.years, p.lang_and_version, p.limit, p.sleep_seconds) == (("act",), 1, "fin@", 10, 5.0)
    assert not any((p.fetch_pdf, p.fetch_zip, p.fetch_media, p.force, p.dry_run, p.resume, p.reset))
    assert p.asset_kinds == ("xml",)


def test_year_overrides():
    p = params(years=1, years_by_category={"act": 5, "judgment": 0, "authority-regulation": 10})
    assert [p.years_back(c) for c in ("act", "judgment", "doc", "authority-regulation")] == [5, 1, 1, 10]
    assert p.year_window("act") == (2020, 2024)
    assert params(years=0).year_window("act") == (2025, 2024)


def test_expand_types_keeps_overlap(listing):
    got = S.expand_types(listing, ("doc", "authority-regulation"))
    assert ids(got) == [3, 4, 4]
    assert [r.pass_no for r in got.where("item_no = 4").orderBy("pass_no").collect()] == [3, 4]
    assert ids(S.expand_types(listing, ("unknown",))) == []
    assert len(requested_types(tuple(DOCUMENT_TYPES))) == 11


def test_run_order_follows_requests(listing):
    got = S.expand_types(listing, ("judgment", "act")).orderBy("run_order")
    assert [row.item_no for row in got.collect()] == [5, 1, 2, 6]


def test_filter_category(listing):
    assert ids(S.filter_category(listing)) == [1, 2, 6]
    assert ids(S.filter_category(listing, ("authority-regulation", "judgment"))) == [4, 5]


@pytest.mark.parametrize(
    "p, kept, kept_unparsed",
    [
        (params(categories=("act", "doc"), years=2), [1, 3], [1, 3, 6]),
        (params(categories=("act", "doc"), years_by_category={"act": 5, "doc": 3}), [1, 2, 3, 4], [1, 2, 3, 4, 6]),
        (params(categories=("act",), years=0), [], [6]),
        # a start year of 0 is no bound
        (params(categories=("act",), years=2025), [1, 2], [1, 2, 6]),
        (params(categories=("act", "judgment"), years_by_category={"act": 2025}), [1, 2, 5], [1, 2, 5, 6]),
        (CrawlParams(base_path=BASE, current_year=0, categories=("act",)), [1, 2], [1, 2, 6]),
    ],
)
def test_filter_year_window(listing, p, kept, kept_unparsed):
    scoped = S.with_document_key(S.expand_types(listing, p.categories), BASE)
    assert ids(S.filter_year_window(scoped, p)) == kept
    assert ids(S.filter_year_window(scoped, p, keep_unparsed=True)) == kept_unparsed


def test_filter_lang(listing):
    keyed = S.with_document_key(listing, BASE)
    assert ids(S.filter_lang(keyed)) == [1, 2, 4, 5]
    assert ids(S.filter_lang(keyed, "swe@", keep_unparsed=True)) == [3, 6]


def test_paginate_over_many_buckets(spark):
    # Two listings, one with most items; sparse and shuffled item numbers.
    numbers = random.Random(1).sample(range(10_000), 900)
    lines = [(n, "act", "statute" if i % 9 else "kko") for i, n in enumerate(numbers)]
    frame = spark.createDataFrame(lines, "item_no long, category string, document_type string")
    got = {row.item_no: (row.position, row.page) for row in S.paginate(frame, 10, range_rows=64).collect()}
    for kind in ("statute", "kko"):
        ordered = sorted(n for n, _, k in lines if k == kind)
        for position, number in enumerate(ordered, 1):
            assert got[number] == (position, (position - 1) // 10 + 1)
    assert S.take_page(S.paginate(frame, 10), 1).count() == 20


def test_bucketed_ordinal_takes_negative_order_values(spark):
    frame = spark.createDataFrame([("a", n) for n in range(-50, 50)], "k string, o long")
    got = {r.o: r.rn for r in bucketed_ordinal(frame, ["k"], "o", "rn", range_rows=7).collect()}
    assert got == {n: n + 51 for n in range(-50, 50)}


def loop_over_pages(log, limit, max_pages):
    """The paging loop: (kept pages with items, stop page, reason)."""
    kept, page = [], 1
    while True:
        if max_pages and page > max_pages:
            return kept, page, "max_pages"
        if page not in log:
            return kept, None, None
        status, ok, n = log[page]
        if status != 200:
            return kept + [(page, 0)], page, "http_error"
        if not ok:
            return kept + [(page, 0)], page, "bad_json"
        if not n:
            return kept + [(page, 0)], page, "empty"
        kept.append((page, n))
        if n < limit:
            return kept, page, "short"
        page += 1


@pytest.mark.parametrize("max_pages", [None, 0, 3, 8])
def test_listing_stop_as_the_loop_does(spark, max_pages):
    draw = random.Random(7)
    logs = {}
    for stream in range(60):
        logs[stream] = {
            page: (
                draw.choice([200] * 12 + [500, 404]),
                draw.random() > 0.05,
                draw.choice([10] * 10 + [0, 4]),
            )
            for page in range(1, draw.randint(1, 15))
        }
    lines = [(s, p, *values) for s, log in logs.items() for p, values in log.items()]
    frame = spark.createDataFrame(lines, "stream_id int, page long, http_status int, json_ok boolean, n_items int")
    stops = {r.stream_id: (r.stop_page, r.stop_reason) for r in S.stop_points(frame, 10, max_pages).collect()}
    pages = {}
    for r in S.listing_stop(frame, 10, max_pages).collect():
        pages.setdefault(r.stream_id, []).append((r.page, r.items_kept))
    for stream, log in logs.items():
        kept, stop, reason = loop_over_pages(log, 10, max_pages)
        if log:
            assert stops[stream] == (stop, reason)
        assert sorted(pages.get(stream, [])) == kept


def test_limit_pages(spark):
    pages = spark.range(1, 6).withColumnRenamed("id", "page")
    assert [S.limit_pages(pages, n).count() for n in (None, 0, 2)] == [5, 5, 2]


def test_listing_sort(spark):
    numbers = ["10", "9", "9b", "100", "9"]
    frame = spark.createDataFrame(
        [(i, f"act/statute/2024/{n}/fin@", f"2024-01-0{5 - i}") for i, n in enumerate(numbers)],
        "item_no long, document_key string, date_issued string",
    )
    assert [r.item_no for r in S.listing_sort(frame).collect()] == [1, 4, 0, 3, 2]
    assert [r.item_no for r in S.listing_sort(frame, descending=True, limit=2).collect()] == [3, 0]
    assert [r.item_no for r in S.listing_sort(frame, "dateIssued").collect()] == [4, 3, 2, 1, 0]
    with pytest.raises(ValueError):
        S.listing_sort(frame, "title")


def test_union_keeps_duplicates(listing):
    assert S.union_listings(listing, listing.where("item_no = 1")).count() == 7
