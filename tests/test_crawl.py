"""The whole run against a loop that works off one item after the other."""

import datetime as dt
import random

import pytest

from lawgrain.params import CrawlParams, requested_types
from lawgrain.plans import crawl as C
from lawgrain.schemas import ATTEMPT, LIST_PAGE
from lawgrain.sources import landing as L
from tests.test_uri import python_key

BASE = "/open/data/v1"
NOW = dt.datetime(2024, 6, 1)
TYPES = [("act", "statute"), ("judgment", "kko"), ("doc", "treaty"), ("doc", "authority-regulation")]


def world(seed):
    """A random listing, attempt results, completed set and store."""
    draw = random.Random(seed)
    listing, results = [], {}
    for number in range(260):
        category, kind = draw.choice(TYPES)
        middle = "/agency" if kind == "authority-regulation" and draw.random() < 0.8 else ""
        uri = f"/akn/fi/{category}/{kind}{middle}/{draw.randint(2020, 2024)}/{draw.randint(1, 5)}/{draw.choice(['fin@', 'fin%40', 'swe@'])}"
        if draw.random() < 0.3:
            uri = draw.choice(["", "", "", "junk"])
        listing.append((number, category, kind, uri))
        if python_key(uri):
            results[uri] = draw.choice([200, 200, 200, 404, "read timed out", None])
    uris = sorted(results)
    completed = draw.sample(uris, len(uris) // 5)
    stored = sorted({python_key(uri) for uri in draw.sample(uris, len(uris) // 5)})
    return listing, results, completed, stored


def loop(params, listing, results, completed, stored):
    """(uri, status, error, files) in the order a single-threaded run writes them."""
    done = set(completed) if params.resume and not params.reset else set()
    stored = set(stored)
    entries = []
    for _, requested, category, kind in requested_types(params.categories):
        start, end = params.year_window(requested)
        for _, item_category, item_kind, uri in sorted(listing):
            if (item_category, item_kind) != (category, kind):
                continue
            key = python_key(uri)
            if key is not None:
                *_, year, _, lang = key.split("/")
                if lang != params.lang_and_version or not start <= int(year) <= end:
                    continue  # the source would not have listed it
            if uri in done:
                continue
            result = results.get(uri)
            if key is None:
                entry = ("error", f"Failed to parse URI: {uri}", [])
            elif key in stored and not params.force:
                entry = ("skipped", None, [f"out/{key}/main.xml"])
            elif params.dry_run:
                entry = ("dry-run", None, [])
            elif result is None:
                continue  # not fetched yet
            elif result == 200:
                entry = ("success", None, [f"out/{key}/main.xml"])
            elif isinstance(result, int):
                entry = ("error", f"HTTP {result} fetching XML", [])
            else:
                entry = ("error", f"Failed to fetch XML: {result}", [])
            entries.append((uri, *entry))
            if entry[0] == "success":
                stored.add(key)
            if entry[0] in ("success", "skipped"):
                done.add(uri)
    return entries


@pytest.mark.parametrize(
    "more",
    [
        {},
        {"resume": True},
        {"resume": True, "reset": True},
        {"force": True},
        {"dry_run": True, "resume": True},
        {"categories": ("doc", "authority-regulation", "act"), "years_by_category": {"authority-regulation": 2}},
        {"lang_and_version": "swe@", "years": 2},
    ],
)
def test_manifest_of_a_run(spark, more):
    options = {"categories": ("act", "judgment", "doc"), "years": 4, **more}
    params = CrawlParams(base_path=BASE, current_year=2024, output_dir="out", **options)
    listing, results, completed, stored = world(17)
    log = [
        ("r1", uri, "xml", None, 1, r if isinstance(r, int) else None, r if isinstance(r, str) else None, NOW, NOW)
        for uri, r in results.items()
        if r is not None
    ]
    tables = C.LandingTables(
        listing=spark.createDataFrame(listing, "item_no long, category string, document_type string, akn_uri string"),
        completed=spark.createDataFrame([(u,) for u in completed], "akn_uri string"),
        inventory=spark.createDataFrame([(f,) for f in stored], "folder_path string"),
        attempts=spark.createDataFrame(log, ATTEMPT),
    )
    manifest = C.crawl_manifest(tables, params, "2024-06-01 00:00:00")
    got = [(r.akn_uri, r.status, r.error, r.files) for r in manifest.orderBy("item_no").collect()]
    want = loop(params, listing, results, completed, stored)
    assert got == want
    if not more:
        # two URIs of one folder: the second is skipped after the first is stored
        assert any(status == "skipped" and python_key(uri) not in stored for uri, status, _, _ in want)
    report = C.run_report(manifest).first()
    errors = sum(entry[1] == "error" for entry in want)
    assert (report.total, report.error, report.exit_code) == (len(want), errors, 1 if errors else 0)


def test_max_pages_limits_a_paged_listing(spark):
    lines = [(n, "act", "statute", 1 + n // 10, f"/akn/fi/act/statute/2024/{n}/fin@") for n in range(30)]
    listing = spark.createDataFrame(lines, "item_no long, category string, document_type string, page long, akn_uri string")
    empty = spark.createDataFrame([], "akn_uri string")
    tables = C.LandingTables(listing, empty, spark.createDataFrame([], "folder_path string"), spark.createDataFrame([], ATTEMPT))
    params = CrawlParams(base_path=BASE, current_year=2024, max_pages=2)
    assert C.pending_documents(tables, params).count() == 20


def test_listed_items_follow_the_paging_loop(spark):
    def body(*numbers):
        return "[" + ",".join(f'{{"akn_uri": "u{n}", "status": "NEW"}}' for n in numbers) + "]"

    lines = [
        ("act", "statute", 1, 200, body(1, 2)),
        ("act", "statute", 2, 200, body(3)),
        ("act", "statute", 3, 200, body(4, 5)),
        ("doc", "treaty", 1, 200, body(6, 7)),
        ("doc", "treaty", 2, 503, body(8, 9)),
        ("judgment", "kko", 1, 200, "{broken"),
        ("judgment", "kho", 1, 200, body(10, 11)),
        ("judgment", "kho", 2, 200, body(12, 13)),
    ]
    pages = L.pages_from_bodies(spark.createDataFrame(lines, LIST_PAGE))
    params = CrawlParams(base_path=BASE, current_year=2024, limit=2)
    assert [r.akn_uri for r in C.listed_items(pages, params).orderBy("akn_uri").collect()] == [
        "u1", "u10", "u11", "u12", "u13", "u2", "u3", "u6", "u7",
    ]
    capped = CrawlParams(base_path=BASE, current_year=2024, limit=2, max_pages=1)
    assert sorted(r.akn_uri for r in C.listed_items(pages, capped).collect()) == ["u1", "u10", "u11", "u2", "u6", "u7"]
