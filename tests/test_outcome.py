"""Attempts, outcomes, files, requests and pacing."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lawgrain.operators import outcome as O
from lawgrain.operators import scope as S
from lawgrain.operators import worklist as W
from lawgrain.params import CrawlParams
from lawgrain.schemas import ATTEMPT

BASE = "/open/data/v1"
T0 = dt.datetime(2024, 1, 1)
URI = "/akn/fi/act/statute/2024/{}/fin@"


def attempts(spark, lines, run="r1"):
    """(uri, kind, link, [status or exception text, ...]) per request of one run."""
    out = []
    for uri, kind, link, chain in lines:
        for n, result in enumerate(chain, 1):
            status, exception = (None, result) if isinstance(result, str) else (result, None)
            start = T0 + dt.timedelta(seconds=len(out))
            out.append((run, uri, kind, link, n, status, exception, start, start + dt.timedelta(milliseconds=100)))
    random.Random(5).shuffle(out)
    return spark.createDataFrame(out, ATTEMPT)


def test_final_responses(spark):
    log = attempts(
        spark,
        [
            ("ok", "xml", None, [200]),
            ("429", "xml", None, [429, 200]),
            ("503", "xml", None, [503, 503, 404]),
            ("out", "xml", None, [503] * 6),
            ("long", "xml", None, [503] * 6 + [200]),
            ("timeout", "xml", None, [500, "read timed out"]),
            ("down", "xml", None, ["refused"] * 6),
            ("two", "media", "media/1.gif", [200]),
            ("two", "media", "media/2.gif", [404]),
        ],
    )
    final = O.final_responses(log).collect()
    got = {(r.akn_uri, r.link): (r.http_status, r.exception, r.attempts_used, r.exhausted) for r in final}
    assert {r.akn_uri for r in final if r.over_budget} == {"long"}
    assert got == {
        ("ok", None): (200, None, 1, False),
        ("429", None): (200, None, 2, False),
        ("503", None): (404, None, 3, False),
        ("out", None): (503, None, 6, True),
        ("long", None): (200, None, 7, False),
        ("timeout", None): (None, "read timed out", 2, False),
        ("down", None): (None, "refused", 6, True),
        ("two", "media/1.gif"): (200, None, 1, False),
        ("two", "media/2.gif"): (404, None, 1, False),
    }


def test_newest_run_decides(spark):
    first = attempts(spark, [("back", "xml", None, [503] * 6), ("gone", "xml", None, [200]), ("once", "xml", None, [200])])
    second = attempts(spark, [("back", "xml", None, [200]), ("gone", "xml", None, [503, 404])], run="r2")
    got = {r.akn_uri: (r.run_id, r.http_status, r.attempts_used, r.exhausted) for r in O.final_responses(first.union(second)).collect()}
    assert got == {"back": ("r2", 200, 1, False), "gone": ("r2", 404, 2, False), "once": ("r1", 200, 1, False)}


def test_classes_and_retryable(spark):
    log = spark.createDataFrame([(s,) for s in (200, 304, 404, 429, 500, 501, 502, 503, 504, None)], "http_status int")
    classes = {r.http_status: r.response_class for r in O.classify_responses(log).collect()}
    assert classes[429] == "rate_limited" and classes[None] is None
    assert {s for s, c in classes.items() if c == "ok"} == {200, 304}
    assert {r.http_status for r in O.filter_retryable(log).collect()} == {429, 500, 502, 503, 504}


ALL = CrawlParams(
    base_path=BASE, current_year=2024, output_dir="out", fetch_pdf=True, fetch_zip=True, fetch_media=True
)


def run(spark, params, lines, uris, stored=()):
    listing = spark.createDataFrame([(n, u) for n, u in enumerate(uris)], "item_no long, akn_uri string")
    inventory = spark.createDataFrame([(folder,) for folder in stored], "folder_path string")
    work = W.with_existing(S.with_paths(S.with_document_key(listing, BASE)), inventory, params.force)
    by_document = O.responses_by_document(O.final_responses(attempts(spark, lines)), params)
    return {r.item_no: r for r in O.document_outcome(work, by_document, params).collect()}


LINES = [
    (URI.format(1), "xml", None, [200]),
    (URI.format(1), "pdf", None, [404]),
    (URI.format(1), "zip", None, [503, 200]),
    (URI.format(1), "media", "media/b/x.gif", [200]),
    (URI.format(1), "media", "media/a/x.gif", [200]),
    (URI.format(1), "media", "media/c.gif", [500]),
    (URI.format(2), "xml", None, [404]),
    (URI.format(3), "xml", None, ["read timed out"]),
    (URI.format(4), "xml", None, [200]),
]
URIS = [URI.format(n) for n in (1, 2, 3, 4, 5)] + ["", "nonsense"]
STORED = ["act/statute/2024/4/fin@"]
FOLDER = "out/act/statute/2024/{}/fin@/"


def test_document_outcome(spark):
    got = run(spark, ALL, LINES, URIS, STORED)
    assert [got[n].outcome for n in range(7)] == ["success", "error", "error", "skipped", None, "error", "error"]
    assert [got[n].error for n in range(7)] == [
        None,
        "HTTP 404 fetching XML",
        "Failed to fetch XML: read timed out",
        None,
        None,
        "Failed to parse URI: ",
        "Failed to parse URI: nonsense",
    ]
    # XML, PDF, ZIP, media; two links of one name both stay
    first = FOLDER.format(1)
    assert got[0].files == [first + name for name in ("main.xml", "main.zip", "media/x.gif", "media/x.gif")]
    assert got[1].files == [] and got[3].files == [FOLDER.format(4) + "main.xml"]
    assert got[0].first_ts == T0


def test_files_only_of_requested_kinds(spark):
    got = run(spark, CrawlParams(base_path=BASE, current_year=2024, output_dir="out"), LINES, URIS, STORED)
    assert got[0].files == [FOLDER.format(1) + "main.xml"]


def test_force_ignores_the_store(spark):
    params = CrawlParams(base_path=BASE, current_year=2024, output_dir="out", force=True)
    assert run(spark, params, LINES, URIS, STORED)[3].outcome == "success"


def test_dry_run_comes_after_the_store(spark):
    params = CrawlParams(base_path=BASE, current_year=2024, output_dir="out", dry_run=True)
    got = run(spark, params, LINES, URIS, STORED)
    assert [got[n].outcome for n in range(7)] == ["dry-run"] * 3 + ["skipped", "dry-run", "error", "error"]
    assert got[0].files == []


def test_asset_warnings(spark):
    log = attempts(
        spark,
        [
            ("a", "pdf", None, [404]),
            ("b", "pdf", None, [500]),
            ("c", "zip", None, ["reset"]),
            ("d", "media", "media/1", [500]),
            ("d", "media", "media/2", ["reset"]),
            ("d", "media", "media/3", ["reset"]),
            ("e", "xml", None, [500]),
        ],
    )
    got = {tuple(r) for r in O.asset_warnings(O.final_responses(log)).collect()}
    assert got == {("b", "pdf", 1), ("c", "zip", 1), ("d", "media", 2)}


def test_asset_plan(spark):
    params = CrawlParams(
        base_path=BASE, base_url="https://h/v1", current_year=2024, output_dir="out", fetch_zip=True, fetch_media=True
    )
    documents = spark.createDataFrame(
        [(URI.format(1), ["media/a/x.gif"]), (URI.format(2), None), ("broken", ["media/z"])],
        "akn_uri string, media_links array<string>",
    )
    plan = O.asset_plan(S.with_paths(S.with_document_key(documents, BASE)), params, "media_links")
    got = [tuple(r) for r in plan.orderBy("akn_uri", "ord").collect()]
    root = "https://h/v1/akn/fi/act/statute/2024/1/fin@"
    assert [g[1:] for g in got if g[0] == URI.format(1)] == [
        ("xml", 0, None, root, FOLDER.format(1) + "main.xml", "application/xml"),
        ("zip", 2, None, root + "/main.akn", FOLDER.format(1) + "main.zip", "application/zip"),
        ("media", 3, "media/a/x.gif", root + "/media/a/x.gif", FOLDER.format(1) + "media/x.gif", "application/xml"),
    ]
    assert len(got) == 5


@pytest.mark.parametrize("bucket_seconds", [1, 7, 3600])
def test_pacing_audit_as_the_client_waits(spark, bucket_seconds):
    draw = random.Random(11)
    lines, want = [], {}
    for client in range(4):
        at, end = T0, None
        for n in range(120 if client == 0 else 25):
            at = at + dt.timedelta(microseconds=draw.choice([0, 400_000, 2_000_000, 9_000_000]))
            request = client * 1000 + n
            if end is None:
                want[request] = 0
            else:
                elapsed = (at - end) // dt.timedelta(microseconds=1)
                want[request] = max(0, 5_000_000 - elapsed)
            end = at + dt.timedelta(microseconds=draw.randint(0, 300_000))
            lines.append((request, client, at, end))
    draw.shuffle(lines)
    log = spark.createDataFrame(
        lines, "request_id long, client_id long, start_ts timestamp_ntz, end_ts timestamp_ntz"
    )
    got = {r.request_id: r.wait_us for r in O.pacing_audit(log, 5.0, bucket_seconds=bucket_seconds).collect()}
    assert got == want


def test_document_files_are_numbered(spark):
    outcomes = spark.createDataFrame([(1, "u", ["x", "y"]), (2, "v", [])], "item_no long, akn_uri string, files array<string>")
    assert [tuple(r) for r in O.document_files(outcomes).orderBy(F.col("file_no")).collect()] == [
        (1, "u", 0, "x"),
        (1, "u", 1, "y"),
    ]


def test_attempts_are_spread_before_they_are_sorted(spark):
    log = attempts(spark, [(URI.format(n), "xml", None, [503, "timeout", 200]) for n in range(20)])
    plan = O.final_responses(log)._jdf.queryExecution().executedPlan().toString()
    below_sorts = plan[plan.rindex("Sort [") :]
    assert f"{spark.conf.get('spark.sql.shuffle.partitions')}), REPARTITION_BY_NUM" in below_sorts
    assert "REPARTITION" not in O.final_responses(log, spread=False)._jdf.queryExecution().executedPlan().toString()
    chain = log.where("attempt < 0").unionByName(attempts(spark, [(URI.format(1), "xml", None, [503] * 400)]))
    spread = chain.repartition(8, F.xxhash64("akn_uri", "kind", "link", "run_id", "attempt", "start_ts"))
    assert spread.groupBy(F.spark_partition_id()).count().count() == 8
