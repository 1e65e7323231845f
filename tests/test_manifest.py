"""Manifest aggregates and progress."""

import datetime as dt
import random

import pytest

from lawgrain.operators import manifest as M

T0 = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
ENTRIES = [
    (1, "a", "success", 0),
    (2, "b", "error", 1),
    (3, "b", "success", 2),
    (4, "c", "skipped", 2),
    (5, "d", "dry-run", 3),
]


@pytest.fixture(scope="module")
def manifest(spark):
    lines = [(n, u, s, T0 + dt.timedelta(seconds=at)) for n, u, s, at in ENTRIES]
    return spark.createDataFrame(lines, "item_no long, akn_uri string, status string, timestamp timestamp_ntz")


def test_summary_and_header(manifest):
    assert M.manifest_summary(manifest).first().asDict() == {"total": 5, "success": 2, "skipped": 1, "error": 1}
    header = M.manifest_header(manifest).first()
    assert header.updated_at == T0 + dt.timedelta(seconds=3)
    assert tuple(header)[1:] == (5, 2, 1, 1)


def test_verdict_covers_history(manifest):
    assert M.run_verdict(manifest).first().exit_code == 1
    assert M.run_verdict(manifest.where("status <> 'error'")).first().exit_code == 0
    assert M.run_verdict(manifest.where("false")).first().exit_code == 0


def test_completed_set_and_last_uri(manifest):
    assert {r.akn_uri for r in M.completed_set(manifest).collect()} == {"a", "b", "c"}
    assert M.last_uri(manifest).first().last_uri == "c"
    times = M.session_times(manifest).first()
    assert (times.started_at, times.updated_at) == (T0, T0 + dt.timedelta(seconds=3))


def test_latest_and_unions(spark, manifest):
    assert {(r.akn_uri, r.item_no) for r in M.manifest_latest(manifest).collect()} == {("a", 1), ("b", 3), ("c", 4), ("d", 5)}
    assert M.append_manifest(manifest, manifest).count() == 10
    extra = spark.createDataFrame([("a",), ("z",)], "akn_uri string")
    assert {r.akn_uri for r in M.set_add(M.completed_set(manifest), extra).collect()} == {"a", "b", "c", "z"}


def test_status_domain(spark, manifest):
    assert M.unknown_statuses(manifest).count() == 0
    odd = spark.createDataFrame([("done",), (None,)], "status string")
    assert M.unknown_statuses(odd).count() == 2


def test_progress_as_the_loop_counts(spark):
    draw = random.Random(2)
    streams = [("act", "statute"), ("act", "statute-sami"), ("doc", "treaty"), ("judgment", "kko")]
    lines, position, last = [], {}, None
    for number, (category, kind) in enumerate(streams):
        count = 0
        for n in range(40 if number else 200):
            item = number * 1000 + n * 3
            done = draw.random() < 0.6 or kind == "kko"
            count += 1
            lines.append((item, category, kind, not done))
            if not done:
                position[category, kind] = count
                last = (category, kind)
    draw.shuffle(lines)
    items = spark.createDataFrame(lines, "item_no long, category string, document_type string, processed boolean")
    progress = M.progress_counter(items)
    assert {(r.category, r.document_type): r.position for r in progress.collect()} == position
    resume = {(r.category, r.document_type): r.resume_at for r in M.resume_position(progress).collect()}
    assert resume == {s: (p if s == last else 1) for s, p in position.items()}
    assert M.resume_position(progress, *last).first().resume_at == position[last]
