"""Completed documents, repeats and documents in store."""

import random

import pytest

from lawgrain.operators import scope as S
from lawgrain.operators import worklist as W

BASE = "/open/data/v1"


@pytest.fixture(scope="module")
def listing(spark):
    lines = [(1, "a"), (2, "b"), (3, "a"), (4, ""), (5, "c")]
    return spark.createDataFrame(lines, "item_no long, akn_uri string")


def ids(frame):
    return sorted(row.item_no for row in frame.collect())


def test_worklist_and_its_complement(spark, listing):
    completed = spark.createDataFrame([("a",), ("z",)], "akn_uri string")
    assert ids(W.worklist(listing, completed)) == [2, 4, 5]
    assert ids(W.skip_completed(listing, completed)) == [1, 3]
    # without resuming nothing counts as completed
    assert ids(W.worklist(listing, completed, resume=False)) == [1, 2, 3, 4, 5]
    assert ids(W.skip_completed(listing, completed, resume=False)) == []


def test_in_run_dedup_as_the_loop_does(spark):
    draw = random.Random(3)
    lines = [
        (n, draw.choice(["", "", "", "u1", "u2", "u3", "u4"]), draw.choice(["error", "dry-run", "success", "skipped"]))
        for n in range(300)
    ]
    lines = [(n, uri, "error" if uri == "" else status) for n, uri, status in lines]
    completed, kept = set(), []
    for n, uri, status in lines:
        if uri in completed:
            continue
        kept.append(n)
        if status in ("success", "skipped"):
            completed.add(uri)
    draw.shuffle(lines)
    frame = spark.createDataFrame(lines, "item_no long, akn_uri string, status string")
    assert ids(W.in_run_dedup(frame)) == kept


def test_existing_documents(spark):
    rows = spark.createDataFrame([(1, "f/1"), (2, "f/2"), (3, None)], "item_no long, folder_path string")
    inventory = spark.createDataFrame([("f/1",)], "folder_path string")
    assert ids(W.existing_documents(rows, inventory)) == [1]
    flags = {r.item_no: r.exists for r in W.with_existing(rows, inventory).collect()}
    assert flags == {1: True, 2: False, 3: False}
    assert not any(r.exists for r in W.with_existing(rows, inventory, force=True).collect())


def test_dry_run_plan(spark):
    uri = "/akn/fi/act/statute/2024/{}/fin@"
    listing = spark.createDataFrame(
        [(1, uri.format(1)), (2, uri.format(2)), (3, uri.format(2)), (4, "broken")], "item_no long, akn_uri string"
    )
    inventory = spark.createDataFrame([("act/statute/2024/1/fin@",)], "folder_path string")
    work = S.with_paths(S.with_document_key(listing, BASE))
    got = {tuple(r) for r in W.dry_run_plan(work, inventory, "out").collect()}
    target = "out/act/statute/2024/2/fin@"
    assert got == {(2, uri.format(2), target), (3, uri.format(2), target)}
