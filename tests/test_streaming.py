"""Streams stopped and started again, against their batch form."""

import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from lawgrain.operators import manifest as M
from lawgrain.sources import catalogue as G
from lawgrain.sources import landing as L
from lawgrain.streaming import jobs as J
from tests.test_sources import write_pages


def finish(query):
    query.awaitTermination()
    query.stop()


def page(*uris):
    return json.dumps([{"akn_uri": uri, "status": "NEW"} for uri in uris])


def test_listing_and_dedup_over_restarts(spark, tmp_path):
    landing = tmp_path / "pages"
    completed = spark.createDataFrame([("u2",)], "akn_uri string")
    listed, fresh = str(tmp_path / "listed"), str(tmp_path / "fresh")

    def run():
        listing = J.stream_listing(spark, str(landing))
        finish(J.append_to_table(listing, listed, str(tmp_path / "c1")))
        deduped = J.stream_dedup(J.stream_listing(spark, str(landing)), completed).select("akn_uri")
        finish(J.append_to_table(deduped, fresh, str(tmp_path / "c2")))
        return sorted(r.akn_uri for r in spark.read.parquet(fresh).collect())

    write_pages(landing, "act", "statute", [page("u1", "u2", "u1")])
    assert run() == ["u1"]
    write_pages(landing, "act", "statute", [page("u1", "u2", "u1"), page("u1", "u3"), "{broken"])
    assert run() == ["u1", "u3"]
    assert run() == ["u1", "u3"]
    columns = ["category", "document_type", "page", "pos", "akn_uri", "status"]
    stored = spark.read.parquet(listed).select(columns)
    batch = L.read_list_pages(spark, str(landing)).select(columns)
    assert stored.exceptAll(batch).count() == 0 and batch.exceptAll(stored).count() == 0


def test_counts_and_progress_are_kept_current(spark, tmp_path):
    source, table = str(tmp_path / "entries"), str(tmp_path / "counts")
    schema = "akn_uri string, status string"

    def run():
        entries = spark.readStream.schema(schema).parquet(source)
        finish(J.keep_current(J.stream_counts(entries), table, str(tmp_path / "c")))
        return {r.status: r.entries for r in J.read_current(spark, table).collect()}

    first = spark.createDataFrame([("a", "success"), ("b", "error")], schema)
    first.write.mode("append").parquet(source)
    assert run() == {"success": 1, "error": 1}
    first.where("status = 'success'").write.mode("append").parquet(source)
    assert run() == {"success": 2, "error": 1}

    landing = tmp_path / "pages"
    write_pages(landing, "doc", "treaty", [page("x", "y"), page("z")])
    progress = J.stream_progress(J.stream_listing(spark, str(landing)))
    finish(J.keep_current(progress, str(tmp_path / "progress"), str(tmp_path / "c3")))
    assert [tuple(r) for r in J.read_current(spark, str(tmp_path / "progress")).collect()] == [("doc", "treaty", 3)]


def test_manifest_is_appended_once(spark, tmp_path):
    source, table = str(tmp_path / "entries"), str(tmp_path / "manifest")
    schema = "akn_uri string, status string"
    for lines in ([("a", "success")], [("b", "error"), ("a", "skipped")]):
        spark.createDataFrame(lines, schema).write.mode("append").parquet(source)
        entries = spark.readStream.schema(schema).parquet(source)
        finish(J.stream_manifest(entries, table, str(tmp_path / "c")))
    stored = G.read_manifest_table(spark, table)
    assert sorted((r.akn_uri, r.status) for r in stored.collect()) == [("a", "skipped"), ("a", "success"), ("b", "error")]
    assert M.manifest_summary(stored).first().total == 3


def test_stream_crawl_retries_errors_and_skips_completed(spark, tmp_path):
    source = str(tmp_path / "listing")
    schema = "item_no long, akn_uri string, result string"
    manifest, completed = str(tmp_path / "manifest"), str(tmp_path / "completed")

    def decide(batch, before, stored):
        files = F.array(F.concat(F.lit("corpus/"), "akn_uri", F.lit("/main.xml"))).alias("files")
        return batch.join(before, "akn_uri", "left_anti").select("akn_uri", F.col("result").alias("status"), files)

    batches = [
        [(1, "a", "error"), (2, "b", "success")],
        [(3, "a", "success"), (4, "b", "success"), (5, "c", "skipped")],
        [(6, "a", "success"), (7, "c", "error")],
    ]
    for lines in batches:
        spark.createDataFrame(lines, schema).write.mode("append").parquet(source)
        listing = spark.readStream.schema(schema).parquet(source)
        finish(J.stream_crawl(listing, decide, manifest, completed, str(tmp_path / "c")))
    rows = spark.read.option("basePath", manifest).parquet(manifest).collect()
    got = sorted((r.batch_id, r.akn_uri, r.status) for r in rows)
    assert got == [(0, "a", "error"), (0, "b", "success"), (1, "a", "success"), (1, "c", "skipped")]


def test_stream_crawl_equals_the_batch_over_shared_folders(spark, tmp_path):
    """Two URIs of one folder: the second is skipped, in one batch or in two."""
    import datetime as dt

    from lawgrain.operators import manifest as M
    from lawgrain.params import CrawlParams
    from lawgrain.plans import crawl as C
    from lawgrain.schemas import ATTEMPT

    uris = [f"/akn/fi/act/statute/2024/{n}/fin{at}" for at in ("@", "%40") for n in (1, 2)]
    now = dt.datetime(2024, 5, 1)
    log = [("r1", u, "xml", None, 1, 503 if "/2/fin@" in u else 200, None, now, now) for u in uris]
    listing = spark.createDataFrame([(n, "act", "statute", u) for n, u in enumerate(uris)], "item_no long, category string, document_type string, akn_uri string")
    empty = spark.createDataFrame([], "akn_uri string")
    folders = spark.createDataFrame([], "folder_path string")
    attempts = spark.createDataFrame(log, ATTEMPT)
    params = CrawlParams(base_path="/v1", current_year=2024, resume=True)

    def decide(batch, completed, stored):
        tables = C.LandingTables(batch, completed, stored, attempts)
        return C.crawl_manifest(tables, params, "2024-06-01 00:00:00")

    batch = decide(listing, empty, folders)
    want = sorted((r.akn_uri, r.status) for r in batch.collect())
    assert [s for _, s in want] == ["skipped", "success", "success", "error"]
    source, manifest, checkpoint = (str(tmp_path / n) for n in ("listing", "manifest", "checkpoint"))
    for part in ("item_no < 2", "item_no >= 2"):
        listing.where(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(listing.schema).option("maxFilesPerTrigger", 1).parquet(source)
        finish(J.stream_crawl(stream, decide, manifest, str(tmp_path / "completed"), checkpoint))
    entries = spark.read.parquet(manifest)
    assert sorted((r.akn_uri, r.status) for r in entries.collect()) == want
    assert {r.folder_path for r in M.stored_folders(entries, "corpus").collect()} == {"act/statute/2024/1/fin@", "act/statute/2024/2/fin@"}


def test_old_versions_go(spark, tmp_path):
    import os

    source, table = str(tmp_path / "entries"), str(tmp_path / "counts")
    for n in range(4):
        spark.createDataFrame([(str(n), "success")], "akn_uri string, status string").write.mode("append").parquet(source)
        entries = spark.readStream.schema("akn_uri string, status string").parquet(source)
        finish(J.keep_current(J.stream_counts(entries), table, str(tmp_path / "c")))
    assert sorted(os.listdir(table)) == ["batch_id=2", "batch_id=3"]
    assert J.read_current(spark, table).first().entries == 4


def run_until_done(spark, base, lines, expiry_ms):
    """Append outcomes, run the stream, and give its output and the rows of its state."""
    schema = "item_no long, akn_uri string, status string"
    source, table = f"{base}/outcomes", f"{base}/kept"
    spark.createDataFrame(lines, schema).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    completed = spark.createDataFrame([("gone",)], "akn_uri string")
    query = J.append_to_table(J.stream_until_done(stream, completed, expiry_ms), table, f"{base}/checkpoint")
    query.awaitTermination()
    (state,) = query.recentProgress[-1].stateOperators
    query.stop()
    kept = sorted((r.item_no, r.akn_uri, r.status) for r in spark.read.parquet(table).collect())
    return kept, state.numRowsTotal


def test_a_failing_uri_is_tried_in_three_batches(spark, tmp_path):
    batches = [
        [(2, "u", "error"), (1, "u", "error"), (3, "v", "success"), (4, "v", "success"), (5, "gone", "error")],
        [(6, "u", "error"), (7, "v", "error"), (8, "w", "error"), (9, "w", "skipped"), (10, "w", "error")],
        [(11, "u", "success"), (12, "u", "error"), (13, "w", "success")],
    ]
    for lines in batches:
        kept, rows = run_until_done(spark, tmp_path, lines, 10**9)
    assert kept == [
        (1, "u", "error"), (2, "u", "error"), (3, "v", "success"), (6, "u", "error"),
        (8, "w", "error"), (9, "w", "skipped"), (11, "u", "success"),
    ]
    assert rows == 3


def test_state_of_uris_no_longer_listed_expires(spark, tmp_path):
    for n in range(4):
        lines = [(100 * n + i, f"u{n}-{i}", "success") for i in range(50)] + [(100 * n + 99, "again", "success")]
        kept, rows = run_until_done(spark, tmp_path, lines, 1)
        assert rows <= 2 * 51  # of this batch, and of the one before until it is cleaned
    assert [k for k in kept if k[1] == "again"] == [(n, "again", "success") for n in (99, 199, 299, 399)]


def test_the_function_kept_with_the_state_needs_no_module_of_ours(spark, tmp_path, monkeypatch):
    from pyspark import cloudpickle
    from pyspark.sql import GroupedData

    sent = []
    real = GroupedData.applyInPandasWithState
    monkeypatch.setattr(GroupedData, "applyInPandasWithState", lambda self, f, *rest: sent.append(f) or real(self, f, *rest))
    schema = "item_no long, akn_uri string, status string"
    spark.createDataFrame([(1, "u", "error")], schema).write.parquet(str(tmp_path / "outcomes"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "outcomes"))
    J.stream_until_done(stream, spark.createDataFrame([("gone",)], "akn_uri string"))
    code = f"import pickle; pickle.loads(bytes.fromhex({cloudpickle.dumps(sent[0]).hex()!r}))"
    elsewhere = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=elsewhere)


def test_the_uris_of_a_bucket_are_worked_off_together(spark, tmp_path):
    from lawgrain.streaming import state as T

    schema = "item_no long, akn_uri string, status string, size long"
    uris = [None, "", *[f"u{i}" for i in range(300)]]
    lines, number = [], 2**60  # no float holds these
    for batch in range(3):
        for i, uri in enumerate(uris):
            for again in range(1 + i % 3):
                number += 1
                status = "success" if (i + again) % 5 < batch else "error"
                lines.append((batch, number, uri, status, None if i % 4 == 0 else number))
    want, done = [], set()
    for batch, *line in lines:
        if line[1] not in done:
            want.append(tuple(line))
            done |= {line[1]} if line[2] == "success" else set()
    assert 0 < len(want) < len(lines)
    source, table = f"{tmp_path}/outcomes", f"{tmp_path}/kept"
    for batch in range(3):
        some = [line[1:] for line in lines if line[0] == batch]
        spark.createDataFrame(some[::-1], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        query = J.append_to_table(T.until_done(stream, 10**9, buckets=3), table, f"{tmp_path}/checkpoint")
        query.awaitTermination()
        (state,) = query.recentProgress[-1].stateOperators
        query.stop()
        assert state.numRowsTotal == 3
    kept = spark.read.parquet(table)
    assert kept.columns == ["item_no", "akn_uri", "status", "size"]
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[0]) == want


def test_a_bucket_keeps_its_uris_apart(spark, tmp_path, monkeypatch):
    import pandas as pd
    from pyspark.sql import GroupedData

    class State:
        hasTimedOut, exists, now = False, False, 0
        getCurrentProcessingTimeMs = property(lambda self: lambda: self.now)

        def update(self, value):
            self.get, self.exists = value, True

        def setTimeoutDuration(self, ms):
            pass

    sent = []
    real = GroupedData.applyInPandasWithState
    monkeypatch.setattr(GroupedData, "applyInPandasWithState", lambda self, f, *rest: sent.append(f) or real(self, f, *rest))
    schema = "item_no long, akn_uri string, status string"
    spark.createDataFrame([(1, "u", "error")], schema).write.parquet(str(tmp_path / "outcomes"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "outcomes"))
    J.stream_until_done(stream, spark.createDataFrame([("gone",)], "akn_uri string"), 100)
    state = State()

    def kept(now, *frames):
        state.now = now
        tables = [pd.DataFrame(lines, columns=["item_no", "akn_uri", "status"]).assign(**{"item_no is null": False}) for lines in frames]
        out = pd.concat(sent[0]((7,), iter(tables), state))
        return sorted(zip(out["item_no"], out["akn_uri"], out["status"]))

    assert kept(0, [(1, "u", "success"), (2, "v", "success"), (3, "w", "error")]) == [
        (1, "u", "success"), (2, "v", "success"), (3, "w", "error"),
    ]
    assert kept(99, [(4, "v", "success"), (5, "w", "error")]) == [(5, "w", "error")]
    # u was not listed for 100 ms, v was
    assert kept(101, [(6, "u", "error"), (7, "v", "error"), (8, "w", "success")]) == [(6, "u", "error"), (8, "w", "success")]
    # many frames: the least completion counts wherever it comes
    frames = [[(10 * n + i, f"x{i}", "success" if n % 7 == 0 else "error") for i in range(10)] for n in range(20_000, 100, -1)]
    joined = [sum(frames[k : k + 1000], []) for k in range(0, len(frames), 1000)]
    assert kept(102, *joined) == sorted(line for frame in frames[-5:] for line in frame)


def test_failing_uris_are_kept_in_spark_s_own_state_store(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        for lines in ([(1, "u", "error"), (2, "v", "success")], [(3, "u", "success"), (4, "v", "error")]):
            kept, _ = run_until_done(spark, tmp_path, lines, 10**9)
    finally:
        spark.conf.set(key, before)
    assert kept == [(1, "u", "error"), (2, "v", "success"), (3, "u", "success")]


def test_packed_pages_are_listed_like_a_file_a_page_in_few_batches(spark, tmp_path, rows):
    pages = [(n, page(f"u{n}", f"é\r\n{n}")) for n in range(1, 41)] + [(41, "no json")]
    write_pages(tmp_path / "single", "act", "statute", [body for _, body in pages])
    lines = "\n".join(json.dumps({"page": n, "body": body}) for n, body in pages)
    folder = tmp_path / "packed" / "category=act" / "document_type=statute"
    folder.mkdir(parents=True)
    (folder / "part-0.txt").write_text(lines)
    listing = J.stream_listing(spark, str(tmp_path / "packed"), max_files=4, packed=True)
    query = J.append_to_table(listing, str(tmp_path / "listed"), str(tmp_path / "c"))
    query.awaitTermination()
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 1
    query.stop()
    columns = ("category", "document_type", "page", "pos", "akn_uri", "status")
    found = rows(spark.read.parquet(str(tmp_path / "listed")).select(*columns))
    assert len(found) == 80
    assert found == rows(L.read_list_pages(spark, str(tmp_path / "single")).select(*columns))


def test_twelve_batches_read_few_folders_of_state(spark, tmp_path):
    from lawgrain.streaming import state as T

    schema = T.StructType.fromDDL("akn_uri string")
    root = str(tmp_path / "state")
    for batch in range(12):
        T.drop_merged(spark, root, batch)
        assert len(T.state_folders(spark, root, batch)) <= 4 + 1
        before = {r.akn_uri for r in T.state_before(spark, root, schema, batch).collect()}
        assert before == {f"u{n}" for n in range(batch)} | ({"same"} if batch else set())
        rows = spark.createDataFrame([(f"u{batch}",), ("same",)], schema)
        for _ in range(2):  # each batch is replayed
            T.add_to_state(rows, root, batch, 4)
    assert T.state_rows(spark, root, schema).distinct().count() == 13
    folders = {p.name for p in (tmp_path / "state").iterdir()}
    assert len(folders) <= 2 * 5 and "delta=0" not in folders


def test_a_lost_snapshot_is_not_read(spark, tmp_path):
    from lawgrain.streaming import state as T

    schema = T.StructType.fromDDL("akn_uri string")
    root = str(tmp_path / "state")
    for batch in range(3):
        T.add_to_state(spark.createDataFrame([(f"u{batch}",)], schema), root, batch, 2)
    (tmp_path / "state" / "snapshot=2" / "_SUCCESS").unlink()  # lost while it was written
    T.drop_merged(spark, root, 3)
    assert sorted(r.akn_uri for r in T.state_before(spark, root, schema, 3).collect()) == ["u0", "u1", "u2"]


def test_worked_off_pages_move_to_the_archive(spark, tmp_path):
    landing, archive, table = tmp_path / "pages", tmp_path / "archive", str(tmp_path / "listed")

    def run():
        listing = J.stream_listing(spark, str(landing), archive=str(archive), max_age="7d")
        finish(J.append_to_table(listing, table, str(tmp_path / "c")))
        return sorted(r.akn_uri for r in spark.read.parquet(table).collect())

    def files(folder):
        return sorted(p.parent.name for p in folder.rglob("body.json")) if folder.exists() else []

    write_pages(landing, "act", "statute", [page("u1"), page("u2")])
    assert run() == ["u1", "u2"]
    write_pages(landing, "doc", "treaty", [page("u3")])
    assert run() == ["u1", "u2", "u3"]  # restarted; commits the first batch's pages as done
    write_pages(landing, "judgment", "kko", [page("u4")])
    assert run() == ["u1", "u2", "u3", "u4"]
    assert run() == ["u1", "u2", "u3", "u4"]
    assert len(files(archive)) >= 2 and len(files(landing)) + len(files(archive)) == 4
    assert files(landing) != files(archive)
