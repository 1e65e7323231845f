"""Readers and writers on small files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lawgrain.functions import uri as U
from lawgrain.sources import catalogue as G
from lawgrain.sources import commits
from lawgrain.sources import landing as L

BASE = "/open/data/v1"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8") if isinstance(text, str) else path.write_bytes(text)


def write_pages(root, category, kind, bodies):
    for page, body in enumerate(bodies, 1):
        put(root / f"category={category}" / f"document_type={kind}" / f"page={page}" / "body.json", body)


def test_read_list_pages(spark, tmp_path):
    write_pages(
        tmp_path,
        "act",
        "statute",
        [
            json.dumps([{"akn_uri": "u1", "status": "NEW"}, {"status": "MODIFIED"}, {"akn_uri": "u3", "more": 1}], indent=1),
            "[]",
            "{broken",
            json.dumps([{}]),
        ],
    )
    rows = L.read_list_pages(spark, str(tmp_path)).orderBy("item_no").collect()
    assert [(r.page, r.pos, r.akn_uri, r.status) for r in rows] == [
        (1, 0, "u1", "NEW"),
        (1, 1, "", "MODIFIED"),
        (1, 2, "u3", ""),
        (4, 0, "", ""),
    ]
    assert {(r.category, r.document_type) for r in rows} == {("act", "statute")}
    pages = L.pages_from_text(L._page_files(spark, str(tmp_path), streaming=False))
    log = {r.page: (r.json_ok, r.n_items) for r in L.page_log(pages).collect()}
    assert log == {1: (True, 3), 2: (True, 0), 3: (False, 0), 4: (True, 1)}


def test_document_tree_and_inventory(spark, tmp_path):
    plain = "judgment/kho/2011/64/fin@"
    regulation = "doc/authority-regulation/a+b ä/2003/517/swe@"
    put(tmp_path / plain / "main.xml", "<a>\n</a>\n")
    put(tmp_path / plain / "main.pdf", b"%PDF")
    put(tmp_path / plain / "media" / "x.gif", b"GIF")
    put(tmp_path / regulation / "main.xml", "<ä/>".encode("latin-1"))
    tree = {r.folder_path: r.xml for r in L.read_document_tree(spark, str(tmp_path)).collect()}
    assert set(tree) == {plain, regulation} and tree[plain] == "<a>\n</a>\n"
    raw = {r.folder_path: bytes(r.content) for r in L.read_document_tree(spark, str(tmp_path), text_bytes=-1).collect()}
    assert raw[regulation] == "<ä/>".encode("latin-1")
    inventory = L.file_inventory(spark, str(tmp_path))
    assert "content" not in inventory.columns
    assert sorted(r.length for r in inventory.collect()) == [3, 4, 4, 9]
    assert {r.folder_path for r in L.stored_documents(inventory).collect()} == {plain, regulation}


def test_tree_written_by_spark_and_sizes(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("act", "sta/tute", f"{n}", "x" * n) for n in (5, 50, 500)]
    frame = spark.createDataFrame(rows, "category string, kind string, number string, xml string")
    frame.write.partitionBy("category", "kind", "number").text(path)
    tree = L.read_document_tree(spark, path, "*.txt", "store", text_bytes=60, max_bytes=400)
    got = {r.folder_path: (r.length, r.xml, r.content) for r in tree.collect()}
    assert got["act/sta/tute/5"] == (6, "xxxxx\n", None)
    assert got["act/sta/tute/50"][1] == "x" * 50 + "\n"
    assert got["act/sta/tute/500"] == (501, None, None)  # listed, never opened
    tree = L.read_document_tree(spark, path, "*.txt", "store", text_bytes=10)
    assert {r.folder_path: r.xml is None for r in tree.collect()} == {
        "act/sta/tute/5": False, "act/sta/tute/50": True, "act/sta/tute/500": True,
    }
    text = tree._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(length), LessThanOrEqual(length,10)]" in text


def test_small_files_share_tasks(spark, tmp_path):
    for n in range(64):
        put(tmp_path / "act" / "statute" / "2024" / str(n) / "fin@" / "main.xml", "<a/>")
    assert L.read_document_tree(spark, str(tmp_path)).rdd.getNumPartitions() < 64


ENTRY = {
    "akn_uri": "u",
    "status": "success",
    "timestamp": "2019-11-05T08:41:00.000913",
    "files": ["store/k/main.xml", "store/k/main.zip", "store/k/media/p.png"],
    "error": None,
}


def test_read_manifest_file(spark, tmp_path):
    put(tmp_path / "a" / "manifest.json", json.dumps({"total_entries": 2, "entries": [ENTRY, dict(ENTRY, akn_uri="v")]}, indent=2))
    put(tmp_path / "b" / "manifest.json", "{ broken")
    put(tmp_path / "c" / "manifest.json", json.dumps({"entries": []}))
    rows = G.read_manifest(spark, str(tmp_path / "*")).orderBy("akn_uri").collect()
    assert [r.akn_uri for r in rows] == ["u", "v"]
    assert rows[0].timestamp.isoformat() == ENTRY["timestamp"] and rows[0].files == ENTRY["files"]


def test_manifest_table_appends_runs(spark, tmp_path):
    root = str(tmp_path / "manifest")
    entries = spark.createDataFrame([("u", "success"), ("v", "error")], "akn_uri string, status string")
    G.write_manifest(entries, root, "r1")
    G.write_manifest(entries.where("akn_uri = 'u'"), root, "r2")
    G.write_manifest(entries.where("akn_uri = 'u'"), root, "r2")
    table = G.read_manifest_table(spark, root)
    assert {(r.run_id, r.akn_uri) for r in table.collect()} == {("r1", "u"), ("r1", "v"), ("r2", "u")}
    assert table.count() == 3


def test_a_lost_write_leaves_what_was_published(spark, tmp_path):
    """A run that fails midway replaces nothing, also after part files were written."""
    root = str(tmp_path / "manifest")
    entries = spark.createDataFrame([("u", "success"), ("v", "error")], "akn_uri string, status string")
    G.write_manifest(entries, root, "r/1")
    bad = spark.range(40, numPartitions=8).select(
        F.col("id").cast("string").alias("akn_uri"),
        F.when(F.col("id") < 39, "success").otherwise("unheard of").alias("status"),
    )
    with pytest.raises(Exception, match="unknown status"):
        G.write_manifest(bad, root, "r/1")
    # lost between the write and its publication
    good = spark.createDataFrame([("w", "success")], "akn_uri string, status string")
    keep = commits._note
    commits._note = lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost"))
    try:
        with pytest.raises(RuntimeError):
            G.write_manifest(good, root, "r/1")
    finally:
        commits._note = keep
    table = G.read_manifest_table(spark, root)
    assert sorted((r.run_id, r.akn_uri) for r in table.collect()) == [("r/1", "u"), ("r/1", "v")]
    assert tuple(G.read_summary(spark, root).first()) == (2, 1, 0, 1)
    # a reader that has begun still finds its files after the run is replaced
    G.write_manifest(good, root, "r/1")
    assert table.count() == 2
    assert [r.akn_uri for r in G.read_manifest_table(spark, root).collect()] == ["w"]
    assert commits.remove_old(spark, root) == 3
    assert [r.akn_uri for r in G.read_manifest_table(spark, root).collect()] == ["w"]


def test_commits_are_merged_and_a_torn_snapshot_is_ignored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 4)
    root = str(tmp_path / "completed")
    one = spark.createDataFrame([("u", "success")], "akn_uri string, status string")
    for n in range(11):
        G.write_completed(one, root, f"{n}")
        assert len(os.listdir(os.path.join(root, "_commits"))) <= 2 * 6  # a check sum lies beside each
    assert set(commits.published(spark, root)) == {str(n) for n in range(11)}
    last = int(commits._log(spark, root)[-1][0])
    (tmp_path / "completed" / "_commits" / f"{last + 1:010d}.snapshot").write_text('{"3": ')
    assert set(commits.published(spark, root)) == {str(n) for n in range(11)}
    assert G.read_completed(spark, root, but_run="3").count() == 10


def test_a_report_reads_one_row_a_run(spark, tmp_path):
    root = str(tmp_path / "manifest")
    for run in ("a", "b"):
        entries = spark.range(1000).select(F.col("id").cast("string").alias("akn_uri"), F.lit("skipped").alias("status"))
        G.write_manifest(entries, root, run)
    summary = G.read_summary(spark, root)
    assert tuple(summary.first()) == (2000, 0, 2000, 0)
    assert all("/_counts/" in f for f in summary.inputFiles())


def test_state_round_trip_and_reset(spark, tmp_path):
    completed, progress = str(tmp_path / "completed"), str(tmp_path / "progress")
    entries = spark.createDataFrame([("u", "success"), ("v", "error"), ("w", "skipped")], "akn_uri string, status string")
    G.write_completed(entries, completed, "r1")
    G.write_completed(entries.where("akn_uri = 'u'"), completed, "r2")
    position = spark.sql("SELECT 'act' AS category, 'statute' AS document_type, 5L AS position, TIMESTAMP_NTZ'2024-01-01' AS updated_at")
    G.write_progress(position, progress, "r1")
    assert sorted(r.akn_uri for r in G.read_completed(spark, completed).collect()) == ["u", "u", "w"]
    assert G.read_progress(spark, progress).first().position == 5
    G.reset_state(spark, completed, progress)
    assert G.read_completed(spark, completed).count() == 0 and G.read_progress(spark, progress).count() == 0
    G.write_completed(entries, completed, "r3")
    assert G.read_completed(spark, completed).count() == 2


def test_read_state_file(spark, tmp_path):
    state = {
        "current_category": "doc",
        "current_document_type": "treaty",
        "current_page": 37,
        "completed_uris": ["b", "a", "c", "b", "b"],
        "updated_at": "2018-02-14T23:59:59.999999",
    }
    put(tmp_path / "state.json", json.dumps(state, indent=2))
    completed, progress = G.read_state(spark, str(tmp_path / "state.json"))
    assert sorted(r.akn_uri for r in completed.collect()) == ["a", "b", "c"]
    assert tuple(progress.first())[:3] == ("doc", "treaty", 37)
    put(tmp_path / "bad.json", "nonsense")
    completed, progress = G.read_state(spark, str(tmp_path / "bad.json"))
    assert completed.count() == 0 and progress.count() == 0


def test_corpus_is_partitioned_and_pruned(spark, tmp_path):
    root = str(tmp_path / "corpus")
    uris = [f"/akn/fi/act/statute/{2015 + n % 3}/{n}/fin@" for n in range(90)] + ["broken"]
    documents = spark.createDataFrame([(u, f"<a>{u}</a>") for u in uris], "akn_uri string, xml string")
    G.write_corpus(documents.withColumn("info", U.parse_uri(F.col("akn_uri"), BASE)), root, "1")
    corpus = G.read_corpus(spark, root)
    assert corpus.count() == 90
    assert {r.xml for r in corpus.collect()} == {f"<a>{u}</a>" for u in uris[:-1]}
    pruned = corpus.where("year = 2016")
    assert pruned.count() == 30
    files = {f for f in pruned.inputFiles()}
    assert all("/year=" in f for f in files) and len(files) <= 3 * 3
