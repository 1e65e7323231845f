"""Plans hold what the operators promise about large data."""

import re

import pytest
from pyspark.sql import functions as F

from lawgrain.functions import uri as U
from lawgrain.operators import manifest as M
from lawgrain.operators import outcome as O
from lawgrain.operators import scope as S
from lawgrain.operators import worklist as W
from lawgrain.operators.ordering import ranged
from lawgrain.params import CrawlParams
from lawgrain.sources import catalogue as G

BASE = "/open/data/v1"

# No broadcasts, and thresholds at which a few thousand rows count as skewed.
SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_skew(spark):
    for key, value in SMALL_SKEW.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL_SKEW:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A listing of 60,000 rows, half of them of one URI, in many files."""
    path = str(tmp_path_factory.mktemp("hot") / "listing")
    rows = spark.range(60_000).select(
        F.col("id").alias("item_no"),
        F.when(F.col("id") % 2 == 0, "/akn/fi/act/statute/2024/1/fin@")
        .otherwise(F.concat(F.lit("/akn/fi/act/statute/2024/"), "id", F.lit("/fin@")))
        .alias("akn_uri"),
        F.when(F.col("id") % 3 == 0, "success").otherwise("error").alias("status"),
    )
    rows.repartition(16).write.parquet(path)
    return path


def run_plan(frame):
    """Final plan after running; executes the very DataFrame whose plan is read."""
    frame.collect()
    return plan(frame)


def is_split(text):
    return "skew=true" in text


def test_hot_uri_is_split_in_worklist(spark, small_skew, hot, tmp_path):
    completed = str(tmp_path / "completed")
    spark.range(5_000).select(F.concat(F.lit("/akn/fi/act/statute/2024/"), "id", F.lit("/fin@")).alias("akn_uri")).write.parquet(completed)
    listing = spark.read.parquet(hot)
    assert is_split(run_plan(W.worklist(listing, spark.read.parquet(completed))))


def test_completed_uris_in_buckets_do_not_move(spark, small_skew, hot, tmp_path):
    root = str(tmp_path / "completed")
    done = spark.range(5_000).select(F.concat(F.lit("/akn/fi/act/statute/2024/"), "id", F.lit("/fin@")).alias("akn_uri"))
    for run in ("1", "2"):
        G.write_completed(done.withColumn("status", F.lit("success")), root, run)
    stored = G.bucket_completed(spark, root, "completed_buckets", 8)
    listing = spark.read.parquet(hot)
    work = W.worklist_bucketed(listing, stored)
    lines = plan(work).split("\n")
    (scan,) = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    indent = [len(line) - len(line.lstrip(" :|+-")) for line in lines]
    above, depth = [], indent[scan]
    for i in range(scan - 1, -1, -1):  # from the scan up to the join
        if indent[i] < depth:
            above.append(lines[i])
            depth = indent[i]
            if "Join" in lines[i]:
                break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above)
    assert is_split(run_plan(work))
    assert sorted(r.item_no for r in work.collect()) == sorted(r.item_no for r in W.worklist(listing, done).collect())


def test_hot_uri_is_split_in_dedup(spark, small_skew, hot):
    assert is_split(run_plan(W.in_run_dedup(spark.read.parquet(hot))))


def test_hot_uri_is_split_in_outcome(spark, small_skew, hot):
    work = S.with_paths(S.with_document_key(spark.read.parquet(hot), BASE)).withColumn("exists", F.lit(False))
    attempts = work.select(
        F.lit("r1").alias("run_id"),
        "akn_uri",
        F.lit("xml").alias("kind"),
        F.lit(None).cast("string").alias("link"),
        F.col("item_no").alias("attempt"),
        F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("exception"),
        F.lit(None).cast("timestamp_ntz").alias("start_ts"),
    )
    params = CrawlParams(base_path=BASE, current_year=2024)
    by_document = O.responses_by_document(O.final_responses(attempts, max_retries=10**9), params)
    assert is_split(run_plan(O.document_outcome(work.drop("status"), by_document, params)))


def test_latest_entry_is_cut_before_the_shuffle(spark, hot):
    manifest = spark.read.parquet(hot).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    text = plan(M.manifest_latest(manifest))
    limit, exchange = text.rindex("WindowGroupLimit"), text.index("Exchange hashpartitioning")
    assert limit > exchange  # below it in the tree


def test_page_numbers_never_sort_a_whole_listing(spark, hot):
    listing = spark.read.parquet(hot).withColumn("category", F.lit("act")).withColumn("document_type", F.lit("statute"))
    text = plan(S.paginate(listing, range_rows=1000))
    for spec in re.findall(r"row_number\(\) windowspecdefinition\(([^)]*)\)", text):
        assert "_range" in spec


@pytest.mark.parametrize(
    "spread",
    [
        "id",
        # nine tenths in two clusters far apart
        "CASE WHEN id % 10 = 0 THEN id * 1000003 WHEN id % 2 = 0 THEN id ELSE 1000000000000 + id END",
        "(id * 7919 % 1000003) * 9000000000 + id",
        # one row far out
        "CASE WHEN id = 7 THEN 9000000000000000 ELSE id END",
    ],
)
def test_ranges_of_a_listing_are_even_however_its_numbers_lie(spark, spread):
    rows = spark.range(40_000).selectExpr("'act' AS category", f"{spread} AS item_no").repartition(7)
    rows = rows.unionByName(spark.range(30).selectExpr("'doc' AS category", "id AS item_no"))
    sizes = {(r.category, r["_range"]): r["count"] for r in ranged(rows, ["category"], "item_no", 1000).groupBy("category", "_range").count().collect()}
    assert len(sizes) == 41 and max(sizes.values()) <= 2000 and sizes["doc", 0] == 30


@pytest.mark.parametrize("by", ["number", "dateIssued"])
def test_ranks_of_a_whole_listing(spark, by):
    """Ties throughout; places do not depend on how the rows are dealt."""
    rows = spark.range(3000).selectExpr(
        "id AS item_no",
        "CASE WHEN id % 50 = 0 THEN '' ELSE '/akn/fi/act/statute/2024/' || (id % 7) || '/fin@' END AS akn_uri",
        "DATE'2024-01-01' AS date_issued",
    )
    places = []
    for parts in (1, 9):
        listing = S.with_document_key(rows.repartition(parts), BASE)
        ranked = S.listing_rank(listing, by, descending=True)
        assert "_sort" not in ranked.columns and ranked.columns[-1] == "place"
        places.append([r.item_no for r in ranked.orderBy("place").collect()])
        assert sorted(r.place for r in ranked.collect()) == list(range(1, 3001))
    assert places[0] == places[1]
    assert places[0] == [r.item_no for r in S.listing_sort(S.with_document_key(rows, BASE), by, descending=True).collect()]


def test_sort_keys_are_computed_once(spark):
    listing = S.with_document_key(spark.range(10).selectExpr("id AS item_no", "'' AS akn_uri"), BASE)
    text = plan(S.listing_sort(listing))
    (sort,) = re.findall(r"Sort \[([^\n]*)\], true", text)
    assert "CASE" not in sort and "regexp" not in sort and "try_cast" not in sort.lower()


def test_scope_prunes_folders_and_parses_once(spark, tmp_path):
    root = str(tmp_path / "listing")
    lines = [(1, "act", "statute", "/akn/fi/act/statute/2024/1/fin@"), (2, "doc", "treaty", "/akn/fi/doc/treaty/2024/2/fin@")]
    frame = spark.createDataFrame(lines, "item_no long, category string, document_type string, akn_uri string")
    frame.write.partitionBy("category", "document_type").parquet(root)
    params = CrawlParams(base_path=BASE, current_year=2024)
    scoped = S.with_document_key(S.expand_types(spark.read.parquet(root), params.categories), BASE)
    kept = S.filter_lang(S.filter_year_window(scoped, params))
    text = plan(kept)
    assert re.search(r"PartitionFilters: \[[^\]]*category[^\]]*IN|PartitionFilters: \[[^\]]*category[^\]]* = act", text)
    assert text.count("regexp_extract_all") == 1
    assert [r.item_no for r in kept.collect()] == [1]


def test_year_window_prunes_a_listing_stored_by_year(spark, tmp_path):
    root = str(tmp_path / "by_year")
    spark.createDataFrame([(n, "act", 2000 + n) for n in range(20)], "item_no long, requested string, year int").write.partitionBy("year").parquet(root)
    kept = S.filter_year_window(spark.read.parquet(root), CrawlParams(base_path=BASE, current_year=2015, years=3), "year")
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*>= 2013", plan(kept))
    assert sorted(r.item_no for r in kept.collect()) == [13, 14, 15]


def test_filters_and_columns_reach_the_scan(spark, hot):
    text = plan(M.filter_completable(spark.read.parquet(hot)).select("akn_uri"))
    assert "PushedFilters: [In(status, [skipped,success])]" in text or "PushedFilters: [In(status, [success,skipped])]" in text
    assert "ReadSchema: struct<akn_uri:string,status:string>" in text


def test_corpus_write_splits_a_large_partition(spark, small_skew, tmp_path):
    documents = spark.range(4_000).select(
        F.concat(F.lit("/akn/fi/act/statute/2024/"), "id", F.lit("/fin@")).alias("akn_uri"),
        F.sha2(F.col("id").cast("string"), 512).alias("xml"),
    )
    root = str(tmp_path / "corpus")
    G.write_corpus(documents.withColumn("info", U.parse_uri(F.col("akn_uri"), BASE)), root, "1")
    assert len(G.read_corpus(spark, root).inputFiles()) > 4
    assert G.read_corpus(spark, root).count() == 4_000


@pytest.mark.parametrize("name", ["crawl_manifest", "dry_run_plan", "media_links", "paginate", "pacing_audit"])
def test_no_cross_joins(spark, name):
    from checks.queries import QUERIES

    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_a_run_moves_the_log_once_and_the_uris_twice(spark, tmp_path):
    """The log by URI; the URIs by URI and by folder; the listing is read once."""
    from checks.queries import PARAMS, _tables
    from lawgrain.plans import crawl as C

    tables = _tables(spark, "/root/testdata/sf0.001")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    texts = []
    keep = C.staged

    def spy(table, label):
        texts.append((label, plan(table)))
        return keep(table, label)

    C.staged = spy
    try:
        C.crawl_manifest(tables, PARAMS, "2001-12-31 00:00:00").collect()
    finally:
        C.staged = keep
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scans = dict(texts)
    assert scans["scope"].count("FileScan parquet") == 1 and "Exchange" not in scans["scope"].replace("BroadcastExchange", "")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", scans["outcomes"])
    # each side of the folder join by folder; all else by URI, the log in one exchange
    assert len([e for e in exchanges if "folder_path" in e]) <= 3
    assert all("akn_uri" in e or "folder_path" in e for e in exchanges)
    assert not any("kind" in e or "link" in e for e in exchanges)


def test_a_log_is_cut_before_it_moves(spark):
    """Attempts of documents that are not asked for are dropped where they lie."""
    from checks.queries import PARAMS, _tables
    from lawgrain.plans import crawl as C

    texts, keep = {}, C.staged

    def spy(table, label):
        texts[label] = plan(table)
        return keep(table, label)

    C.staged = spy
    try:
        C.crawl_manifest(_tables(spark, "/root/testdata/sf0.001"), PARAMS, "2001-12-31 00:00:00").collect()
    finally:
        C.staged = keep
    lines = texts["outcomes"].splitlines()
    log = next(i for i, line in enumerate(lines) if "FileScan" in line and "http_status" in line)
    above = [line for line in lines[:log] if "Exchange hashpartitioning" in line or "_bucket" in line and "BroadcastHashJoin" in line]
    assert "BroadcastHashJoin" in above[-1] and "REPARTITION_BY_NUM" in above[-2]


@pytest.mark.parametrize("max_bits", [27, 15])
def test_likely_matches_lose_no_match(spark, monkeypatch, max_bits):
    """With bits enough few others pass, with too few many, but never is a match lost."""
    from lawgrain.operators import joins

    monkeypatch.setattr(joins, "MAX_BITS", max_bits)
    uri = F.concat(F.lit("/akn/fi/act/statute/2020/"), F.col("id").cast("string"))
    key = F.when(F.col("id") % 1000 != 7, uri).alias("akn_uri")
    rows = spark.range(200_000).select("id", key)
    facts = spark.range(20_000).select(key)
    found = joins.likely_matches(rows, facts, "akn_uri")
    assert found.columns == rows.columns
    assert found.where("id < 20000").count() == 20_000 - 20 and found.where("akn_uri IS NULL").count() == 0
    others = found.where("id >= 20000").count()
    assert others < 180_000 / 6 if max_bits == 27 else others < 180_000
    assert joins.likely_matches(rows, facts.where("false"), "akn_uri").count() == 0


def test_a_run_parses_its_listing_once(spark, tmp_path):
    """Entries and progress start from one stored scope."""
    from checks.queries import PARAMS, _tables
    from lawgrain.plans import crawl as C

    parsed, keep = [], C.scoped_listing

    def spy(listing, params):
        parsed.append(params)
        return keep(listing, params)

    C.scoped_listing = spy
    try:
        roots = C.CatalogueRoots(*(str(tmp_path / name) for name in ("manifest", "completed", "progress")))
        C.run_crawl(_tables(spark, "/root/testdata/sf0.001"), roots, PARAMS, "001", "2001-12-31 00:00:00")
    finally:
        C.scoped_listing = keep
    assert len(parsed) == 1
