"""How the checks store their input tables."""

import os

from checks import derived as D
from lawgrain.sources import landing as L


def test_attempts_move_once_and_before_their_uris_are_made(spark, tmp_path):
    spark.sql(
        """SELECT id AS l_orderkey, id AS l_partkey, id % 7 AS l_suppkey, CAST(id % 7 + 1 AS INT) AS l_linenumber,
        CAST(id AS DOUBLE) AS l_quantity, 1.0D AS l_extendedprice, TIMESTAMP_NTZ '2000-01-01 00:00:00' AS l_shipdate
        FROM range(500)"""
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    stored = D.derive(spark, str(tmp_path), "attempts")
    plan = D.table_of(spark, str(tmp_path), "attempts")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 2 and all("REPARTITION_BY_COL" in line for line in exchanges)  # one a run
    assert stored.count() == D.table_of(spark, str(tmp_path), "attempts").count() > 500


def test_every_row_is_a_file_of_its_own(spark, tmp_path):
    lines = [("act/1", "a\n"), ("act/1", "a\n"), ("doc/2/ä", "é\n"), ("act/1", "b\n")]
    root = str(tmp_path / "tree")
    for _ in range(2):  # tasks may be repeated
        D.write_files(spark.createDataFrame(lines, "folder string, text string").coalesce(1), root)
    tree = L.read_document_tree(spark, root, "*.txt", "tree")
    assert sorted((r.folder_path, r.xml) for r in tree.collect()) == sorted(lines)
    assert len([n for _, _, names in os.walk(root) for n in names]) == 4


def test_a_tree_is_listed_by_few_tasks(spark, tmp_path):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    for n in range(200):
        (tmp_path / "tree" / f"{n}").mkdir(parents=True)
        (tmp_path / "tree" / f"{n}" / "f.txt").write_text(f"{n}")
    spark.sparkContext.setJobGroup("listing", "listing")
    tree = L.read_document_tree(spark, str(tmp_path / "tree"), "*.txt", "tree")
    tracker = spark.sparkContext.statusTracker()
    tasks = [
        tracker.getStageInfo(stage).numTasks
        for job in tracker.getJobIdsForGroup("listing")
        for stage in tracker.getJobInfo(job).stageIds
    ]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == before
    assert tree.select("xml").distinct().count() == 200
