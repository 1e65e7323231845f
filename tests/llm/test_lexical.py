"""Ranked search against its statement, in one block and in many, and on odd rows."""

from checks.compare import canonical, connect
from lawgrain.llm import lexical, queries


def test_equal_to_its_statement(spark, data):
    want = canonical(connect(data).execute(queries.OP12_SQL).df())
    assert canonical(queries.op12_lexical_search(spark, data).toPandas()).equals(want)
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    blocks = lexical.search(docs, items, block_bytes=3000)
    assert canonical(blocks.toPandas()).equals(want)


def test_tasks_and_small_cells_do_not_matter(spark, data, monkeypatch):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    want = canonical(lexical.search(docs, items).toPandas())
    assert canonical(lexical.search(docs.repartition(13), items).toPandas()).equals(want)


def test_counts_by_windows(monkeypatch):
    block = lexical.Block([(1, "ab"), (1, "c"), (2, "é"), (2, "b")])
    text = "AB c,ab abc É é c\tab" * 20
    whole = [x.tolist() if hasattr(x, "tolist") else x for x in lexical.term_counts(text, block.automaton)]
    monkeypatch.setattr(lexical, "WINDOW", 3)
    parts = [x.tolist() if hasattr(x, "tolist") else x for x in lexical.term_counts(text, block.automaton)]
    assert whole == parts
    words = text.lower().replace(",", " ").replace("\t", " ").replace("É".lower(), "é").split()
    assert whole[0] == len(words)


def test_odd_rows(spark):
    docs = [("b", "x y", 1), ("a", "x y", 1), ("a", "x y", 1), (None, "x y", 1), ("n", None, 1), ("e", " ,. ", 1), ("long", "x " * 300_000, 1), *[(f"o{i}", "q", 1) for i in range(9)]]
    items = [("i", "X x"), ("none", None), ("empty", ""), ("far", "zzz"), (None, "y"), ("i", "y")]
    frame = spark.createDataFrame(docs, "doc_id string, text string, item_id int")
    table = spark.createDataFrame(items, "item_id string, text string")
    got = {}
    for r in lexical.search(frame, table, top=3).collect():
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"]))
    assert {k: [d for _, d in sorted(v)] for k, v in got.items()} == {"i": ["a", "a", "b"], None: ["a", "a", "b"]}
    assert lexical.search(frame.where("false"), table).count() == 0
    assert lexical.search(frame, table.where("false")).count() == 0
