"""Every operator on NULLs, empty and long texts, repeats, clashing columns, no rows."""

import pytest

from lawgrain.llm import (
    chat,
    decontaminate,
    licences,
    packing,
    pii,
    quality,
    scoring,
    simhash,
    substrings,
    toxicity,
)


def small_labels(spark):
    rows = [(3, 1), (4, None), (None, 1), (4, 0), (99, 1), (6, 0)]
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def items(spark):
    rows = [(1, "alpha beta gamma delta alpha beta gamma delta alpha beta gamma delta"), (2, None), (None, "only words here"), (3, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


SAME_ROWS = {
    "quality": lambda s, d: quality.quality_rules(d),
    "simhash": lambda s, d: simhash.simhash_groups(d),
    "pii": lambda s, d: pii.find_personal_data(d),
    "redact": lambda s, d: pii.redact(d),
    "scoring": lambda s, d: scoring.score_documents(d),
    "toxicity": lambda s, d: toxicity.score_documents(d, small_labels(s)),
    "substrings": lambda s, d: substrings.repeated_strings(d),
}


@pytest.mark.parametrize("name", sorted(SAME_ROWS))
def test_one_row_for_each_document(spark, odd, none, name):
    got = sorted(SAME_ROWS[name](spark, odd).toPandas()["doc_id"].fillna(-1).astype(int))
    assert got == [-1, -1, 1, 2, 3, 4, 4, 5, 6, 7]
    assert SAME_ROWS[name](spark, none).count() == 0


def test_ids_keep_their_type(spark):
    text = "alpha beta gamma delta " * 12
    rows = [("b-1", text), ("a-2", text), (None, "other words here"), ("c", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    bench = spark.createDataFrame([("i-1", text)], "item_id string, text string")
    overlaps = decontaminate.find_overlaps(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in overlaps) == [("a-2", "i-1"), ("b-1", "i-1")]
    groups = {r["doc_id"]: r["component_id"] for r in simhash.simhash_groups(docs).collect()}
    assert groups["b-1"] == groups["a-2"] == "a-2"
    assert sorted(r["doc_id"] or "" for r in simhash.keep_one(docs).collect()) == ["", "a-2", "c"]
    assert {r["doc_id"] for r in packing.pack(docs).collect()} == {"b-1", "a-2", "c", None}
    assert {r["doc_id"] for r in pii.find_personal_data(docs).collect()} == {"b-1", "a-2", "c", None}


FILTERS = {
    "quality": lambda s, d: quality.keep_good(d),
    "simhash": lambda s, d: simhash.keep_one(d),
    "decontaminate": lambda s, d: decontaminate.drop_contaminated(d, items(s)),
    "redact": lambda s, d: pii.redact(d),
}


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_keep_the_columns(spark, odd, none, name):
    got = FILTERS[name](spark, odd)
    assert got.columns == odd.columns
    assert [f.dataType for f in got.schema] == [f.dataType for f in odd.schema]
    assert got.count() <= odd.count()
    assert FILTERS[name](spark, none).count() == 0


def test_one_of_each_group_of_copies_stays(spark, odd, rows):
    kept = simhash.keep_one(odd).select("doc_id").collect()
    # no words: 1, 2, NULL, 5 share fingerprint zero; 3 and 4 are copies
    assert sorted(-1 if r[0] is None else r[0] for r in kept) == [-1, 1, 3, 6, 7]


def test_overlaps(spark, odd, none, rows):
    found = decontaminate.find_overlaps(odd, items(spark))
    got = sorted((r["doc_id"] or -1, r["item_id"] or -1) for r in found.collect())
    assert got == [(-1, -1), (3, 1), (4, 1), (4, 1)]
    assert decontaminate.find_overlaps(none, items(spark)).count() == 0
    assert decontaminate.find_overlaps(odd, items(spark).where("false")).count() == 0


def test_licences(spark, odd, none):
    assert licences.scan_licences(odd).where("confirmed").count() == 0
    assert licences.scan_licences(none).count() == 0


def test_packing(spark, odd, none):
    got = packing.pack(odd).collect()
    assert packing.pack(none).count() == 0
    assert sorted(r["doc_tokens"] for r in got if r["doc_id"] in (1, 2)) == [1, 1]
    assert all(sum(p["length"] for p in got if p["sequence_id"] == r["sequence_id"]) <= 1024 for r in got)


def test_conversations(spark):
    rows = [
        (1, 0, "user", None),
        (1, 0, "user", "b"),
        (1, 0, "user", "b"),
        (1, None, None, "a\\<|im_start|>x\\"),
        (None, 3, "assistant\n<|", "c<"),
        (2, 1, "assistant", ""),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(chat.events_of_turns(turns))
    back = out.select(
        "conv_id",
        chat.parse_turns(out["formatted"]).alias("turns"),
        chat.loss_text(out["formatted"], out["loss_spans"]).alias("loss"),
    ).collect()
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in back}
    assert got == {
        1: [("", "a\\<|im_start|>x\\"), ("user", ""), ("user", "b"), ("user", "b")],
        None: [("assistant\n<|", "c<")],
        2: [("assistant", "")],
    }
    assert chat.format_conversations(chat.events_of_turns(turns.where("false"))).count() == 0
