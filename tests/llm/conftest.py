import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("driver tables not present")
    return DATA


@pytest.fixture(scope="session")
def corpus(spark, data):
    """doc_id and text of the smallest driver table, as Python pairs."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with NULLs, empty and long texts, ties, repeats and clashing columns."""
    long = "Alpha beta gamma delta. " * 9000
    rows = [
        (1, None, None, None, 0, 1, "x", 5),
        (2, "", "en", "s", 0, 2, "x", 5),
        (None, "Only words here", "en", "s", 15, 3, None, 5),
        (None, None, None, None, None, None, None, None),
        (3, long, "en", "s", len(long), 4, "x", 5),
        (4, long, "xx", "s", len(long), 4, "x", 5),
        (4, long, "xx", "s", len(long), 4, "x", 5),
        (5, " \t\n\x0b\x0c\r ", "de", "s", 7, 4, "x", 5),
        (6, "Ünïcødé 😀 word", "fr", "s", 14, 4, "x", 5),
        (7, "mail a.b@c.de or 10.0.0.1, +1 (202) 555-0147", "en", "s", 44, 4, "x", 5),
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, k1 long, fp string, kept int"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
