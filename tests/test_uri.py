"""URI functions: reference cases, traps, and a comparison with Python's own URL functions."""

import re
from pathlib import PurePosixPath
from urllib.parse import unquote, urlparse

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lawgrain.functions import uri as U
from lawgrain.operators import scope as S

BASE = "/open/data/v1"
HOST = "https://data.example.org" + BASE


def parse_all(spark, uris):
    frame = spark.createDataFrame([(n, uri) for n, uri in enumerate(uris)], "n int, uri string")
    out = frame.select("n", U.parse_uri(F.col("uri"), BASE).alias("i")).orderBy("n").collect()
    return [row.i.asDict() if row.i else None for row in out]


def info(category, document_type, year, number, lang, authority=None):
    return {
        "category": category,
        "document_type": document_type,
        "authority": authority,
        "year": year,
        "number": number,
        "lang_and_version": lang,
    }


CASES = [
    # nothing to parse
    (None, None),
    ("akn/fi", None),
    ("/akn/fi/doc/treaty/1987", None),
    # six parts with an authority, for one document type only
    ("/akn/fi/doc/authority-regulation/harbours/2009/A-17/swe@", info("doc", "authority-regulation", "2009", "A-17", "swe@", "harbours")),
    (HOST + "/akn/fi/doc/authority-regulation/harbours/2009/A-17/swe%40", info("doc", "authority-regulation", "2009", "A-17", "swe@", "harbours")),
    ("/akn/fi/doc/treaty/harbours/2009/A-17/swe@", None),
    # five parts else; paths and URLs alike
    ("/akn/fi/doc/treaty-consolidated/1987/6/eng@19990102", info("doc", "treaty-consolidated", "1987", "6", "eng@19990102")),
    (HOST + "/akn/fi/judgment/kho/2011/T640/fin@", info("judgment", "kho", "2011", "T640", "fin@")),
    ("/akn/fi/act/statute-sami/2016/1501/sme%40", info("act", "statute-sami", "2016", "1501", "sme@")),
    # the last base path counts, and only on URLs
    (HOST + "/x" + BASE + "/akn/fi/act/statute/2024/1/fin@", info("act", "statute", "2024", "1", "fin@")),
    (BASE + "/akn/fi/act/statute/2024/1/fin@", None),
    ("HTTPS://data.example.org/akn/fi/act/statute/2024/1/fin@", None),
    # query, fragment and params go from URLs only
    (HOST + "/akn/fi/act/statute/2024/1/fin@?a=b#c", info("act", "statute", "2024", "1", "fin@")),
    (HOST + "/akn/fi/act/statute/2024/1/fin@;v=2", info("act", "statute", "2024", "1", "fin@")),
    (HOST + "/akn/fi/act/sta;x/2024/1/fin@", info("act", "sta;x", "2024", "1", "fin@")),
    ("/akn/fi/act/statute/2024/1/fin@?a=b", info("act", "statute", "2024", "1", "fin@?a=b")),
    # decoding comes before matching
    ("/akn/fi/act/statute/2024%2F1/fin%40", info("act", "statute", "2024", "1", "fin@")),
    ("/akn/fi/act/a+b%zz%/2024/1/fin@", info("act", "a+b%zz%", "2024", "1", "fin@")),
    ("/akn/fi/act/%ff/2024/%C3%A4/fin@", info("act", "�", "2024", "ä", "fin@")),
    # no authority: the plain form
    (
        "/akn/fi/doc/authority-regulation/1996/32082/fin@",
        info("doc", "authority-regulation", "1996", "32082", "fin@"),
    ),
    # nothing is trimmed
    ("/akn/fi/act/statute/2024/1/fin@ \n", info("act", "statute", "2024", "1", "fin@ \n")),
    (" /akn/fi/act/statute/2024/1/fin@", None),
    ("/akn/fi/act/statute/2024/1/fin@/", None),
    ("/akn/fi/act/statute/20x4/1/fin@", None),
    ("/akn/fi/law/statute/2024/1/fin@", None),
    ("/akn/fi/act//2024/1/fin@", None),
    # blanks inside a URL vanish, other digits are digits
    (HOST + "/akn/fi/act/stat\nute/2024/1/fin@\t", info("act", "statute", "2024", "1", "fin@")),
    ("/akn/fi/act/statute/٢٠٢٤/1/fin@", info("act", "statute", "٢٠٢٤", "1", "fin@")),
]


def test_cases(spark):
    assert parse_all(spark, [uri for uri, _ in CASES]) == [want for _, want in CASES]


def test_sql_functions_agree(spark):
    U.register_sql_functions(spark, BASE)
    frame = spark.createDataFrame([(uri,) for uri, _ in CASES], "uri string")
    frame = frame.withColumn("i", U.parse_uri(F.col("uri"), BASE))
    both = frame.select(
        F.expr("akn_parse(uri)").eqNullSafe(F.col("i")).alias("a"),
        F.expr("akn_path(uri)").eqNullSafe(U.normalise_path(F.col("uri"), BASE)).alias("b"),
        F.expr("akn_folder(akn_parse(uri))").eqNullSafe(U.folder_path(F.col("i"))).alias("c"),
        F.expr("akn_api_path(akn_parse(uri))").eqNullSafe(U.api_path(F.col("i"))).alias("d"),
    )
    assert {tuple(row) for row in both.collect()} == {(True, True, True, True)}


PATHS = [
    (("judgment", "kho", "", "2011", "T640", "fin@"), "judgment/kho/2011/T640/fin@"),
    (("judgment", "kho", None, "2011", "T640", "fin@"), "judgment/kho/2011/T640/fin@"),
    (
        ("doc", "authority-regulation", "harbours", "2009", "A-17", "swe@"),
        "doc/authority-regulation/harbours/2009/A-17/swe@",
    ),
]


def test_paths_of_components(spark):
    fields = "category string, document_type string, authority string, year string, number string, lang_and_version string"
    frame = spark.createDataFrame([parts for parts, _ in PATHS], fields).select(F.struct("*").alias("i"))
    got = frame.select(U.folder_path(F.col("i")), U.api_path(F.col("i"))).collect()
    assert [tuple(row) for row in got] == [(path, "/akn/fi/" + path) for _, path in PATHS]


def test_document_info_columns_agree_with_components(spark):
    frame = spark.createDataFrame([(uri,) for uri, _ in CASES], "akn_uri string")
    out = S.with_document_info(frame, BASE).withColumn("f", U.folder_path(F.col("info")))
    assert out.where(~F.col("f").eqNullSafe(F.col("folder_path"))).count() == 0
    years = {row.akn_uri: row.year_int for row in out.collect()}
    assert years["/akn/fi/act/statute-sami/2016/1501/sme%40"] == 2016
    assert years["/akn/fi/doc/treaty/1987"] is None


def python_key(uri):
    if uri.startswith("http"):
        path = unquote(urlparse(uri).path).rsplit(BASE, 1)[-1]
    else:
        path = unquote(uri)
    part = path.split("/")
    if part[:3] != ["", "akn", "fi"] or any(p == "" for p in part[3:]):
        return None
    rest = part[3:]
    shift = len(rest) == 6
    if len(rest) not in (5, 6) or (shift and rest[:2] != ["doc", "authority-regulation"]):
        return None
    if rest[0] not in ("act", "judgment", "doc") or not re.fullmatch(r"\d+", rest[2 + shift]):
        return None
    return str(PurePosixPath(*rest))


SEGMENT = st.text(alphabet="aB1ä%4520/;?#+.@ =\n-", min_size=0, max_size=6)


@settings(max_examples=3, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["", HOST, HOST, "http://h", "https://h;p/q;r"]),
            st.sampled_from(["act", "judgment", "doc", "doc/authority-regulation", "law"]),
            st.lists(SEGMENT, min_size=0, max_size=2),
            st.sampled_from(["2024", "1999", "x", "%32%30"]),
            SEGMENT,
            st.one_of(st.just("fin@"), SEGMENT),
        ),
        min_size=200,
        max_size=300,
    )
)
def test_folders_as_python_would_make_them(spark, parts):
    uris = ["/".join([f"{head}/akn/fi/{kind}", *middle, year, number, tail]) for head, kind, middle, year, number, tail in parts]
    frame = spark.createDataFrame([(uri,) for uri in uris], "uri string")
    got = [row[0] for row in frame.select(U.key_folder(U.document_key(F.col("uri"), BASE))).collect()]
    assert got == [python_key(uri) for uri in uris]
    # the SQL functions repeat the rules as text: they must agree on any input
    U.register_sql_functions(spark, BASE)
    same = F.expr("akn_folder(akn_parse(uri))").eqNullSafe(U.folder_path(U.parse_uri(F.col("uri"), BASE)))
    assert frame.where(~same).count() == 0


@pytest.mark.parametrize(
    "link, name",
    [
        ("media/1.gif", "1.gif"),
        ("media/a/x.gif", "x.gif"),
        ("media/", "media"),
        ("media/.", "media"),
        ("media/..", ".."),
        ("media/a/./", "a"),
        ("media//b.png", "b.png"),
    ],
)
def test_media_basename(spark, link, name):
    assert PurePosixPath(link).name == name
    assert spark.range(1).select(U.media_basename(F.lit(link))).first()[0] == name


def test_lang_version(spark):
    markers = ["fin@", "swe@", "fin@20230525", "fin", "@", None, "fin@2023x", "fin@20231399"]
    frame = spark.createDataFrame([(n, m) for n, m in enumerate(markers)], "n int, m string")
    got = [tuple(row.v) for row in frame.select(U.lang_version(F.col("m")).alias("v"), "n").orderBy("n").collect()]
    day = spark.sql("SELECT DATE'2023-05-25'").first()[0]
    assert got == [
        ("fin", None, None),
        ("swe", None, None),
        ("fin", "20230525", day),
        ("fin", None, None),
        (None, None, None),
        (None, None, None),
        ("fin", "2023x", None),
        ("fin", "20231399", None),
    ]


def test_request_url_has_one_slash(spark):
    urls = spark.range(1).select(
        U.request_url("https://h/v1", F.lit("/akn/x")), U.request_url("https://h/v1", F.lit("akn/x"))
    )
    assert tuple(urls.first()) == ("https://h/v1/akn/x", "https://h/v1/akn/x")
