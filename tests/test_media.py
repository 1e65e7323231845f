"""Media links and metadata of documents."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lawgrain.functions import xml as X
from lawgrain.operators import media as M
from lawgrain.params import CrawlParams

NS = "http://docs.oasis-open.org/legaldocml/ns/akn/3.0"


def akn(body, head='<?xml version="1.0"?>'):
    return f'{head}<akomaNtoso xmlns="{NS}" xmlns:f="urn:f"><act><body>{body}</body></act></akomaNtoso>'


CASES = [
    # what is not well-formed has no links, and nothing is an error
    (None, []),
    ("", []),
    ("<act media/q.png", []),
    ("plain text that names media/q.png", []),
    (akn("<p>media/q.png</p>"), []),
    # each link once: images, then attachments, then references
    (akn('<ref href="media/t/7.pdf">t</ref><img src="media/k.svg"/><ref href="media/t/7.pdf">u</ref>'), ["media/k.svg", "media/t/7.pdf"]),
    (akn('<p><attachment href="media/z-1.xls"/></p><img src="media/k.svg"/>'), ["media/k.svg", "media/z-1.xls"]),
    # only links into the media folder
    (akn('<img src="/media/k.svg"/><ref href="akn/fi/act">r</ref><img src="Media/k.svg"/><img src="media/"/>'), ["media/"]),
    # only elements of the document namespace, whatever their prefix
    (akn('<f:img src="media/foreign.gif"/>'), []),
    ('<a><img src="media/none.gif"/></a>', []),
    (f'<a:x xmlns:a="{NS}"><a:img src="media/p.gif"/></a:x>', ["media/p.gif"]),
    # an attachment counts with everything below it, also foreign elements
    (akn('<attachment><p><f:q href="media/in.pdf"/></p></attachment><p href="media/out.pdf"/>'), ["media/in.pdf"]),
    # other attributes do not count, nor do other elements
    (akn('<img href="media/1.gif"/><ref src="media/2.gif"/><a href="media/3.gif"/>'), []),
    # the prefix may be written in character references or come from an entity
    (akn('<img src="&#109;edia/c.gif"/>'), ["media/c.gif"]),
    (akn('<img src="&m;/e.gif"/>', '<!DOCTYPE akomaNtoso [<!ENTITY m "med&#105;a">]>'), ["media/e.gif"]),
    (akn('<img src="&m;ia/e.gif"/>', '<!DOCTYPE akomaNtoso [<!ENTITY m "med">]>'), ["media/e.gif"]),
    (akn('<img src="media/b.gif"/><img src="media/a.gif"/>') + "<", []),
    (akn('<img src="media/ä&amp;b.gif"/>'), ["media/ä&b.gif"]),
]


def test_media_links(spark):
    frame = spark.createDataFrame([(n, xml) for n, (xml, _) in enumerate(CASES)], "n int, xml string")
    got = frame.select("n", X.media_links(F.col("xml")).alias("l")).orderBy("n").collect()
    assert [row.l for row in got] == [want for _, want in CASES]


def test_media_links_of_bytes_in_their_own_encoding(spark):
    text = akn('<img src="media/ä.gif"/>', '<?xml version="1.0" encoding="ISO-8859-1"?>')
    frame = spark.createDataFrame([(bytearray(text.encode("latin-1")),), (bytearray(text.encode("utf-16")[:9]),)], "xml binary")
    got = frame.select(X.media_links(F.col("xml"), is_text=False).alias("l")).collect()
    assert [row.l for row in got] == [["media/ä.gif"], []]


def test_asset_rows_and_collisions(spark):
    corpus = spark.createDataFrame(
        [
            (1, "act/statute/2024/1/fin@", akn('<img src="media/a/x.gif"/><img src="media/b/x.gif"/><img src="media/y.gif"/>')),
            (2, "act/statute/2024/2/fin@", akn("")),
        ],
        "doc_id long, folder_path string, xml string",
    )
    params = CrawlParams(base_path="/v1", current_year=2024, output_dir="out")
    rows = M.media_asset_rows(M.with_media_links(corpus), params).orderBy("doc_id", "link").collect()
    folder = "out/act/statute/2024/1/fin@/media/"
    assert [(r.doc_id, r.link, r.file_path) for r in rows] == [
        (1, "media/a/x.gif", folder + "x.gif"),
        (1, "media/b/x.gif", folder + "x.gif"),
        (1, "media/y.gif", folder + "y.gif"),
        (2, None, None),
    ]
    assert [tuple(r) for r in M.media_collisions(M.media_link_rows(corpus)).collect()] == [(1, "x.gif", 2)]


def frbr(kind, extra=""):
    return f"""<akomaNtoso xmlns="{NS}" xmlns:s="urn:s"><{kind} name="main"><meta><identification source="#o">
      <FRBRWork><FRBRthis value="/w/!main"/><FRBRuri value="/w"/>
        <FRBRalias name="x" value="no"/><FRBRalias name="eli" value="eli:w"/>
        <FRBRdate date="2026-01-15" name="dateIssued"/><FRBRdate date="2026-01-16" name="datePublished"/>
        <FRBRsubtype value="statute"/><FRBRnumber value="3"/></FRBRWork>
      <FRBRExpression><FRBRthis value="/e/!main"/><FRBRuri value="/e"/><FRBRalias name="eli" value="eli:e"/>
        <FRBRdate date="2026-01-15" name="dateIssued"/><FRBRlanguage language="fin"/></FRBRExpression>
      <FRBRManifestation><FRBRthis value="/m"/><FRBRuri value="/m.akn"/><FRBRalias name="eli" value="eli:m"/></FRBRManifestation>
      </identification><proprietary source="#o"><s:documentYear>2026</s:documentYear></proprietary></meta>
      <body><p>text <b>bold</b> tail</p>{extra}</body></{kind}></akomaNtoso>"""


@pytest.mark.parametrize("kind", ["act", "judgment", "doc"])
def test_frbr_metadata(spark, kind):
    corpus = spark.createDataFrame(
        [(1, frbr(kind)), (2, frbr(kind)[:-5]), (3, ""), (4, akn(""))], "doc_id long, xml string"
    )
    got = {r.doc_id: r.asDict() for r in M.frbr_metadata(corpus).collect()}
    first = got[1]
    assert (first["work_this"], first["work_uri"], first["work_eli"]) == ("/w/!main", "/w", "eli:w")
    assert (first["expression_uri"], first["expression_eli"]) == ("/e", "eli:e")
    assert (first["manifestation_uri"], first["manifestation_eli"]) == ("/m.akn", "eli:m")
    assert str(first["date_issued"]) == "2026-01-15" and str(first["date_published"]) == "2026-01-16"
    assert (first["subtype"], first["number"], first["language"], first["document_year"]) == ("statute", "3", "fin", 2026)
    for doc_id in (2, 3, 4):
        assert set(v for k, v in got[doc_id].items() if k != "doc_id") == {None}


def tree_links(document):
    """The same links from a whole tree."""
    from xml.etree import ElementTree

    akn = "{http://docs.oasis-open.org/legaldocml/ns/akn/3.0}"
    try:
        root = ElementTree.fromstring(document)
    except (ElementTree.ParseError, ValueError, LookupError):
        return []
    found = {e.get("src") for e in root.iter(f"{akn}img")} | {e.get("href") for e in root.iter(f"{akn}ref")}
    for attachment in root.iter(f"{akn}attachment"):
        found |= {e.get("href") for e in attachment.iter()}
    return sorted(found - {None})


AKN = 'xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0"'


@pytest.mark.parametrize(
    "document",
    [
        f'<a {AKN} xmlns:f="urn:f"><img src="media/1"/><f:img src="media/2"/><img xmlns="" src="media/3"/><img f:src="media/4"/></a>',
        f'<a {AKN}><attachment href="x"><p href="y"><attachment href="z"/></p><img href="w" src="media/v"/></attachment><p href="no"/></a>',
        f'<k:a xmlns:k="{AKN[7:-1]}"><k:ref href="media/&#x61;&amp;b"/><ref href="no"/></k:a>',
        f'<a {AKN}><ref href="media/é"/></a>',
        f'<?xml version="1.0" encoding="ISO-8859-1"?><a {AKN}><ref href="media/é"/></a>',
        f'<!DOCTYPE a [<!ENTITY m "media/m">]><a {AKN}><ref href="&m;.gif"/>&m;</a>',
        f'<!DOCTYPE a SYSTEM "x.dtd"><a {AKN}><ref href="media/1"/>&unknown;</a>',
        f'<a {AKN}><ref href="media/1"/>&unknown;</a>',
        f'<a {AKN}><ref href="media/1"/>',
        f'<a {AKN}><ref href="media/1"/></a><b/>',
        f'<a {AKN}><ref href="media/1"/></a>\0',
        "",
        " ",
        "no xml",
    ],
)
def test_links_are_those_of_a_tree(document, monkeypatch):
    raw = document.encode()
    want = tree_links(document)
    assert X.document_links(memoryview(raw)) == want
    monkeypatch.setattr(X, "PARSE_BYTES", 3)
    assert X.document_links(memoryview(raw)) == want
    assert X.document_links(memoryview(raw), None) == tree_links(raw)


def test_links_of_a_sliced_column():
    rows = [None, f'<a {AKN}><img src="1"/></a>', "", f'<a {AKN}><img src="2"/></a>', None]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(rows, kind)
        assert X._link_array(column).to_pylist() == [[], ["1"], [], ["2"], []]
        assert X._link_array(column.slice(2, 2)).to_pylist() == [[], ["2"]]
    binary = pa.array([f'<?xml version="1.0" encoding="ISO-8859-1"?><a {AKN}><img src="é"/></a>'.encode("latin-1")])
    assert X._link_array(binary).to_pylist() == [["é"]]


def test_a_document_of_200_mb_takes_little_memory():
    """No tree and no copy: what Python allocates stays far below the document."""
    part = b"<p>text <i>of a</i> paragraph</p><img src='media/%d.gif'/>" * 1000
    body = b"".join(part.replace(b"%d", b"%d" % n) for n in range(3600))
    document = f"<a {AKN}>".encode() + body + b"</a>"
    del body
    assert len(document) > 200_000_000
    column = pa.array([document], pa.binary())
    view = memoryview(column.buffers()[2])
    tracemalloc.start()
    found = X.document_links(view)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == sorted(f"media/{n}.gif" for n in range(3600))
    assert peak < 100_000_000
