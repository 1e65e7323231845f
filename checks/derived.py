"""Landing-zone tables derived from the driver tables.

The driver tables hold no listings, attempts or documents, so these statements
build them, each over whole driver tables. The text runs unchanged in Spark and
DuckDB; `{orders}` and the like stand for the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lawgrain.session import scratch_dir

BASE_PATH = "/open/data/v1"
BASE_URL = "https://data.example.org" + BASE_PATH
CURRENT_YEAR = 2001


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def category_sql(k: str) -> str:
    return f"CASE {k} % 4 WHEN 0 THEN 'act' WHEN 1 THEN 'judgment' ELSE 'doc' END"


def type_sql(k: str) -> str:
    return (
        f"CASE {k} % 4 WHEN 0 THEN 'statute' WHEN 1 THEN 'kko' WHEN 2 THEN 'treaty' "
        "ELSE 'authority-regulation' END"
    )


def valid_sql(k: str) -> str:
    """Whether document k has a URI that can be parsed; only such are ever requested."""
    return f"(({uri_sql(k)}) LIKE '%/akn/fi/%')"


def folder_sql(k: str) -> str:
    """Folder of document k, from its key alone."""
    return (
        f"({category_sql(k)}) || '/' || ({type_sql(k)}) || "
        f"(CASE WHEN {k} % 4 = 3 THEN '/agency+' || {_text(f'{k} % 25')} ELSE '' END)"
        f" || '/' || {_text(f'1995 + {k} % 7')} || '/' || {_text(k)}"
        f" || (CASE WHEN {k} % 13 = 0 THEN 'ä' ELSE '' END) || '/' || {lang_sql(k)}"
    )


def lang_sql(k: str) -> str:
    return f"(CASE {k} % 6 WHEN 2 THEN 'swe@' WHEN 5 THEN 'fin@20230525' ELSE 'fin@' END)"


def uri_sql(k: str) -> str:
    """URI of document k: URL or bare path, plain or encoded, with trailing parts."""
    return (
        f"CASE WHEN {k} % 101 = 0 THEN '' WHEN {k} % 17 = 0 THEN '/invalid/' || {_text(k)} ELSE "
        f"(CASE WHEN {k} % 5 = 0 THEN '' ELSE '{BASE_URL}' END) || '/akn/fi/' || "
        f"({category_sql(k)}) || '/' || ({type_sql(k)}) || "
        f"(CASE WHEN {k} % 4 = 3 THEN '/agency+' || {_text(f'{k} % 25')} ELSE '' END)"
        f" || '/' || {_text(f'1995 + {k} % 7')} || '/' || {_text(k)}"
        f" || (CASE WHEN {k} % 13 = 0 THEN '%C3%A4' ELSE '' END) || '/'"
        f" || (CASE WHEN {k} % 2 = 0 THEN {lang_sql(k)} ELSE replace({lang_sql(k)}, '@', '%40') END)"
        f" || (CASE {k} % 5 WHEN 1 THEN '?ref=x#top' WHEN 2 THEN ';v=2' WHEN 3 THEN '#s1' ELSE '' END) END"
    )


# Listing: every order is a listed document; urgent ones are listed twice.
LISTING = f"""
WITH base AS (
  SELECT o_orderkey AS k, o_orderkey AS item_no, o_orderstatus, o_orderdate FROM {{orders}}
  UNION ALL
  SELECT o_orderkey, o_orderkey + 1000000000, o_orderstatus, o_orderdate
  FROM {{orders}} WHERE o_orderpriority = '1-URGENT'
)
SELECT item_no, {category_sql('k')} AS category, {type_sql('k')} AS document_type,
  {uri_sql('k')} AS akn_uri,
  CASE WHEN o_orderstatus = 'F' THEN 'NEW' ELSE 'MODIFIED' END AS status,
  CAST(o_orderdate AS DATE) AS date_issued, o_orderdate AS modified
FROM base
"""

# Completed by an earlier run: the orders that are finished.
COMPLETED = f"""
SELECT DISTINCT {uri_sql('o_orderkey')} AS akn_uri
FROM {{orders}} WHERE o_orderstatus = 'F' AND {valid_sql('o_orderkey')}
"""

# In store already: the orders of high priority.
INVENTORY = f"""
SELECT {folder_sql('o_orderkey')} AS folder_path
FROM {{orders}} WHERE o_orderpriority = '2-HIGH' AND {valid_sql('o_orderkey')}
"""

# Attempt log: every line item is an HTTP attempt for its order's document; a later run
# has asked for every fifth document again.
ATTEMPTS = f"""
WITH a AS (
  SELECT l_orderkey AS k,
    CASE WHEN l_linenumber <= 3 THEN 'xml' WHEN l_linenumber = 4 THEN 'pdf'
         WHEN l_linenumber = 5 THEN 'zip' ELSE 'media' END AS kind,
    CASE WHEN l_linenumber > 5 THEN 'media/' || CASE WHEN l_linenumber = 6 THEN 'a/' ELSE '' END
         || {_text('l_suppkey % 20')} || '.gif' END AS link,
    l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice, CAST(l_quantity AS BIGINT) AS q
  FROM {{lineitem}})
SELECT * FROM (
  SELECT 'run-1' AS run_id, {uri_sql('k')} AS akn_uri, kind, link,
    CAST(row_number() OVER (PARTITION BY k, kind, link
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_extendedprice, q) AS BIGINT) AS attempt,
    CASE q % 10 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN 429 WHEN 3 THEN NULL ELSE 200 END AS http_status,
    CASE WHEN q % 10 = 3 THEN 'read timed out' END AS exception,
    l_shipdate AS start_ts, l_shipdate + INTERVAL '2' SECOND AS end_ts
  FROM a WHERE {valid_sql('k')}
  UNION ALL
  SELECT 'run-2', {uri_sql('k')}, kind, link,
    CAST(row_number() OVER (PARTITION BY k, kind, link
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_extendedprice, q) AS BIGINT),
    CASE WHEN q % 3 = 0 THEN 503 ELSE 200 END, NULL,
    l_shipdate + INTERVAL '400' DAY, l_shipdate + INTERVAL '400' DAY + INTERVAL '2' SECOND
  FROM a WHERE k % 5 = 2 AND {valid_sql('k')}
) runs
"""

# List page log: every customer is an answered page of one of 25 streams.
PAGE_LOG = """
SELECT c_custkey % 25 AS stream_id,
  CAST((c_custkey - c_custkey % 25) / 25 AS BIGINT) + 1 AS page,
  CASE WHEN c_custkey % 97 = 13 THEN 500 ELSE 200 END AS http_status,
  c_custkey % 113 <> 5 AS json_ok,
  CASE WHEN c_custkey % 59 = 3 THEN 0 WHEN c_custkey % 41 = 7 THEN 4 ELSE 10 END AS n_items
FROM {customer}
"""

# Request log: every event is a request of its user's client.
REQUEST_LOG = """
SELECT event_id AS request_id, user_id AS client_id, ts AS start_ts, ts + INTERVAL '1' SECOND AS end_ts
FROM {events}
"""

# Manifest history: every order is an entry, a customer's orders share a URI.
MANIFEST = """
SELECT o_orderkey AS item_no,
  '/akn/fi/act/statute/' || CAST(year(o_orderdate) AS STRING) || '/' || CAST(o_custkey AS STRING) || '/fin@' AS akn_uri,
  CASE o_orderkey % 7 WHEN 0 THEN 'error' WHEN 1 THEN 'skipped' WHEN 2 THEN 'dry-run' ELSE 'success' END AS status,
  o_orderdate AS timestamp,
  CASE WHEN o_orderkey % 7 = 0 THEN 'HTTP 500 fetching XML' END AS error
FROM {orders}
"""


def _escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


# Documents: the whole text of every document inside an Akoma Ntoso frame.
XML_CORPUS = f"""
SELECT doc_id, lang,
  '/akn/fi/act/statute/' || {_text('2015 + doc_id % 8')} || '/' || {_text('doc_id')} || '/fin@' AS akn_uri,
  '<akomaNtoso xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0" xmlns:f="urn:f"><act><meta><identification>'
  || '<FRBRWork><FRBRthis value="/akn/w/' || {_text('doc_id')} || '/!main"/><FRBRuri value="/akn/w/' || {_text('doc_id')}
  || '"/><FRBRalias name="other" value="none"/><FRBRalias name="eli" value="urn:eli:' || {_text('doc_id')} || '"/>'
  || '<FRBRdate date="2024-0' || {_text('1 + doc_id % 9')} || '-15" name="dateIssued"/>'
  || '<FRBRdate date="2024-1' || {_text('doc_id % 3')} || '-20" name="datePublished"/>'
  || '<FRBRsubtype value="statute"/><FRBRnumber value="' || {_text('doc_id')} || '"/></FRBRWork>'
  || '<FRBRExpression><FRBRthis value="/akn/e/' || {_text('doc_id')} || '"/><FRBRlanguage language="' || lang
  || '"/></FRBRExpression><FRBRManifestation><FRBRuri value="/akn/m/' || {_text('doc_id')}
  || '.akn"/></FRBRManifestation></identification><proprietary><f:documentYear>' || {_text('2015 + doc_id % 8')}
  || '</f:documentYear></proprietary></meta><body><p>' || {_escaped('text')} || '</p>'
  || (CASE WHEN lang IN ('en', 'fr') THEN '<img src="media/' || {_text('doc_id % 7')} || '.gif"/><img src="media/'
      || {_text('doc_id % 7')} || '.gif"/>' ELSE '' END)
  || '<f:img src="media/foreign.gif"/><img src="http://x.example.org/y.gif"/>'
  || (CASE WHEN doc_id % 2 = 0 THEN '<attachment href="media/a/' || {_text('doc_id % 5')}
      || '.pdf"><p><ref href="media/b/' || {_text('doc_id % 5')} || '.pdf">r</ref></p></attachment>' ELSE '' END)
  || '<ref href="/akn/fi/act/statute/2020/' || {_text('doc_id')} || '">r</ref></body></act>'
  || (CASE WHEN doc_id % 11 = 0 THEN '' ELSE '</akomaNtoso>' END) AS xml
FROM {{documents}}
"""

# Name of each derived table: its statement and the driver tables it reads.
STATEMENTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "listing": (LISTING, ("orders",)),
    "completed": (COMPLETED, ("orders",)),
    "inventory": (INVENTORY, ("orders",)),
    "attempts": (ATTEMPTS, ("lineitem",)),
    "page_log": (PAGE_LOG, ("customer",)),
    "request_log": (REQUEST_LOG, ("events",)),
    "manifest": (MANIFEST, ("orders",)),
    "xml_corpus": (XML_CORPUS, ("documents",)),
}


# Stored tables of this process, by application, table folder and name.
_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}

# Key by which the rows of a driver table are dealt to tasks.
_DEALT_BY = {
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "customer": "c_custkey",
    "events": "event_id",
    "documents": "doc_id",
}

# Columns a stored table is partitioned by.
_PARTITIONED = {"listing": ("category", "document_type")}


def table_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a derived table, from the driver tables.

    One driver file would be one task. Its rows are dealt out before the statement makes
    long URIs of their short keys, by the key its windows group by, so they move once.
    """
    statement, sources = STATEMENTS[name]
    inputs = {
        source: spark.read.parquet(f"{sf_dir}/{source}.parquet").repartition(_DEALT_BY[source]) for source in sources
    }
    return spark.sql(statement, **inputs)


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, stored once per session in the shared folder.

    The operators read stored tables in practice, so they do here.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = scratch_dir(spark, name)
        table = table_of(spark, sf_dir, name)
        writer = table.write
        if name in _PARTITIONED:
            writer = writer.partitionBy(*_PARTITIONED[name])
        writer.parquet(path)
        _STORED[key] = path, table.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def write_files(files: DataFrame, root: str) -> None:
    """A file for each row: `text` in `<root>/<folder>/`, named by the row's task and place.

    Written by the tasks themselves: Spark's sinks open a writer and, on a local disk, start
    two processes for each folder to set the modes of its file. A task that is repeated
    writes the same files.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(root) if ":" in root.split("/", 1)[0] else (fs.LocalFileSystem(), root)
        task, row = TaskContext.get().partitionId(), 0
        for frame in frames:
            for folder, text in zip(frame["folder"], frame["text"]):
                store.create_dir(f"{base}/{folder}")
                with store.open_output_stream(f"{base}/{folder}/part-{task}-{row}.txt") as out:
                    out.write(text.encode())
                row += 1
            yield pd.DataFrame({"n": [len(frame)]})

    files.select("folder", "text").mapInPandas(write, "n BIGINT").agg({"n": "sum"}).collect()


def ctes(*names: str) -> str:
    """Derived tables as a DuckDB WITH list."""
    parts = []
    for name in names:
        statement, sources = STATEMENTS[name]
        parts.append(f"{name} AS ({statement.format(**{source: source for source in sources})})")
    return "WITH " + ",\n".join(parts)
