"""Media links of a corpus, the files they ask for, and document metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lawgrain.functions import uri as U
from lawgrain.functions import xml as X
from lawgrain.params import CrawlParams


def with_media_links(corpus: DataFrame, xml: str = "xml", is_text: bool = True) -> DataFrame:
    """Corpus with its `media_links` array; the XML column is dropped.

    The only step whose rows leave the JVM, in Arrow batches.
    """
    return corpus.withColumn("media_links", X.media_links(F.col(xml), is_text=is_text)).drop(xml)


def media_link_rows(corpus: DataFrame, xml: str = "xml", is_text: bool = True) -> DataFrame:
    """One row per document and distinct media link."""
    linked = with_media_links(corpus, xml, is_text)
    return linked.withColumn("link", F.explode("media_links")).drop("media_links")


def media_asset_rows(linked: DataFrame, params: CrawlParams) -> DataFrame:
    """One row per media link with the file it is stored as.

    `linked` has `folder_path` and `media_links`. A document without links
    keeps one row with NULLs.
    """
    exploded = linked.withColumn("link", F.explode_outer("media_links")).drop("media_links")
    name = U.media_basename(F.col("link"))
    return exploded.withColumn("basename", name).withColumn(
        "file_path",
        F.when(
            F.col("link").isNotNull(),
            F.concat(F.lit(f"{params.output_dir}/"), "folder_path", F.lit("/media/"), "basename"),
        ),
    )


def media_collisions(links: DataFrame, document: str = "doc_id") -> DataFrame:
    """File names that two or more links of one document would be stored under.

    Links are distinct per document, so a document's rows number at most its
    links; the count combines on the map side.
    """
    named = links.where(F.col("link").isNotNull()).withColumn("basename", U.media_basename(F.col("link")))
    return named.groupBy(document, "basename").agg(F.count("*").alias("n_links")).where("n_links > 1")


def frbr_metadata(corpus: DataFrame, xml: str = "xml") -> DataFrame:
    """Bibliographic columns of each document; NULL for malformed XML.

    Each document is parsed once: the struct is a column of its own and the
    fields are read from it.
    """
    rest = [name for name in corpus.columns if name != xml]
    parsed = corpus.select(*rest, X.parsed_document(F.col(xml)).alias("_document"))
    fields = X.frbr_fields(F.col("_document"))
    return parsed.select(*rest, *[column.alias(name) for name, column in fields.items()])
