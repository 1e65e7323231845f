"""Connected components of a link table, and selection of whole rows by content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawgrain.session import staged


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the component's least node.

    Alternating large-star and small-star steps, each a grouped minimum joined back to
    the links: no neighbourhood is ever gathered. Every round is written to the shared
    folder, which cuts the lineage. A graph of n nodes needs about log(n) squared
    rounds at most; running out of rounds is an error.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links",
    )
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
        large = (
            both.join(least, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = staged(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if after == before:
            roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            return roots.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        before = after
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def rows_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of `docs` named by `chosen` (doc_id, text_hash, n_rows), one for each name.

    The name of a row is its id (NULL included) and its text's hash; `n_rows` says how
    many rows of `docs` have that name. Of several, one stays, and which is undefined.
    """
    names = docs.columns
    packed = docs.select(
        F.struct(*[docs[c] for c in names]).alias("row"),
        docs[id_col].alias("doc_id"),
        F.xxhash64(docs[text_col]).alias("text_hash"),
    )
    wanted = chosen.select(
        F.col("doc_id").alias("want_id"), F.col("text_hash").alias("want_hash"), F.col("n_rows").alias("n_rows")
    )
    found = packed.join(wanted, F.expr("doc_id <=> want_id AND text_hash = want_hash"))
    single = found.where("n_rows = 1").select("row.*")
    several = found.where("n_rows > 1").groupBy("doc_id", "text_hash").agg(F.first("row").alias("row"))
    return single.unionByName(several.select("row.*"))
