"""Ranked lexical search without an index: an automaton of the items' terms reads the texts.

Terms are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased. All separators
of a text become line feeds, and the Aho-Corasick automaton holds each term of the items
between two line feeds. These guards keep a term from matching inside a longer one, and as
matches may overlap, neighbours share theirs.

The texts are read twice. The first pass counts documents, their terms and each item
term's documents; the second counts again, scores every document for every item it has a
term of, and keeps each item's best. Nothing is stored between them and no list of
documents is kept for a term; a task sends `top` rows an item. Outputs of the automaton map
to items by one sorted array; a batch's scores are sums over (document, item) cells, taken
`CELLS` at a time.

The items are broadcast in blocks of at most `block_bytes` of text (or one item), each with
an automaton, and a block costs two passes over the texts. One block holds a benchmark of
some 100,000 items.

Defined results: a NULL text, or one without terms, has no terms and does not count as a
document; an item without terms, or whose terms no document has, gives no rows; repeated
rows are documents of their own under one id, also in the ranking; equal scores go by
ascending doc_id (NULL last; of equal ids any order, the rows being equal); items with the
same id are one item with the terms of all; ids may have any type that can be sorted; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lawgrain.session import staged

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GUARD = 10
# Term bytes lower-cased, all others the guard.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else _GUARD for b in range(256)
)
# Bytes the automaton reads at once; (document, item) cells that are summed at once.
WINDOW = 1 << 20
CELLS = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, term)."""
    folded = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    words = F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))
    return items.select(F.col(id_col).alias("item_id"), F.explode(words).alias("term")).distinct()


class Block:
    """Some items: their distinct terms and, for each, the items that have it."""

    def __init__(self, rows: list[tuple]):
        self.items = list(dict.fromkeys(item for item, _ in rows))
        self.terms = sorted({term for _, term in rows})
        place = {item: i for i, item in enumerate(self.items)}
        number = {term: i for i, term in enumerate(self.terms)}
        pairs = sorted((number[term], place[item]) for item, term in rows)
        self.item = np.array([i for _, i in pairs], np.int64)
        # items of term t: first[t] up to first[t + 1]
        self.first = np.searchsorted(np.array([t for t, _ in pairs]), np.arange(len(self.terms) + 1))

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Bytes stand for themselves as characters, so every text is one byte a character.

        Built once a worker process, which keeps a broadcast block over its tasks.
        """
        built = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            built.add_word(f"\n{term.encode().decode('latin-1')}\n", number)
        built.make_automaton()
        return built


def term_counts(text: str, automaton: ahocorasick.Automaton) -> tuple[int, np.ndarray, np.ndarray]:
    """Terms of a text with repeats; numbers of the item terms it has, and their counts."""
    data = text.encode().translate(_FOLD)
    folded = np.frombuffer(data, np.uint8) != _GUARD
    n = int(np.count_nonzero(folded[1:] & ~folded[:-1]) + folded[:1].sum())
    found: list[int] = []
    at = 0
    while at < len(data):
        to = data.find(b"\n", at + WINDOW)  # windows end between terms
        to = len(data) if to < 0 else to
        found += [t for _, t in automaton.iter(f"\n{data[at:to].decode('latin-1')}\n")]
        at = to
    numbers, counts = np.unique(np.array(found, np.int64), return_counts=True)
    return n, numbers, counts


def _statistics(texts: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """N, L and the documents of each term of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton
        having = np.zeros(len(shared.value.terms), np.int64)
        documents = total = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    n, numbers, _ = term_counts(text, automaton)
                    documents, total = documents + (n > 0), total + n
                    having[numbers] += 1
        # two more sums behind those of the terms
        sums = np.append(having, [documents, total])
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["number", "n"])

    counted = texts.select("text").mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
    sums = np.zeros(len(shared.value.terms) + 2, np.int64)
    for number, n in counted.collect():  # a row for each term of the block
        sums[number] = n
    return int(sums[-2]), int(sums[-1]), sums[:-2]


class Best:
    """The `top` best documents of each item so far."""

    def __init__(self, items: int, top: int, kind: pa.DataType):
        self.top, self.least = top, np.zeros(items)
        self.schema = pa.schema([("item", pa.int64()), ("doc_id", kind), ("score", pa.int64())])
        self.rows = self.schema.empty_table()

    def add(self, item: np.ndarray, ids: pa.Array, score: np.ndarray) -> None:
        new = pa.table([pa.array(item), ids, pa.array(score.astype(np.int64))], schema=self.schema)
        rows = pa.concat_tables([self.rows, new])
        order = pc.sort_indices(
            rows, [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_end"
        )
        rows = rows.take(order)
        items = rows.column("item").to_numpy()
        rank = np.arange(len(items)) - np.searchsorted(items, items)
        self.rows = rows.filter(pa.array(rank < self.top))
        full = rows.filter(pa.array(rank == self.top - 1))
        self.least[full.column("item").to_numpy()] = full.column("score").to_numpy()


def _ranked(texts: DataFrame, shared, weights: np.ndarray, documents: int, total: int, top: int) -> DataFrame:
    """Each task's best documents of a block's items: item (its place), doc_id, score."""
    kind = to_arrow_type(texts.schema["doc_id"].dataType)
    schema = T.StructType(
        [T.StructField("item", T.LongType()), T.StructField("doc_id", texts.schema["doc_id"].dataType), T.StructField("score", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        automaton = block.automaton
        items = len(block.items)
        best = Best(items, top, kind)
        group = max(1, CELLS // items)
        for batch in batches:
            ids = batch.column("doc_id").cast(kind)
            at: list[int] = []
            cells = np.zeros(0)

            def score(text: str) -> np.ndarray | None:
                n, numbers, counts = term_counts(text, automaton)
                worth = weights[numbers] > 0
                numbers, counts = numbers[worth], counts[worth]
                if not len(numbers):
                    return None
                m = 10 + (90 * n * documents) // total
                part = weights[numbers] * (1_000_000_000 * counts // (1000 * counts + 8 * m))
                sums = np.zeros(items)
                sizes = block.first[numbers + 1] - block.first[numbers]
                cut = np.concatenate(([0], np.flatnonzero(np.diff(np.cumsum(sizes) // CELLS)) + 1, [len(numbers)]))
                for low, high in zip(cut[:-1], cut[1:]):  # sums are whole numbers below 2**53
                    k = sizes[low:high]
                    start = np.repeat(block.first[numbers[low:high]] - np.cumsum(k) + k, k)
                    sums += np.bincount(block.item[start + np.arange(k.sum())], np.repeat(part[low:high], k), items)
                return sums

            def take() -> None:
                doc, item = np.nonzero((cells[: len(at)] >= best.least) & (cells[: len(at)] > 0))
                if len(doc):
                    best.add(item, ids.take(pa.array(np.array(at)[doc])), cells[doc, item])
                at.clear()

            cells = np.zeros((min(group, max(1, len(ids))), items))
            for i, text in enumerate(batch.column("text").to_pylist()):
                sums = score(text) if text else None
                if sums is None:
                    continue
                cells[len(at)] = sums
                at.append(i)
                if len(at) == len(cells):
                    take()
            take()
        yield from best.rows.combine_chunks().to_batches()

    return texts.mapInArrow(run, schema)


def weight(documents: int, having: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term."""
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * having + 1))).astype(np.int64)


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    block_bytes: int = 16 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's `top` best documents.

    With N documents that have a term, L terms in all of them, n in one and
    m = 10 + 90 n N div L, a document's score sums, over the item's distinct terms,
    weight * (10**9 tf div (1000 tf + 8 m)).
    """
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    terms = staged(item_terms(items, item_col, item_text_col), "item-terms")
    size = terms.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    blocks = -(-int(size) // block_bytes)
    # items are dealt to blocks by hash, so blocks are about even
    dealt = terms.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))))
    kind = terms.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("doc_id", texts.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
    out = spark.createDataFrame([], schema)
    for number in range(blocks):
        rows = [tuple(r) for r in dealt.where(F.col("block") == number).select("item_id", "term").collect()]
        if not rows:
            continue
        shared = spark.sparkContext.broadcast(Block(rows))
        documents, total, having = _statistics(texts, shared)
        if not documents:
            break
        found = _ranked(texts, shared, weight(documents, having), documents, total, top)
        names = spark.createDataFrame(list(enumerate(shared.value.items)), T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind)]))
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "doc_id", "score"))

    def cut(rows: DataFrame, *keys) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # tasks' rows meet in two steps, as there may be very many tasks
    dealt_rows = out.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(64)))
    near = cut(dealt_rows, "item_id", "_part").drop("rank", "_part")
    return cut(near, "item_id").select("item_id", "rank", "doc_id", "score")
