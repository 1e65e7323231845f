"""Benchmark decontamination by spaced seeds.

A seed is a mask over consecutive tokens: its ones are hashed, its zeros ignored, so
windows that differ only in ignored tokens share a hash. Hashes of the training texts
are looked up among those of the benchmark; around each hit the two texts are laid on
the same diagonal, and the two overlap there if any segment that is long enough has
`min_identity` of matches or more. The masks lose none of them: at the default length
and identity, every such segment holds one of 12 to 23 tokens, and wherever its
substitutions stand, some mask has a window without them.

The benchmark is taken in blocks of bounded bytes: each is read by the driver, sent to
the executors, and all documents are compared with it, whole texts in Arrow batches
with no shuffle. However large the benchmark, no more than a block is ever sent.

Tokens are runs of letters and digits, case folded. Items shorter than `min_overlap`
have masks of their own and must overlap over their whole length; those of fewer than
`min_tokens` are looked up whole, and must match whole.

Defined results: NULL or empty texts and items have no tokens and no overlap; a NULL
id is returned as it is; a repeated row gives a repeated result; items with equal texts
are all reported; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lawgrain.llm.texts import Texts, mix, slices


@dataclass(frozen=True)
class SeedParams:
    # Each has six ones. Together they find any 2 substitutions in 12 tokens, 3 in 15, 4 in 20.
    masks: tuple[str, ...] = ("1111011", "110010111", "11000100111")
    # Five ones, for items under min_overlap: any 1 substitution in 8 tokens, 2 in 10.
    short_masks: tuple[str, ...] = ("111011", "11001101", "101000111", "101010101")
    min_tokens: int = 8
    min_overlap: int = 12
    min_identity: float = 0.8
    block_bytes: int = 8 << 20


def window_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the tokens under the ones of `mask`, for each window of its span."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, int(mask, 2) * 2 + 1, np.uint64)
    for at, flag in enumerate(mask):
        if flag == "1":
            total *= np.uint64(0xA0761D6478BD642F)
            total += tokens[at : at + n]
    return mix(total)


class SeedIndex:
    """Sorted window hashes of the benchmark items with item and position."""

    def __init__(self, ids: list, texts: list[str | None], params: SeedParams):
        self.params, self.ids = params, ids
        words = Texts.of(texts).tokens()
        hashes, first = words.hashes(), words.first_word
        self.items = [hashes[first[i] : first[i + 1]] for i in range(len(ids))]
        sizes = [len(x) for x in self.items]
        short = range(params.min_tokens, params.min_overlap)
        whole = sorted({n for n in sizes if 0 < n < params.min_tokens})
        seeds = [
            *((mask, [i for i, n in enumerate(sizes) if n >= params.min_tokens and n not in short]) for mask in params.masks),
            *((mask, [i for i, n in enumerate(sizes) if n in short]) for mask in params.short_masks),
            *(("1" * length, [i for i, n in enumerate(sizes) if n == length]) for length in whole),
        ]
        self.masks = [mask for mask, _ in seeds]
        self.tables = []
        for mask, fit in seeds:
            found = [window_hashes(self.items[i], mask) for i in fit]
            keys = np.concatenate(found) if found else np.zeros(0, np.uint64)
            item = np.repeat(np.array(fit, np.int64), [len(f) for f in found])
            at = np.concatenate([np.arange(len(f)) for f in found]) if found else np.zeros(0, np.int64)
            order = np.argsort(keys, kind="stable")
            bloom = np.zeros(1 << max(16, (8 * len(keys)).bit_length()), bool)
            bloom[keys & np.uint64(len(bloom) - 1)] = True
            self.tables.append((keys[order], item[order], at[order], bloom))

    def overlaps(self, texts: Texts) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, first token, first item token, overlap, matches) of each overlap."""
        words = texts.tokens()
        tokens, of, first = words.hashes(), words.text_of(), words.first_word
        seen: list[np.ndarray] = []
        for mask, (keys, item, at, bloom) in zip(self.masks, self.tables):
            hashes = window_hashes(tokens, mask)
            if not len(keys) or not len(hashes):
                continue
            start = np.flatnonzero(bloom[hashes & np.uint64(len(bloom) - 1)])
            start = start[of[start] == of[start + len(mask) - 1]]
            low = np.searchsorted(keys, hashes[start], "left")
            n = np.searchsorted(keys, hashes[start], "right") - low
            start, low, n = start[n > 0], low[n > 0], n[n > 0]
            entry = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            start = np.repeat(start, n)
            seen.append(np.stack((of[start], item[entry], start - at[entry]), axis=1))
        if not seen:
            return []
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for text, i, diagonal in np.unique(np.concatenate(seen), axis=0).tolist():
            low, high = int(first[text]), int(first[text + 1])
            begin = max(low, diagonal)
            end = min(high, diagonal + len(self.items[i]))
            same = tokens[begin:end] == self.items[i][begin - diagonal : end - diagonal]
            size = len(self.items[i])
            least = size if size < self.params.min_tokens else min(self.params.min_overlap, size)
            segment = best_segment(same, self.params.min_identity if size >= self.params.min_tokens else 1.0, least)
            if segment is None:
                continue
            a, b = segment
            matches = int(same[a:b].sum())
            found = (matches, b - a, begin - low + a, begin - diagonal + a)
            # most matches; of equals the shortest, then the first
            if (text, i) not in best or (-found[0], *found[1:]) < (-best[text, i][0], *best[text, i][1:]):
                best[text, i] = found
        return [(t, i, start, at, n, m) for (t, i), (m, n, start, at) in sorted(best.items())]


def best_segment(same: np.ndarray, identity: float, least: int) -> tuple[int, int] | None:
    """Bounds of the segment of `least` tokens or more with the most matches, among those
    with `identity` of matches or more; of equals the shortest, then the first.

    Any such segment can be widened to the greatest length one of them has, so a segment
    of that length has the most matches.
    """
    n = len(same)
    if n < least or same.sum() < max(1, identity * least - 1e-9):
        return None
    matches = np.concatenate(([0], np.cumsum(same)))
    excess = matches - identity * np.arange(n + 1)
    # the greatest excess from each place on, never rising
    ahead = np.maximum.accumulate(excess[::-1])[::-1]
    ends = np.searchsorted(-ahead, 1e-9 - excess, "right") - 1
    length = int((ends - np.arange(n + 1)).max())
    if length < max(least, 1):
        return None
    start = np.arange(n + 1 - length)
    found = matches[length:] - matches[:-length]
    start = start[found == found.max()]
    # shed substitutions at both ends as far as `least` allows
    at = np.flatnonzero(same)
    first, last = at[matches[start]], at[matches[start + length] - 1] + 1
    begin = np.minimum(first, np.maximum(start, last - least))
    size = np.maximum(last - begin, least)
    k = np.lexsort((begin, size))[0]
    return int(begin[k]), int(begin[k] + size[k])


def _indexes(benchmark: DataFrame, params: SeedParams, item_col: str, text_col: str) -> list[SeedIndex]:
    """One index per block of items; a block is read by the driver on its own."""
    items = benchmark.select(
        benchmark[item_col].alias("item_id"), F.coalesce(benchmark[text_col], F.lit("")).alias("text")
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-size // params.block_bytes)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        if rows:
            yield SeedIndex([r["item_id"] for r in rows], [r["text"] for r in rows], params)


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    params: SeedParams | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that overlap: the best segment.

    Columns doc_id, item_id, doc_start and item_start (tokens before the segment),
    n_tokens (its length), n_matched, item_tokens.
    """
    params = params or SeedParams()
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    ids = [rows.schema["doc_id"].dataType, benchmark.schema[item_col].dataType]
    names = "doc_id item_id doc_start item_start n_tokens n_matched item_tokens".split()
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [*ids, *[T.LongType()] * 5])])
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def against(index: SeedIndex) -> DataFrame:
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part, texts in slices(batch, "text"):
                    ids = part.column(0)
                    out = [
                        (ids[t].as_py(), index.ids[i], start, at, n, m, len(index.items[i]))
                        for t, i, start, at, n, m in index.overlaps(texts)
                    ]
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names
                        )

        return rows.mapInArrow(run, schema)

    found = [against(index) for index in _indexes(benchmark, params, item_col, item_text_col)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    params: SeedParams | None = None,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that overlap no benchmark item, columns unchanged."""
    params = params or SeedParams()
    context = docs.sparkSession.sparkContext

    def without(rows: DataFrame, index: SeedIndex) -> DataFrame:
        shared = context.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in slices(batch, text_col):
                    clean = np.ones(len(texts), bool)
                    clean[[o[0] for o in shared.value.overlaps(texts)]] = False
                    yield part.filter(pa.array(clean))

        return rows.mapInArrow(run, rows.schema)

    return reduce(without, _indexes(benchmark, params, item_col, item_text_col), docs)
