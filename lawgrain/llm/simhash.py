"""SimHash near-duplicates: 64-bit fingerprints compared bit-sliced.

Fingerprints are made from word shingles in Arrow batches. Equal fingerprints are one
node from then on, so groups of copies shrink to one row before anything is compared.

Candidates: the 64 bits are cut into `radius` + 2 blocks; two fingerprints within the
radius agree on two whole blocks at least (32 bits for radius 2), so each fingerprint
goes to one bucket per pair of blocks and no near pair is missed. A partition sorted by
bucket is compared in blocks of whole buckets: bit planes stand vertically (one 64-bit
word holds a bit of 64 fingerprints), distances of a query to all of them are counted
by carry-save bitwise counters, and words in which all exceed the radius are abandoned.
A bucket beyond `tile` rows is dealt out as pairs of tiles, so none meets in one task
whole. Out of a block come spanning links only, never all pairs.

Defined results: a NULL or empty text has no words and fingerprint zero; a repeated
row gets a repeated result; a NULL id is never a component's id unless all ids of the
component are NULL; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawgrain.llm.components import connected_components, rows_of
from lawgrain.llm.texts import slices
from lawgrain.session import staged

TILE = 2048


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits set in over half of the XXH64 values (seed 42) of a text's shingles.

    A-Z are lower-cased; bytes.split() cuts at exactly the six white-space bytes
    0x20 and 0x09 to 0x0D.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], spaces + 1))[: len(words) - shingle + 1].tolist()
    ends = np.concatenate((spaces, [len(line)]))[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], 42) for s, e in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text", 8 << 20):
                prints = np.array([fingerprint(texts.bytes(i), shingle) for i in range(len(texts))], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(prints.view(np.int64))],
                    names=["doc_id", "text_hash", "fp"],
                )

    rows = docs.select(
        docs[id_col].alias("doc_id"),
        F.xxhash64(docs[text_col]).alias("text_hash"),
        docs[text_col].cast("string").alias("text"),
    )
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words) array: bit p of 64 values in each word."""
    words = -(-len(values) // 64)
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[: len(values)] = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near_pairs(values: np.ndarray, radius: int, queries: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of `values` that differ in `radius` bits or fewer."""
    planes = bit_planes(values)
    used = np.zeros(planes.shape[1] * 64, np.uint8)
    used[: len(values)] = 1
    real = np.packbits(used, bitorder="little").view(np.uint64)
    width = radius.bit_length()
    left, right = [], []
    for at in range(0, len(values), queries):
        block = values[at : at + queries]
        row, word = np.divmod(np.arange(len(block) * planes.shape[1]), planes.shape[1])
        counters = [np.zeros(len(row), np.uint64) for _ in range(width)]
        over = ~real[word]
        for p in range(64):
            bit = (block >> np.uint64(p)) & np.uint64(1)
            carry = planes[p][word] ^ (np.uint64(0) - bit)[row]
            for k in range(width):  # add one bit to 64 counters at once
                carry, counters[k] = counters[k] & carry, counters[k] ^ carry
            over = over | carry
            if p % 8 == 7:
                above, equal = over, ~over
                for k in reversed(range(width)):
                    if not radius >> k & 1:
                        above = above | (equal & counters[k])
                        equal = equal & ~counters[k]
                    else:
                        equal = equal & counters[k]
                alive = ~above != 0
                row, word, over = row[alive], word[alive], above[alive]
                counters = [c[alive] for c in counters]
                if not len(row):
                    break
        near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") if len(row) else np.zeros((0, 64))
        hit, lane = np.nonzero(near)
        i, j = at + row[hit], word[hit] * 64 + lane
        left.append(i[i < j])
        right.append(j[i < j])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def spanning_links(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, least linked value of its group) among `values`."""
    values = np.unique(values)
    i, j = near_pairs(values, radius)
    label = np.arange(len(values))
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, label[i].copy(), low)
        label = label[label]
        if (label[i] == label[j]).all():
            break
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _compare(radius: int, block: int):
    """mapInArrow body: whole buckets of a sorted partition, compared block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def compare(values: np.ndarray) -> pa.RecordBatch:
            a, b = spanning_links(values, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        def blocks(keys: np.ndarray, fps: np.ndarray, final: bool):
            """Runs of whole buckets; the last bucket waits unless `final`."""
            cuts = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys)) if len(keys) else np.zeros(0, int)
            if not final:
                cuts = cuts[:-1]
            at = 0
            while at < (cuts[-1] if len(cuts) else 0):
                k = np.searchsorted(cuts, at + block, "right") - 1
                to = int(cuts[k]) if k >= 0 and cuts[k] > at else int(cuts[np.searchsorted(cuts, at, "right")])
                yield fps[at:to]
                at = to
            blocks.at = at

        for batch in batches:
            keys = np.concatenate((rest_key, np.asarray(batch.column(0))))
            fps = np.concatenate((rest_fp, np.asarray(batch.column(1)).view(np.uint64)))
            for values in blocks(keys, fps, False):
                yield compare(values)
            rest_key, rest_fp = keys[blocks.at :], fps[blocks.at :]
        for values in blocks(rest_key, rest_fp, True):
            yield compare(values)

    return run


def near_links(nodes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints `nodes` (fp)."""
    n_blocks = radius + 2
    edges = [round(64 * k / n_blocks) for k in range(n_blocks + 1)]

    def block(k: int):
        low, width = edges[k], edges[k + 1] - edges[k]
        return F.shiftrightunsigned(F.col("fp"), low).bitwiseAND(F.lit((1 << width) - 1))

    keys = F.array(
        *[F.xxhash64(F.lit(n), block(x), block(y)) for n, (x, y) in enumerate(combinations(range(n_blocks), 2))]
    )
    entries = nodes.select("fp", F.explode(keys).alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("n"))
    entries = entries.join(sizes.where("n > 1"), "key")
    tiles = F.ceil(F.col("n") / tile)
    mine = F.pmod(F.xxhash64("fp"), tiles)
    dealt = F.transform(
        F.sequence(F.lit(0).cast("long"), tiles - 1),
        lambda t: F.xxhash64(F.col("key"), F.least(t, mine), F.greatest(t, mine)),
    )
    dealt = entries.select(F.explode(F.when(F.col("n") <= tile, F.array("key")).otherwise(dealt)).alias("key"), "fp")
    links = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_compare(radius, tile), "a long, b long")
    return links.distinct()


def simhash_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text_hash, fp and component_id (least id reachable) of every row."""
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(near_links(nodes.select("fp"), radius))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(named.join(least, "root").select("fp", "root", "component_id"), "fp")


def keep_one(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of `docs` for each component: of its least id, columns unchanged."""
    groups = simhash_groups(docs, shingle, radius, id_col, text_col)
    names = groups.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n_rows"))
    order = F.struct(F.isnull("doc_id"), "doc_id", "text_hash")
    chosen = names.groupBy("root").agg(
        F.min_by(F.struct("doc_id", "text_hash", "n_rows"), order).alias("keep")
    )
    return rows_of(docs, chosen.select("keep.*"), id_col, text_col)
