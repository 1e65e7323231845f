"""Removal of repeated byte strings by suffix arrays.

A byte goes if it lies in a string of `length` bytes that starts anywhere else in the
corpus too. The work, on distinct texts (one stands for all its copies):

1. Anchors. The least hash of the short strings within a window of `length` bytes
   depends on the window alone, so a window can only repeat where its anchor does. The
   anchors of all texts (about one for every 90 bytes) are counted by grouping; windows
   of anchors found once are unique for certain and are left out of what follows.
2. Segments. Runs of the other windows are cut out of the texts and dealt to shards by
   their least anchor, so that like texts mostly meet; an anchor with more than a
   shard's bytes is dealt out over several.
3. Shards. Each builds the suffix array of its segments (Larsson-Sadakane refinement)
   and the common prefixes of neighbours (Kasai); windows that share `length` bytes with
   a neighbour repeat.
4. Merge. Windows whose anchor is also in another shard are sent, one key for each
   distinct window of a shard in sorted runs, to ranges of the key space, where each
   run is looked up in the others by binary search.
5. Removal. Intervals are joined to the texts once more and the rest is hashed.

Defined results: a NULL text is empty; repeated rows are copies of each other; texts
shorter than `length` stay whole; an empty table gives an empty table; ids keep their type. Texts are told
apart by two 64-bit hashes and windows by one beside their order in a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawgrain.llm.suffixes import anchors, common_prefixes, suffix_array
from lawgrain.llm.texts import run_hashes, slices
from lawgrain.operators.joins import attach
from lawgrain.session import staged


@dataclass(frozen=True)
class SubstringParams:
    length: int = 200
    gram: int = 24
    shard_bytes: int = 4 << 20


def text_anchors(data: np.ndarray, params: SubstringParams) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors of a text, and which of them occur twice or more in it."""
    if len(data) < params.length:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    hashes, least = anchors(data, params.length, params.gram)
    found = np.unique(least[np.append(True, least[1:] != least[:-1])])
    maybe = np.zeros(1 << 16, bool)
    maybe[found & np.uint64(0xFFFF)] = True
    hashes = hashes[maybe[hashes & np.uint64(0xFFFF)]]
    place = np.minimum(np.searchsorted(found, hashes), len(found) - 1)
    times = np.bincount(place[found[place] == hashes], minlength=len(found))
    return found, times > 1


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ones, by binary search."""
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[place] == values


def _u64(blob: bytes | None) -> np.ndarray:
    return np.frombuffer(blob or b"", np.uint64)


def _anchor_rows(params: SubstringParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                keys = np.asarray(part.column(0))
                _, once = np.unique(keys, return_index=True)
                h, k, twice = [], [], []
                for i in once.tolist():
                    found, repeated = text_anchors(texts.data[texts.offsets[i] : texts.offsets[i + 1]], params)
                    h.append(found.view(np.int64))
                    k.append(np.full(len(found), keys[i]))
                    twice.append(repeated)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(h)), pa.array(np.concatenate(k)), pa.array(np.concatenate(twice))],
                    names=["h", "k1", "twice"],
                )

    return run


_SEGMENT = "route long, k1 long, k2 long, start long, bytes binary, hs binary"


def _segments(params: SubstringParams):
    """Runs of windows with a suspect anchor: their bytes and anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = []
                for i in range(len(texts)):
                    data = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
                    suspect = np.sort(np.array(part.column(3)[i].as_py(), np.int64).view(np.uint64))
                    if len(data) < params.length:
                        continue
                    _, least = anchors(data, params.length, params.gram)
                    for a, b in zip(*_runs(_member(suspect, least))):
                        own = np.unique(least[a:b])
                        rows.append(
                            (
                                int(own[:1].view(np.int64)[0]),
                                part.column(0)[i].as_py(),
                                part.column(1)[i].as_py(),
                                int(a),
                                data[a : b + params.length - 1].tobytes(),
                                own.tobytes(),
                            )
                        )
                columns = list(zip(*rows)) or [()] * 6
                kinds = [pa.int64()] * 4 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=[c.split()[0] for c in _SEGMENT.split(", ")],
                )

    return run


def _explode_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shards = np.asarray(batch.column(0))
        blobs = [_u64(x).view(np.int64) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.zeros(0, np.int64), *blobs])),
                pa.array(np.repeat(shards, [len(b) for b in blobs])),
            ],
            names=["h", "shard"],
        )


class Shard:
    """Distinct segments of a shard, laid end to end with a gap of one zero byte."""

    def __init__(self, table: pa.Table, params: SubstringParams):
        self.rows = sorted(table.select(["k1", "k2", "start", "bytes"]).to_pylist(), key=lambda r: (r["k1"], r["k2"], r["start"]))
        self.place: dict[bytes, int] = {}
        copies: dict[bytes, int] = {}
        parts, at = [], 0
        for row in self.rows:
            data = row["bytes"]
            copies[data] = copies.get(data, 0) + 1
            if copies[data] == 1:
                self.place[data] = at
                parts.append(data + b"\0")
                at += len(data) + 1
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.whole = np.zeros(len(self.data), bool)  # windows within one segment
        self.repeated = np.zeros(len(self.data), bool)
        for data, begin in self.place.items():
            windows = slice(begin, begin + len(data) - params.length + 1)
            self.whole[windows] = True
            self.repeated[windows] = copies[data] > 1
        self.params = params

    def window_keys(self, at: np.ndarray) -> np.ndarray:
        return run_hashes(self.data, at, at + self.params.length)

    def crossing(self, cross: np.ndarray) -> np.ndarray:
        """Starts of windows whose anchor is in another shard too."""
        if len(self.data) < self.params.length or not len(cross):
            return np.zeros(0, np.int64)
        _, least = anchors(self.data, self.params.length, self.params.gram)
        return np.flatnonzero(self.whole[: len(least)] & _member(cross, least))

    def groups(self) -> np.ndarray:
        """A number for each window of the shard, the same for equal windows."""
        order = suffix_array(self.data)
        prefix = common_prefixes(self.data, order, self.params.length)
        number = np.empty(len(order), np.int32)
        number[order] = np.cumsum(prefix < self.params.length)
        return number


def _blobs(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


_LOCAL = "shard long, r long, k1 long, k2 long, start long, a binary, b binary"


def _search_shard(params: SubstringParams, ranges: int):
    """Repeats within a shard (r = -1), and the keys of its crossing windows by range."""

    def run(key: tuple, segments: pa.Table, crossing: pa.Table) -> pa.Table:
        shard = Shard(segments, params)
        number = shard.groups()
        windows = np.flatnonzero(shard.whole)
        times = np.bincount(number[windows], minlength=number.max(initial=0) + 1)
        shard.repeated[windows] |= times[number[windows]] > 1
        uid, rows = key[0].as_py(), []
        for row in shard.rows:
            begin = shard.place[row["bytes"]]
            a, b = _runs(shard.repeated[begin : begin + len(row["bytes"]) - params.length + 1])
            if len(a):
                rows.append((uid, -1, row["k1"], row["k2"], row["start"], a.tobytes(), b.tobytes()))
        cross = np.sort(crossing.column("h").to_numpy().astype(np.int64).view(np.uint64))
        at = shard.crossing(cross)
        if len(at):
            _, one = np.unique(number[at], return_index=True)  # a key for each distinct window
            keys = np.unique(shard.window_keys(at[one]))
            cuts = np.searchsorted(keys, [np.uint64((k << 64) // ranges) for k in range(1, ranges)]).tolist()
            for r, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(keys)])):
                if a < b:
                    rows.append((uid, r, 0, 0, 0, keys[a:b].tobytes(), b""))
        return _blobs(rows, _LOCAL)

    return run


_MERGED = "shard long, keys binary"


def _merge_runs(table: pa.Table) -> pa.Table:
    """Keys of each sorted run that another shard's run holds too.

    Runs are merged pairwise; those found in both sides of a merge repeat.
    """
    runs = [(row["shard"], _u64(row["a"])) for row in table.select(["shard", "a"]).to_pylist()]
    repeated = [np.zeros(0, np.uint64)]
    level = [keys for _, keys in runs]
    while len(level) > 1:
        merged = []
        for i in range(0, len(level) - 1, 2):
            small, large = sorted((level[i], level[i + 1]), key=len)
            place = np.searchsorted(large, small)
            both = large[np.minimum(place, len(large) - 1)] == small
            repeated.append(small[both])
            merged.append(np.insert(large, place[~both], small[~both]))
        level = merged + level[len(level) - len(level) % 2 :]
    found = np.unique(np.concatenate(repeated))
    rows = []
    for shard, keys in runs:
        own = keys[_member(found, keys)]
        if len(own):
            rows.append((shard, own.tobytes()))
    return _blobs(rows, _MERGED)


_SPANS = "k1 long, k2 long, a binary, b binary"


def _apply_merge(params: SubstringParams):
    """Runs of windows that the merge found, as window intervals of the texts."""

    def run(key: tuple, segments: pa.Table, crossing: pa.Table) -> pa.Table:
        found = np.sort(np.concatenate([_u64(None), *(_u64(x) for x in crossing.column("keys").to_pylist())]))
        if not len(found) or not len(segments):
            return _blobs([], _SPANS)
        shard = Shard(segments, params)
        windows = np.flatnonzero(shard.whole)
        repeated = np.zeros(len(shard.data), bool)
        repeated[windows] = _member(found, shard.window_keys(windows))
        rows = []
        for row in shard.rows:
            begin = shard.place[row["bytes"]]
            a, b = _runs(repeated[begin : begin + len(row["bytes"]) - params.length + 1])
            if len(a):
                rows.append((row["k1"], row["k2"], (a + row["start"]).tobytes(), (b + row["start"]).tobytes()))
        return _blobs(rows, _SPANS)

    return run


def _local_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            a, b = (np.frombuffer(row[c], np.int64) + row["start"] for c in "ab")
            rows.append((row["k1"], row["k2"], a.tobytes(), b.tobytes()))
        yield from _blobs(rows, _SPANS).to_batches()


_REMOVED = "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>"


def _remove(params: SubstringParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                out = []
                for i, row in enumerate(part.select(["k1", "k2", "spans"]).to_pylist()):
                    data = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
                    a = np.concatenate([np.frombuffer(s["a"], np.int64) for s in row["spans"]])
                    b = np.concatenate([np.frombuffer(s["b"], np.int64) for s in row["spans"]])
                    depth = np.zeros(len(data) + 1, np.int64)
                    np.add.at(depth, a, 1)
                    np.add.at(depth, b + params.length - 1, -1)
                    gone = np.cumsum(depth)[:-1] > 0
                    starts, ends = _runs(gone)
                    kept = hashlib.sha256(data[~gone].tobytes()).hexdigest()
                    out.append((row["k1"], row["k2"], int(gone.sum()), len(starts), kept, starts, ends))
                columns = list(zip(*out)) or [()] * 7
                longs = pa.list_(pa.int64())
                kinds = [pa.int64()] * 4 + [pa.string(), longs, longs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=[c.split()[0] for c in _REMOVED.split(", ")],
                )

    return run


def repeated_strings(
    docs: DataFrame, params: SubstringParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans
    (`starts`, `ends`) of every row."""
    params = params or SubstringParams()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit("second"), text).alias("k2"),
        text.alias("text"),
    )
    meta = staged(
        rows.select(
            "doc_id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")
        ),
        "texts",
    )
    texts = meta.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))

    anchors = rows.select("k1", "text").mapInArrow(_anchor_rows(params), "h long, k1 long, twice boolean")
    found = staged(anchors, "anchors")
    suspect = (
        found.groupBy("h")
        .agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.max("twice").alias("twice"))
        .where("a <> b OR twice")
        .select("h")
    )
    of_text = attach(found.select("h", "k1"), suspect, "h", "inner").groupBy("k1").agg(F.collect_set("h").alias("hs"))
    one_each = texts.join(of_text, "k1").select(
        F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("first_id").alias("wid"), "hs"
    )
    same = F.expr("k1 = w1 AND k2 = w2 AND doc_id <=> wid")
    segments = staged(
        rows.join(one_each, same).select("k1", "k2", "text", "hs").mapInArrow(_segments(params), _SEGMENT), "segments"
    )

    size = segments.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0)).alias("n")).first()["n"]
    shards = -(-2 * size // params.shard_bytes) or 1
    routes = segments.groupBy("route").agg(F.sum(F.octet_length("bytes")).alias("n"))
    salt = F.pmod(F.xxhash64("k1", "k2", "start"), F.ceil(F.col("n") / params.shard_bytes))
    dealt = staged(
        attach(segments, routes, "route", "inner").select(
            F.pmod(F.xxhash64("route", salt), F.lit(shards)).cast("long").alias("shard"),
            "k1", "k2", "start", "bytes", "hs",
        ),
        "shards",
    )
    by_shard = dealt.select("shard", "hs").mapInArrow(_explode_anchors, "h long, shard long").distinct()
    met = by_shard.groupBy("h").agg(F.min("shard").alias("a"), F.max("shard").alias("b")).where("a <> b").select("h")
    cross = attach(by_shard, met, "h", "inner")
    pieces = dealt.select("shard", "k1", "k2", "start", "bytes")
    local = staged(
        pieces.groupBy("shard").cogroup(cross.groupBy("shard")).applyInArrow(_search_shard(params, shards), _LOCAL),
        "repeats",
    )
    merged = local.where("r >= 0").select("r", "shard", "a").groupBy("r").applyInArrow(_merge_runs, _MERGED)
    crossing = pieces.groupBy("shard").cogroup(merged.groupBy("shard")).applyInArrow(_apply_merge(params), _SPANS)
    within = local.where("r < 0").select("k1", "k2", "start", "a", "b").mapInArrow(_local_spans, _SPANS)
    spans = (
        within.unionByName(crossing)
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    )
    wanted = texts.join(spans, ["k1", "k2"]).select(
        F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("first_id").alias("wid"), "spans"
    )
    removed = rows.join(wanted, same).select("k1", "k2", "text", "spans").mapInArrow(_remove(params), _REMOVED)
    removed = removed.dropDuplicates(["k1", "k2"])
    empty = F.sha2(F.lit(""), 256)
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= params.length)
    all_of = F.array(F.col("n_bytes"))
    facts = texts.join(removed, ["k1", "k2"], "left").withColumn("text", F.struct("k1", "k2")).drop("k1", "k2")
    return (
        attach(meta.withColumn("text", F.struct("k1", "k2")), facts, "text", "inner")
        .select(
            "doc_id",
            "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(gone, empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
            F.when(gone, F.array(F.lit(0).cast("long"))).otherwise(F.coalesce("starts", F.array().cast("array<long>"))).alias("starts"),
            F.when(gone, all_of).otherwise(F.coalesce("ends", F.array().cast("array<long>"))).alias("ends"),
        )
    )
