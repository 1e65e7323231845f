"""Alignment of two tokenizers over whole texts, by an associative monoid of fragments.

A text (with one space before it) is encoded twice. Byte offsets at which tokens of both
sides end cut it into groups; an A and a B token are linked where their byte ranges
overlap, and an id pair counts as often as any document links it.

Texts longer than `chunk_chars` are cut into byte ranges that go to tasks of their own. A
range is encoded with a little context on both sides, out to the next blank between two
non-blank characters: neither tokenizer has a token that crosses one, so the tokens are
those of the whole text. A token belongs to the range its end lies in. A range gives a
fragment: an open prefix (tokens up to its first common end), closed groups, an open suffix
(tokens behind its last one). Fragments compose: the suffix of one and the prefix of the
next close a group between them. Composition is associative, so a tree of tasks reduces a
text's fragments, `FAN` at a time. Closed groups stay behind as rows; only the digest, which
is one value, reads a document's groups in order in one task, as a stream.

Pair counts: a slice of texts is stored with its distinct pairs; these are summed over all
slices, and each slice gets the sums of its pairs back. Nothing is broadcast but the
greatest count of each B id (`PIECES` rows at most).

Memory: a slice is encoded in parts (whole texts of `part_bytes`, or one text), and only a
part's tokens are held, and only its texts taken out of the Arrow batch; the parts' distinct
pairs are joined. Groups are rendered `BLOCK` at a time.

Defined results: a NULL or empty text, and one whose tokens do not give its bytes back, has
no tokens, links or groups, and its digest is `''`; a repeated row is a document of its own
under the same id, which may have any type; ties for the greatest count all count; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import ctypes
import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lawgrain.session import staged

# Ids of B are below this; a pair is a * PIECES + b and fits 31 bits.
PIECES = 1 << 15
FAN = 16
# Groups rendered at once.
BLOCK = 1 << 16
# Characters for which both libraries of side A share one idea of letters, digits and spaces.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa0-ɏ‐-‧]")
# A blank that starts a token on both sides.
_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class AlignParams:
    tokenizer: str = "byte_bpe_50k.json"
    ranks: str = "byte_bpe_50k.tiktoken"  # the same vocabulary
    pieces: str = "piece_bpe_32k.model"
    chunk_chars: int = 1 << 20
    max_context: int = 1 << 16  # a border without a cut so near moves to the next cut
    slice_bytes: int = 2 << 20
    part_bytes: int = 1 << 18


class Side:
    """Bytes and byte lengths of the ids of one vocabulary."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.length = np.array([len(b) for b in table], np.int64)

    def gives(self, ids: np.ndarray, data: bytes) -> bool:
        return b"".join(map(self.table.__getitem__, ids.tolist())) == data


class Encoders:
    """Both tokenizers of a process; special tokens' strings are plain text."""

    def __init__(self, tokenizer: str, ranks: str, pieces: str):
        import public_tokenizers
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
        self.exact = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        self.exact.encode_special_tokens = True
        self.model = SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
        by_id = [b""] * (max(table.values()) + 1)
        for data, i in table.items():
            by_id[i] = data
        self.a = Side(by_id)
        self.b = Side([self._piece(i) for i in range(self.model.get_piece_size())])

    def _piece(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A over blank + unit and of B over the unit (it adds the blank)."""
        left = [
            np.array(self.exact.encode(" " + u, add_special_tokens=False).ids, np.int32)
            if _UNUSUAL.search(u)
            else self.plain.encode_to_numpy(" " + u, disallowed_special=()).astype(np.int32)
            for u in units
        ]
        right = [np.array(ids, np.int32) for ids in self.model.encode(units, num_threads=1)] if units else []
        return list(zip(left, right))


@cache
def encoders(tokenizer: str, ranks: str, pieces: str) -> Encoders:
    return Encoders(tokenizer, ranks, pieces)


@cache
def _decimals() -> tuple[np.ndarray, np.ndarray]:
    """"0,1,2,…" as bytes, and where each number starts."""
    lines = [b"%d," % i for i in range(1 << 16)]
    starts = np.zeros(len(lines) + 1, np.int64)
    np.cumsum([len(x) for x in lines], out=starts[1:])
    return np.frombuffer(b"".join(lines), np.uint8), starts


def render(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups as `a1,a2|b1;…;` and where each group's text ends (behind its semicolon).

    `shared` are the ascending common ends; both sides end at the last one.
    """
    texts, ends, size, from_a, from_b = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)], 0, 0, 0
    for at in range(0, len(shared), BLOCK):
        some = shared[at : at + BLOCK]
        to_a, to_b = np.searchsorted(a_end, some[-1]) + 1, np.searchsorted(b_end, some[-1]) + 1
        text, end = _render(a[from_a:to_a], a_end[from_a:to_a], b[from_b:to_b], b_end[from_b:to_b], some)
        texts.append(text)
        ends.append(end + size)
        size, from_a, from_b = size + len(text), to_a, to_b
    return np.concatenate(texts), np.concatenate(ends)


def _render(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    flat, starts = _decimals()
    last_a, last_b = np.searchsorted(a_end, shared), np.searchsorted(b_end, shared)
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    at_a = np.arange(len(a)) + np.repeat(last_b + 1 - size_b, size_a)
    at_b = np.arange(len(b)) + np.repeat(last_a + 1, size_b)
    ids = np.empty(len(a) + len(b), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    ids[at_a], ids[at_b] = a, b
    mark[at_a[last_a]], mark[at_b[last_b]] = ord("|"), ord(";")
    sizes = starts[ids + 1] - starts[ids]
    ends = np.cumsum(sizes)
    out = flat[np.arange(ends[-1]) + np.repeat(starts[ids] - ends + sizes, sizes)]
    out[ends - 1] = mark
    return out, ends[at_b[last_b]]


def group_text(a: list[int], b: list[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


@dataclass
class Fragment:
    """Open prefix, whether any group end lies in the range, open suffix."""

    prefix: tuple[list[int], list[int]]
    closed: bool
    suffix: tuple[list[int], list[int]]
    first: int  # first chunk with a group end

    def __add__(self, other: "Fragment") -> tuple["Fragment", tuple[int, str] | None]:
        """The composition, and the group closed between the two, if any."""

        def joined(x, y):
            return x[0] + y[0], x[1] + y[1]

        if not self.closed:
            return Fragment(joined(self.prefix, other.prefix), other.closed, other.suffix, other.first), None
        if not other.closed:
            return Fragment(self.prefix, True, joined(self.suffix, other.prefix), self.first), None
        seam = group_text(*joined(self.suffix, other.prefix))
        return Fragment(self.prefix, True, other.suffix, self.first), (2 * other.first - 1, seam)


def chunks(text: str, size: int, max_context: int) -> Iterator[tuple[int, str, int, int]]:
    """(number, unit, low, high) of each range of a long text.

    The unit stands between two cuts; of the bytes of blank + unit, low < end <= high is
    the range. `size` is in characters; borders may fall anywhere, also inside tokens.
    """

    def cut_before(at: int) -> int | None:
        """The last cut at or before a position, -1 for the blank before the text."""
        i = at
        while (i := text.rfind(" ", max(0, at - max_context), i + 1)) > 0:
            if _CUT.match(text, i):
                return i
            i -= 1
        return -1 if at <= max_context else None

    number, low, left = 0, 0, -1
    while low < len(text):
        high = low + size
        if high < len(text):
            found = _CUT.search(text, high)
            right = found.start() if found else len(text)
            begin = cut_before(high)
            if begin is None or right - high > max_context:
                high = begin = right  # no cut near: the range ends at the next one
        else:
            high = right = begin = len(text)
        start = len(text[left + 1 : low].encode()) + (number > 0 and low > left)
        yield number, text[left + 1 : right], start, 1 + len(text[left + 1 : high].encode())
        number, low, left = number + 1, high, begin


def runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(from, to) of runs that reach a limit with their last size; the last may not."""
    at, total = 0, 0
    for i, size in enumerate(sizes.tolist(), 1):
        total += size
        if total >= limit:
            yield at, i
            at, total = i, 0
    if at < len(sizes):
        yield at, len(sizes)


@dataclass
class Pairs:
    """Distinct pairs of some units: `codes` with `counts` over all; those of unit i are
    codes[pair], each `times`, of first_pair[i] up to first_pair[i + 1]."""

    codes: np.ndarray
    counts: np.ndarray
    first_pair: np.ndarray
    pair: np.ndarray
    times: np.ndarray

    @staticmethod
    def joined(parts: list["Pairs"]) -> "Pairs":
        codes, of = np.unique(np.concatenate([p.codes for p in parts]), return_inverse=True)
        counts = np.zeros(len(codes), np.int64)
        np.add.at(counts, of, np.concatenate([p.counts for p in parts]))
        pair, first_pair, at, size = [], [np.zeros(1, np.int64)], 0, 0
        for p in parts:
            pair.append(of[at : at + len(p.codes)][p.pair])
            first_pair.append(p.first_pair[1:] + size)
            at, size = at + len(p.codes), size + len(p.pair)
        return Pairs(codes, counts, np.concatenate(first_pair), np.concatenate(pair), np.concatenate([p.times for p in parts]))


class Slice:
    """Tokens, links and groups of some units (of whole texts, or one range)."""

    def __init__(self, units: list[str], tools: Encoders, low: int = 0, high: int | None = None):
        tokens = tools.encode(units)
        padded = [b" " + u.encode() if u else b"" for u in units]
        self.valid = np.array(
            [bool(p) and tools.a.gives(a, p) and tools.b.gives(b, p) for p, (a, b) in zip(padded, tokens)], bool
        )
        none = np.zeros(0, np.int32)
        kept = [t if ok else (none, none) for t, ok in zip(tokens, self.valid)]
        self.a = np.concatenate([a for a, _ in kept]) if kept else none
        self.b = np.concatenate([b for _, b in kept]) if kept else none
        self.a_end = np.cumsum(tools.a.length[self.a])
        self.b_end = np.cumsum(tools.b.length[self.b])
        # behind each unit
        self.bound = np.cumsum([len(p) if ok else 0 for p, ok in zip(padded, self.valid)])
        # 1 where a token of A ends, 2 where one of B does
        mark = np.zeros((self.bound[-1] if units else 0) + 1, np.uint8)
        mark[self.a_end] = 1
        mark[self.b_end] += 2
        ends = np.flatnonzero(mark)
        sides = mark[ends]
        self.shared = ends[sides == 3]
        # a link for each part between neighbouring ends: its tokens are the next to end
        next_a, next_b = np.cumsum(sides & 1) - (sides & 1), np.cumsum(sides >> 1) - (sides >> 1)
        if high is not None:
            inside = (ends > low) & (ends <= high)
            ends, next_a, next_b = ends[inside], next_a[inside], next_b[inside]
        code = (self.a[next_a] * PIECES + self.b[next_b]).astype(np.int32)
        codes, of, counts = np.unique(code, return_inverse=True, return_counts=True)
        unit = np.repeat(np.arange(len(units)), self.per_unit(ends))
        pairs = unit * max(1, len(codes)) + of
        pairs, times = np.unique(pairs, return_counts=True)
        unit, pair = np.divmod(pairs, max(1, len(codes)))
        first_pair = np.searchsorted(unit, np.arange(len(units) + 1))
        self.pairs = Pairs(codes, counts, first_pair, pair, times)
        self.n_links = np.add.reduceat(np.append(times, 0), first_pair[:-1]) if len(units) else none
        self.n_links[np.diff(first_pair) == 0] = 0

    def per_unit(self, ends: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(ends, self.bound, "right"), prepend=0)

    def digests(self) -> list[str]:
        """Digest of each whole text's groups."""
        text, group_end = render(self.a, self.a_end, self.b, self.b_end, self.shared)
        last = np.searchsorted(self.shared, self.bound, "right")
        stops = np.concatenate(([0], group_end))[last].tolist()
        out, at = [], 0
        for ok, stop in zip(self.valid, stops):
            out.append(hashlib.sha256(text[at : stop - 1].tobytes()).hexdigest() if ok else "")
            at = stop
        return out

    def fragment(self, low: int, high: int) -> tuple[int, int, int, bytes, tuple, tuple]:
        """n_a, n_b, n_groups, text of the closed groups, prefix and suffix of a range."""
        a = slice(*np.searchsorted(self.a_end, [low, high], "right"))
        b = slice(*np.searchsorted(self.b_end, [low, high], "right"))
        shared = self.shared[slice(*np.searchsorted(self.shared, [low, high], "right"))]
        ids_a, end_a, ids_b, end_b = self.a[a], self.a_end[a], self.b[b], self.b_end[b]
        if not len(shared):
            return len(ids_a), len(ids_b), 0, b"", (ids_a, ids_b), (ids_a[:0], ids_b[:0])
        fa, la = np.searchsorted(end_a, shared[[0, -1]], "right")
        fb, lb = np.searchsorted(end_b, shared[[0, -1]], "right")
        text, _ = render(ids_a[fa:la], end_a[fa:la], ids_b[fb:lb], end_b[fb:lb], shared[1:])
        closed = text[:-1].tobytes()
        return len(ids_a), len(ids_b), len(shared), closed, (ids_a[:fa], ids_b[:fb]), (ids_a[la:], ids_b[lb:])


def _trim() -> None:
    """Give freed memory back to the system: the worker stays and has later tasks."""
    if sys.platform == "linux":
        release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if release is not None:
            release(0)


_INTS = "array<int>"
_LONGS = "array<bigint>"
_FRAGMENT = "prefix_a array<int>, prefix_b array<int>, closed boolean, suffix_a array<int>, suffix_b array<int>"


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


def _slices(rows: DataFrame, params: AlignParams) -> DataFrame:
    """Encoded slices: of whole texts, many to a row; of ranges, one to a row.

    `rows` has doc_id, text, and for ranges key, chunk, low and high (else NULL).
    """
    kind = to_arrow_type(rows.schema["doc_id"].dataType)
    names = "slice codes counts ids n_a n_b n_groups n_links digest first_pair pair times key chunk valid".split()
    names += "closed_text prefix_a prefix_b closed suffix_a suffix_b".split()
    schema = T.StructType(
        [
            T.StructField("slice", T.LongType()),
            *T._parse_datatype_string(f"codes {_INTS}, counts {_INTS}").fields,
            T.StructField("ids", T.ArrayType(rows.schema["doc_id"].dataType)),
            *T._parse_datatype_string(
                f"n_a {_LONGS}, n_b {_LONGS}, n_groups {_LONGS}, n_links {_LONGS}, digest array<string>, "
                f"first_pair {_INTS}, pair {_INTS}, times {_INTS}, key bigint, chunk bigint, valid boolean, "
                f"closed_text binary, {_FRAGMENT}"
            ).fields,
        ]
    )
    files = (params.tokenizer, params.ranks, params.pieces)
    limit, part = params.slice_bytes, params.part_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = encoders(*files)
        number = TaskContext.get().partitionId() << 33

        def row(found: Pairs, ids: pa.Array, numbers: list, digests: list, rest: list) -> pa.RecordBatch:
            nonlocal number
            one = [
                pa.array([number], pa.int64()),
                *[_lists(x.astype(np.int32), np.array([0, len(x)])) for x in (found.codes, found.counts)],
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                *[_lists(np.asarray(x, np.int64), np.array([0, len(x)])) for x in numbers],
                pa.array([digests], pa.list_(pa.string())),
                *[_lists(x.astype(np.int32), np.array([0, len(x)])) for x in (found.first_pair, found.pair, found.times)],
            ]
            types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), *[pa.list_(pa.int32())] * 2, pa.bool_(), *[pa.list_(pa.int32())] * 2]
            number += 1
            return pa.RecordBatch.from_arrays([*one, *[pa.array([v], t) for v, t in zip(rest, types)]], names=names)

        def whole(ids: pa.Array, texts: pa.Array, sizes: np.ndarray) -> pa.RecordBatch:
            pairs, counts, digests = [], [], []
            for low, high in runs(sizes, part):
                found = Slice(texts.slice(low, high - low).to_pylist(), tools)
                pairs.append(found.pairs)
                counts.append([*[found.per_unit(x) for x in (found.a_end, found.b_end, found.shared)], found.n_links])
                digests += found.digests()
            return row(Pairs.joined(pairs), ids, [np.concatenate(x) for x in zip(*counts)], digests, [None] * 9)

        def one_range(ids: pa.Array, unit: str, key: int, chunk: int, low: int, high: int) -> pa.RecordBatch:
            found = Slice([unit], tools, low, high)
            n_a, n_b, n_groups, text, prefix, suffix = found.fragment(low, high)
            lists = [x.astype(np.int32) for x in (*prefix, *suffix)]
            rest = [key, chunk, bool(found.valid[0]), text, *lists[:2], n_groups > 0, *lists[2:]]
            return row(found.pairs, ids, [[n_a], [n_b], [n_groups], found.n_links], [None], rest)

        for batch in batches:
            ids, texts = batch.column(0).cast(kind), batch.column(1)
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            keys, chunk, low, high = (batch.column(i).to_pylist() for i in range(2, 6))
            at = 0
            for i in [*[i for i, key in enumerate(keys) if key is not None], len(batch)]:
                for x, y in runs(sizes[at:i], limit):
                    yield whole(ids.slice(at + x, y - x), texts.slice(at + x, y - x), sizes[at + x : at + y])
                if i < len(batch):
                    yield one_range(ids.slice(i, 1), texts[i].as_py(), keys[i], chunk[i], low[i], high[i])
                at = i + 1
        batch = ids = texts = sizes = None
        _trim()

    return rows.mapInArrow(run, schema)


def _split(long: DataFrame, params: AlignParams) -> DataFrame:
    """Ranges of long texts, dealt over tasks of their own."""
    kind = long.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", kind), *T._parse_datatype_string("text string, key bigint, chunk bigint, low bigint, high bigint").fields]
    size, context = params.chunk_chars, params.max_context

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (text, key) in enumerate(zip(batch.column("text").to_pylist(), batch.column("key").to_pylist())):
                for number, unit, low, high in chunks(text, size, context):
                    values = [pa.array([v], t) for v, t in zip((unit, key, number, low, high), (pa.string(), *[pa.int64()] * 4))]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 1), *values], names=[f.name for f in fields])

    keyed = long.withColumn("key", F.monotonically_increasing_id())
    return keyed.mapInArrow(run, T.StructType(fields)).repartition("key", "chunk")


def _reduce(fragments: DataFrame) -> DataFrame:
    """Seams (key, place, text) of each long text, by a tree of compositions.

    Each level folds runs of `FAN` neighbours, until one fragment a text is left; its
    prefix and suffix are the first and the last group (the suffix is empty).
    """
    spark = fragments.sparkSession
    schema = f"key bigint, chunk bigint, first bigint, {_FRAGMENT}, place bigint, seam string"

    def fold(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        key, out, whole = rows[0]["key"], [], None
        for r in rows:
            part = Fragment((r["prefix_a"], r["prefix_b"]), r["closed"], (r["suffix_a"], r["suffix_b"]), r["first"])
            if whole is None:
                whole = part
                continue
            whole, seam = whole + part
            if seam is not None:
                out.append({"key": key, "place": seam[0], "seam": seam[1]})
        kept = {"key": key, "chunk": rows[0]["chunk"] // FAN, "first": whole.first, "closed": whole.closed}
        kept |= {"prefix_a": whole.prefix[0], "prefix_b": whole.prefix[1], "suffix_a": whole.suffix[0], "suffix_b": whole.suffix[1]}
        return pa.Table.from_pylist([kept, *out], schema=arrow)

    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in T._parse_datatype_string(schema).fields])
    level, seams = fragments.withColumn("first", F.col("chunk")), []
    while True:
        last = level.agg(F.max("chunk")).first()[0] or 0
        level = level.withColumn("parent", F.floor(F.col("chunk") / F.lit(FAN)))
        folded = staged(level.groupBy("key", "parent").applyInArrow(fold, schema), "fragments")
        seams.append(folded.where("seam IS NOT NULL").select("key", "place", F.col("seam").alias("text")))
        level = folded.where("seam IS NULL").drop("place", "seam")
        if last < FAN:
            break
    ends = level.select(
        "key",
        (2 * F.col("first") - 1).alias("place"),
        F.concat(F.array_join("prefix_a", ","), F.lit("|"), F.array_join("prefix_b", ",")).alias("text"),
    )
    for more in seams:
        ends = ends.unionByName(more)
    return ends


def _digests(pieces: DataFrame) -> DataFrame:
    """(key, digest) of the pieces (key, place, text) in order, read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            found = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                if k != key:
                    if key is not None:
                        found.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b";")
                state.update(text.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.string()))], names=["key", "digest"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "digest"])

    ordered = pieces.select("key", "place", F.col("text").cast("binary").alias("text"))
    ordered = ordered.repartition("key").sortWithinPartitions("key", "place")
    return ordered.mapInArrow(run, "key bigint, digest string")


def pair_counts(slices: DataFrame) -> DataFrame:
    """code, total and best (no pair of its B id has a greater total) over all slices."""
    each = slices.select(F.inline(F.arrays_zip("codes", "counts")))
    totals = each.groupBy(F.col("codes").alias("code")).agg(F.sum("counts").alias("total"))
    piece = F.col("code") % F.lit(PIECES)
    most = totals.groupBy(piece.alias("piece")).agg(F.max("total").alias("most"))
    joined = totals.withColumn("piece", piece).join(F.broadcast(most), "piece")  # PIECES rows at most
    return joined.select("code", "total", (F.col("total") == F.col("most")).alias("best"))


def _with_sums(slices: DataFrame, kind: T.DataType) -> DataFrame:
    """Rows of documents and ranges with n_best and count_sum."""
    each = slices.select("slice", F.posexplode("codes").alias("at", "code"))
    answers = each.join(pair_counts(slices), "code").groupBy("slice").agg(
        F.sort_array(F.collect_list(F.struct("at", "total", "best"))).alias("answer")
    )
    rows = slices.drop("codes", "counts", "closed_text").join(
        answers.select("slice", F.col("answer.total").alias("totals"), F.col("answer.best").alias("bests")), "slice", "left"
    )
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    fields = [T.StructField("doc_id", kind), *[T.StructField(n, T.LongType()) for n in (*numbers, "n_best", "count_sum")]]
    fields += [T.StructField("digest", T.StringType()), T.StructField("key", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flat(column: str, i: int) -> np.ndarray:
            values = batch.column(column)[i].values
            return np.zeros(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False)

        for batch in batches:
            for i in range(len(batch)):
                first, pair, times = (flat(c, i) for c in ("first_pair", "pair", "times"))
                times, totals, best = times.astype(np.int64), flat("totals", i).astype(np.int64), flat("bests", i).astype(bool)
                sums = [
                    np.diff(np.concatenate(([0], np.cumsum(x)))[first])
                    for x in ((times * best[pair], times * totals[pair]) if len(pair) else (pair, pair))
                ]
                ids = batch.column("ids")[i].values
                columns = [ids, *[batch.column(n)[i].values for n in numbers], *[pa.array(s, pa.int64()) for s in sums]]
                key = pa.array([batch.column("key")[i].as_py()] * len(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, batch.column("digest")[i].values, key], names=[f.name for f in fields])

    wanted = ("ids", *numbers, "digest", "first_pair", "pair", "times", "key", "totals", "bests")
    return rows.select(*wanted).mapInArrow(run, T.StructType(fields))


def align(docs: DataFrame, params: AlignParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair
    is the most frequent of its B id), count_sum (of the links' pair counts) and
    groups_sha256.
    """
    params = params or AlignParams()
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    long = F.length("text") > params.chunk_chars
    empty = [F.lit(None).cast("bigint").alias(n) for n in ("key", "chunk", "low", "high")]
    units = rows.where(~long).select("doc_id", "text", *empty).unionByName(_split(rows.where(long), params))
    slices = staged(_slices(units, params), "alignment")
    ranges = slices.where("key IS NOT NULL")
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    if ranges.isEmpty():
        return _with_sums(slices, kind).select("doc_id", *names, F.col("digest").alias("groups_sha256"))
    # A range without its bytes voids the whole text, before its pairs are counted.
    judged = ranges.groupBy("key").agg(F.bool_and("valid").alias("sound"))
    sound = staged(judged.where("sound").select("key"), "sound")
    counted = slices.where("key IS NULL").unionByName(slices.join(sound, "key", "left_semi").select(*slices.columns))
    sums = _with_sums(counted, kind)
    fragments = ranges.join(sound, "key", "left_semi")
    seams = _reduce(fragments.select("key", "chunk", "prefix_a", "prefix_b", "closed", "suffix_a", "suffix_b"))
    bodies = fragments.where("length(closed_text) > 0").select(
        "key", (2 * F.col("chunk")).alias("place"), F.col("closed_text").cast("string").alias("text")
    )
    digests = _digests(seams.unionByName(bodies))
    totals = sums.where("key IS NOT NULL").groupBy("key").agg(F.first("doc_id").alias("doc_id"), *[F.sum(n).alias(n) for n in names])
    done = totals.join(digests, "key").select("doc_id", *names, F.col("digest").alias("groups_sha256"))
    void = (
        judged.where("NOT sound")
        .join(ranges.where("chunk = 0").select("key", F.get("ids", F.lit(0)).alias("doc_id")), "key")
        .select("doc_id", *[F.lit(0).cast("bigint").alias(n) for n in names], F.lit("").alias("groups_sha256"))
    )
    whole = sums.where("key IS NULL").select("doc_id", *names, F.col("digest").alias("groups_sha256"))
    return whole.unionByName(done).unionByName(void)
