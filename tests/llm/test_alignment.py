"""Alignment of tokenizers against a plain version, whole and in ranges."""

import hashlib
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from lawgrain.llm import alignment as A, queries

ODD = [
    None,
    "",
    " ",
    "a▁b " * 30,
    "<|endoftext|>x <s> " * 9,
    "x" * 500,
    " \n\t  a  b" * 40,
    "日本語テキスト é ü " * 30,
    "a\0b ﻿​c",
]
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_of_char():
    """Byte of each character of a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def plain_version(rows):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    chars = byte_of_char()

    def left_bytes(i):
        return bytes(chars[c] for c in left.id_to_token(i))

    def right_bytes(i):
        piece = right.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()

    def ranges(ids, data):
        at = 0
        for i in ids:
            yield at, at + len(data(i)), i
            at += len(data(i))

    out, links = [], []
    for text in rows:
        data = (" " + text).encode() if text else b""
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        if not text or b"".join(map(left_bytes, a)) != data or b"".join(map(right_bytes, b)) != data:
            out.append(None)
            links.append([])
            continue
        a, b = list(ranges(a, left_bytes)), list(ranges(b, right_bytes))
        found, j = [], 0
        for low, high, i in a:
            while b[j][1] <= low:
                j += 1
            k = j
            while k < len(b) and b[k][0] < high:
                found.append((i, b[k][2]))
                k += 1
        links.append(found)
        groups = []
        ends = sorted({x[1] for x in a} & {x[1] for x in b})
        for low, high in zip([0, *ends], ends):
            inside = [",".join(str(i) for s, e, i in side if low < e <= high) for side in (a, b)] if len(ends) < 400 else None
            groups.append(inside)
        if None in groups:  # long texts: one pass
            groups, side_a, side_b = [], iter(a), iter(b)
            for high in ends:
                parts = []
                for side in (side_a, side_b):
                    part = []
                    for s, e, i in side:
                        part.append(str(i))
                        if e == high:
                            break
                    parts.append(",".join(part))
                groups.append(parts)
        text_of = ";".join("|".join(g) for g in groups)
        out.append((len(a), len(b), len(groups), len(found), hashlib.sha256(text_of.encode()).hexdigest()))
    count = Counter(x for found in links for x in found)
    best = defaultdict(int)
    for (_, i), n in count.items():
        best[i] = max(best[i], n)
    return [
        (0,) * 6 + ("",) if o is None else (*o[:4], sum(count[x] == best[x[1]] for x in f), sum(count[x] for x in f), o[4])
        for o, f in zip(out, links)
    ]


@pytest.fixture(scope="module")
def texts(corpus):
    return [*ODD, *[t for _, t in corpus[:60]]]


@pytest.fixture(scope="module")
def want(texts):
    return plain_version(texts)


@pytest.mark.parametrize("size, context", [(1 << 20, 1 << 16), (1500, 200), (37, 5)])
def test_whole_texts_and_ranges(spark, texts, want, size, context):
    few = len(texts) if size > 1000 else 24  # tiny ranges of a few texts
    expected = want if few == len(texts) else plain_version(texts[:few])
    docs = spark.createDataFrame(list(enumerate(texts[:few])), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in A.align(docs, A.AlignParams(chunk_chars=size, max_context=context)).collect()}
    assert got == dict(enumerate(expected))


def test_the_registered_query(spark, data, corpus):
    expected = dict(zip((i for i, _ in corpus), plain_version([t for _, t in corpus])))
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in queries.op13_tokenizer_alignment(spark, data).collect()}
    assert got == expected


def test_composition_is_associative():
    open_part = A.Fragment(([1], [2]), False, ([], []), 9)
    parts = [A.Fragment(([i], [i, i]), True, ([10 * i], [20 * i]), i) for i in (1, 2, 3)] + [open_part]

    def fold(left, right):
        (x, seams), (y, more) = left, right
        whole, seam = x + y
        return whole, sorted([*seams, *more, *([seam] if seam else [])])

    one = [(p, []) for p in parts]
    for order in ([0, 1, 2], [0, 3, 1], [3, 0, 3], [0, 3, 3], [1, 2, 3]):
        x, y, z = (one[i] for i in order)
        assert fold(fold(x, y), z) == fold(x, fold(y, z))


def test_ids_of_any_type_repeats_and_clashing_columns(spark):
    rows = [("x", "one two", 1, 2), ("x", "one two", 1, 2), (None, "a b c" * 50, 1, 2), ("z", None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, key int, slice int")
    for size in (1 << 20, 20):
        got = A.align(docs, A.AlignParams(chunk_chars=size)).collect()
        assert sorted(str(r["doc_id"]) for r in got) == ["None", "x", "x", "z"]
        one, two = (tuple(r) for r in got if r["doc_id"] == "x")
        assert one == two and one[1] > 0
    assert A.align(docs.where("false")).count() == 0


def test_a_slice_holds_the_tokens_of_a_part_only(spark, monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    class Rows:
        schema = T.StructType.fromDDL("doc_id bigint, text string, key bigint, chunk bigint, low bigint, high bigint")
        mapInArrow = staticmethod(lambda run, schema: run)

    monkeypatch.setattr(A, "TaskContext", Task)
    words = "The alignment of 12 tokens, grouped by their common ends; one after another. "
    texts = [f"{i} " + words * 50 for i in range(500)]
    long = words * 12_000
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(501), pa.int64()),
            pa.array([*texts, long]),
            *[pa.array([None] * 500 + [v], pa.int64()) for v in (7, 0, 0, 1 + len(long))],
        ],
        names=Rows.schema.names,
    )
    list(A._slices(Rows, A.AlignParams())(iter([batch.slice(0, 1), batch.slice(500)])))  # tokenizers are loaded
    for some, limit in ((batch.slice(0, 500), 40 << 20), (batch.slice(500), 45 << 20)):
        tracemalloc.start()
        rows = list(A._slices(Rows, A.AlignParams())(iter([some])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(len(r["ids"][0].values) for r in rows) == len(some)
        assert peak < limit
