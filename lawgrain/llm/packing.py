"""Packing of token sequences under several limits at once.

Vector bin packing: an item has a size in tokens, segments (one) and loss-bearing
tokens, a sequence a limit on each. The dot-product heuristic fills one sequence at a
time and takes, of the items that fit, the one whose sizes best match what is left of
the limits. Items may be cut: when none fits, or the last segment is reached, the
greatest item is cut to fill the sequence and its rest goes on as an item.

A partition is packed in one pass over its Arrow batches: whole sequences leave, and
only items that do not fill one wait for the next batch, so memory is bounded by a
slice of texts (or one text) and nothing is shuffled.

Defined results: a NULL or empty text is its end token alone; a repeated row is packed
again under the same id; an empty table gives no pieces. The last sequence of a
partition is the only one that may be short, except where the segment or loss limit
closes a sequence early.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from lawgrain.llm.texts import slices

SPECIAL = "<|endoftext|>"
# Characters for which both tokenizer libraries share one idea of letters, digits and spaces.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa0-ɏ‐-‧]")


@dataclass(frozen=True)
class PackParams:
    max_tokens: int = 1024
    max_segments: int = 64
    max_loss: int = 1024
    end_id: int = 0
    tokenizer: str = "byte_bpe_50k.json"
    ranks: str | None = "byte_bpe_50k.tiktoken"  # the same vocabulary; None: not used
    with_ids: bool = True


@cache
def encoder(tokenizer: str, ranks: str | None) -> Callable[[str], np.ndarray]:
    """Text to ids of a `tokenizers` file, no special tokens added.

    Where a rank file of the same vocabulary is given, plain texts take the faster
    library; texts with the special token's string or unusual characters never do.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(tokenizer))

    def exact(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    if ranks is None:
        return exact
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text or _UNUSUAL.search(text):
            return exact(text)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


class Packer:
    """Fills one sequence after the other from the items added so far."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int):
        self.limits = np.array([max_tokens, max_segments, max_loss], float)
        self.piece = min(max_tokens, max_loss)
        self.heap: dict[tuple[int, int], list] = {}  # (tokens, loss) -> (item, start)

    def add(self, item: object, tokens: int, loss: int, start: int = 0) -> Iterator[list[tuple]]:
        """Sequences that the item fills alone; the rest of it waits.

        The last tokens - loss tokens of an item bear no loss.
        """
        while min(tokens, loss) >= self.piece:
            yield [(item, start, self.piece)]
            start, tokens, loss = start + self.piece, tokens - self.piece, loss - self.piece
        if tokens:
            self.heap.setdefault((tokens, loss), []).append((item, start))

    def waiting(self) -> int:
        return sum(t * len(v) for (t, _), v in self.heap.items())

    def _take(self, kind: tuple[int, int]) -> tuple:
        rows = self.heap[kind]
        got = rows.pop()
        if not rows:
            del self.heap[kind]
        return got

    def fill(self, last: bool = False) -> Iterator[list[tuple]]:
        """Sequences as lists of (item, start, tokens); `last` also gives short ones."""
        while self.heap and (last or self.waiting() >= self.limits[0]):
            left = self.limits.copy()
            sequence = []
            while self.heap and left.min() >= 1:
                sizes = np.array(list(self.heap), float)
                sizes = np.column_stack((sizes[:, 0], np.ones(len(sizes)), sizes[:, 1]))
                fits = (sizes <= left).all(axis=1)
                if left[1] == 1:  # the last segment should fill what is left
                    fits &= sizes[:, 0] >= min(left[0], sizes[:, 0].max())
                if fits.any():
                    score = np.where(fits, (sizes / self.limits) @ (left / self.limits), -1.0)
                    kind = list(self.heap)[int(score.argmax())]
                    item, start = self._take(kind)
                    used = kind
                else:
                    kind = max(self.heap)
                    item, start = self._take(kind)
                    n = int(min(kind[0], left[0], left[2]))
                    used = (n, min(n, kind[1]))
                    rest = (kind[0] - n, kind[1] - used[1])
                    if rest[0]:
                        self.heap.setdefault(rest, []).append((item, start + n))
                sequence.append((item, start, used[0]))
                left -= (used[0], 1, used[1])
            yield sequence


def padded(tokens: int, limit: int) -> int:
    """Length of a sequence after padding: a power of two stays as it is."""
    return tokens if tokens & (tokens - 1) == 0 else limit


def pack(
    docs: DataFrame, params: PackParams | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece of a document.

    doc_id; start (tokens of the document before it); length; ids_crc32 (of its
    little-endian 32-bit ids); doc_tokens; sequence_id; offset (in the sequence);
    loss_tokens (all but the end token); padded_length (of its sequence); and, with
    `with_ids`, ids.
    """
    params = params or PackParams()
    names = (
        "doc_id start length ids_crc32 doc_tokens sequence_id offset loss_tokens padded_length".split()
    )
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType
    kinds = [to_arrow_type(id_type), *[pa.int64()] * (len(names) - 1)]
    schema = f"doc_id {id_type.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:])
    schema += ", ids array<int>" if params.with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(params.tokenizer, params.ranks)
        packer = Packer(params.max_tokens, params.max_segments, params.max_loss)
        number = TaskContext.get().partitionId() << 33
        pieces: list[tuple] = []

        def record(sequence: list[tuple]) -> None:
            nonlocal number
            at = 0
            whole = padded(sum(n for _, _, n in sequence), params.max_tokens)
            for (doc_id, ids), start, n in sequence:
                piece = ids[start : start + n]
                crc = zlib.crc32(piece.astype("<u4").tobytes())
                loss = n - (start + n == len(ids))
                row = (doc_id, start, n, crc, len(ids), number, at, loss, whole)
                pieces.append((*row, piece) if params.with_ids else row)
                at += n
            number += 1

        def out() -> pa.RecordBatch:
            columns = list(zip(*pieces)) or [()] * (len(names) + params.with_ids)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            if params.with_ids:
                arrays.append(pa.array([p.astype(np.int32) for p in columns[-1]], pa.list_(pa.int32())))
            pieces.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[*names, *["ids"] * params.with_ids])

        for batch in batches:
            for part, texts in slices(batch, "text", 4 << 20):
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    ids = np.append(encode(texts.bytes(i).decode("utf-8", "replace")), np.uint32(params.end_id))
                    for sequence in packer.add((doc_id, ids), len(ids), len(ids) - 1):
                        record(sequence)
                for sequence in packer.fill():
                    record(sequence)
                yield out()
        for sequence in packer.fill(last=True):
            record(sequence)
        yield out()

    return rows.mapInArrow(run, schema)
