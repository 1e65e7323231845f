"""Texts of an Arrow batch as byte arrays: words, hashes and positions in numpy.

A batch is cut into slices of bounded bytes (one text is never cut), so the arrays
made from a slice stay small whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# 64-bit mixing constants (odd), and one value per byte for word hashes.
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _MUL
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(20, (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        step, b = 1, base
        while step < size:
            have[step : 2 * step] = have[:step] * np.uint64(b)
            step, b = 2 * step, b * b % (1 << 64)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


class Texts:
    """Concatenated UTF-8 bytes of some texts with their offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    @staticmethod
    def of(texts: list[str | None]) -> "Texts":
        parts = [(t or "").encode() for t in texts]
        offsets = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=offsets[1:])
        return Texts(np.frombuffer(b"".join(parts), np.uint8), offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def parts(self, limit: int = SLICE_BYTES) -> Iterator["Texts"]:
        """Runs of whole texts with up to `limit` bytes (or one text) each."""
        at = 0
        while at < len(self):
            to = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + limit, "right")) - 1)
            low, high = self.offsets[at], self.offsets[to]
            yield Texts(self.data[low:high], self.offsets[at : to + 1] - low)
            at = to

    def bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def words(self, lower: bool = True) -> "Words":
        return Words(LOWER[self.data] if lower else self.data, self.offsets)

    def tokens(self) -> "Words":
        """Runs of letters and digits (all beyond ASCII taken as letters), case folded
        in ASCII and Latin-1."""
        data = LOWER[self.data]
        if len(data) > 1:
            after = data[1:]
            capital = (data[:-1] == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
            data[1:][capital] += 32
        return Words(data, self.offsets, PUNCTUATION)


class Words:
    """Maximal runs of non-separators; a run never crosses texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR):
        solid = ~separator[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        first = first[: len(data)]
        before = np.empty_like(solid)
        before[:1] = False
        before[1:] = solid[:-1]
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(solid & (~before | first))
        ends = solid.copy()
        ends[:-1] &= ~solid[1:] | first[1:]
        self.end = np.flatnonzero(ends) + 1
        # words of text i: first_word[i] up to first_word[i + 1]
        self.first_word = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first_word))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes, the same in every batch and process."""
        return run_hashes(self.data, self.start, self.end)


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end], by differences of one prefix sum."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    values = (sums[end] - sums[start]) * powers(_BASE_INVERSE, len(data) + 1)[start]
    return mix(values + (end - start).astype(np.uint64) * _MUL)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch with up to `limit` bytes of text (or one text) each; NULL is empty."""
    column = batch.column(batch.schema.get_field_index(text))
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, values = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), Texts(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to
