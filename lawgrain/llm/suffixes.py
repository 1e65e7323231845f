"""Suffix arrays in numpy: refinement by Larsson and Sadakane, prefixes by Kasai."""

from __future__ import annotations

import numpy as np

from lawgrain.llm.texts import run_hashes


def packed(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one big-endian number, zeros past the end."""
    wide = np.concatenate((data.astype(np.uint64), np.zeros(8, np.uint64)))
    two = (wide[:-1] << np.uint64(8)) | wide[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    return ((four[:-4] << np.uint64(32)) | four[4:])[: len(data)]


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes of `data` (fewer than 2**31 bytes) in order.

    Suffixes are sorted by seven bytes; then only groups that are still tied are sorted
    by the ranks of the suffixes h bytes on, and h doubles, until none is tied. (Kasai's
    rule needs the whole order, also among suffixes that share all bytes of interest.)
    """
    n = len(data)
    # seven bytes, and how many there are: a suffix that ends sooner has a rank of its own
    keys = packed(data) & ~np.uint64(0xFF)
    keys |= np.minimum(n - np.arange(n), 7).astype(np.uint64)
    order = np.argsort(keys, kind="stable").astype(np.int32)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if n else np.zeros(0, np.int64)
    del keys
    size = np.diff(np.append(first, n))
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1
    rank[order] = np.repeat(first, size)
    tied = np.flatnonzero(np.repeat(size, size) > 1).astype(np.int32)
    h = 7
    while len(tied):
        suffix = order[tied]
        key = (rank[suffix].astype(np.int64) << 32) | (rank[suffix + h] + 1)
        by = np.argsort(key, kind="stable")
        key, suffix = key[by], suffix[by]
        order[tied] = suffix
        new = np.append(True, key[1:] != key[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(key)))
        rank[suffix] = np.repeat(tied[begin], size)
        tied = tied[np.repeat(size, size) > 1]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int, lane: int = 512) -> np.ndarray:
    """Common prefix of each suffix with the one before it in `order`, up to `limit`.

    Kasai's rule, a suffix shares at least one byte less with its neighbour than the
    suffix one byte earlier does, is followed in many lanes of the text side by side;
    a lane goes on comparing eight bytes at a time from where its last prefix ended.
    """
    n = len(data)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    words = np.concatenate((packed(data), np.zeros(limit + 16, np.uint64)))
    prefix = np.zeros(n, np.int16 if limit < 1 << 15 else np.int32)
    starts = np.arange(0, n, lane)
    length = np.zeros(len(starts), np.int64)
    for step in range(min(lane, n)):
        at = starts + step
        if at[-1] >= n:
            at = at[:-1]
        length = np.maximum(length[: len(at)] - 1, 0)
        other = before[at].astype(np.int64)
        length[other < 0] = 0
        going = np.flatnonzero((other >= 0) & (length < limit))
        while len(going):
            a, b, l = at[going], other[going], length[going]
            differ = words[a + l] ^ words[b + l]
            room = np.minimum(n - np.maximum(a, b) - l, limit - l)
            same = np.full(len(going), 8)
            odd = np.flatnonzero(differ)
            # leading equal bytes of a word: by its highest differing bit
            bits = np.zeros(len(odd), np.int64)
            d = differ[odd]
            for shift in (32, 16, 8):
                high = (d >> np.uint64(shift)) != 0
                bits += np.where(high, shift, 0)
                d = np.where(high, d >> np.uint64(shift), d)
            same[odd] = 7 - bits // 8
            gain = np.minimum(same, room)
            length[going] = l + gain
            going = going[(gain == 8) & (length[going] < limit)]
        prefix[at] = length
    out = np.zeros(n, prefix.dtype)
    out[1:] = prefix[order[1:]]
    return out


def anchors(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each `gram` bytes, and the least of them within each `window` bytes.

    The second depends on the window's bytes alone, so equal windows share it.
    """
    n = len(data) - gram + 1
    start = np.arange(n)
    hashes = run_hashes(data, start, start + gram)
    least, width, span = hashes, 1, window - gram + 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    return hashes, np.minimum(least[:-rest], least[rest:]) if rest else least
