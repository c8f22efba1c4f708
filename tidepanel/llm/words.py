"""Vectorised word splitting and hashing on Arrow string columns.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z lowered. Both rules act on
ASCII bytes only, which never occur inside a multi-byte UTF-8 character, so whole batches are handled
as one byte array without a Python loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
HELD = 1 << 20
_powers = {"n": 0, "up": np.ones(0, np.uint64), "down": np.ones(0, np.uint64)}


def _powers_of(base: np.uint64, size: int) -> np.ndarray:
    table = np.full(size, base, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(1 << (n - 1).bit_length(), 1 << 16)
        if size > HELD:  # a very long text's tables go with it
            return tuple(_powers_of(base, size) for base in (_BASE, _UNBASE))
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            _powers[name] = _powers_of(base, size)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows in them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, block: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the offsets of the rows in them.

    Rows are taken together up to `block` bytes, so memory stays bounded by the block or the longest row.
    """
    out, counts = [], np.zeros(len(offsets) - 1, np.int64)
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block, "right")) - 1)
        starts, rows, hashes = hashed_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        out.append(hashes)
        counts[i:j] = np.diff(rows)
        i = j
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(counts)))


def hashed_words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, rows, hashes): where each word begins, the rows' offsets in the words, and the words' hashes.

    apart tells of each of the 256 bytes whether it stands between words.
    """
    none = np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64)
    if len(data) == 0:
        return none
    inside = ~apart[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    begins[cuts] = inside[cuts]  # a row starts a new word
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        return none
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    weighted = np.where(inside, _BYTE[data], np.uint64(0)) * up[: len(data)]
    np.cumsum(weighted, out=sums[1:])
    ends = np.append(starts[1:], len(data))  # what lies between words weighs nothing
    return starts, np.searchsorted(starts, offsets), mix((sums[ends] - sums[starts]) * down[starts])


def word_texts(data: np.ndarray, starts: np.ndarray, which: np.ndarray, apart: np.ndarray = _SPACE) -> list[str]:
    """Some of the words that begin at starts, as they stand."""
    gaps = np.append(np.flatnonzero(apart[data]), len(data))
    begin = starts[which]
    sizes = np.minimum(gaps[np.searchsorted(gaps, begin)], np.append(starts, len(data))[which + 1]) - begin
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    found = data[np.repeat(begin - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(found)).to_pylist()


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; with fewer words, of the whole sequence."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    acc = np.full(n - width + 1, np.uint64(width))
    for j in range(width):
        acc = (acc * _BASE + words[j : n - width + 1 + j]) ^ (acc >> np.uint64(29))
    return mix(acc)


def _words_back(data: np.ndarray, start: int, at: int, apart: np.ndarray, k: int) -> tuple[int, int]:
    """Where the k-th last word before `at` begins, not before `start`, and how many words that takes in."""
    reach = 256
    while True:
        low = max(start, at - reach)
        gap = apart[data[low:at]]
        begins = np.flatnonzero(~gap & np.concatenate(([low == start], gap[:-1])))
        if len(begins) >= k:
            return low + int(begins[-k]), k
        if low == start:
            return (start + int(begins[0]), len(begins)) if len(begins) else (at, 0)
        reach *= 8


def text_blocks(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray, context: int, block: int = 1 << 21):
    """Rows in pieces of about `block` bytes: (first row, end row, bytes, offsets of the rows in them, words seen before).

    A longer row comes in several pieces that end between words; each but its first begins with up to
    `context` words of the piece before, whose number is the last item. A word is never cut.
    """
    i = 0
    while i < len(offsets) - 1:
        start, end = int(offsets[i]), int(offsets[i + 1])
        if end - start <= block:
            j = max(i + 1, int(np.searchsorted(offsets, start + block, "right")) - 1)
            yield i, j, data[start : offsets[j]], offsets[i : j + 1] - start, 0
            i = j
            continue
        at = begin = start
        seen = 0
        while at < end:
            stop, reach = min(at + block, end), 1 << 12
            while stop < end:
                gaps = np.flatnonzero(apart[data[stop : min(stop + reach, end)]])
                stop, reach = (stop + int(gaps[0]), 0) if len(gaps) else (min(stop + reach, end), reach * 4)
                if reach == 0:
                    break
            yield i, i + 1, data[begin:stop], np.array([0, stop - begin]), seen
            begin, seen = _words_back(data, start, stop, apart, context)
            at = stop
        i += 1
