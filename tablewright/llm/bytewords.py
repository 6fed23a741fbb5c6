"""Words of many texts at once, as 64-bit hashes, straight from the bytes of an Arrow column: no Python object for any word."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes looked at together, cut between words

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered() -> np.ndarray:
    """Bytes with A-Z made small."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def bytes_but(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes belong to words: all but those in the ranges, ends included."""
    out = np.ones(256, bool)
    for low, high in ranges:
        out[low : high + 1] = False
    return out


#: Words are stretches of anything but ASCII white space; terms, of ASCII letters and digits and all that is not ASCII.
WORD_BYTES = bytes_but((0x20, 0x20), (0x09, 0x0D))
TERM_BYTES = bytes_but((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


@cache
def _values() -> np.ndarray:
    return mix((lowered().astype(np.uint64) + np.uint64(1)) * _ODD)


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0, 1, 2, ... of an odd number and of its inverse modulo 2 ** 64; 2 ** bits of each."""
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    out = []
    for x in (_ODD, inverse):
        p = np.full(1 << bits, x, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, or of all binary values, and where each begins (one more: the end). Null texts are empty."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, places, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8), at - at[0]


def word_hashes(data: np.ndarray, at: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count): the hashes of all words, A-Z made small, text by text, and the number of words of each text.

    The hash of a word is the sum of value(byte) * odd ** place, mixed with the word's length; words that differ get equal hashes
    about as rarely as random 64-bit numbers do."""
    hashes, starts_at = [], []
    begin, n = 0, len(data)
    edges = np.unique(at)
    while begin < n:
        end = min(n, begin + PIECE)
        while end < n:  # between two texts or behind a byte that is in no word
            k = np.searchsorted(edges, end, side="right") - 1
            gaps = np.flatnonzero(~word_bytes[data[max(begin, end - 4096) : end]])
            cut = max(int(edges[k]), max(begin, end - 4096) + int(gaps[-1]) + 1 if len(gaps) else begin)
            if cut > begin:
                end = cut
                break
            end = min(n, end + PIECE)
        piece = data[begin:end]
        inside = word_bytes[piece]
        if inside.any():
            before = np.concatenate([[False], inside[:-1]])
            limits = edges[np.searchsorted(edges, begin, side="right") : np.searchsorted(edges, end, side="left")] - begin
            before[limits] = False
            after = np.concatenate([inside[1:], [False]])
            after[limits - 1] = False
            first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
            powers, inverse = _powers(max(20, int(len(piece) - 1).bit_length()))
            sums = np.cumsum(_values()[piece] * powers[: len(piece)], dtype=np.uint64)
            total = sums[last] - np.where(first > 0, sums[np.maximum(first, 1) - 1], np.uint64(0))
            hashes.append(mix(total * inverse[first] + (last - first + 1).astype(np.uint64)))
            starts_at.append(first + begin)
        begin = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    places = np.searchsorted(np.concatenate(starts_at), at)
    return np.concatenate(hashes), np.diff(places)
