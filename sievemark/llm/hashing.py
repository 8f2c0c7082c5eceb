"""Hashing the words of many texts at once, on their UTF-8 bytes, inside a task."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space between words, by byte: space, tab, line feed, vertical tab, form feed, return.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
# All of ASCII but letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
PIECE = 1 << 20  # bytes hashed at a time


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, _BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow array of strings and where each text starts; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, most: int = 1 << 22) -> Iterator[pa.Array]:
    """The texts in order, in runs of about ``most`` bytes, so that arrays stay small."""
    sizes = np.cumsum(np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False)))
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield texts.slice(at, stop - at)
        at = stop


def word_hashes(
    data: np.ndarray,
    bounds: np.ndarray,
    prefix: int | None = None,
    between: np.ndarray = SPACES,
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the number of words before each text.

    With ``prefix``, only so many bytes of a word count. ``between`` tells by byte what
    separates words.
    """
    first_of_text = np.zeros(len(data) + 1, bool)
    first_of_text[bounds] = True
    hashes, starts, at = [], [], 0
    while at < len(data):
        stop = _next_gap(data, first_of_text, at + PIECE, between)
        found, where = _piece(data[at:stop], first_of_text[at:stop], prefix, between)
        hashes.append(found)
        starts.append(where + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds)


def _next_gap(
    data: np.ndarray, first_of_text: np.ndarray, at: int, between: np.ndarray
) -> int:
    """The first place from ``at`` that no word crosses."""
    while at < len(data):
        ahead = slice(at, at + 4096)
        gaps = np.flatnonzero(between[data[ahead]] | first_of_text[ahead][: len(data[ahead])])
        if len(gaps):
            return at + int(gaps[0])
        at += 4096
    return len(data)


def _piece(
    data: np.ndarray, first_of_text: np.ndarray, prefix: int | None, between: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    low = _LOWER[data]
    word = ~between[low]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | first_of_text))
    # A word ends where a separator or the next text begins.
    after = np.ones_like(word)
    after[:-1] = ~word[1:] | first_of_text[1:]
    ends = np.flatnonzero(word & after) + 1
    if prefix is not None:
        ends = np.minimum(ends, starts + prefix)
    size = 1 << max(20, (len(data) + 1).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[low] * up[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(value ^ (ends - starts).astype(np.uint64)), starts


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """The distinct shingles of one text's words, sorted; fewer than ``k`` words make one."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    k = min(k, len(words))
    total = np.full(len(words) - k + 1, np.uint64(k))
    for step in range(k):
        total = mix(total * _BASE + words[step : len(words) - k + 1 + step])
    return np.unique(total)
