"""Vectorised text splitting inside Arrow batches.

The splitters return the pieces of all texts of a chunk as one Arrow array that
shares the texts' own buffer, so that equal pieces are found by Arrow's dictionary
encoding and Python code only touches distinct pieces. Chunks bound the memory;
a text is never cut.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


class Texts:
    """Some whole texts: their UTF-8 bytes and where each begins and ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, size: int | None = None) -> Iterator[Texts]:
    """The texts of a string column in chunks of about ``size`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    yield from parts(Texts(data[offsets[0]:offsets[-1]], offsets - offsets[0], 0), size)


def parts(group: Texts, size: int | None = None) -> Iterator[Texts]:
    """The texts of a chunk in smaller chunks."""
    size, start, n = size or CHUNK_BYTES, 0, len(group)
    while start < n:
        end = int(np.searchsorted(group.offsets, group.offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield Texts(group.data[group.offsets[start]:group.offsets[end]], group.offsets[start:end + 1] - group.offsets[start], group.first + start)
        start = end


def pieces(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The contiguous pieces of ``data`` between ``bounds`` as a binary array (no copy)."""
    offsets = np.ascontiguousarray(bounds, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def words(texts: Texts, lower: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the code of every word in order, and each text's first word (with an end).

    Words are the maximal runs without ASCII white space; ``lower`` maps A-Z.
    """
    values, codes, first = word_codes(texts, lower)
    return values.to_pylist(), codes, first


def word_codes(texts: Texts, lower: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    data = _LOWER[texts.data] if lower else texts.data
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    space = _SPACE[data]
    edge = np.empty(len(data), dtype=bool)
    edge[0] = True
    np.not_equal(space[1:], space[:-1], out=edge[1:])
    edge[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge)
    is_word = ~space[starts]
    encoded = pieces(data, np.append(starts, len(data))).dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)[is_word]
    first = np.searchsorted(starts[is_word], texts.offsets)
    # Runs of white space are pieces too; renumber the words alone.
    used = np.zeros(len(encoded.dictionary), dtype=bool)
    used[codes] = True
    number = np.cumsum(used) - 1
    return encoded.dictionary.filter(pa.array(used)), number[codes], first


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Per code point: 0 other, 1 letter, 2 number, 3 white space, 4 the blank U+0020."""
    kinds = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for point in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = 1
        elif major == "N":
            kinds[point] = 2
    # The code points of the property White_Space.
    kinds[[*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = 3
    kinds[0x20] = 4
    return kinds


# The endings that the pattern splits off after an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def pretoken_bounds(texts: Texts) -> np.ndarray:
    """Byte positions where pre-tokens of the public byte-level pattern begin, with the end.

    Works on character classes instead of a regular expression: a pre-token is a run
    of letters, numbers or other signs with one blank before it, an ending such as
    ``'s``, or white space. Of white space before a visible character the last
    character stands apart (and joins the run that follows, if it is a blank).
    """
    data = texts.data
    if not len(data):
        return np.zeros(1, dtype=np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at_byte = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(points)
    kind = _classes()[points]
    blank = kind == 4
    kind = np.where(blank, 3, kind).astype(np.uint8)
    opens = np.zeros(n + 1, dtype=bool)  # a text begins here
    opens[np.searchsorted(at_byte, texts.offsets)] = True
    opens[n] = True
    space = kind == 3
    edge = opens[:n].copy()
    edge[1:] |= kind[1:] != kind[:-1]
    # the last white space before a visible character of the same text stands apart
    last = np.zeros(n, dtype=bool)
    last[:-1] = space[:-1] & ~space[1:] & ~opens[1:n]
    edge |= last
    # and a blank there belongs to what follows
    joined = np.flatnonzero(last & blank) + 1
    edge[joined] = False
    # endings after an apostrophe that begins a pre-token
    quote = np.flatnonzero((points == 39) & edge)
    quote = quote[quote + 1 < n]
    quote = quote[~opens[quote + 1]]
    for ending in _ENDINGS:
        found = quote
        for k, letter in enumerate(ending, 1):
            found = found[found + k < n]
            found = found[(points[found + k] == ord(letter)) & ~opens[found + k]]
        edge[found + 1] = False
        after = found + 1 + len(ending)
        edge[after[after < n]] = True
    return np.append(at_byte[edge], len(data))


def pretokens(texts: Texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pre-tokens (binary), the code of each in order, each text's first (with an end)."""
    bounds = pretoken_bounds(texts)
    encoded = pieces(texts.data, bounds).dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    return encoded.dictionary, codes, np.searchsorted(bounds[:-1], texts.offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift); equal inputs, equal outputs."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def hash64(values: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values), dtype=np.uint64, count=len(values))


def window_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` consecutive words (none if there are fewer)."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = word_hashes[:n].copy()
    with np.errstate(over="ignore"):
        for k in range(1, width):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += word_hashes[k:k + n]
    return mix64(out)


def lines(texts: Texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lines (binary, their line feed included), codes in order, each text's first.

    Every text has one line more than line feeds; an empty line at a text's end is
    given as the code -1.
    """
    data, offsets = texts.data, texts.offsets
    feeds = np.flatnonzero(data == 10) + 1
    text_of_feed = np.searchsorted(offsets, feeds - 1, side="right") - 1
    ends_open = np.flatnonzero(offsets[1:] > offsets[:-1])
    ends_open = ends_open[data[offsets[1:][ends_open] - 1] != 10] if len(data) else ends_open
    bounds = np.unique(np.concatenate([[0], feeds, offsets]))
    encoded = pieces(data, bounds).dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.bincount(text_of_feed, minlength=len(texts)) + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(first[-1], -1, dtype=np.int64)
    closed = np.ones(len(texts), dtype=bool)
    closed[ends_open] = False
    filled = np.ones(first[-1], dtype=bool)
    filled[first[1:][closed] - 1] = False
    out[filled] = codes
    return encoded.dictionary, out, first
