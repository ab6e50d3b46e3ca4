"""A minimal perfect hash over 128-bit keys, by levels of bit arrays, in numpy.

A level is an array of two bits per key left; keys alone on their bit are placed
there, the others go to the next level. A key's index is the number of set bits
before its own. Beside it lie a 64-bit fingerprint and a value per key.
"""

from __future__ import annotations

import numpy as np

from agroclim.llm.textarrow import mix64

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _place(high: np.ndarray, low: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(high ^ mix64(low + np.uint64(level + 1) * _STEP)) % np.uint64(bits)).astype(np.int64)


def build(high: np.ndarray, low: np.ndarray, values: np.ndarray) -> dict[str, bytes]:
    """Index distinct keys (``high``, ``low``), each with an integer value."""
    sizes, arrays, placed = [], [], np.full(len(high), -1, dtype=np.int64)
    left, base, level = np.arange(len(high)), 0, 0
    while len(left):
        bits = max(64, -(-2 * len(left) // 64) * 64)
        at = _place(high[left], low[left], level, bits)
        alone = np.bincount(at, minlength=bits) == 1
        arrays.append(np.packbits(alone, bitorder="little"))
        single = alone[at]
        placed[left[single]] = base + at[single]
        sizes.append(bits)
        left, base, level = left[~single], base + bits, level + 1
    order = np.argsort(placed)
    bitmap = np.concatenate(arrays) if arrays else np.zeros(0, np.uint8)
    return {
        "sizes": np.array(sizes, dtype=np.int64).tobytes(),
        "bitmap": bitmap.tobytes(),
        "fingerprints": low[order].astype(np.uint64).tobytes(),
        "values": values[order].astype(np.int64).tobytes(),
    }


class Index:
    """Look keys up in what ``build`` made."""

    def __init__(self, sizes: bytes, bitmap: bytes, fingerprints: bytes, values: bytes):
        self.sizes = np.frombuffer(sizes, dtype=np.int64)
        self.blocks = np.frombuffer(bitmap, dtype=np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)])
        self.fingerprints = np.frombuffer(fingerprints, dtype=np.uint64)
        self.values = np.frombuffer(values, dtype=np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is indexed, and its value (0 if it is not)."""
        slot = np.full(len(high), -1, dtype=np.int64)
        left, base = np.arange(len(high)), 0
        for level, bits in enumerate(self.sizes):
            if not len(left):
                break
            at = _place(high[left], low[left], level, int(bits)) + base
            shift = (at & 63).astype(np.uint64)
            block = self.blocks[at >> 6]
            hit = (block >> shift) & np.uint64(1) == 1
            below = block[hit] & ((np.uint64(1) << shift[hit]) - np.uint64(1))
            slot[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below)
            left, base = left[~hit], base + int(bits)
        found = slot >= 0
        found[found] = self.fingerprints[slot[found]] == low[found]
        value = np.zeros(len(high), dtype=np.int64)
        value[found] = self.values[slot[found]]
        return found, value
