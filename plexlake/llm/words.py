"""Words of Arrow text columns as 64-bit hashes, computed on whole buffers.

Worker-side helpers: they run inside Arrow functions and work on slices of a few
megabytes, so memory does not follow the batch. Only a single text longer than a slice
is held whole, and even that is hashed piece by piece.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
PIECE_BYTES = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def per_process(key: str, make: Callable[[], Any], alone: str | None = None) -> Any:
    """``make()`` once per Python worker; with ``alone``, older keys that start with it are let go.

    Functions travel to the workers by value, so a module's own globals would be new in every
    task; what should outlive a task is hung on a module of the worker process.
    """
    holder = sys.modules.setdefault("_plexlake_worker", types.ModuleType("_plexlake_worker"))
    if not hasattr(holder, key):
        for old in [k for k in vars(holder) if alone is not None and k.startswith(alone)]:
            delattr(holder, old)
        setattr(holder, key, make())
    return getattr(holder, key)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = PIECE_BYTES + 1
    if n > size:  # one word longer than a piece
        return _powers(_BASE, n), _powers(_BASE_INVERSE, n)
    return per_process("powers", lambda: (_powers(_BASE, size), _powers(_BASE_INVERSE, size)))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def byte_set(separators: bytes) -> np.ndarray:
    """Truth per byte value: does it belong to a word?"""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges (first, last) of at most ``limit`` bytes with their bytes and offsets; null reads as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; a run ends where its text ends."""
    inside = is_word[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    starts[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One 64-bit hash per span: differences of a running polynomial, then mixed."""
    out = np.empty(len(starts), np.uint64)
    values = _BYTE_VALUES[ASCII_LOWER] if lower else _BYTE_VALUES
    at = 0
    while at < len(starts):
        base = starts[at]
        upto = int(np.searchsorted(ends, base + PIECE_BYTES, side="right"))
        upto = max(upto, at + 1)
        piece = data[base : ends[upto - 1]]
        forward, backward = _tables(len(piece) + 1)
        running = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * forward[: len(piece)], out=running[1:])
        s, e = starts[at:upto] - base, ends[at:upto] - base
        lengths = (e - s).astype(np.uint64)
        out[at:upto] = mix((running[e] - running[s]) * backward[s] + lengths * np.uint64(0xA24BAED4963EE407))
        at = upto
    return out


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the first word of each text, with the total at the end."""
    return np.searchsorted(starts, offsets, side="left")


def gather_runs(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices first[i], first[i]+1, ... for every run i, in order."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts - first, counts)


class HashIndex:
    """Open-addressing map from 64-bit hashes to positions, filled and read as arrays."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)
        self.size = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions, -1 where a hash is unknown. Hash 0 must not occur."""
        out = np.full(len(hashes), -1, np.int32)
        pending = np.arange(len(hashes))
        slots = (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(pending):
            keys, wanted = self.keys[slots], hashes[pending]
            hit = keys == wanted
            out[pending[hit]] = self.values[slots[hit]]
            on = ~hit & (keys != 0)
            pending, slots = pending[on], (slots[on] + 1) & self.mask
        return out

    def insert(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Add distinct hashes that are not there yet."""
        self.size += len(hashes)
        slots = (hashes & np.uint64(self.mask)).astype(np.int64)
        while len(hashes):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = hashes[free]  # of several on one slot the last stays
            won = self.keys[slots] == hashes
            self.values[slots[won]] = values[won]
            hashes, values, slots = hashes[~won], values[~won], (slots[~won] + 1) & self.mask
