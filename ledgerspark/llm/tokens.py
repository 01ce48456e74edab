"""Words of many texts at once: numpy over the byte buffer of an Arrow column, so a task spends
its time in array operations and not in a Python loop per word."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of a word: ASCII letters and digits, apostrophe, and every byte of other characters.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 39, *range(128, 256)]] = True
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


class Words(NamedTuple):
    """One entry per word: hash of its lower-cased bytes, hashes of its first bytes (one array for
    each length asked for), index of its text, byte range."""
    hashes: np.ndarray
    stems: list[np.ndarray]
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * _MIX
    return (h ^ (h >> np.uint64(32))) * _MIX


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's factor and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        for k, base in ((0, _STEP), (1, _BACK)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end and the offsets of each; nulls must be filled before."""
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    if len(texts) == 0 or buffers[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def words(texts: pa.Array, stems: tuple[int, ...] = ()) -> Words:
    """All words of all texts, in order. No word spans two texts."""
    data, offsets = buffer_of(texts)
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        empty = np.zeros(0, dtype=np.uint64)
        return Words(empty, [empty] * len(stems), none, none, none)
    inside = _IN_WORD[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    power, back = _power(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    hashed = [mix((sums[till] - sums[start]) * back[start]) for till in (end, *(np.minimum(end, start + k) for k in stems))]
    return Words(hashed[0], hashed[1:], np.searchsorted(offsets, start, side="right") - 1, start, end)


class Table(NamedTuple):
    """Open addressing: ``keys`` by slot (all ones: empty) and the row of each."""
    keys: np.ndarray
    rows: np.ndarray
    bits: int
    reach: int


_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * _STEP) >> np.uint64(64 - bits)).astype(np.int64)


def make_table(keys: np.ndarray) -> Table:
    bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
    size = 1 << bits
    slots, rows = np.full(size, _EMPTY), np.zeros(size, dtype=np.int32)
    left, at, reach = np.arange(len(keys)), _slot(keys, bits), 0
    while len(left):
        free = slots[at] == _EMPTY
        first = np.unique(at[free], return_index=True)[1]
        took = np.flatnonzero(free)[first]
        slots[at[took]], rows[at[took]] = keys[left[took]], left[took]
        stay = np.ones(len(left), dtype=bool)
        stay[took] = False
        left, at, reach = left[stay], (at[stay] + 1) % size, reach + 1
    return Table(slots, rows, bits, reach)


def find(table: Table, keys: np.ndarray) -> np.ndarray:
    """Row of each key, -1 if there is none."""
    out = np.full(len(keys), -1, dtype=np.int32)
    at, left = _slot(keys, table.bits), None
    for step in range(table.reach):
        here = table.keys[at]
        same = here == (keys if left is None else keys[left])
        index = np.flatnonzero(same) if left is None else left[same]
        out[index] = table.rows[at[same]]
        more = ~same & (here != _EMPTY)
        left = np.flatnonzero(more) if left is None else left[more]
        if not len(left):
            break
        at = (at[more] + 1) & ((1 << table.bits) - 1)
    return out
