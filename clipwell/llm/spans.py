"""Numbers for equal pieces of bytes, by array operations inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from xxhash import xxh64_intdigest

K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SHORT = 64
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K2
    return x ^ (x >> np.uint64(29))


class Spans:
    """Spans of bytes with their hashes and exact numbers: two spans have one ``code`` if their bytes are equal.

    Spans of equal hash are compared byte by byte. ``first`` has one span of each code.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.start, self.end, self.size = start, end, end - start
        self.data = np.concatenate([data, np.zeros(_SHORT + 8, np.uint8)])
        # eight bytes from every place on
        self.eight = np.ndarray((len(data) + _SHORT,), "<u8", self.data.data, strides=(1,))
        h = self.size.astype(np.uint64) * K1
        at = np.flatnonzero(self.size <= _SHORT)
        for j in range(0, _SHORT, 8):
            at = at[self.size[at] > j]
            if not len(at):
                break
            x = self.eight[start[at] + j] & _MASK[np.minimum(self.size[at] - j, 8)]
            h[at] = mixed((h[at] ^ x) * K1)
        for i in np.flatnonzero(self.size > _SHORT).tolist():
            h[i] = xxh64_intdigest(self.bytes_of(i))
        self.hash = h
        _, first, code = np.unique(h, return_index=True, return_inverse=True)
        alias = np.flatnonzero(first[code] != np.arange(len(h)))
        other = alias[self._differ(alias, first[code[alias]])]
        # each span with the hash of other bytes has a code of its own
        code[other] = len(first) + np.arange(len(other))
        self.first, self.code = np.concatenate([first, other]), code

    def _differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = self.size[a] != self.size[b]
        rest = np.flatnonzero(~out & (self.size[a] <= _SHORT))
        for j in range(0, _SHORT, 8):
            rest = rest[self.size[a[rest]] > j]
            if not len(rest):
                break
            x = self.eight[self.start[a[rest]] + j] ^ self.eight[self.start[b[rest]] + j]
            out[rest] |= (x & _MASK[np.minimum(self.size[a[rest]] - j, 8)]) != 0
        for k in np.flatnonzero(~out & (self.size[a] > _SHORT)).tolist():
            out[k] = self.bytes_of(a[k]) != self.bytes_of(b[k])
        return out

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()
