"""Numpy work on the bytes of Arrow text columns, shared by operators 11 to 13."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK = 1 << 20  # bytes that are worked on at once
ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def byte_values(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * ODD + np.uint64(seed))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a text or binary column, and where each row starts and ends in them; null: empty."""
    column = column.cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, ends[:-1], ends[1:]


def row_ranges(starts: np.ndarray, ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of ``limit`` bytes at most together; a longer row is alone."""
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + limit, "right")))
        yield first, last
        first = last


def cut_ranges(data: np.ndarray, start: int, end: int, cut: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes that cover ``start`` to ``end``, each but the last ending behind a byte of ``cut``."""
    while end - start > limit:
        at = start + limit
        while at < end:
            some = np.flatnonzero(cut[data[at:min(end, at + limit)]])
            if len(some):
                at += int(some[0]) + 1
                break
            at = min(end, at + limit)
        yield start, at
        start = at
    if end > start:
        yield start, end


class SpanHash:
    """Two 64-bit hashes of spans of a byte array, both by prefix sums modulo 2**64.

    Spans over 512 bytes are hashed by XXH3, as sums of powers have known collisions from 1024 bytes on."""

    LONG = 512

    def __init__(self, seeds: tuple[int, int] = (1, 2)):
        self.values = [byte_values(s) for s in seeds]
        self.base = [np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)]
        self.powers = [np.ones(1, np.uint64)] * 2
        self.inverse = [np.ones(1, np.uint64)] * 2

    def _grown(self, n: int) -> None:
        if len(self.powers[0]) < n:
            size = 1 << (n - 1).bit_length()
            for i, b in enumerate(self.base):
                back = np.uint64(pow(int(b), -1, 1 << 64))
                self.powers[i] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, b)]))
                self.inverse[i] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, back)]))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """The hashes of data[starts:ends]; ``data`` is one chunk."""
        self._grown(len(data) + 1)
        out, long = [], np.flatnonzero(ends - starts > self.LONG)
        for i in range(2):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.values[i][data] * self.powers[i][:len(data)], out=sums[1:])
            h = mixed((sums[ends] - sums[starts]) * self.inverse[i][starts] + (ends - starts).astype(np.uint64))
            for j in long.tolist():
                h[j] = xxhash.xxh3_64_intdigest(data[starts[j]:ends[j]], i)
            out.append(h)
        return out


def groups(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): the rows sorted so that those of equal ``h1`` and ``h2`` stand together, and where groups start."""
    order = np.argsort(h1, kind="stable")
    a, b = h1[order], h2[order]
    new = a[1:] != a[:-1]
    if (~new & (b[1:] != b[:-1])).any():  # different texts of one hash
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.concatenate([np.zeros(min(1, len(order)), np.int64), np.flatnonzero(new) + 1])
