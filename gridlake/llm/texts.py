"""Helpers that run inside tasks: Arrow batches in bounded slices, and words as arrays of 64-bit hashes.

Words are never Python objects here: a slice of texts is one byte array, word bounds come from a table of
separators, and the hash of a word is a difference of prefix sums, so the cost is a few passes of numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = bytes([0x20, *range(0x09, 0x0E)])
# Fixed value of two contracts: everything in ASCII but digits and lower-case letters (A-Z are folded first).
NOT_ALNUM = bytes(b for b in range(128) if not (chr(b).isdigit() or chr(b).islower() or chr(b).isupper()))
SLICE_BYTES = 1 << 20  # texts handled at once in a task; a longer text makes a slice of its own
CHUNK_BYTES = 1 << 20  # bytes hashed at once, cut between words

_rng = np.random.default_rng(20240229)
_EXACT = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _FOLDED[97:123]
_BASE = np.uint64(int(_rng.integers(1 << 40, 1 << 60)) * 8 + 5)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LENGTH = np.uint64(0x9E3779B97F4A7C15)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit hash of each span buf[start:end]; `fold` treats A-Z as a-z. Spans are in order and disjoint."""
    out = np.empty(len(start), np.uint64)
    values, first = (_FOLDED if fold else _EXACT), 0
    while first < len(start):
        origin = int(start[first])
        last = max(first + 1, int(np.searchsorted(end, origin + CHUNK_BYTES, "right")))
        piece = buf[origin : int(end[last - 1])]
        power, inverse = _powers_to(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * power[: len(piece)], out=sums[1:])
        s, e = start[first:last] - origin, end[first:last] - origin
        out[first:last] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * _LENGTH)
        first = last
    return out


@dataclass
class Words:
    """The words of a slice of texts, in order. Word i is buf[start[i]:end[i]]; text d has words first[d]:first[d+1]."""

    buf: np.ndarray
    origin: np.ndarray  # where each text starts in buf; one entry more than texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    fold: bool

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end, self.fold)

    def text_no(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array, each text closed by a line feed, and where each text starts in it."""
    origin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=origin[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), origin


def words_of(texts: list[bytes], separators: bytes, fold: bool) -> Words:
    """The maximal runs of bytes that are no separators. The line feed must be a separator."""
    buf, origin = joined(texts)
    table = np.zeros(256, np.int8)
    table[list(separators)] = 1
    apart = table[buf]
    edge = np.diff(apart, prepend=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return Words(buf, origin, start, end, np.searchsorted(start, origin), fold)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a slice hold about `limit` bytes at most, or one text."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + 1)
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
            yield batch.slice(at, to - at)
            at, done = to, int(sizes[to - 1])


def code_points(text: bytes) -> np.ndarray:
    """For each byte offset (and the end), how many code points begin before it."""
    starts = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(starts)])


def cover(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For 0..n-1, whether a half-open span holds it."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true flags."""
    edge = np.diff(flags.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
