"""Words of many texts as flat numpy arrays: offsets, hashes, n-gram hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D. Texts are
handled in chunks of about a megabyte, so the temporary arrays stay small
whatever the size of a batch; one longer text is one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n of each."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK_BYTES + 64)
        have = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            have.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[base] = have = tuple(have)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hash(prefix: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = _powers(base, len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


class Words:
    """Words of one chunk. ``doc`` is the index of the text in the chunk."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        sums = prefix_sums(data.astype(np.uint64) + np.uint64(1), _BYTE_BASE)
        self.hash = span_hash(sums, _BYTE_BASE, self.start, self.end)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_start = text_start = np.concatenate(([0], np.cumsum(size + 1)))
        #: index of each text's first word, and the number of words at the end
        self.first = np.searchsorted(self.start, text_start)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def sums(self, base: int = _WORD_BASE) -> np.ndarray:
        return prefix_sums(self.hash, base)

    def grams(self, k: int, sums: np.ndarray | None = None, base: int = _WORD_BASE):
        """(start, hash) of all runs of k words inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        start = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        return start, span_hash(self.sums(base) if sums is None else sums, base, start, start + k)


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Slices of about CHUNK_BYTES with the index of their first text."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= CHUNK_BYTES:
            yield at, texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def as_bytes(column) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in column]


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as a Spark long."""
    return np.ascontiguousarray(h).view(np.int64)
