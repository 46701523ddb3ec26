"""Words of many texts at once: places, hashes, and hashes of runs of words.

A word is a run of bytes other than ASCII white space, lower-cased from A to
Z. The texts of a slice are one buffer, so that places, line numbers and
hashes of runs are array operations; only the hash of each word is a call.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """The powers 0..n-1 of an odd base modulo 2^64."""
    if len(_POWERS.get(base, ())) < max(n, 1):
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _POWERS[base] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
    return _POWERS[base][:n]


class RunHashes:
    """Polynomial hashes of any runs of words, from prefix sums."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(base, n))])
        self.down = _powers(pow(base, -1, 1 << 64), n + 1)

    def fixed(self, size: int) -> np.ndarray:
        """Of every run of ``size`` words; equal runs of one size have equal hashes."""
        if len(self.sums) <= size:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])

    def ranges(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the words ``first`` to ``last`` (excluded), whatever their number."""
        size = (last - first).astype(np.uint64)
        return mix((self.sums[last] - self.sums[first]) * self.down[first] + size * _LENGTH)


class Words:
    """The words of a slice of texts; null texts have none."""

    def __init__(self, texts: list[str | None]):
        from xxhash import xxh3_64_digest

        parts = [t.encode() if t else b"" for t in texts]
        self.data = b"\n".join(parts) + b"\n" if parts else b""
        self.raw = np.frombuffer(self.data, np.uint8)
        blank = np.concatenate([[True], _BLANK[self.raw], [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        #: Bytes where words start, and past their ends.
        self.starts, self.stops = edges[::2], edges[1::2]
        self.hashes = np.frombuffer(b"".join(map(xxh3_64_digest, self.data.lower().split())), ">u8").astype(np.uint64)
        #: Byte where each text starts, and past the last one's separator.
        self.bytes = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)])
        #: Number of words before each text, and of all words.
        self.firsts = np.searchsorted(self.starts, self.bytes)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    @cached_property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.firsts) - 1), self.counts)

    @cached_property
    def chars(self) -> np.ndarray:
        """Number of characters before each byte."""
        return np.concatenate([[0], np.cumsum((self.raw & 0xC0) != 0x80)])

    @cached_property
    def line_ends(self) -> np.ndarray:
        """Bytes of line feeds; the last of a text is its separator."""
        return np.flatnonzero(self.raw == 10)

    @cached_property
    def lines(self) -> np.ndarray:
        """The line of each word, counted over the whole slice."""
        return np.searchsorted(self.line_ends, self.starts)

    @cached_property
    def first_lines(self) -> np.ndarray:
        """The first line of each text."""
        return np.searchsorted(self.line_ends, self.bytes[:-1])

    def offsets(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Characters of bytes ``at`` from the starts of their texts."""
        return self.chars[at] - self.chars[self.bytes[text]]

    @cached_property
    def runs(self) -> tuple[RunHashes, RunHashes]:
        """Hashes of runs by two bases: together 128 bits."""
        return RunHashes(self.hashes, BASES[0]), RunHashes(self.hashes, BASES[1])

    def shingle_sets(self, first: np.ndarray, last: np.ndarray, size: int) -> list[np.ndarray]:
        """Ascending distinct hashes of the shingles of word ranges; a range of ``size`` words or fewer is one shingle."""
        found, whole = self.runs[0].fixed(size), self.runs[0].ranges(first, last)
        out = []
        for a, z, w in zip(first.tolist(), last.tolist(), whole, strict=True):
            if z - a >= size:
                out.append(np.unique(found[a : z - size + 1]))
            else:
                out.append(np.array([w] if z > a else [], np.uint64))
        return out
