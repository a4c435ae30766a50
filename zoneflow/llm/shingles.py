"""Words and word windows of many texts at once, hashed with numpy.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. A word's hash is a
polynomial of its bytes modulo 2**64, taken from prefix sums over a whole chunk of texts, then mixed; equal words have equal
hashes in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text hashed at once (a longer text is hashed alone).
CHUNK = 2_000_000
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
WORD = np.ones(256, bool)
WORD[[0x20, 9, 10, 11, 12, 13]] = False
POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; kept up to one chunk's length."""
    have = POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size == CHUNK + 1:
            POWERS[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (all input bits reach all output bits)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) + 1 > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words of several texts: ``hashes``, ``starts`` and ``ends`` (in ``buffer``) and ``first[i]:first[i + 1]`` for text i."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join([*texts, b""])
        buffer = self.buffer = np.frombuffer(joined, np.uint8)
        inside = np.zeros(len(buffer) + 2, np.int8)
        inside[1:-1] = WORD[buffer]
        edge = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = self.offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        self.first = np.searchsorted(self.starts, offsets)
        sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(buffer.astype(np.uint64) * powers(BASE, len(buffer)), out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * powers(INVERSE, len(buffer) + 1)[self.starts]
        self.hashes = mixed(raw + (self.ends - self.starts).astype(np.uint64))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows, and bounds: text i has the windows bounds[i]:bounds[i + 1]. Texts of fewer than
        n words have none."""
        count = len(self.hashes)
        if count < n:
            return np.zeros(0, np.uint64), np.zeros(len(self.first), np.int64)
        multipliers = mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
        total = np.zeros(count - n + 1, np.uint64)
        for j in range(n):
            total += self.hashes[j:count - n + 1 + j] * multipliers[j]
        sizes = np.diff(self.first)
        has = np.maximum(sizes - n + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(has)])
        keep = np.repeat(self.first[:-1] - bounds[:-1], has) + np.arange(bounds[-1])
        return mixed(total[keep]), bounds


def shingle_sets(texts: list[bytes], n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text's index, shingle hashes, bounds) by chunk: the n-word windows of each text, repeats included; a text
    of fewer words has one shingle of all its words, and a text without words none."""
    for a, b in chunks(texts):
        words = Words(texts[a:b])
        hashes, bounds = words.windows(n)
        sizes = np.diff(words.first)
        short = np.flatnonzero((sizes > 0) & (sizes < n))
        if len(short):
            multipliers = mixed(np.arange(101, 101 + n, dtype=np.uint64)) | np.uint64(1)
            own = [mixed((words.hashes[words.first[i]:words.first[i + 1]] * multipliers[:sizes[i]]).sum(keepdims=True)) for i in short]
            hashes = np.insert(hashes, bounds[short], np.concatenate(own))
            has = np.diff(bounds)
            has[short] = 1
            bounds = np.concatenate([[0], np.cumsum(has)])
        yield a, hashes, bounds
