"""Vectorised word hashes: 64-bit polynomial hashes of words and of word windows, in numpy.

A word's hash does not depend on where it stands, and a window's hash is the
difference of two prefix sums, so a window of twice the length costs no more
than the first.  The tables live in an object made inside the task.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
#: bytes.split() separates on these
SPACES = b"\t\n\x0b\x0c\r "


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (SplitMix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def to(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(n, 2 * len(self.up)) + 1
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(n, b, U)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))


class WordHasher:
    """Word and window hashes; ``blob`` bounds the bytes of one kernel call."""

    def __init__(self, blob: int = 1 << 19):
        rng = np.random.default_rng(20240229)
        self.blob, self.byte = blob, rng.integers(0, 1 << 64, 256, dtype=U) | U(1)
        self.space = np.zeros(256, np.int8)
        self.space[list(SPACES)] = 1
        self.bytes = Powers(0x9E3779B97F4A7C15)
        self.windows = [Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5)]

    def _kernel(self, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the words of ``blob``."""
        a = np.frombuffer(blob, np.uint8)
        edge = np.flatnonzero(np.diff(self.space[a], prepend=np.int8(1), append=np.int8(1)))
        start, end = edge[::2], edge[1::2]
        self.bytes.to(len(a))
        total = np.zeros(len(a) + 1, U)
        np.cumsum(self.byte[a] * self.bytes.up[:len(a)], out=total[1:])
        return start, mix((total[end] - total[start]) * self.bytes.down[start])

    def _pieces(self, text: bytes):
        """``text`` in pieces of about ``blob`` bytes, cut after white space."""
        at = 0
        while len(text) - at > self.blob:
            cut = at + self.blob
            while cut < len(text) and text[cut] not in SPACES:
                cut += 1
            yield text[at:cut]
            at = cut
        yield text[at:]

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and for each the index of its text."""
        hashes, owners, batch, owner, size = [], [], [], [], 0

        def flush():
            start, h = self._kernel(b"\n".join(batch))
            ends = np.cumsum([len(b) + 1 for b in batch])
            hashes.append(h)
            owners.append(np.asarray(owner, np.int32)[np.searchsorted(ends, start, side="right")])
            batch.clear()
            owner.clear()

        for i, text in enumerate(texts):
            for piece in self._pieces(text):
                if batch and size + len(piece) > self.blob:
                    flush()
                    size = 0
                batch.append(piece)
                owner.append(i)
                size += len(piece) + 1
        if batch:
            flush()
        if not hashes:
            return np.zeros(0, U), np.zeros(0, np.int32)
        return np.concatenate(hashes), np.concatenate(owners)

    def prefix(self, words: np.ndarray, which: int = 0) -> np.ndarray:
        p = self.windows[which]
        p.to(len(words) + 1)
        total = np.zeros(len(words) + 1, U)
        np.cumsum(words * p.up[:len(words)], out=total[1:])
        return total

    def window(self, prefix: np.ndarray, start: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """Hashes of the windows of ``length`` words at ``start``."""
        return mix((prefix[start + length] - prefix[start]) * self.windows[which].down[start])
