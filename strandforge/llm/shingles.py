"""64-bit hashes of the distinct word n-grams of texts, by array operations over many texts at a time.

Words are `[^\\x20\\x09-\\x0D]+` of the UTF-8 bytes with A-Z in lower case. A
word's hash is the polynomial of its bytes at an odd base, modulo 2^64, mixed
with its length; it comes from differences of running sums, so its cost does
not depend on how words repeat, and no store of words is kept. A text of fewer
words than an n-gram has one n-gram of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes that are hashed together.
BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(_BASE)
_S29, _S33 = np.uint64(29), np.uint64(33)
_SPACES = bytes(range(9, 14)) + b" "
_PLAIN = bytes.maketrans(_SPACES, b" " * len(_SPACES))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo 2^64."""
    out = np.ones(n, np.uint64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        with np.errstate(over="ignore"):
            out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


class Shingles:
    """Calls give the sorted hashes of a text's distinct n-grams; many() those of several texts."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.up, self.down = _powers(_BASE, BLOCK + 1), _powers(pow(_BASE, -1, 1 << 64), BLOCK + 1)

    def word_hashes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first bytes of the words of data (spaces only between words), of at most BLOCK bytes."""
        raw = np.frombuffer(data, np.uint8)
        word = np.empty(len(raw) + 2, bool)
        word[0] = word[-1] = False
        np.not_equal(raw, 32, out=word[1:-1])
        edges = np.flatnonzero(word[1:] != word[:-1])
        start, end = edges[::2], edges[1::2]
        sums = np.zeros(len(raw) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(raw * self.up[: len(raw)], out=sums[1:])
            return self.mixed((sums[end] - sums[start]) * self.down[start], (end - start).astype(np.uint64)), start

    @staticmethod
    def mixed(h: np.ndarray, length: np.ndarray) -> np.ndarray:
        h = (h + length * _M3) * _M1
        h ^= h >> _S33
        h *= _M2
        return h ^ (h >> _S29)

    def long_word(self, data: bytes) -> np.ndarray:
        """The hash of one word of any length."""
        total, at, mask = 0, 0, (1 << 64) - 1
        with np.errstate(over="ignore"):
            while at < len(data):
                raw = np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at), at)
                total = (total + int((raw * self.up[: len(raw)]).sum(dtype=np.uint64)) * pow(_BASE, at, 1 << 64)) & mask
                at += len(raw)
            return self.mixed(np.array([total], np.uint64), np.array([len(data)], np.uint64))

    def _long(self, data: bytes) -> np.ndarray:
        """Word hashes of a text above BLOCK bytes, cut at spaces."""
        made, at = [], 0
        while at < len(data):
            end = len(data) if len(data) - at <= BLOCK else data.rfind(b" ", at, at + BLOCK)
            if end > at:
                made.append(self.word_hashes(data[at:end])[0])
            elif end < at:  # no space in reach: one word above BLOCK bytes
                end = data.find(b" ", at)
                end = len(data) if end < 0 else end
                made.append(self.long_word(data[at:end]))
            at = end + 1
        return np.concatenate(made) if made else np.zeros(0, np.uint64)

    def _joined(self, h: np.ndarray, k: int) -> np.ndarray:
        """Hashes of every k consecutive words."""
        if len(h) < k:
            return np.zeros(0, np.uint64)
        out = np.full(len(h) - k + 1, k, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                out = (out * _M3) ^ (out >> _S29)
                out += h[i : len(h) - k + 1 + i]
            out ^= out >> _S33
            out *= _M1
            return out ^ (out >> _S33)

    def __call__(self, raw: bytes) -> np.ndarray:
        return next(self.many([raw]))

    def many(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        held: list[bytes] = []
        size = 0
        for raw in texts:
            raw = raw.lower().translate(_PLAIN)
            if held and size + len(raw) + 1 > BLOCK:
                yield from self._together(held)
                held, size = [], 0
            if len(raw) >= BLOCK:
                yield self._set(self._long(raw))
            else:
                held.append(raw)
                size += len(raw) + 1
        yield from self._together(held)

    def _set(self, h: np.ndarray) -> np.ndarray:
        return np.unique(self._joined(h, min(self.words, len(h)))) if len(h) else np.zeros(0, np.uint64)

    def _together(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not texts:
            return
        h, start = self.word_hashes(b" ".join(texts))
        ends = np.cumsum([len(t) + 1 for t in texts])
        cut = [0, *np.searchsorted(start, ends).tolist()]
        every = self._joined(h, self.words)
        for a, b in zip(cut, cut[1:]):
            yield np.unique(every[a : b - self.words + 1]) if b - a >= self.words else self._set(h[a:b])
