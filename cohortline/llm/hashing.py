"""64-bit hashes of words and word runs, a whole block of texts at a time."""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)

# Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
# Bytes that do not belong to a word of letters, digits or non-ASCII characters.
NON_WORD = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
SMALL = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2**64; made anew each time, so that no worker keeps them."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every bit of the result depends on all bits of ``h``."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of several texts: ``hash`` per word, ``doc`` bounds as word offsets, byte bounds."""

    def __init__(self, texts: list[bytes], separator: np.ndarray = SPACES,
                 prefixes: tuple[int, ...] = ()):
        blob = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        gap = separator[blob]
        edges = np.flatnonzero(np.diff(gap, prepend=True))
        self.begin, self.end = edges[::2], edges[1::2]
        sums = np.zeros(len(blob) + 1, np.uint64)
        terms = _powers(_P, len(blob))
        terms *= blob.astype(np.uint64) + np.uint64(1)
        np.cumsum(terms, out=sums[1:])
        del terms
        back = _powers(_P_INVERSE, len(blob))
        self.hash = mix((sums[self.end] - sums[self.begin]) * back[self.begin])
        self.prefixes = [mix((sums[np.minimum(self.begin + n, self.end)] - sums[self.begin]) * back[self.begin]
                             + np.uint64(n * int(_Q) % 2 ** 64)) for n in prefixes]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        after = np.cumsum(lengths)
        self.bounds = np.concatenate([[0], np.searchsorted(self.begin, after)]).astype(np.int64)
        self.text_begin = after - lengths

    def doc(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words that begin at each word (meaningful where ``n`` words of a text follow)."""
    out = np.zeros(len(words), np.uint64)
    for j in range(n):
        out *= _Q
        out[:len(words) - j] += words[j:]
    return mix(out + np.uint64(n))
