"""Hashes of words, vectorised over the bytes of many texts."""

from __future__ import annotations

import re

import numpy as np

_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)


class _Cache(dict):
    """Travels empty to other processes."""

    def __reduce__(self):
        return (_Cache, ())


_POWERS = _Cache()
#: Scripts written without blanks: Thai, Lao, Burmese, Khmer, kana, ideographs. Each character is a word.
_DENSE = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number mod 2**64 and of its inverse, n of them at least."""
    size = 1 << max(16, n.bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (_ODD, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[size] = tuple(out)
    return _POWERS[size]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-case words (letters, digits, bytes of non-ASCII letters; single characters of scripts without
    blanks), and how many each text has."""
    lower = ((t or "").lower() for t in texts)
    parts = [(t if t.isascii() else _DENSE.sub(r" \1 ", t)).encode("utf-8", "replace") for t in lower]
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)])])
    hashes = mix((total[ends] - total[starts]) * up[ends])
    at = np.cumsum([0, *[len(p) + 1 for p in parts]])
    return hashes, np.diff(np.searchsorted(starts, at)).astype(np.int64)
