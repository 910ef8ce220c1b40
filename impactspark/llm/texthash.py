"""Word hashes of a batch of texts, all bytes at once (numpy inside a task).

A word's hash is a polynomial over its bytes modulo 2^64, taken as the
difference of two prefix sums, so its cost does not depend on the number of
words.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

#: Fixed value: the bytes that separate words (space, tab, line feed to carriage return).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        with np.errstate(over="ignore"):
            for k, base in enumerate((_BASE, _INVERSE)):
                full = np.full(size, base)
                full[0] = 1
                _powers[k] = np.cumprod(full)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * _M1
        h = (h ^ (h >> U(27))) * _M2
        return h ^ (h >> U(31))


#: Bytes that are hashed at once (a longer word is hashed alone).
WINDOW = 1 << 20


def span_hashes(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span ``flat[start:end]`` (in order, apart), a window of spans at a time."""
    out, i = [np.empty(0, U)], 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + WINDOW, side="right")))
        low, high = start[i], end[j - 1]
        out.append(_hash_window(flat[low:high], start[i:j] - low, end[i:j] - low))
        i = j
    return np.concatenate(out)


def _hash_window(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = (p[:len(flat)] for p in _power(max(1, len(flat))))
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, U), np.cumsum((flat.astype(U) + U(1)) * up)])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(U) * _M2)


def flatten(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, a space after each, and where each text starts."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    return np.frombuffer(b" ".join([*raw, b""]), np.uint8), np.concatenate([[0], np.cumsum(size)])


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of all texts in order, and each text's bounds among them."""
    flat, at = flatten(texts)
    gap = np.concatenate([[True], SPACE[flat], [True]])
    start = np.flatnonzero(gap[:-1] & ~gap[1:])
    end = np.flatnonzero(~gap[:-1] & gap[1:])
    return span_hashes(LOWER[flat], start, end), np.searchsorted(start, at)


def shingle_sets(texts: list[str], size: int = 5) -> list[np.ndarray]:
    """The distinct ``size``-word shingles of each text as sorted 64-bit hashes.

    A text of fewer words has its whole sequence as one shingle, one without
    words none.
    """
    h, at = words(texts)
    n = max(0, len(h) - size + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, U)
        for k in range(size):
            total = total * _BASE + h[k:k + n]
        full = mix(total + U(size))
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= size:
                out.append(np.unique(full[a:b - size + 1]))
            elif b > a:
                s = U(0)
                for w in h[a:b]:
                    s = s * _BASE + w
                out.append(mix(np.array([s + U(b - a)], U)))
            else:
                out.append(np.empty(0, U))
    return out
