"""Hashes of word shingles, computed on whole batches of text at once.

Words are the runs of bytes other than blank and 0x09-0x0D, with A-Z in lower case. A text of at least ``k`` words has
the shingles of every ``k`` words in a row; a shorter one has its whole sequence as its only shingle; none without words.
The 64-bit hashes only find candidates or count inside one pair of texts, where a collision is out of reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 20  # bytes worked on at once
_U = np.uint64
_P, _Q = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_INVERSE = _U(pow(int(_P), -1, 1 << 64))
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a fixed bijection)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _P)[np.frombuffer(LOWER, np.uint8)]
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE)
        grown = []
        for base in (_P, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            grown.append(np.cumprod(steps, dtype=np.uint64))
        _powers = grown[0], grown[1]
        if n > SLICE:  # not kept: one very long text shall not hold memory for good
            kept, _powers = _powers, (grown[0][:SLICE].copy(), grown[1][:SLICE].copy())
            return kept
    return _powers


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def shingle_set(text: str | None, k: int = 5) -> set[tuple[bytes, ...]]:
    """The shingles themselves, for exact checks."""
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, place of its text), in text order."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    full = sizes > 0
    word = ~BLANK[data]
    first, last = np.ones(n, bool), np.ones(n, bool)
    first[1:], last[:-1] = ~word[:-1], ~word[1:]
    first[bounds[:-1][full]] = True
    last[bounds[1:][full] - 1] = True
    starts, stops = np.flatnonzero(word & first), np.flatnonzero(word & last) + 1
    up, down = _power(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    hashes = mix((total[stops] - total[starts]) * down[starts])
    return hashes, np.searchsorted(bounds, starts, "right") - 1


def _chain(parts) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    for part in parts:
        h = (h + part) * _Q
        h = h ^ (h >> _U(32))
    return mix(h)


def shingle_hashes(texts: list[bytes], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, place of its text), in text order, repeats included."""
    w, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    if len(w) >= k:
        whole = np.flatnonzero(owner[: len(w) - k + 1] == owner[k - 1 :])
        h, place = _chain(w[whole + i] for i in range(k)), owner[whole]
    else:
        h, place = np.empty(0, np.uint64), np.empty(0, np.int64)
    starts = np.cumsum(counts) - counts
    extra_h, extra_place = [h], [place]
    for size in range(1, k):
        short = np.flatnonzero(counts == size)
        if len(short):
            extra_h.append(_chain([np.full(1, size, np.uint64), *(w[starts[short] + i] for i in range(size))]))
            extra_place.append(short)
    if len(extra_h) > 1:
        h, place = np.concatenate(extra_h), np.concatenate(extra_place)
        order = np.argsort(place, kind="stable")
        h, place = h[order], place[order]
    return h, place


def slices(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in runs of about ``SLICE`` bytes, with the place of the first; a longer text is a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def set_rows(texts: list[bytes], k: int = 5) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    for _, part in slices(texts):
        h, place = shingle_hashes(part, k)
        bounds = np.searchsorted(place, np.arange(len(part) + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield np.unique(h[a:b])
