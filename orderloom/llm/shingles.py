"""Hashes of words and word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_PIECE = 1 << 20  # bytes hashed at a time
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RANDOM = np.random.default_rng(42)
_LETTERS = _RANDOM.integers(0, 1 << 63, 256, np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if n > 2 * _PIECE:
            return made[0], made[1]
        _powers = (made[0], made[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letter_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums s and factors f such that (s[b] - s[a]) * f[a] is a hash of the bytes from a to b, wherever they stand."""
    power, inverse = _powers_to(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_LETTERS[data] * power[: len(data)], out=sums[1:])
    return sums, inverse


def _hash_words(raw: bytes, prefix: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in ``raw``, which ends in white space."""
    data = np.frombuffer(raw, np.uint8)
    word = ~_SPACE[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.r_[0, edge]
    starts, ends = edge[::2], edge[1::2]
    if prefix:
        ends = np.minimum(ends, starts + prefix)
    sums, inverse = letter_sums(data)
    return starts, mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes], prefix: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and how many each text has; long texts are hashed piece by piece.

    With ``prefix`` only so many first bytes of each word count.
    """
    hashes, counts = [], np.zeros(len(texts), np.int64)
    batch: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal batch, size
        if batch:
            at = np.cumsum([0] + [len(t) + 1 for _, t in batch])
            starts, found = _hash_words(b"\n".join([t for _, t in batch]) + b"\n", prefix)
            np.add.at(counts, [k for k, _ in batch], np.diff(np.searchsorted(starts, at)))
            hashes.append(found)
        batch, size = [], 0

    for k, text in enumerate(texts):
        at = 0
        while at < len(text) or not at:
            end = len(text)
            if end - at > _PIECE:  # cut after white space
                cuts = [c for c in (text.rfind(s, at, at + _PIECE) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if c > at]
                end = max(cuts) + 1 if cuts else end
            batch.append((k, text[at:end]))
            size += end - at
            at = max(end, 1)
            if size >= _PIECE:
                flush()
    flush()
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``width`` words, text by text, repeats included, and how many each text has.

    A text of fewer words is one shingle, one without words has none.
    """
    words, counts = word_hashes(texts)
    factors = np.random.default_rng(width).integers(0, 1 << 63, width, np.uint64) << np.uint64(1) | np.uint64(1)
    first = np.cumsum(counts) - counts
    many = np.maximum(counts - width + 1, np.minimum(counts, 1))
    at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
    total = np.zeros(len(at), np.uint64)
    short = np.repeat(counts < width, many)
    last = np.repeat(first + counts, many) - 1
    for j in range(width):
        inside = at + j <= last
        total += np.where(inside, words[np.minimum(at + j, last)], 0) * factors[j]
    return mix(total + short), many
