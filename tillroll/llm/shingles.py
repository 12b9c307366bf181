"""Hashes of word shingles of many texts at once.

A word is a maximal run of ASCII letters, digits, underscores and non-ASCII characters of the lower-cased text; a
shingle is ``width`` words in a row, or all words of a text that has fewer. Words are hashed by prefix sums of a
polynomial over their bytes, shingles by a linear form of their words' hashes, both modulo 2**64 and then mixed.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_SLICE = 1 << 20  # bytes hashed at once
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, a bijection on 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, count: int) -> np.ndarray:
    """``count`` odd 64-bit numbers that depend on ``seed`` only."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BYTE = numbers(1, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = numbers(2, 64)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, offset of the first byte) of every word."""
    hashes, starts = [], []
    at = 0
    while at < len(data):
        until = min(len(data), at + _SLICE)
        if until < len(data):  # end behind a byte outside words
            back = np.flatnonzero(~_IN_WORD[data[at:until]])
            if len(back):
                until = at + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(~_IN_WORD[data[until:]])
                until = until + int(ahead[0]) + 1 if len(ahead) else len(data)
        part = data[at:until]
        inside = np.concatenate([[False], _IN_WORD[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _powers(_BASE, len(part)), dtype=np.uint64)])
        hashes.append(mixed((sums[end] - sums[begin]) * _powers(_INVERSE, len(part) + 1)[begin] + (end - begin).astype(np.uint64)))
        starts.append(begin + at)
        at = until
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_hashes(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): text ``i`` has the shingles ``hashes[bounds[i]:bounds[i + 1]]``, repeated ones included."""
    raw = [t.lower().encode() if t else b"" for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    words, starts = _word_hashes(np.frombuffer(b"\n".join(raw) + b"\n", np.uint8))
    first = np.concatenate([[0], np.searchsorted(starts, ends)])  # by text, its first word
    count = np.diff(first)
    places = np.maximum(count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(places)])
    text = np.repeat(np.arange(len(raw)), places)
    at = first[text] + np.arange(bounds[-1]) - bounds[text]
    out = np.minimum(count, width)[text].astype(np.uint64)
    for k in range(width):
        have = np.flatnonzero(k < count[text])
        out[have] += words[at[have] + k] * _PLACE[k]
    return mixed(out), bounds


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Like ``shingle_hashes``, each text's hashes ascending and without repetition."""
    hashes, bounds = shingle_hashes(texts, width)
    parts = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *parts]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def chunks(texts: list[str | None], size: int = 1 << 21):
    """Runs of texts of about ``size`` characters: (first, last exclusive)."""
    at = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
