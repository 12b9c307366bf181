"""CRC-32 of many byte spans at once, from tables by position.

CRC-32 is linear up to a constant: the checksum of a span is the XOR of what each of its bytes contributes, given how
far it stands from the end, and of a constant of the span's length. The contributions of ``SIZE`` distances are a table;
``bitwise_xor.reduceat`` adds them up for all spans in one call. A longer span is folded blockwise: its blocks of ``SIZE``
bytes, counted from the end, give a value each, which in turn contributes by its distance in blocks, and so on by levels.
"""

from __future__ import annotations

from functools import cache

import numpy as np

SIZE = 64
#: Bytes looked at in one go, which bounds the memory whatever the spans' lengths.
WINDOW = 1 << 21
_POLYNOMIAL = 0xEDB88320
_ALL = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = (x >> np.uint32(1)) ^ np.where(x & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    return x


_STEP = _byte_table()


def _one_on(state: np.ndarray) -> np.ndarray:
    """The states after one more byte of zero."""
    return _STEP[state & np.uint32(255)] ^ (state >> np.uint32(8))


@cache
def _contributions() -> np.ndarray:
    """By distance from the end and byte."""
    rows = [_STEP]
    for _ in range(SIZE - 1):
        rows.append(_one_on(rows[-1]))
    return np.stack(rows)


def _moved(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    """States after the zeros ``table`` (by place and value of a state's byte) stands for."""
    out = table[..., 0, :][state & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ table[..., k, :][(state >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@cache
def _moves(level: int) -> np.ndarray:
    """By count, place and value of a state's byte: the state after count * SIZE**level bytes of zero."""
    start = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    one = _one_on(start) if level == 0 else _moved(_moves(level - 1)[1], _moves(level - 1)[-1])
    rows = [start, one]
    for _ in range(SIZE - 2):
        rows.append(_moved(one, rows[-1]))
    return np.stack(rows)


def _by_count(level: int, count: np.ndarray, state: np.ndarray) -> np.ndarray:
    table = _moves(level).reshape(-1)
    at = count.astype(np.int64) * 1024
    out = table[at + (state & np.uint32(255))]
    for k in range(1, 4):
        out ^= table[at + 256 * k + ((state >> np.uint32(8 * k)) & np.uint32(255))]
    return out


def advanced(state: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """The states after so many bytes of zero each."""
    level, state, zeros = 0, state.astype(np.uint32), np.asarray(zeros, np.int64)
    while zeros.any():
        state = _by_count(level, zeros % SIZE, state)
        zeros, level = zeros // SIZE, level + 1
    return state


@cache
def _constants() -> np.ndarray:
    """By length up to SIZE: the checksum of so many bytes of zero."""
    return advanced(np.full(SIZE + 1, _ALL), np.arange(SIZE + 1)) ^ _ALL


def _constant(length: np.ndarray) -> np.ndarray:
    out = _constants()[np.minimum(length, SIZE)]
    long = np.flatnonzero(length > SIZE)
    if len(long):
        out[long] = advanced(np.full(len(long), _ALL), length[long]) ^ _ALL
    return out


def _linear(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The XOR of the contributions of all bytes, by span; no span is empty."""
    ends = np.cumsum(length)
    first = ends - length
    within = np.arange(ends[-1]) - np.repeat(first, length)
    byte = data[np.repeat(starts, length) + within]
    distance = np.repeat(length, length) - 1 - within
    value = _contributions().reshape(-1)[(distance % SIZE) * 256 + byte]
    level = 0
    while True:
        if distance.max(initial=0) < SIZE:
            return np.bitwise_xor.reduceat(value, first)
        # blocks of SIZE, counted from the end of their span
        opens = distance % SIZE == SIZE - 1
        opens[first] = True
        at = np.flatnonzero(opens)
        value, distance = np.bitwise_xor.reduceat(value, at), distance[at] // SIZE
        first = np.searchsorted(at, first)
        level += 1
        value = _by_count(level, distance % SIZE, value)


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The checksums of ``data[starts[i]:ends[i]]``; spans may overlap and be of any length."""
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    length = ends - starts
    out = _constant(length)
    whole = np.flatnonzero((length > 0) & (length <= WINDOW))
    if len(whole):
        group = np.cumsum(length[whole]) // WINDOW
        for part in np.split(whole, np.flatnonzero(np.diff(group)) + 1):
            out[part] ^= _linear(data, starts[part], length[part])
    for i in np.flatnonzero(length > WINDOW):
        cuts = np.arange(starts[i], ends[i], WINDOW)
        for low in cuts:
            high = min(low + WINDOW, ends[i])
            piece = _linear(data, np.array([low]), np.array([high - low]))
            out[i] ^= advanced(piece, np.array([ends[i] - high]))[0]
    return out
