"""64-bit hashes of words and shingles of whole texts, vectorised with numpy."""

from __future__ import annotations

import numpy as np

# ASCII white space: space and the control characters 9 to 13.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Odd multipliers; the word hash is a polynomial modulo 2^64 in BASE, finished by a mixing function.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_K = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)
_BLOCK = 1 << 21

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * _K[0]
    x = (x ^ (x >> np.uint64(27))) * _K[1]
    return x ^ (x >> np.uint64(31))


def _power_table(base: int, n: int) -> np.ndarray:
    key = hex(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= _BLOCK * 2:
            _powers[key] = have
    return have[:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each white-space separated word of ``data``, of any length."""
    if len(data) > _BLOCK:
        return _long_word_hashes(data)
    buf = np.frombuffer(data, dtype=np.uint8)
    if not len(buf):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = np.empty(len(buf) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    np.logical_not(_SPACE[buf], out=inside[1:-1].view(bool))
    change = np.diff(inside)
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    return range_hashes(buf, start, end), start


def range_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes ``start`` to ``end`` (exclusive) for any number of ranges of a buffer."""
    sums = np.empty(len(buf) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power_table(BASE, len(buf)), out=sums[1:])
    raw = (sums[end] - sums[start]) * _power_table(_INVERSE, len(buf) + 1)[start]
    return mix(raw + (end - start).astype(np.uint64))


def _long_word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Block by block, cut at white space, so that memory does not follow the text."""
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        piece = data[at:end]
        if len(piece) > _BLOCK:  # a word longer than a block
            h, s = _whole(piece)
        else:
            h, s = word_hashes(piece)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def _whole(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Words of a piece that holds one word beyond the block size; same values, word by word."""
    hashes, starts, at = [], [], 0
    for word in piece.split():
        at = piece.index(word, at)
        value, factor = np.uint64(0), np.uint64(1)
        with np.errstate(over="ignore"):
            for i in range(0, len(word), _BLOCK):
                part = np.frombuffer(word[i : i + _BLOCK], dtype=np.uint8).astype(np.uint64) + np.uint64(1)
                table = _power_table(BASE, _BLOCK)
                value += (part * table[: len(part)]).sum(dtype=np.uint64) * factor
                factor = factor * table[-1] * np.uint64(BASE)
        hashes.append(value + np.uint64(len(word)))
        starts.append(at)
        at += len(word)
    return mix(np.array(hashes, dtype=np.uint64)), np.array(starts, dtype=np.int64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; fewer words are one shingle, no words none."""
    if not len(words):
        return words
    width = min(size, len(words))
    n = len(words) - width + 1
    total = np.full(n, width if width < size else 0, dtype=np.uint64)
    for i in range(width):
        total = mix(total * _K[2] + words[i : i + n])
    return total


def shingle_set(data: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text in UTF-8, A-Z in lower case."""
    return np.unique(shingles(word_hashes(data.lower())[0], size))
