"""Word-shingle hashes of many texts at once, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = x + _M3
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(_LOWER + np.uint64(1))
_POWERS = mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)
_PLACE = mix(np.arange(100, 100 + 64, dtype=np.uint64)) | np.uint64(1)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): 64-bit hashes of the A-Z lower-cased words of all texts, and how many each text has."""
    return hashed_words(texts)[:2]


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes``, and a hash of each word's last two bytes."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    word = ~_SPACE[raw]
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), np.zeros(0, np.uint64)
    chars = raw[word]
    lengths = last - first
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    at = np.arange(len(chars)) - np.repeat(begin, lengths)
    hashes = np.add.reduceat(_BYTE[chars] * (_POWERS[at & 4095] + (at >> 12).astype(np.uint64)), begin)
    ends = np.cumsum(sizes + 1)
    counts = np.diff(np.searchsorted(first, ends), prepend=0)
    end = _BYTE[raw[last - 1]] * np.uint64(3) + np.where(lengths > 1, _BYTE[raw[last - 2]], np.uint64(0))
    return mix(hashes + lengths.astype(np.uint64)), counts, mix(end)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    A text with fewer words has its whole sequence as one shingle; a text
    without words has an empty set.
    """
    hashes, counts = word_hashes(texts)
    out, at = [], 0
    if len(hashes) >= words:
        n = len(hashes) - words + 1
        rolled = hashes[:n] * _PLACE[0]
        for j in range(1, words):
            rolled = rolled + hashes[j : j + n] * _PLACE[j]
        rolled = mix(rolled)
    for c in counts.tolist():
        if c >= words:
            out.append(np.unique(rolled[at : at + c - words + 1]))
        elif c:
            part = hashes[at : at + c]
            out.append(mix(np.array([(part * _PLACE[:c]).sum(dtype=np.uint64) + np.uint64(c)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit key of a sorted set."""
    if not len(s):
        return 0
    total = mix(np.array([np.bitwise_xor.reduce(mix(s ^ _M1)) + mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))
    return int(total.view(np.int64)[0])
