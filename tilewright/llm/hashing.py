"""64-bit hashes of words and n-grams, over whole arrays of text at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes hashed at a time; arrays of eight times that size are alive meanwhile.
WINDOW = 1 << 18
#: Bytes of words between white space: all but space and 9 to 13.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (the finishing steps of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            _powers[k] = np.cumprod(out, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def _window(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word in bytes that end with one that is in no word."""
    edge = np.flatnonzero(np.diff(np.take(inside, data), prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    power, inverse = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.take(_BYTE, data, out=total[1:], mode="clip")
    total[1:] *= power
    np.cumsum(total[1:], out=total[1:])
    sums = total[ends]
    sums -= total[starts]
    sums *= inverse[starts]
    sums += (ends - starts).astype(np.uint64)
    return starts, ends, mix(sums)


def _windows(joined: bytes, inside: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Where a window of bytes begins, and start, end and hash of the words in it. The last byte is in no word."""
    data, at = np.frombuffer(joined, np.uint8), 0
    while at < len(data):
        end = min(at + WINDOW, len(data))
        if end < len(data):  # back to white space, or on to it where a word is longer than the window
            cut = max(joined.rfind(c, at, end) for c in (b" ", b"\n"))
            if cut < at:
                cut = min((c for c in (joined.find(b" ", end), joined.find(b"\n", end)) if c >= 0), default=len(data) - 1)
            end = cut + 1
        yield at, *_window(data[at:end], inside)
        at = end


def spans(joined: bytes, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word: runs of bytes that inside marks. The last byte is in no word."""
    found = [(s + at, e + at, h) for at, s, e, h in _windows(joined, inside)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def joined_texts(texts: list[str], lower: bool = True, sep: bytes = b"\n") -> tuple[bytes, np.ndarray]:
    """All texts end to end, each closed by sep, and their sizes with it; lower puts A-Z in lower case."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
    joined = sep.join(coded) + sep
    return joined.lower() if lower else joined, sizes


def word_hashes(texts: list[str], lower: bool = True, sep: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, end to end, and how many words each text has.

    Words are runs without white space (space, 9 to 13); lower puts A-Z in lower case first.
    """
    if not texts:
        return np.empty(0, np.uint64), np.zeros(0, np.int64)
    joined, sizes = joined_texts(texts, lower, sep)
    starts, hashes = [], []
    for at, s, _, h in _windows(joined, NOT_SPACE):
        starts.append(s + at)
        hashes.append(h)
    ends = np.searchsorted(np.concatenate(starts), np.cumsum(sizes))
    return np.concatenate(hashes), np.diff(ends, prepend=0)


def grams(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within each text, and how many each text has. Shorter texts have none."""
    if n == 1:
        return hashes, counts
    if len(hashes) < n:
        return np.empty(0, np.uint64), np.zeros(len(counts), np.int64)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out *= np.uint64(BASE)
        out += hashes[k : len(hashes) - n + 1 + k]
    out = mix(out)
    ends = np.cumsum(counts)
    inside = np.repeat(ends, counts)[: len(out)] - np.arange(len(out)) >= n
    return out[inside], np.maximum(counts - n + 1, 0)
