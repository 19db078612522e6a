"""Vectorised byte-pair merging over ragged batches of words, shared by the token operators."""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import regex

NONE = np.int64(1) << 40
#: Bytes, about, that a worker keeps of words it has met, with what each of them stands for; then it starts anew.
KEPT = 32 << 20
#: Bytes that an entry takes beside its word and value.
ENTRY = 160
#: Longer sequences merge one by one on a heap: in step with short ones they would be quadratic.
LONG = 512


@dataclass
class Pairs:
    """Mergeable pairs: key left << 32 | right in ascending order, with rank and merged symbol."""

    key: np.ndarray
    rank: np.ndarray
    merged: np.ndarray
    #: Place in the table of each pair of symbols below 256 (first letters of words), else -1.
    small: np.ndarray

    @classmethod
    def of(cls, left, right, rank, merged) -> Pairs:
        key = np.asarray(left, np.int64) << 32 | np.asarray(right, np.int64)
        order = np.argsort(key)
        key = key[order]
        small = np.full(1 << 16, -1)
        low = np.flatnonzero((key >> 32 < 256) & (key & 0xFFFFFFFF < 256))
        small[(key[low] >> 32) << 8 | (key[low] & 0xFF)] = low
        return cls(key, np.asarray(rank, np.int64)[order], np.asarray(merged, np.int64)[order], small)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE where it does not merge) and its place in the table.

        Symbols below 0 merge with nothing: such a key is negative and never in the table.
        """
        low = (left | right) >> 8 == 0
        at = self.small[np.where(low, left << 8 | right, 0)]
        high = np.flatnonzero(~low)
        key = left[high] << 32 | (right[high] & 0xFFFFFFFF)
        found = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        at[high] = np.where((self.key[found] == key) & (right[high] >= 0), found, -1)
        return np.where(at >= 0, self.rank[at], NONE), at


def merge_one(symbols: list[int], table: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same merges on one long sequence: a heap of (rank, position), leftmost first."""
    n = len(symbols)
    sym, after, before = list(symbols), [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [(hit[0], i, sym[i], sym[i + 1]) for i in range(n - 1) if (hit := table.get((sym[i], sym[i + 1])))]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j < 0 or sym[i] != a or sym[j] != b:
            continue
        sym[i], sym[j] = table[a, b][1], None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0 and (hit := table.get((sym[x], sym[y]))):
                heapq.heappush(heap, (hit[0], x, sym[x], sym[y]))
    return [s for s in sym if s is not None]


class Merger:
    """Rank-synchronous merging: in every round each sequence applies its lowest-rank pair, the leftmost of equals."""

    def __init__(self, pairs: Pairs):
        self.pairs = pairs
        self._table: dict | None = None

    def _dict(self) -> dict:
        if self._table is None:
            p = self.pairs
            self._table = {(k >> 32, k & 0xFFFFFFFF): (r, m) for k, r, m in zip(p.key.tolist(), p.rank.tolist(), p.merged.tolist())}
        return self._table

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """symbols of all sequences end to end and their lengths -> the same after all merges."""
        symbols, lengths = symbols.astype(np.int64), np.asarray(lengths, np.int64)
        out_row, out_sym = [], []
        row = np.repeat(np.arange(len(lengths)), lengths)
        if (long := lengths > LONG).any():
            starts = np.concatenate(([0], np.cumsum(lengths)))
            for r in np.flatnonzero(long):
                got = merge_one(symbols[starts[r] : starts[r + 1]].tolist(), self._dict())
                out_row.append(np.full(len(got), r))
                out_sym.append(np.array(got, np.int64))
            keep = ~long[row]
            symbols, row = symbols[keep], row[keep]
        rank, at = self._ranks(symbols, row)
        while len(symbols):
            heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            least = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.append(heads, len(row)))
            best = np.repeat(least, sizes)
            done = best == NONE
            if done.any():  # sequences with no pair left are finished
                out_row.append(row[done])
                out_sym.append(symbols[done])
                symbols, row, rank, at, best = (x[~done] for x in (symbols, row, rank, at, best))
                if not len(symbols):
                    break
            hits = np.flatnonzero(rank == best)
            hits = hits[np.concatenate(([True], row[hits[1:]] != row[hits[:-1]]))]
            symbols[hits] = self.pairs.merged[at[hits]]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            hits = hits - np.arange(len(hits))  # each row lost one symbol after its hit
            symbols, row, rank, at = (x[keep] for x in (symbols, row, rank, at))
            touched = np.concatenate((hits, hits[hits > 0] - 1))
            self._rerank(touched, symbols, row, rank, at)
        if not out_row:
            return np.empty(0, np.int64), np.zeros(len(lengths), np.int64)
        row, symbols = np.concatenate(out_row), np.concatenate(out_sym)
        order = np.argsort(row, kind="stable")
        return symbols[order], np.bincount(row, minlength=len(lengths))

    def _ranks(self, symbols, row):
        rank, at = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        self._rerank(np.arange(len(symbols)), symbols, row, rank, at)
        return rank, at

    def _rerank(self, places, symbols, row, rank, at):
        rank[places] = NONE
        places = places[places + 1 < len(symbols)]
        places = places[row[places] == row[places + 1]]
        rank[places], at[places] = self.pairs.find(symbols[places], symbols[places + 1])


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def latin(pattern: str) -> re.Pattern | None:
    """The same split for Latin-1 texts, without Unicode classes: the plain re module is faster."""
    letters, digits, spaces = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
    inside = lambda m: m[0].replace(r"\p{L}", letters).replace(r"\p{N}", digits).replace(r"\s", spaces)
    plain = regex.sub(r"\[[^\]]*\]", inside, pattern)
    for name, chars in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{digits}]"), (r"\s", f"[{spaces}]"), (r"\S", f"[^{spaces}]")):
        plain = plain.replace(name, chars)
    return None if r"\p" in plain else re.compile(plain)


#: Characters outside ranges whose Unicode classes have long been settled: there the regex module and the tokenizers
#: library may know different versions, so such texts are split into words by the library's own rules.
UNSETTLED = re.compile("[^\x00-\u04ff\u1e00-\u1eff\u2000-\u206f\u20ac]")


def split_by_library(tokenizer, text: str) -> list[str]:
    """Words by the normalizer and pre-tokenizer of a tokenizers.Tokenizer."""
    if tokenizer.normalizer is not None:
        text = tokenizer.normalizer.normalize_str(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
