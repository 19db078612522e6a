"""Byte-level BPE encoding and decoding by speculation and verification.

Greedy longest match proposes tokens for all new words of a batch in lockstep. A proposal is the true encoding when
each token encodes to itself and no adjacent pair would have merged across its border at any earlier moment; that
check runs once over all adjacent pairs as arrays. Only words that fail it go through the exact merges.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from . import bpe, common


class ByteCodec:
    """One byte-level vocabulary. Symbols are token ids throughout."""

    def __init__(self, vocabulary_file: str, pattern: str):
        from tokenizers import Tokenizer

        with open(vocabulary_file, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        alphabet = bpe.byte_alphabet()
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        left, right, merged = (np.array([vocab[x] for x in xs], np.int64) for xs in zip(*((a, b, a + b) for a, b in merges)))
        self.pairs = bpe.Pairs.of(left, right, np.arange(len(merges)), merged)
        self.merger = bpe.Merger(self.pairs)
        # How each token came about: its rank (-1 for bytes) and the two halves.
        self.born, self.left, self.right = np.full(size, -1), np.arange(size), np.arange(size)
        self.born[merged], self.left[merged], self.right[merged] = np.arange(len(merges)), left, right
        self.byte_id = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        self._trie([*vocab.values()])
        self.split, self.split_latin = regex.compile(pattern), bpe.latin(pattern)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.tokenizer = Tokenizer.from_file(vocabulary_file)
        self.ids: dict[str, str] = {}
        self.held = 0
        self.decoded: dict[str, bytes] = {}
        self.size_of = np.array([*map(len, self.bytes_of)])
        self.text_of = [*map(str, range(size))]

    def _trie(self, ids: list[int]) -> None:
        """Transitions node << 8 | byte -> child, over the tokens that encode to themselves."""
        flat = np.frombuffer(b"".join(self.bytes_of[i] for i in ids), np.uint8)
        sizes = np.array([len(self.bytes_of[i]) for i in ids])
        _, left = self.merger.merge(self.byte_id[flat], sizes)
        step: dict[int, int] = {}
        accept = [-1]
        for i in (i for i, n in zip(ids, left.tolist()) if n == 1):
            node = 0
            for b in self.bytes_of[i]:
                key = node << 8 | b
                if key not in step:
                    step[key] = len(accept)
                    accept.append(-1)
                node = step[key]
            accept[node] = i
        self.step_key = np.array(sorted(step), np.int64)
        self.step_to = np.array([step[k] for k in self.step_key.tolist()], np.int64)
        self.accept = np.array(accept, np.int64)

    def speculate(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest match from the left in all words at once: tokens end to end, and tokens per word."""
        end = np.cumsum(sizes)
        pos = end - sizes
        word = np.flatnonzero(sizes > 0)
        pos, end = pos[word], end[word]
        node, best, best_end = np.zeros(len(word), np.int64), np.full(len(word), -1), pos.copy()
        words, tokens = [], []
        while len(word):
            inside = pos < end
            key = node << 8 | np.where(inside, flat[np.minimum(pos, len(flat) - 1)], 0)
            at = np.minimum(np.searchsorted(self.step_key, key), len(self.step_key) - 1)
            goes = inside & (self.step_key[at] == key)
            node = np.where(goes, self.step_to[at], 0)
            pos = pos + goes
            full = goes & (self.accept[node] >= 0)
            best, best_end = np.where(full, self.accept[node], best), np.where(full, pos, best_end)
            stop = ~goes
            if stop.any():
                words.append(word[stop])
                tokens.append(best[stop])
                pos = np.where(stop, best_end, pos)
                live = ~(stop & (best_end >= end))
                word, pos, end, node, best, best_end = (x[live] for x in (word, pos, end, node, best, best_end))
        if not words:
            return np.empty(0, np.int64), np.zeros(len(sizes), np.int64)
        words, tokens = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(words, kind="stable")
        return tokens[order], np.bincount(words, minlength=len(sizes))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of neighbours stays apart.

        Both tokens are taken back in time, the later-born half first. At each moment the two parts that touch would
        merge if their pair ranks before what next happened to either of them; of equal ranks the leftmost goes first.
        """
        ok = np.ones(len(a), bool)
        place = np.arange(len(a))
        a_next, b_next = np.full(len(a), bpe.NONE), np.full(len(a), bpe.NONE)
        while len(place):
            rank, _ = self.pairs.find(a, b)
            clash = (rank < a_next) & (rank <= b_next) & (rank < bpe.NONE)
            ok[place[clash]] = False
            live = ~clash & ((self.born[a] >= 0) | (self.born[b] >= 0))
            place, a, b, a_next, b_next = (x[live] for x in (place, a, b, a_next, b_next))
            undo_a = self.born[a] > self.born[b]
            a_next, b_next = np.where(undo_a, self.born[a], a_next), np.where(undo_a, b_next, self.born[b])
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tokens, n = self.speculate(flat, sizes)
        row = np.repeat(np.arange(len(words)), n)
        inner = np.flatnonzero(row[1:] == row[:-1])
        key, back = np.unique(tokens[inner] << 32 | tokens[inner + 1], return_inverse=True)
        wrong = ~self.compatible(key >> 32, key & 0xFFFFFFFF)[back]
        failed = np.zeros(len(words), bool)
        failed[row[inner[wrong]]] = True
        if not failed.any():
            return tokens, n
        at_byte = np.repeat(failed, sizes)
        exact, m = self.merger.merge(self.byte_id[flat[at_byte]], sizes[failed])
        good = ~failed[row]
        row = np.concatenate((row[good], np.repeat(np.flatnonzero(failed), m)))
        order = np.argsort(row, kind="stable")
        return np.concatenate((tokens[good], exact))[order], np.bincount(row, minlength=len(words))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def learn(self, words: set[str]) -> None:
        """Remembers of each new word its ids as text and the bytes that those ids decode to."""
        fresh = list(words - self.ids.keys())
        if not fresh:
            return
        tokens, n = self.encode_words([w.encode() for w in fresh])
        ids = tokens.tolist()
        text, decoded = [*map(self.text_of.__getitem__, ids)], self.decode(ids)
        ends = np.cumsum(n)
        bytes_to = np.concatenate(([0], np.cumsum(self.size_of[tokens])))[ends]
        self.held += 8 * len(ids) + 2 * len(decoded) + 2 * bpe.ENTRY * len(fresh)
        ends, bytes_to = [0, *ends.tolist()], [0, *bytes_to.tolist()]
        for i, w in enumerate(fresh):
            self.ids[w] = ",".join(text[ends[i] : ends[i + 1]])
            self.decoded[w] = decoded[bytes_to[i] : bytes_to[i + 1]]

    def words(self, text: str) -> list[str]:
        if self.split_latin:
            try:
                text.encode("latin-1")
                return self.split_latin.findall(text)
            except UnicodeEncodeError:
                pass
        if bpe.UNSETTLED.search(text):
            return bpe.split_by_library(self.tokenizer, text)
        return self.split.findall(text)

    def parts(self, text: str) -> list[str]:
        """Words and special strings in order; a special string is its own word."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.words(text)
        out = []
        for piece in self.cut.split(text):
            out += [piece] if piece in self.special else self.words(piece)
        return out

    def encode(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Of each text its ids joined by commas, and those ids decoded."""
        split = [self.parts(t) for t in texts]
        if self.held > bpe.KEPT:
            self.ids.clear()
            self.decoded.clear()
            self.held = 0
        for token, i in self.special.items():
            self.ids[token], self.decoded[token] = str(i), self.bytes_of[i]
        self.learn(set().union(*split))
        ids, decoded = self.ids.__getitem__, self.decoded.__getitem__
        return [(",".join(map(ids, words)), b"".join(map(decoded, words))) for words in split]


def coded(vocabulary_file: str | None, pattern: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        codec = ByteCodec(vocabulary_file or public_tokenizers.path("byte_bpe_50k.json"), pattern or public_tokenizers.PATTERN)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in common.slices(batches):
            got = codec.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array([ids.count(",") + 1 if ids else 0 for ids, _ in got], pa.int64()),
                    "ids_sha256": pa.array([sha(ids.encode()) for ids, _ in got], pa.string()),
                    "decoded_sha256": pa.array([sha(b.decode("utf-8", "replace").encode()) for _, b in got], pa.string()),
                }
            )

    return run


def bpe_round_trip(documents: DataFrame, vocabulary_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row: the whole text encoded, then decoded from its ids.

    Null and empty texts have no tokens and the digests of the empty string. Texts of any length are taken whole.
    Repeated rows come out each; a null doc_id is carried along. An empty table gives no rows. Other columns, whatever
    their names, stay behind.
    """
    rows = common.texts(documents).selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(common.task(coded(vocabulary_file, pattern)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(common.read_table(spark, sf_dir, "documents"))
