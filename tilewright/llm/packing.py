"""Best-fit packing of token sequences after Martello and Toth's dominance reduction.

A document's pieces enter the packing by their length alone, and there are at most `capacity` lengths. So the whole
instance is a table of counts with at most that many rows, however many documents there are: it is reduced and packed
as counts, and the plan that comes out (which ranks of which length go to which sequences) is bounded as well. Spark
ranks the pieces of each length and looks every one up in the plan.
"""

from __future__ import annotations

import functools
import itertools
import json
import random
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common

#: Pieces of one length that are ranked together: a more frequent length is dealt out in parts of about so many.
RANKED = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordCodec:
    """Word-level BPE with an end-of-word mark: NFC, lower case, white space dropped. Words map to packed ids."""

    def __init__(self, vocabulary_file: str):
        with open(vocabulary_file, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        mark = spec["model"]["end_of_word_suffix"]
        left, right, merged = zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in merges))
        self.merger = bpe.Merger(bpe.Pairs.of(left, right, np.arange(len(merges)), merged))
        self.inner, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for c, b in bpe.byte_alphabet().items():
            self.inner[b], self.last[b] = vocab[c], vocab[c + mark]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split, self.split_latin = regex.compile(pattern), bpe.latin(pattern)
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.vocabulary_file = vocabulary_file
        self.known: dict[str, bytes] = {}
        self.held = 0

    @functools.cached_property
    def tokenizer(self):
        """The library's own, for texts whose splitting it has to settle: few, so it isn't loaded for the others."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary_file)

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.split_latin.findall(text.lower())
        if bpe.UNSETTLED.search(text):
            return bpe.split_by_library(self.tokenizer, text)
        # Lower case goes letter by letter: a sigma at a word's end stays an ordinary one.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        try:
            text.encode("latin-1")
            return self.split_latin.findall(text)
        except UnicodeEncodeError:
            return self.split.findall(text)

    def parts(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self.words(text)
        out = []
        for piece in self.cut.split(text):
            out += [piece] if piece in self.special else self.words(piece)
        return out

    def learn(self, words: set[str]) -> None:
        fresh = list(words - self.known.keys())
        if not fresh:
            return
        coded = [w.encode() for w in fresh]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.frombuffer(b"".join(coded), np.uint8)
        symbols, ends = self.inner[flat], np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        ids, n = self.merger.merge(symbols, sizes)
        packed, ends = ids.astype("<u4").tobytes(), [0, *(4 * np.cumsum(n)).tolist()]
        for i, w in enumerate(fresh):
            self.known[w] = packed[ends[i] : ends[i + 1]]
        self.held += len(packed) + len(flat) + bpe.ENTRY * len(fresh)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Of each text its ids as little-endian unsigned 32-bit numbers."""
        split = [self.parts(t) for t in texts]
        if self.held > bpe.KEPT:
            self.known.clear()
            self.held = 0
        self.known.update(self.special)
        self.learn(set().union(*split))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def cut_pieces(vocabulary_file: str | None, end_id: int, capacity: int):
    """mapInArrow function: the pieces of every text. salt: a number that deals pieces out evenly, repeated rows too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        codec = WordCodec(vocabulary_file or public_tokenizers.path("word_bpe_49k.json"))
        end = np.array([end_id], "<u4").tobytes()
        salt = itertools.count(random.getrandbits(24))
        for batch in common.slices(batches, most=1 << 20):
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), codec.encode(batch.column("text").to_pylist())):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), next(salt)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    return run


@dataclass
class Bins:
    """count bins alike: runs of (length, how many), and the room left in each."""

    runs: list[tuple[int, int]]
    count: int
    room: int


def reduce_instance(counts: np.ndarray, capacity: int) -> list[Bins]:
    """Fixes sets that dominate every other feasible set holding their largest item, and takes them out of counts.

    For an item of length j with r = capacity - j left and k the longest other item that fits:
    {j} when nothing fits; {j, k} when k fills r, when no two others fit together, or when at most two fit and no
    two sum to more than k; {j, a, b} when at most two fit and a >= b bound every other fitting pair item by item.
    """
    fixed, changed = [], True
    while changed:
        changed = False
        for j in np.flatnonzero(counts)[::-1].tolist():
            while counts[j]:
                best = dominating(counts, j, capacity - j)
                if best is None:
                    break
                need: dict[int, int] = {j: 1}
                for x in best:
                    need[x] = need.get(x, 0) + 1
                times = min(int(counts[x]) // n for x, n in need.items())
                for x, n in need.items():
                    counts[x] -= n * times
                fixed.append(Bins(sorted(need.items(), reverse=True), times, capacity - j - sum(best)))
                changed = True
    return fixed


def dominating(counts: np.ndarray, j: int, r: int) -> tuple[int, ...] | None:
    """The items that go with one of length j in a dominating set; None where no such set is known."""
    counts[j] -= 1
    try:
        fits = np.flatnonzero(counts[: r + 1])
        if not len(fits):
            return ()
        k = int(fits[-1])
        if k == r:
            return (k,)
        low = []  # the three smallest
        for x in fits[:3].tolist():
            low += [x] * min(3, int(counts[x]))
        low = low[:3]
        if len(low) < 2 or low[0] + low[1] > r:
            return (k,)
        if len(low) == 3 and sum(low) <= r:
            return None
        # At most two others fit. The longest partner of each x, not x itself unless there are two.
        upto = np.zeros(r + 1, np.int64)
        upto[fits] = fits
        upto = np.maximum.accumulate(upto)
        partner = upto[r - fits]
        alone = (partner == fits) & (counts[fits] < 2)
        partner[alone] = upto[np.maximum(fits[alone] - 1, 0)]
        pairs = partner > 0
        if not pairs.any() or int((fits + partner)[pairs].max()) <= k:
            return (k,)
        a = k
        b = int(partner[-1])
        least = np.minimum(fits, partner)[pairs].max()
        return (a, b) if b > 0 and b <= a and int(least) <= b else None
    finally:
        counts[j] += 1


def best_fit(counts: np.ndarray, capacity: int) -> list[Bins]:
    """Best-fit decreasing on counts: equal items go into equal bins together, the fullest that still fit first."""
    by_room: dict[int, list[Bins]] = {}
    rooms = np.zeros(capacity + 1, bool)

    def put(bins: Bins) -> None:
        by_room.setdefault(bins.room, []).append(bins)
        rooms[bins.room] = True

    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            found = np.flatnonzero(rooms[size:])
            if len(found):
                room = int(found[0]) + size
                bins = by_room[room].pop()
                rooms[room] = bool(by_room[room])
            else:
                room, bins = capacity, Bins([], -(-left // (capacity // size)), capacity)
            each = room // size
            used = min(bins.count, left // each)
            if used == 0:
                used, each = 1, left
            if bins.count > used:
                put(Bins(bins.runs, bins.count - used, room))
            put(Bins([*bins.runs, (size, each)], used, room - each * size))
            left -= used * each
        counts[size] = 0
    return [b for bins in by_room.values() for b in bins if b.runs]


def plan_packing(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Rows (length, first_rank, each, first_sequence, offset) in order, and the number of sequences.

    Pieces of a length ranked from first_rank on lie there, each to a sequence, at offset and after one another.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    rank, rows, sequences = np.zeros(capacity + 1, np.int64), [], 0
    for bins in [*reduce_instance(counts, capacity), *best_fit(counts, capacity)]:
        offset = 0
        for size, each in bins.runs:
            rows.append((size, int(rank[size]), each, sequences, offset))
            rank[size] += each * bins.count
            offset += size * each
        sequences += bins.count
    return np.array(sorted(rows), np.int64).reshape(-1, 5), sequences


def placed(slots: np.ndarray, first: np.ndarray, before: np.ndarray):
    """mapInArrow function: global rank of each piece in its length, then its slot.

    slots: rows of plan_packing. before[first[length] + part]: pieces of that length in the parts before.
    """
    key = slots[:, 0] << 40 | slots[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
            length = take("length")
            rank = take("rank") - 1 + before[first[length] + take("part")]
            slot = slots[np.searchsorted(key, length << 40 | rank, side="right") - 1]
            nth = rank - slot[:, 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(slot[:, 3] + nth // slot[:, 2]), pa.array(slot[:, 4] + nth % slot[:, 2] * length)],
                [*names, "sequence_id", "offset"],
            )

    return run


def pack_documents(documents: DataFrame, capacity: int = 4096, end_id: int = 1, vocabulary_file: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece of every row and its place.

    A document is its tokens and the end id; only one longer than capacity is cut, into pieces of capacity tokens and
    a last, shorter one. Texts of any length count whole; null and empty ones are the end id alone. Repeated rows are
    packed each; a null doc_id is carried along. An empty table gives no rows. Other columns stay behind.
    """
    rows = common.texts(documents).selectExpr("cast(doc_id as long) doc_id", "text")
    spark = documents.sparkSession
    pieces = common.save(rows.mapInArrow(common.task(cut_pieces(vocabulary_file, end_id, capacity)), PIECES + ", salt long"))

    # At most capacity rows, whatever the input; then as many more as there are times RANKED pieces.
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    parts = -(-counts // RANKED)
    first = np.cumsum(parts) - parts
    dealt = spark.createDataFrame([(n, int(parts[n])) for n in np.flatnonzero(parts).tolist()], "length long, parts long")
    pieces = pieces.join(F.broadcast(dealt), "length").withColumn("part", F.pmod("salt", "parts")).drop("salt", "parts")
    before = np.zeros(int(parts.sum()), np.int64)
    if (parts > 1).any():
        many = pieces.filter(F.col("length").isin(np.flatnonzero(parts > 1).tolist()))
        for r in many.groupBy("length", "part").count().collect():
            before[first[r["length"]] + r["part"]] = r["count"]
        for n in np.flatnonzero(parts > 1).tolist():
            own = before[first[n] : first[n] + parts[n]]
            own[:] = np.cumsum(own) - own
    slots, _ = plan_packing({int(n): int(counts[n]) for n in np.flatnonzero(counts)}, capacity)

    ranked = pieces.selectExpr("*", "row_number() OVER (PARTITION BY length, part ORDER BY doc_id, piece, start, ids_crc32) AS rank")
    return ranked.mapInArrow(common.task(placed(slots, first, before)), PIECES + ", sequence_id long, offset long")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.read_table(spark, sf_dir, "documents"))
