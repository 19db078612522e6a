"""LM scoring with a weighted backoff automaton.

The model is a smoothed n-gram model over all training documents, of order three unless told otherwise. Its automaton
has a state for every run of up to n - 1 words that training had, an arc for every longer run that was seen, and a
failure arc from each state to that of its shorter suffix, down to the root, which has an arc for any word. No task
ever holds the whole automaton: documents are taken in blocks; each block asks for the counts of its own n-grams, the
owners of ranges of hashes add up what all blocks counted and answer, and the block's part of the automaton scores its
documents in one traversal from left to right.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, hashing

END, START = np.uint64(0x5BF0363546729C1D), np.uint64(0x2545F4914F6CDD1D)
#: Bytes of text in a block: about a million words.
BLOCK = 6 << 20
#: Kind of the rows that carry a block's documents; others have the length of their n-grams.
TEXTS = 0
#: Longer n-grams than words are known by 56 bits.
SHORT = ~np.uint64(0xFF)
ROWS = "kind int, slot int, block long, mark long, body binary, counts binary"


@dataclass
class Block:
    """Some documents as numbers of distinct n-grams.

    keys[k]: sorted hashes of the distinct runs of k + 1 words; the first run of a document starts at START. at[k]: the
    run that ends at each place, ends of documents included, -1 where the document is too short for one. sizes: tokens
    of each document, firsts: its first place. mark: a hash of all that.
    """

    keys: list[np.ndarray]
    at: list[np.ndarray]
    sizes: np.ndarray
    firsts: np.ndarray
    mark: int

    @classmethod
    def of(cls, texts: list[str], order: int) -> Block:
        hashes, n = hashing.word_hashes(texts)
        sizes, ends = n + 1, np.cumsum(n + 1) - 1
        flat = np.full(int(sizes.sum()), END, np.uint64)
        flat[np.delete(np.arange(len(flat)), ends)] = hashes
        firsts = ends - n
        nth = np.arange(len(flat)) - np.repeat(firsts, sizes)
        mark = np.bitwise_xor.reduce(hashing.mix(flat + np.arange(len(flat), dtype=np.uint64) * np.uint64(hashing.BASE)), initial=np.uint64(0))
        words, at = np.unique(flat, return_inverse=True)
        keys, places, last = [words], [at], flat
        for k in range(1, order):
            before = np.concatenate(([START], last[:-1]))
            before[firsts] = START
            last = hashing.mix(before * np.uint64(hashing.BASE) + flat) & SHORT
            long = nth >= k - 1
            found, inverse = np.unique(last[long], return_inverse=True)
            at = np.full(len(flat), -1)
            at[long] = inverse
            keys.append(found)
            places.append(at)
        return cls(keys, places, sizes, firsts, int(mark.view(np.int64)))

    def counted(self, train: np.ndarray) -> list[np.ndarray]:
        """How often each n-gram stands in the training documents."""
        own = np.repeat(train, self.sizes)
        return [np.bincount(at[own & (at >= 0)], minlength=len(keys)) for keys, at in zip(self.keys, self.at)]


def cut(keys: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """Where the sorted keys of each range (their high bits) lie."""
    slot = (keys >> np.uint64(64 - bits)).astype(np.int64)
    ends = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(keys)]
    return [(int(slot[a]), slice(a, b)) for a, b in zip(ends, ends[1:]) if b > a]


def pack(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte in planes, as many as the largest takes: high ones are nearly all zero and compress away."""
    planes = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return bytes([planes]) + np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()


def unpack(body: bytes) -> np.ndarray:
    planes = np.frombuffer(body, np.uint8, offset=1).reshape(body[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : body[0]] = planes.T
    return out.reshape(-1).view("<u8")


def pack_keys(keys: np.ndarray, kind: int) -> bytes:
    """Sorted keys of one range by the steps between them."""
    keys = keys >> np.uint64(8 * (kind > 1))
    return pack(np.diff(keys, prepend=keys[:1])) + keys[:1].tobytes()


def unpack_keys(body: bytes, kind: int) -> np.ndarray:
    steps = unpack(body[:-8]).copy()
    steps[0] = np.frombuffer(body, np.uint64, 1, len(body) - 8)[0]
    return np.cumsum(steps, dtype=np.uint64) << np.uint64(8 * (kind > 1))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches and their numbers: the same in every pass, as a partition's rows come in the same order."""
    held, size, number = [], 0, 0
    for batch in common.slices(batches, most=BLOCK):
        own = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if held and size + own > BLOCK:
            yield (held[0].column("part")[0].as_py() << 32) + number, joined(held)
            held, size, number = [], 0, number + 1
        held.append(batch)
        size += own
    if held:
        yield (held[0].column("part")[0].as_py() << 32) + number, joined(held)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def record(kind, slot, block, mark, body, counts) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((kind, slot, block, mark, body, counts), kinds)], ["kind", "slot", "block", "mark", "body", "counts"])


def asked(bits: int, order: int):
    """mapInArrow function: every block's distinct n-grams, with their training counts, by range."""

    def run(batches):
        for number, batch in blocks(batches):
            block = Block.of(batch.column("text").to_pylist(), order)
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for kind, (keys, n) in enumerate(zip(block.keys, block.counted(train)), 1):
                parts = cut(keys, bits) if len(keys) else []
                yield record([kind] * len(parts), [s for s, _ in parts], [number] * len(parts), [block.mark] * len(parts), [pack_keys(keys[p], kind) for _, p in parts], [pack(n[p]) for _, p in parts])

    return run


def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over rows sorted by key: the total counts of the n-grams that each block asked for.

    total and distinct: tokens and different words of the range in training, in one row of each range of words.
    """
    for table in common.by_key(batches):
        kind, slot = table.column("kind")[0].as_py(), table.column("slot")[0].as_py()
        lists = [unpack_keys(b, kind) for b in table.column("body").to_pylist()]
        n = np.concatenate([unpack(b) for b in table.column("counts").to_pylist()]).astype(np.int64)
        _, at = np.unique(np.concatenate(lists), return_inverse=True)
        sums = np.zeros(at.max() + 1, np.int64)
        np.add.at(sums, at, n)
        ends, rows = np.cumsum([*map(len, lists)]), len(lists)
        out = record([kind] * rows, [slot] * rows, table.column("block").to_pylist(), table.column("mark").to_pylist(), [b""] * rows, [pack(x) for x in np.split(sums[at], ends[:-1])])
        words = (np.arange(rows) == 0) & (kind == 1)
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.where(words, sums.sum(), 0)), pa.array(np.where(words, np.count_nonzero(sums), 0))], [*out.schema.names, "total", "distinct"])


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: the documents of each block as one compressed row."""
    for number, batch in blocks(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        yield record([TEXTS], [-1], [number], [0], [sink.getvalue().to_pybytes()], [b""])


def traverse(block: Block, counts: list[np.ndarray], base: np.ndarray, mu: float) -> np.ndarray:
    """log10 probability of each document: all go through the automaton side by side, one token a step.

    base: log10 of each word's own probability, the root's arcs. A document's state is the longest run of words before
    the token, of order - 1 at most, that training had; level: how many words that is. Where no arc leaves it with the
    token, its failure arc leads to the next shorter one.
    """
    order, at = len(counts), block.at
    ends = np.searchsorted(block.keys[0], END)
    starts = counts[0][ends] if ends < len(block.keys[0]) and block.keys[0][ends] == END else 0
    fail = [np.log10(mu / (n + mu)) for n in counts[:-1]]
    fail_start = np.log10(mu / (starts + mu))
    probability, arcs = [10.0**base], [base]
    first = np.zeros(int(block.sizes.sum()), bool)
    first[block.firsts] = True
    for k in range(1, order):
        place = np.flatnonzero(at[k] >= 0)
        one = np.empty(len(counts[k]), np.int64)  # a place of each run
        one[at[k][place]] = place
        context = np.where(first[one], starts, counts[k - 1][at[k - 1][one - 1]])
        probability.append((counts[k] + mu * probability[k - 1][at[k - 1][one]]) / (context + mu))
        arcs.append(np.log10(probability[k]))

    longest = np.argsort(-block.sizes, kind="stable")
    firsts, sizes = block.firsts[longest], block.sizes[longest]
    level, score = np.full(len(sizes), min(1, order - 1)), np.zeros(len(sizes))
    alive = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    for step, n in enumerate(alive.tolist()):
        place, rows = firsts[:n] + step, np.arange(n)
        for k in range(order - 1, 0, -1):
            known = level[rows] >= k
            own = rows[known]
            if not len(own):
                continue
            run = at[k][place[own]]
            seen = counts[k][run] > 0
            score[own[seen]] += arcs[k][run[seen]]
            lost = own[~seen]
            score[lost] += fail[k - 1][at[k - 1][place[lost] - 1]] if step else fail_start
            rows = np.concatenate((rows[~known], lost))
        score[rows] += base[at[0][place[rows]]]
        level[:n] = 0
        for k in range(order - 1):
            run = at[k][place]
            level[:n][(run >= 0) & (counts[k][run] > 0)] = k + 1
    out = np.empty(len(sizes))
    out[longest] = score
    return out


def scored(order: int, tokens: int, distinct: int, mu: float):
    """mapInArrow function over rows sorted by block, kind and slot: the documents of each block and their scores."""

    def run(batches):
        for table in common.by_key(batches, "block"):
            kind, marks, counts = table.column("kind").to_numpy(), table.column("mark").to_numpy(), table.column("counts").to_pylist()
            if kind[0] != TEXTS or (kind == TEXTS).sum() != 1:
                raise RuntimeError("the rows of a partition came in another order than before")
            batch = pa.ipc.open_stream(table.column("body")[0].as_py()).read_all()
            block = Block.of(batch.column("text").to_pylist(), order)
            if (marks[1:] != block.mark).any():
                raise RuntimeError("the rows of a partition came in another order than before")
            found = [np.concatenate([unpack(counts[i]) for i in np.flatnonzero(kind == k)] or [np.empty(0, np.uint64)]).astype(np.int64) for k in range(1, order + 1)]
            base = np.log10((found[0] + 0.5) / (tokens + 0.5 * (distinct + 1)))
            row = np.repeat(np.arange(len(block.sizes)), block.sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").combine_chunks(),
                    batch.column("held_out").combine_chunks(),
                    pa.array(block.sizes),
                    pa.array(np.bincount(row, found[0][block.at[0]] > 0, len(block.sizes)).astype(np.int64)),
                    pa.array(np.full(len(block.sizes), tokens, np.int64)),
                    pa.array(np.bincount(row, base[block.at[0]], len(block.sizes))),
                    pa.array(traverse(block, found, base, mu)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def lm_scores(documents: DataFrame, order: int = 3, mu: float = 3.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Learns from the documents whose crc32 of doc_id as text is not 1 modulo 5 (held_out: it is; a null id counts as
    the empty text). Tokens: runs without white space (space, 9 to 13), A-Z in lower case, and one end. base_score:
    the words on their own, as log10. score: log10 of the product of P(w after u v) over all tokens; P(w after u v) =
    (count of u v w + mu P(w after v)) / (count of u v + mu), and so on down to P(w) as in base_score; a document
    starts after one start mark, and order says how many words a run has. Null, empty and blank texts are the end
    alone, texts of any length count whole. Repeated rows count each time. An empty table gives no rows. Other columns,
    whatever their names, stay behind. documents is read twice and must come in the same order both times, as files
    do; otherwise common.save() it first: a block that differs raises an error. Without a training document every
    count is 0.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    docs = common.texts(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.crc32(ids) % 5 == 1).alias("held_out"), F.spark_partition_id().alias("part"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # As many ranges as blocks, so that an owner holds about as many n-grams as a block asks for.
    bits = int(np.clip(np.ceil(np.log2(max(size / BLOCK, 1))), 8, 22))
    asks = docs.mapInArrow(common.task(asked(bits, order)), ROWS).withColumn("key", F.col("kind").cast("long") * (1 << 32) + F.col("slot"))
    asks = asks.repartition("key").sortWithinPartitions("key", "block")
    answers = common.save(asks.mapInArrow(common.task(answered), ROWS + ", total long, distinct long"))
    tokens, distinct = answers.agg(F.sum("total"), F.sum("distinct")).first()
    rows = docs.mapInArrow(common.task(packed), ROWS).union(answers.drop("total", "distinct"))
    rows = rows.repartition("block").sortWithinPartitions("block", "kind", "slot")
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.mapInArrow(common.task(scored(order, int(tokens or 0), int(distinct or 0), mu)), out)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(common.read_table(spark, sf_dir, "documents"))
