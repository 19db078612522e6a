"""Phrase collocation mining by Suffix-sigma.

Every word begins a suffix, cut off after max_n words or at the end of its piece; a phrase occurs as often as it is
the beginning of one. Suffixes are counted up within a task, shuffled by language and first word, sorted in reverse
lexicographic order, and one pass with a stack counts all their beginnings. Then the parts of each phrase are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import common, hashing

#: Words of text that a task counts up before they leave, and suffixes of a key on average.
BLOCK, KEY = 1 << 21, 1 << 20
#: A first word with more than one in so many of all words is hot: its suffixes go by their second word too, and so on.
HOT = 4096
#: Word frequencies are counted in so many cells to find hot words; a word that shares a hot one's cell is taken as hot.
CELLS = 1 << 16
#: Candidates of a language are ranked in so many parts, then what is left in fewer, at last together.
PARTS = 512, 32, 4, 1
#: Kinds of bytes: in a word, between words, and between pieces ([.,;:!?] and 10 to 13).
WORD, GAP, BREAK = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[9, 32]] = GAP
KIND[[10, 11, 12, 13, *b".,;:!?"]] = BREAK


def words_of(data: np.ndarray, word: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Runs of bytes that word marks, as strings, and where they start. The last byte is in none."""
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[word].tobytes())), starts


def coded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words, and the number of each word among them."""
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64)


def hashes_of(words: pa.Array) -> np.ndarray:
    """A hash of each of some distinct words."""
    return hashing.word_hashes(words.to_pylist(), lower=False)[0]


class Block:
    """Words of some texts of one language: their numbers, the distinct words, and the piece of each word."""

    def __init__(self, texts: list[str]):
        data = np.frombuffer(hashing.joined_texts(texts)[0], np.uint8)
        kind = KIND[data]
        words, starts = words_of(data, kind == WORD)
        self.piece = np.cumsum(kind == BREAK, dtype=np.int64)[starts]
        self.distinct, self.code = coded(words)

    def suffixes(self, max_n: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct suffixes, a row of max_n words each (from 1, 0: none), and how often each stands there."""
        n = len(self.code)
        columns = np.zeros((max_n, n), np.int64)
        for k in range(min(max_n, n)):
            columns[k, : n - k] = np.where(self.piece[: n - k] == self.piece[k:], self.code[k:] + 1, 0)
        rank, size = columns[0], len(self.distinct) + 1
        for k in range(1, max_n):
            _, first, rank, times = np.unique(rank * size + columns[k], return_index=True, return_inverse=True, return_counts=True)
        if max_n == 1:
            _, first, times = np.unique(rank, return_index=True, return_counts=True)
        return columns[:, first], times


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Block]]:
    """The texts of each language in blocks of about BLOCK words, a longer text alone."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in common.slices(batches, most=1 << 20):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text)
        if size > 5 * BLOCK:
            yield from ((lang, Block(texts)) for lang, texts in held.items())
            held, size = {}, 0
    yield from ((lang, Block(texts)) for lang, texts in held.items())


def frequencies(cells: int):
    """mapInArrow function: how many words fall into each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for _, block in blocks(batches):
            cell = (hashes_of(block.distinct) % np.uint64(cells)).astype(np.int64)
            total += np.bincount(cell, np.bincount(block.code, minlength=len(cell)), cells).astype(np.int64)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])

    return common.task(run)


def shuffled(max_n: int, hot: np.ndarray, keys: int):
    """mapInArrow function: suffixes packed by key.

    A key is drawn from the language and the words up to the first one that is not hot. A row holds the distinct words
    of its suffixes, a line each, their numbers column by column, and how often each suffix stands in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in blocks(batches):
            if not len(block.code):
                continue
            columns, times = block.suffixes(max_n)
            mark = np.concatenate((np.zeros(1, np.uint64), hashes_of(block.distinct)))
            often = hot[(mark % np.uint64(len(hot))).astype(np.int64)]
            often[0] = False
            spread = hashing.mix(mark[columns[0]] ^ hashing.word_hashes([lang or " ", "x"])[0][:1])
            going = often[columns[0]]
            for column in columns[1:]:
                spread = np.where(going, hashing.mix(spread + mark[column] + np.uint64(1)), spread)
                going &= often[column]
            key = (spread % np.uint64(keys)).astype(np.int64)
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order], prepend=-1))
            rows = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
                own = columns[:, order[a:b]]
                used, inverse = np.unique(own, return_inverse=True)
                some = used[used > 0]
                numbers = (inverse.reshape(own.shape) + (len(some) == len(used))).astype("<u2" if len(some) < 1 << 16 else "<u4")
                words = "\n".join(block.distinct.take(pa.array(some - 1)).to_pylist())
                rows.append((int(key[order[a]]), lang, words, numbers.tobytes(), times[order[a:b]].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.large_string(), pa.large_binary(), pa.large_binary()))], PACKED)

    return common.task(run)


PACKED = ["key", "lang", "words", "numbers", "times"]


def opened(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some packed rows in order, their suffixes as numbers of them (from 1, 0: none), and times."""
    lines = [x.encode() for x in table.column("words").to_pylist()]
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    distinct, code = coded(words_of(data, data != 10)[0])
    order = pc.array_sort_indices(distinct).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(1, len(order) + 1)
    code = place[code]
    columns, at = [], 0
    times = [np.frombuffer(x, "<u4").astype(np.int64) for x in table.column("times").to_pylist()]
    for line, numbers, n in zip(lines, table.column("numbers").to_pylist(), times):
        count = line.count(b"\n") + 1
        own = np.frombuffer(numbers, "<u2" if count < 1 << 16 else "<u4").reshape(-1, len(n))
        columns.append(np.concatenate(([0], code[at : at + count]))[own])
        at += count
    return distinct.take(pa.array(order)), np.concatenate(columns, axis=1), np.concatenate(times)


def beginnings(columns: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, first row and count of every beginning of suffixes in reverse order, the empty one included.

    The stack of a suffix is its beginnings. Where a suffix leaves that of the one before it from some depth on, what
    is open from there on closes with its count: all rows at a time, a depth after the other.
    """
    new = np.zeros(len(times), bool)
    new[:1] = True
    for depth in range(len(columns) + 1):
        if depth:
            new[1:] |= columns[depth - 1, 1:] != columns[depth - 1, :-1]
        starts = np.flatnonzero(new)
        count = np.add.reduceat(times, starts) if len(starts) else np.empty(0, np.int64)
        real = columns[depth - 1, starts] > 0 if depth else np.ones(len(starts), bool)
        yield depth, starts[real], count[real]


def phrases(hot: np.ndarray, least: int):
    """mapInArrow function over rows sorted by key: lang, phrase, size, n and whole for every beginning in a key.

    Of those that stand in this key only (whole), the ones with least or more; those of hot words alone, the empty one
    among them, stand in other keys too and leave with any count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.by_key(batches):
            langs = table.column("lang")
            for lang in langs.unique().to_pylist():
                distinct, columns, times = opened(table.filter(pc.equal(langs, lang)))
                order = np.lexsort(columns[::-1])[::-1]
                columns, times = columns[:, order], times[order]
                often = np.concatenate(([False], hot[(hashes_of(distinct) % np.uint64(len(hot))).astype(np.int64)]))
                for depth, rows, n in beginnings(columns, times):
                    part = often[columns[:depth, rows]].all(axis=0)
                    keep = part | (n >= least)
                    rows, n, part = rows[keep], n[keep], part[keep]
                    if not len(rows):
                        continue
                    words = [distinct.take(pa.array(columns[k, rows] - 1)) for k in range(depth)]
                    text = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if depth else pa.array([""] * len(rows), pa.large_string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), text.cast(pa.string()), pa.array(np.full(len(rows), depth, np.int32)), pa.array(n), pa.array(~part)], FOUND)

    return common.task(run)


FOUND = ["lang", "phrase", "size", "n", "whole"]


def phrase_counts(documents: DataFrame, max_n: int = 3, least: int = 10) -> DataFrame:
    """lang, phrase, size, n: every phrase of up to max_n words that occurs least times or more, and for each language
    the empty phrase with the number of all words. A saved table; see collocations for what a phrase is."""
    common.bound_batches(documents.sparkSession)
    docs = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    cells = docs.mapInArrow(frequencies(CELLS), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # CELLS rows at most
    often = np.zeros(CELLS, np.int64)
    often[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    total = int(often.sum())
    hot, keys = often > max(total / HOT, least), max(1, -(-total // KEY))
    packed = docs.mapInArrow(shuffled(max_n, hot, keys), "key long, lang string, words string, numbers binary, times binary")
    found = packed.repartition("key").sortWithinPartitions("key").mapInArrow(phrases(hot, least), "lang string, phrase string, size int, n long, whole boolean")
    found = common.save(found)
    parts = found.filter("not whole").groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("size") == 0))
    out = common.save(found.filter("whole").select("lang", "phrase", "size", "n").union(parts))
    common.discard(found)
    return out


def scored(cuts: DataFrame) -> DataFrame:
    """Adds score, floor(1000000 * a * a / (l * r)), exactly for counts below 10**15; a is neither above l nor above r."""
    exact = lambda c: F.col(c).cast("decimal(15,0)")
    above = (exact("a") * exact("a")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    cuts = cuts.withColumns({"above": above.cast("decimal(38,0)"), "below": (exact("l") * exact("r")).cast("decimal(38,0)")})
    return cuts.withColumn("score", F.expr("above div below")).drop("above", "below")


def collocations(documents: DataFrame, min_n: int = 2, max_n: int = 3, least: int = 10, top: int = 2000, share: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of min_n to max_n words that hold together best.

    Texts (A-Z in lower case) fall into pieces at [.,;:!?] and line ends, pieces into words at spaces and tabs; all is
    per lang, null being und. A phrase occurs wherever its words stand in a row within a piece (a), candidates least
    times or more. Cut after k words its parts occur l and r times; the cut with the lowest score counts, of equal ones
    the first. A candidate goes if its words stand in a row in a longer one that occurs in share of 100 of its places.
    Ranks go by score and a, descending, then by the bytes of the phrase; the first top of each language stay.
    Null and empty texts have no words; repeated rows count each; very long texts are taken whole; an empty table gives
    no rows; other columns, whatever their names, stay behind.
    """
    counts = phrase_counts(documents, max_n, least)
    words = counts.filter("size = 0").select("lang", F.col("n").alias("all"))
    some = counts.filter(F.col("size") >= min_n)
    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = some.select("lang", "phrase", "size", F.col("n").alias("a"), k.alias("k"))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - size)")})
    counted = counts.filter("size > 0")
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    best = scored(cuts).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # What stands in a longer candidate: all runs of its words, by where they start and how long they are.
    size = F.explode(F.sequence(F.lit(min_n), F.col("size") - 1))
    inner = some.filter(F.col("size") > min_n).select("lang", F.split("phrase", " ").alias("words"), "size", "n", size.alias("m"))
    inner = inner.select("lang", "words", "n", "m", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("m"))).alias("at"))
    longer = inner.groupBy("lang", F.array_join(F.slice("words", F.col("at") + 1, F.col("m")), " ").alias("phrase")).agg(F.max("n").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # What is not among the first of its part isn't among the first of all.
    for parts in PARTS:
        kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
        kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return kept.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("all").alias("n"), "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH p AS (
    SELECT row_number() OVER () AS k, lang, piece FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM w WHERE len(w) > 0),
f AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*)::HUGEINT AS c
    FROM s, (VALUES (1), (2), (3)) AS sizes(size) WHERE i + size - 1 <= len(w) GROUP BY ALL
), n AS (SELECT lang, sum(c) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, c AS a FROM f WHERE size > 1 AND c >= 10),
cut AS (
    SELECT lang, phrase, size, w, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:size], ' ') AS rest
    FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c)
), scored AS (
    SELECT cut.*, x.c AS l, y.c AS r, 1000000 * a * a // (x.c * y.c) AS score FROM cut
    JOIN f AS x ON x.lang = cut.lang AND x.phrase = first AND x.size = k JOIN f AS y ON y.lang = cut.lang AND y.phrase = rest AND y.size = cut.size - k
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
    SELECT lang, sub, max(a) AS m FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS sub FROM c WHERE size = 3) GROUP BY lang, sub
), kept AS (
    SELECT best.* FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.sub = best.phrase WHERE best.size = 3 OR m IS NULL OR 100 * m < 50 * a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000
"""
