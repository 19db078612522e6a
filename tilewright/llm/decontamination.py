"""Benchmark decontamination by winnowing.

Of every run of consecutive word n-grams the one with the smallest hash is a fingerprint, so texts that share a run of
words as long as guaranteed share a fingerprint in it, at the same place. Fingerprints of documents and of benchmark
items meet in a join; what meets is extended, within the words around it, to the windows it may belong to, and those
are compared as words. Nothing depends on hashes but which places are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import common, hashing

#: Bytes of words: 0-9, a-z and whatever is beyond ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[97:123] = INSIDE[128:] = True
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bits for each fingerprint of the benchmark in the filter that documents pass, and the least and most of them, as powers
#: of two: 16 MB at most. Beyond that size more fingerprints pass, and the join takes them.
FILTER, FILTER_BITS = 16, (16, 27)
#: A fingerprint: length of its windows, hash, words before it in span, place of span's first word, words around it.
SEED = "struct<length:int,hash:long,lead:int,first:long,span:string>"


def scheme(length: int) -> tuple[int, int]:
    """n of the n-grams, and how many of them a run has: runs span length words."""
    n = (length + 1) // 2
    return n, length - n + 1


def winnow(hashes: np.ndarray, counts: np.ndarray, run: int) -> np.ndarray:
    """Places of fingerprints: in every run of so many hashes within a text the smallest, of equal ones the last."""
    n = len(hashes) - run + 1
    if n < 1:
        return np.empty(0, np.int64)
    best, at = hashes[run - 1 :].copy(), np.full(n, run - 1)
    for k in range(run - 2, -1, -1):
        less = hashes[k : k + n] < best
        best[less] = hashes[k : k + n][less]
        at[less] = k
    whole = np.repeat(np.cumsum(counts), counts)[:n] - np.arange(n) >= run
    chosen = np.zeros(len(hashes), bool)
    chosen[(np.arange(n) + at)[whole]] = True
    return np.flatnonzero(chosen)


def seeds_of(joined: bytes, words: tuple, counts: np.ndarray, length: int, some: np.ndarray, bits: np.ndarray | None) -> tuple:
    """Text and SEED fields of the fingerprints of the texts that some marks, those that the bits let pass."""
    starts, ends, hashes = words
    n, run = scheme(length)
    grams, each = hashing.grams(hashes, counts, n)
    at = winnow(grams, each, run)
    text = np.searchsorted(np.cumsum(each), at, side="right")
    value = hashing.mix(grams[at] + np.uint64(length))
    keep = some[text] if bits is None else some[text] & passes(bits, value)
    at, text, value = at[keep], text[keep], value[keep]
    begin = np.cumsum(counts) - counts
    word = at - (np.cumsum(each) - each)[text] + begin[text]
    low = np.maximum(begin[text], word - (length - n))
    high = np.minimum(begin[text] + counts[text], word + length)
    spans = [b" ".join([joined[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]).decode("utf-8", "replace") for a, b in zip(low.tolist(), high.tolist())]
    return text, np.full(len(at), length, np.int32), value.view(np.int64), (word - low).astype(np.int32), low - begin[text], spans


def passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    cell = (values & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def fingerprinted(lengths: list[int], longest: int, bits: np.ndarray | None = None):
    """mapInArrow function: id, mark, n_words and seeds of every text.

    With bits, those fingerprints for windows of each of lengths that they let pass; without, those of the text's own
    windows: of longest words, or of all words where a text has fewer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, most=1 << 20):
            joined, sizes = hashing.joined_texts(batch.column("text").to_pylist())
            words = hashing.spans(joined, INSIDE)
            counts = np.diff(np.searchsorted(words[0], np.cumsum(sizes)), prepend=0)
            found = [seeds_of(joined, words, counts, x, counts >= x if bits is not None or x == longest else counts == x, bits) for x in lengths]
            text = np.concatenate([f[0] for f in found])
            order = np.argsort(text, kind="stable")
            spans = pa.array([s for f in found for s in f[5]], pa.string()).take(pa.array(order))
            fields = [pa.array(np.concatenate([f[k] for f in found])[order]) for k in (1, 2, 3, 4)] + [spans]
            ends = np.searchsorted(text[order], np.arange(len(sizes) + 1)).astype(np.int32)
            seeds = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["length", "hash", "lead", "first", "span"]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(counts), seeds], ["id", "mark", "n_words", "seeds"])

    return common.task(run)


MARKED = f"id long, mark long, n_words long, seeds array<{SEED}>"


def filter_bits(prints: DataFrame) -> np.ndarray:
    """A bit for each hash, FILTER times as many bits as rows within FILTER_BITS; comes in blocks of 4 KB."""
    size = 1 << int(np.clip(np.ceil(np.log2(FILTER * prints.count() + 1)), *FILTER_BITS))
    cells = prints.select((F.col("hash").bitwiseAND(F.lit(size - 1)) + 1).alias("cell"))  # Spark numbers bits from 1
    blocks = cells.groupBy(F.bitmap_bucket_number("cell").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).toArrow()
    out = np.zeros(max(size // 8, 4096), np.uint8)
    for block, bits in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist()):
        out[(block - 1) * 4096 : block * 4096] = np.frombuffer(bits, np.uint8)
    return out[: size // 8]


def keyed(rows: DataFrame, key: str) -> DataFrame:
    """id, mark, text: rows of one id with different texts are told apart by a hash of the text."""
    return rows.select(F.col(key).cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))


def gram(span: str | Column, lead: str, length: str) -> Column:
    """The words of the fingerprint within its span."""
    n = F.floor((F.col(length) + 1) / 2).cast("int")
    return F.array_join(F.slice(F.split(span, " "), F.col(lead) + 1, n), " ")


class Leaks:
    """Where windows of benchmark items stand in documents.

    A window is longest consecutive words of an item (A-Z in lower case); an item of fewer words, but not none, is one
    window. Null and blank texts have no words. Items of one text, or with windows in common, meet a document once: a
    window stands for the set of items that have it. Items without an id hit words, but are neither counted nor listed;
    repeated rows of an item count once. Very long texts are taken whole; empty tables give no hits; other columns,
    whatever their names, stay behind.
    """

    def __init__(self, documents: DataFrame, benchmark: DataFrame, longest: int = 10):
        common.bound_batches(documents.sparkSession)
        docs, items = keyed(documents, "doc_id"), keyed(benchmark, "item_id")
        words = F.regexp_extract_all(common.lower_az(F.col("text")), F.lit(WORD), F.lit(0))
        items = items.select("id", "mark", "text", words.alias("words")).filter("size(words) > 0")
        items = items.withColumn("length", F.least(F.size("words"), F.lit(longest)))
        lengths = sorted(r.length for r in items.select("length").distinct().collect())  # of 1 to longest

        own = items.select("id", "mark", "text").mapInArrow(fingerprinted(lengths, longest), MARKED) if lengths else None
        bits = np.zeros(1, np.uint8)
        if lengths:
            own = own.select(F.explode("seeds").alias("s")).select("s.length", "s.hash", gram("s.span", "s.lead", "s.length").alias("gram"))
            own = common.save(own.distinct())
            bits = filter_bits(own)
        #: Every document with the fingerprints that may be an item's: id, mark, n_words, seeds.
        self.docs = common.save(docs.select("id", "mark", "text").mapInArrow(fingerprinted(lengths, longest, bits) if lengths else counted, MARKED))

        start = F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length")))
        window = F.array_join(F.slice("words", F.col("at") + 1, F.col("length")), " ").alias("window")
        item_windows = common.save(items.select("id", "words", "length", start.alias("at")).select("id", window).distinct())
        # A set of items is known by 128 bits and its size.
        owners = F.struct(F.bit_xor(F.xxhash64("id")).alias("a"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("b"), F.count("id").alias("n"))
        self.windows = common.save(item_windows.groupBy("window").agg(owners.alias("owners")))
        first = self.windows.groupBy("owners").agg(F.min("window").alias("window"))
        #: owners, id: the items of every set.
        self.members = common.save(item_windows.filter("id is not null").join(first, "window").select("owners", "id"))

        seeds = self.docs.select("id", "mark", F.explode("seeds").alias("s")).select("id", "mark", "s.*")
        if lengths:
            met = seeds.withColumn("gram", gram("span", "lead", "length")).join(own, ["length", "hash", "gram"], "left_semi")
        else:
            met = seeds
        around = met.select("id", "mark", "length", "first", F.split("span", " ").alias("words")).filter(F.size("words") >= F.col("length"))
        around = around.select("id", "mark", "length", "first", "words", start.alias("at"))
        #: id, mark, at, length, owners: every occurrence of a window, the same one from more than one fingerprint.
        self.hits = common.save(around.select("id", "mark", (F.col("first") + F.col("at")).alias("at"), "length", window).join(self.windows, "window").drop("window"))
        common.discard(item_windows, *([own] if lengths else []))

    def per_document(self) -> DataFrame:
        """id, mark, n_hit (words inside occurrences) and sets: the sets of items that have windows in the document."""
        before = W.partitionBy("id", "mark").orderBy("at", "length").rowsBetween(W.unboundedPreceding, -1)
        end = F.col("at") + F.col("length")
        fresh = F.greatest(F.lit(0), end - F.greatest("at", F.coalesce(F.max(end).over(before), F.lit(0))))
        rows = self.hits.withColumn("fresh", fresh)
        return rows.groupBy("id", "mark").agg(F.sum("fresh").alias("n_hit"), F.sort_array(F.collect_set("owners")).alias("sets"))

    def items(self, found: DataFrame) -> DataFrame:
        """sets, n_items, item_ids (as strings, in order): worked out once for all documents with the same sets."""
        one = found.select("sets").distinct().select("sets", F.explode("sets").alias("owners")).join(self.members, "owners")
        ids = F.array_sort(F.collect_set(F.col("id").cast("string")))
        return one.groupBy("sets").agg(F.count_distinct("id").alias("n_items"), ids.alias("item_ids"))

    def discard(self) -> None:
        common.discard(self.docs, self.windows, self.members, self.hits)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: texts and no fingerprints, for a benchmark without words."""
    for batch in common.slices(batches, most=1 << 20):
        joined, sizes = hashing.joined_texts(batch.column("text").to_pylist())
        counts = np.diff(np.searchsorted(hashing.spans(joined, INSIDE)[0], np.cumsum(sizes)), prepend=0)
        none = pa.array([[]] * len(counts), pa.list_(pa.struct([("length", pa.int32()), ("hash", pa.int64()), ("lead", pa.int32()), ("first", pa.int64()), ("span", pa.string())])))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(counts), none], ["id", "mark", "n_words", "seeds"])


def decontaminate(documents: DataFrame, benchmark: DataFrame, longest: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids and contaminated for every row; see Leaks for what counts.

    A null doc_id is a document like any other; repeated rows come out alike.
    """
    leaks = Leaks(documents, benchmark, longest)
    found = common.save(leaks.per_document())
    found = common.save(found.join(leaks.items(found), "sets", "left").select("id", "mark", "n_hit", "n_items", "item_ids"))
    marks = leaks.docs.select(F.col("id").alias("doc_id"), F.col("mark").alias("m"), "n_words")
    out = marks.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("m") == F.col("mark")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), (n_hit > 0).alias("contaminated"),
    )


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), i AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), iw AS (
    SELECT DISTINCT item_id, g, array_to_string(w[a:a + g - 1], ' ') AS s
    FROM (SELECT item_id, w, least(len(w), 10) AS g, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS a FROM i WHERE len(w) > 0)
), dw AS (
    SELECT k, a, g, array_to_string(w[a:a + g - 1], ' ') AS s
    FROM (SELECT k, w, g, unnest(generate_series(1, len(w) - g + 1)) AS a FROM d, (SELECT DISTINCT g FROM iw) WHERE len(w) >= g)
), h AS (SELECT k, a, g, item_id FROM dw JOIN iw USING (g, s)),
p AS (SELECT k, count(DISTINCT x) AS n_hit FROM (SELECT k, unnest(generate_series(a, a + g - 1)) AS x FROM h) GROUP BY k),
q AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY k)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (k) LEFT JOIN q USING (k)
"""
