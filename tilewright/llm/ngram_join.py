"""N-gram Jaccard join by MinHash banding.

Documents with the same set of n-grams count once, with their number. Signatures are cut into bands, chosen for a
target recall; equal bands meet in a shuffle, where every member is tied to the smallest one, so a bucket of any size
gives as many rows as it has members. What hangs together is verified on the full n-gram sets, in blocks of bounded
size; every pair within is compared, and only counts and a spanning forest leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, hashing

#: Documents of a block; two blocks are compared at a time.
BLOCK = 384
#: n-gram columns of the matrix products at a time.
COLUMNS = 2048


def choose_bands(threshold: float, recall: float = 0.999, low: float = 0.5, most: float = 0.25) -> tuple[int, int]:
    """Bands and rows of the smallest signature that finds a pair at the threshold with probability recall, and one
    of similarity low with probability most or less."""
    best = None
    for rows in range(1, 33):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**rows))))
        if 1 - (1 - low**rows) ** bands <= most and (best is None or bands * rows < best[0] * best[1]):
            best = bands, rows
    if best is None:
        raise ValueError("no signature parts these similarities")
    return best


def shingles(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words (A-Z in lower case), text by text, and their numbers.

    A text of fewer words has one n-gram, all of them; one without words has none.
    """
    words, counts = hashing.word_hashes(texts)
    out, sizes = hashing.grams(words, counts, n)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        starts = np.cumsum(counts) - counts
        own = np.array([hashing.mix(np.bitwise_xor.reduce(words[starts[i] : starts[i] + counts[i]] * np.arange(3, 2 * counts[i] + 3, 2, dtype=np.uint64))[None])[0] for i in short], np.uint64)
        out = np.insert(out, np.cumsum(sizes)[short], own)
        sizes = sizes.copy()
        sizes[short] = 1
    return out, sizes


def by_row(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by row, then by value (64 bits). One sort of both in one number, where that settles it."""
    if len(row) and row[-1] < 1 << 24:
        key = row.astype(np.uint64) << np.uint64(40) | value >> np.uint64(24)
        order = np.argsort(key)
        key, value = key[order], value[order]
        tied = key[1:] == key[:-1]
        if not (tied & (value[1:] != value[:-1])).any():
            return order
        return order[np.lexsort((value, key))]
    return np.lexsort((value, row))


def unique_sets(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without doubles."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = by_row(row, hashes)
    hashes, row = hashes[order], row[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[fresh], np.bincount(row[fresh], minlength=len(sizes))


def signed(n: int, bands: int, rows: int):
    """mapInArrow function: doc_id, fingerprint of the n-gram set (two numbers) and the bands of its signature.

    All but doc_id are null where there is no n-gram.
    """
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, most=1 << 20):
            hashes, sizes = unique_sets(*shingles(batch.column("text").to_pylist(), n))
            full = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[full]
            buckets, sums = np.zeros((len(sizes), bands), np.uint64), np.zeros((2, len(sizes)), np.uint64)
            if len(full):
                for band in range(bands):
                    acc = np.full(len(full), band + 1, np.uint64)
                    for k in range(band * rows, (band + 1) * rows):
                        acc = hashing.mix(acc ^ np.minimum.reduceat(hashes * a[k] + b[k], starts))
                    buckets[full, band] = acc
                sums[0, full] = np.add.reduceat(hashing.mix(hashes), starts)
                sums[1, full] = np.bitwise_xor.reduceat(hashes * a[0], starts) + sizes[full].astype(np.uint64)
            none = sizes == 0
            packed = [row.tobytes() for row in buckets]
            columns = [pa.array(x.view(np.int64), mask=none) for x in sums] + [pa.array(packed, pa.binary(), mask=none)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "f1", "f2", "bands"])

    return run


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep and bands -> a row (bucket, rep) for each band."""
    for batch in batches:
        packed = batch.column("bands").to_pylist()
        if packed:
            bucket = np.frombuffer(b"".join(packed), np.int64)
            rep = np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), len(bucket) // len(packed))
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(rep)], ["bucket", "rep"])


def with_sets(n: int):
    """mapInArrow function: the text of each row replaced by its packed n-gram set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, most=1 << 20):
            hashes, sizes = unique_sets(*shingles(batch.column("text").to_pylist(), n))
            packed = [x.tobytes() for x in np.split(hashes, np.cumsum(sizes)[:-1])] if len(sizes) else []
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("cluster"), batch.column("members"), batch.column("blocks"), pa.array(packed, pa.binary())], ["rep", "cluster", "members", "blocks", "grams"])

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Common n-grams of every two sets, by products of 0/1 matrices."""
    column = np.unique(np.concatenate(sets), return_inverse=True)[1]
    row = np.repeat(np.arange(len(sets)), [*map(len, sets)])
    often = np.bincount(column) > 1
    column, row = (np.cumsum(often) - 1)[column[often[column]]], row[often[column]]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    last = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, last, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        part = np.zeros((len(sets), min(COLUMNS, last - at)), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out


def verified(threshold: float):
    """mapInArrow function over rows sorted by key: rep, links (documents linked, copies counted) and root.

    A key holds one block, or two different ones of which only pairs across count here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.by_key(batches):
            # A repeated row brings its set again.
            table = table.take(pa.array(np.unique(table.column("rep").to_numpy(), return_index=True)[1]))
            rep, block, members = (table.column(c).to_numpy() for c in ("rep", "block", "members"))
            sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
            common_n, n = shared_counts(sets), np.array([*map(len, sets)], np.float64)
            linked = common_n >= threshold * (n[:, None] + n[None, :] - common_n) - 1e-6
            np.fill_diagonal(linked, False)
            if (block != block[0]).any():
                linked &= block[:, None] != block[None, :]
            links = linked @ members.astype(np.float64)
            i, j = np.nonzero(linked)
            root = rep[common.roots(len(rep), i, j)]  # reps ascend
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some])], ["rep", "links", "root"])

    return run


def block_pairs(rows: DataFrame) -> DataFrame:
    """Sends each row of a cluster of B blocks to every pair of blocks that holds its own: key, block."""
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("block", block).select("*", other.alias("other"))
    pair = F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other"))
    return rows.select(pair.alias("key"), "rep", "block", "members", "grams")


def ngram_join(documents: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """doc_id, class_id, n_links, kept for every row.

    Two documents link when the Jaccard similarity of their sets of n-word runs (A-Z in lower case, words between
    white space) is threshold or more; class_id is the smallest doc_id that links reach, n_links the number of other
    rows linked directly, kept whether the row is its class's smallest. A text of 1 to n - 1 words is one n-gram; null,
    empty and blank texts link with nothing. Repeated rows link with each other and share one class; a null doc_id
    never is a class and keeps itself only when alone. Ids should be unique: where rows of one id differ in text, the
    class of each is still known by its own set, but one of the texts stands for the id in comparisons. Texts of any
    length count whole. An empty table gives no rows.
    Other columns, whatever their names, stay behind.
    """
    bands, rows = choose_bands(threshold, recall)
    docs = common.texts(documents).selectExpr("cast(doc_id as long) doc_id", "text")
    marks = common.save(docs.mapInArrow(common.task(signed(n, bands, rows)), "doc_id long, f1 long, f2 long, bands binary"))
    groups = common.save(marks.filter("f1 is not null").groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members"), F.min("bands").alias("bands")))

    buckets = groups.filter("rep is not null").select("rep", "bands").mapInArrow(common.task(unpacked), "bucket long, rep long")
    hubs = buckets.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    candidates = buckets.join(hubs, "bucket").filter("rep != hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    clusters = common.components(candidates)

    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("long").alias("blocks"))
    wanted = clusters.join(sizes, "component").join(groups.select(F.col("rep").alias("node"), "members"), "node")
    wanted = common.save(wanted.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"), "members", "blocks"))
    sets = docs.join(wanted, "doc_id").select(F.col("doc_id").alias("rep"), "cluster", "members", "blocks", "text").mapInArrow(common.task(with_sets(n)), "rep long, cluster long, members long, blocks long, grams binary")
    tasks = block_pairs(sets).repartition("key").sortWithinPartitions("key")
    checked = common.save(tasks.mapInArrow(common.task(verified(threshold)), "rep long, links long, root long"))
    classes = common.components(checked.filter("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))

    named = groups.select("f1", "f2", "rep", "members").join(links, "rep", "left").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
    named = common.save(named.select("f1", "f2", F.coalesce("component", "rep").alias("class_id"), (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    common.discard(groups, clusters, wanted, checked, classes)
    out = marks.select("doc_id", "f1", "f2").join(named, ["f1", "f2"], "left")
    class_id = F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    out = out.select("doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_classes(documents: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of documents, with all their columns, that stay when each class keeps its smallest doc_id. Rows without
    an id stay."""
    gone = common.save(ngram_join(documents, n, threshold).filter("not kept and doc_id is not null").select("doc_id").distinct())
    return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(common.read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
    FROM d
), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM e AS a JOIN e AS b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), reach AS (
    SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach AS r JOIN pairs AS p ON r.b = p.a
), least AS (SELECT a, min(b) AS m FROM reach GROUP BY a), degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(m, doc_id)) AS class_id, coalesce(n, 0) AS n_links, doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM documents LEFT JOIN least ON least.a = doc_id LEFT JOIN degree ON degree.a = doc_id
"""
