"""Exact dedup through counting quotient filters.

Every input partition folds its fingerprints into a counting quotient filter: a fingerprint's high bits (the
quotient) choose the block, the low bits (the remainder) lie sorted in it with a counter each. Filters of the same
block merge without loss, remainder by sorted remainder, counters adding up. Fingerprints that count once are
unique; the rest go on to a comparison of the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

FILTER = "block int, remainders binary, counts binary"


def quotient_bits(partitions: int) -> int:
    """Blocks grow with the input, so that a merged one stays at some 100,000 fingerprints."""
    return int(np.clip(np.ceil(np.log2(max(partitions, 1))) + 2, 4, 20))


def build(bits: int):
    """mapInArrow function: one filter per partition, a row for each block in use."""
    low = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            fresh, n = np.unique(batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64), return_counts=True)
            found, counts = merge_runs([found, fresh], [counts, n])
        block = (found >> low).astype(np.int64)
        cuts = np.flatnonzero(np.diff(block)) + 1
        remainder = found & ((np.uint64(1) << low) - np.uint64(1))
        if len(found):
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(block[np.concatenate(([0], cuts))], pa.int32()),
                    "remainders": pa.array([packed(x, remainder_bytes(bits)) for x in np.split(remainder, cuts)], pa.binary()),
                    "counts": pa.array([packed(x.astype(np.uint64), count_bytes(x)) for x in np.split(counts, cuts)], pa.binary()),
                }
            )

    return run


def remainder_bytes(bits: int) -> int:
    """Bytes of a remainder: the quotient isn't stored."""
    return -(-(64 - bits) // 8)


def count_bytes(counts: np.ndarray) -> int:
    """Bytes of each counter of a block: one, where none is over 255."""
    return next(k for k in range(1, 9) if int(counts.max(initial=0)) < 1 << 8 * k)


def packed(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit numbers."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def opened(remainders: bytes, counts: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Remainders and counters of a block of a filter."""
    found = unpacked(remainders, remainder_bytes(bits))
    return found, unpacked(counts, max(1, len(counts) // max(len(found), 1))).astype(np.int64)


def merge_runs(runs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs into one; the counters of equal remainders add up. A stable sort merges runs that it finds sorted."""
    every, n = np.concatenate(runs), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    heads = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.empty(0, np.int64)
    return every[heads], np.add.reduceat(n, heads) if len(heads) else n


def repeated(bits: int):
    """applyInArrow function: merges the filters of a block and gives the fingerprints that count above one."""
    low = np.uint64(64 - bits)

    def run(table: pa.Table) -> pa.Table:
        block = np.uint64(table.column("block")[0].as_py())
        runs = [opened(r, n, bits) for r, n in zip(table.column("remainders").to_pylist(), table.column("counts").to_pylist())]
        found, n = merge_runs([r for r, _ in runs], [n for _, n in runs])
        more = (block << low) | found[n > 1]
        return pa.table({"fingerprint": pa.array(more.view(np.int64), pa.int64())})

    return run


def exact_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Texts are equal when they are the same bytes after lower-casing A-Z; null counts as empty. The row with the
    largest doc_id of its group stays. A row repeated with its doc_id counts each time and is kept with its twins; a
    null doc_id is below all others, and alone in its group keeps itself. Texts of any length are compared whole. An
    empty table gives no rows. Other columns, whatever their names, stay behind.
    """
    rows = common.texts(documents).withColumn("text", common.lower_az(F.col("text")))
    rows = rows.withColumn("fingerprint", F.xxhash64("text"))
    bits = quotient_bits(documents.rdd.getNumPartitions())
    filters = rows.select("fingerprint").mapInArrow(common.task(build(bits)), FILTER)
    suspects = common.save(filters.groupBy("block").applyInArrow(repeated(bits), "fingerprint long"))

    # Bytes decide: grouping by the text itself, combined before the shuffle, so a hot group moves a row a partition.
    groups = (
        rows.join(suspects, "fingerprint", "left_semi")
        .groupBy("fingerprint", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
        .select("fingerprint", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    groups = common.save(groups)
    common.discard(suspects)
    marked = rows.select("doc_id", "fingerprint", F.sha2("text", 256).alias("text_sha256"))
    joined = marked.join(groups, ["fingerprint", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(common.read_table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
