"""What several operators share: text access, shared tables, byte-bounded batches."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import string
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch on its way to Python and back.
BATCH = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """From here on the session holds Arrow batches to BATCH bytes. Rows with whole texts are large, and a frame that
    an operator returns runs later, when no setting around a call would hold."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def texts(documents: DataFrame) -> DataFrame:
    """doc_id and text, null as empty; whatever else the table holds stays behind."""
    bound_batches(documents.sparkSession)
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def lower_az(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. Plain ASCII takes the fast path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or the one set on the context. Where neither is, no folder is known that all
    executors share: a RuntimeError, but in local mode, which is one process, a new folder for temporary files."""
    if path := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return path
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tilewright-"))
    return spark.sparkContext.getCheckpointDir()


def task(run: Callable) -> Callable:
    """Wraps a mapInArrow function: when its task ends, free memory goes back to the system. Workers live on from
    task to task and would otherwise each hold what their largest task needed."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def save(frame: DataFrame) -> DataFrame:
    """Cuts lineage: writes frame as a table in the shared folder and reads it back.

    Spark then knows its size, so later joins broadcast it only under
    spark.sql.autoBroadcastJoinThreshold and shuffle beyond that. Shuffle files go when the table is written.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/tilewright-{uuid.uuid4().hex}"
    schema = frame.schema
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        frame.write.parquet(path)
    back = spark.read.schema(schema).parquet(path)
    back.saved_at = path
    return back


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for what runs meanwhile."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of at most so many rows for what runs meanwhile: for tables whose rows are large."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def discard(*frames: DataFrame) -> None:
    """Deletes tables made by save() that no later plan reads."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.saved_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about most bytes of text, a longer text alone in its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def by_key(batches: Iterator[pa.RecordBatch], key: str = "key", least: int = 1) -> Iterator[pa.Table]:
    """The rows of each key as one table, from batches sorted by key (repartition and sortWithinPartitions before).

    Whole keys go together until a table has at least so many rows. Unlike a grouped map it starts no new call to
    Python for every small group.
    """
    held: list[pa.RecordBatch] = []
    rows, last = 0, None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        cuts, at = (np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), 0
        for cut in [0, *cuts] if held and last != keys[0] else cuts:
            if rows + cut - at >= least:
                yield pa.Table.from_batches([*held, batch.slice(at, cut - at)])
                held, rows, at = [], 0, cut
        held.append(batch.slice(at))
        rows, last = rows + len(keys) - at, keys[-1]
    if held:
        yield pa.Table.from_batches(held)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of n nodes the smallest node that the edges a-b reach from it."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node of each connected component, for every node that has an edge.

    edges: long columns a and b, a never equal to b. Each round every node moves to the neighbour whose hash is
    smallest, unless its own is, and the graph is drawn again over the targets, without doubles. Hashes are in no
    order that data could have, so a chain of any length shrinks by half a round on average and a star takes two; the
    logarithmic number of rounds is put together at the end.
    """
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    edges = save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    moves = []
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min(order("b")).alias("best"))
        moves.append(save(least.select(F.col("a").alias("node"), F.least("best", order("a")).getField("v").alias("to"))))
        at = lambda end: moves[-1].select(F.col("node").alias(end), F.col("to").alias(f"to_{end}"))
        moved = edges.join(at("a"), "a").join(at("b"), "b").filter("to_a != to_b")
        following = save(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
        discard(edges)
        edges = following
        if edges.isEmpty():
            break
    discard(edges)
    used = [moves.pop()]
    out = used[0].withColumnRenamed("to", "root")
    for move in reversed(moves):
        ends = out.select(F.col("node").alias("to"), "root")
        out = save(move.join(ends, "to", "left").select("node", F.coalesce("root", "to").alias("root")))
        used += [move, out]
    least = out.groupBy("root").agg(F.min("node").alias("component"))
    found = save(out.join(least, "root").select("node", "component"))
    discard(*used)
    return found
