"""Embedding near-dedup with a forest of random-projection trees.

Vectors of one label are split again and again along random directions, with some overlap at every split, in several
independent trees; vectors that share a leaf are compared. A pair that shares several leaves belongs to the first of
them, so every link is counted once and no list of pairs is ever made. Equal vectors go through as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Settings:
    """trees: independent trees. leaf: vectors that a leaf should hold. overlap: how far from a split, as a share of
    the distance that two vectors at the threshold have along a random direction (standard deviation), vectors go both
    ways. node: vectors, about, on which the last split above a leaf is set; least: on which those of a label are, at
    the least. first: levels that are set in one go from one sample of a label; deeper ones are set below each of their
    nodes, from a sample that grows with the depth. values: most split values in all, which bounds the forest that
    every task gets. block: vectors compared at a time."""

    trees: int = 4
    leaf: int = 256
    overlap: float = 0.6
    node: int = 8
    least: int = 4096
    first: int = 11
    values: int = 4_000_000
    block: int = 1024
    seed: int = 11


@dataclass
class Forest:
    """By space, that is label and number of components: splits[space][tree] in heap order. By number of components:
    directions[dim][tree, level], and the margin on either side of a split."""

    directions: dict[int, np.ndarray]
    splits: dict[tuple[int, int], np.ndarray]
    margin: dict[int, float]

    def route(self, vectors: np.ndarray, label: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each tree (vector, leaf) for every leaf that a vector falls into. A space without splits is one leaf."""
        dim = vectors.shape[1]
        splits, out = self.splits.get((label, dim)), []
        if splits is None:
            return [(np.arange(len(vectors)), np.zeros(len(vectors), np.int64))]
        margin, depth = self.margin[dim], int(np.log2(splits.shape[1] + 1))
        for tree, values in enumerate(splits):
            row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
            for level in range(depth):
                side = vectors @ self.directions[dim][tree, level]
                off = side[row] - values[node]
                left, right = off <= margin, off >= -margin
                row, node = np.concatenate((row[left], row[right])), np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
            out.append((row, node))
        return out


def set_splits(vectors: np.ndarray, directions: np.ndarray, depth: int) -> np.ndarray:
    """Medians of the sample at every node of a tree, in heap order."""
    out, node = np.zeros(2**depth - 1), np.zeros(len(vectors), np.int64)
    for level in range(depth):
        side = vectors @ directions[level]
        order = np.lexsort((side, node))
        ends = np.searchsorted(node[order], np.arange(2**level - 1, 2 ** (level + 1)))
        for k in range(2**level):
            at = order[ends[k] : ends[k + 1]]
            out[2**level - 1 + k] = np.median(side[at]) if len(at) else 0.0
        node = 2 * node + 1 + (side > out[node])
    return out


def descended(vectors: np.ndarray, directions: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """The one node below the splits of a tree that each vector falls into, margins aside, counted from the left."""
    node = np.zeros(len(vectors), np.int64)
    for level in range(int(np.log2(len(splits) + 1))):
        node = 2 * node + 1 + (vectors @ directions[level] > splits[node])
    return node - len(splits)


def unit(rows) -> np.ndarray:
    found = np.asarray(rows, np.float64)
    found = found / np.abs(found).max(axis=1, keepdims=True)  # no square overflows or vanishes
    return found / np.sqrt((found * found).sum(axis=1, keepdims=True))


def sampled(vectors: DataFrame, shares: dict[tuple[int, int], float], seed: int) -> DataFrame:
    """About the given share of each space, by a hash of the vector's id; other spaces are left out."""
    spark = vectors.sparkSession
    rows = [(label, dim, min(1.0, share)) for (label, dim), share in shares.items()]
    wanted = F.broadcast(spark.createDataFrame(rows, "label long, dim int, share double"))  # SPACES rows at most
    return vectors.join(wanted, ["label", "dim"]).filter(F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(1 << 40)) < F.col("share") * (1 << 40)).drop("share")


#: Spaces with a forest of their own, the largest first; any other is one leaf, compared in blocks.
SPACES = 1024


def fit(vectors: DataFrame, threshold: float, settings: Settings) -> Forest:
    """Splits from samples: of each space with more than a leaf of vectors, settings.node for every leaf it gets.

    vectors: label, dim, rep, vector. The upper levels of a space are one group, each node below them another, so no
    group has more than settings.node * 2**settings.first vectors, or settings.least, about.
    """
    big = vectors.groupBy("label", "dim").agg(F.count("*").alias("n")).filter(F.col("n") > settings.leaf)
    big = big.orderBy(F.desc("n"), "label", "dim").limit(SPACES).collect()
    depths, counts, room = {}, {}, settings.values // settings.trees
    for r in big:
        depth = int(min(np.ceil(np.log2(r.n / settings.leaf)), 2 * settings.first, np.floor(np.log2(max(room, 1)))))
        if depth > 0:
            depths[r.label, r.dim], counts[r.label, r.dim], room = depth, r.n, room - 2**depth
    directions, margin = {}, {}
    for dim in {d for _, d in depths}:
        found = np.random.default_rng([settings.seed, dim]).normal(size=(settings.trees, max(n for (_, d), n in depths.items() if d == dim), dim))
        directions[dim] = found / np.linalg.norm(found, axis=2, keepdims=True)
        margin[dim] = settings.overlap * np.sqrt(2 * (1 - threshold) / dim)
    forest = Forest(directions, {}, margin)
    if not depths:
        return forest
    first = settings.first

    def upper(table: pa.Table) -> pa.Table:
        space = table.column("label")[0].as_py(), table.column("dim")[0].as_py()
        rows = unit(table.column("vector").to_pylist())
        found = np.stack([set_splits(rows, d, min(depths[space], first)) for d in directions[space[1]]])
        return pa.table({"label": pa.array([space[0]], pa.int64()), "dim": pa.array([space[1]], pa.int32()), "splits": pa.array([found.tobytes()], pa.binary())})

    share = {space: max(settings.least, settings.node * 2.0 ** min(depth, first)) / counts[space] for space, depth in depths.items()}
    rows = sampled(vectors, share, settings.seed).groupBy("label", "dim").applyInArrow(upper, "label long, dim int, splits binary").collect()  # settings.values at most
    for r in rows:
        forest.splits[r.label, r.dim] = np.frombuffer(r.splits).reshape(settings.trees, -1)
    deep = {space: depth for space, depth in depths.items() if depth > first and space in forest.splits}
    if not deep:
        return forest

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, dims = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "dim"))
            for label, dim in set(zip(labels.tolist(), dims.tolist())):
                own = batch.filter(pa.array((labels == label) & (dims == dim)))
                found = unit(own.column("vector").to_pylist())
                for tree, splits in enumerate(forest.splits[label, dim]):
                    node = descended(found, directions[dim][tree], splits)
                    same = lambda x, kind: pa.array(np.full(len(node), x), kind)
                    yield pa.RecordBatch.from_arrays([same(label, pa.int64()), same(dim, pa.int32()), same(tree, pa.int32()), pa.array(node), own.column("vector")], ["label", "dim", "tree", "node", "vector"])

    def lower(table: pa.Table) -> pa.Table:
        label, dim, tree, node = (table.column(c)[0].as_py() for c in ("label", "dim", "tree", "node"))
        found = set_splits(unit(table.column("vector").to_pylist()), directions[dim][tree, first:], deep[label, dim] - first)
        return pa.table({"label": pa.array([label], pa.int64()), "dim": pa.array([dim], pa.int32()), "tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64()), "splits": pa.array([found.tobytes()], pa.binary())})

    share = {space: settings.node * 2.0**depth / counts[space] for space, depth in deep.items()}
    kind = vectors.schema["vector"].dataType.simpleString()
    placed = sampled(vectors, share, settings.seed + 1).select("label", "dim", "vector").mapInArrow(common.task(place), f"label long, dim int, tree int, node long, vector {kind}")
    below = placed.groupBy("label", "dim", "tree", "node").applyInArrow(lower, "label long, dim int, tree int, node long, splits binary")
    for space, depth in deep.items():
        forest.splits[space] = np.concatenate([forest.splits[space], np.zeros((settings.trees, 2**depth - 2**first))], axis=1)
    for r in below.toLocalIterator():  # settings.values at most
        found, whole = np.frombuffer(r.splits), forest.splits[r.label, r.dim][r.tree]
        for level in range(deep[r.label, r.dim] - first):
            at = 2 ** (first + level) - 1 + (r.node << level)
            whole[at : at + 2**level] = found[2**level - 1 : 2 ** (level + 1) - 1]
    return forest


LEAVES = "label long, dim int, leaf long, rep long, members long, vector binary, leaves binary"


def routed(forest, kind: str):
    """mapInArrow function: a row for each leaf of each vector, with all leaves of that vector.

    leaves: (tree, node) as one number each, in ascending order. vector: its components in the kind they came in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = forest.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                labels, dims, rep = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "dim", "rep"))
                given, row, leaf, packed = batch.column("vector").to_pylist(), [], [], [b""] * len(rep)
                for label, dim in set(zip(labels.tolist(), dims.tolist())):
                    own = np.flatnonzero((labels == label) & (dims == dim))
                    vectors = np.array([given[i] for i in own.tolist()], np.float64)
                    for i, v in zip(own.tolist(), vectors.astype(kind)):
                        packed[i] = v.tobytes()
                    for tree, (r, node) in enumerate(found.route(unit(vectors), label)):
                        row.append(own[r])
                        leaf.append(tree << 40 | node)
                row, leaf = np.concatenate(row), np.concatenate(leaf)
                order = np.lexsort((leaf, row))
                row, leaf = row[order], leaf[order]
                n = np.bincount(row, minlength=len(rep))
                lists = [x.tobytes() for x in np.split(leaf, np.cumsum(n)[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(labels[row].astype(np.int64)),
                        pa.array(dims[row].astype(np.int32)),
                        pa.array(leaf),
                        pa.array(rep[row]),
                        batch.column("members").take(pa.array(row)),
                        pa.array([packed[i] for i in row.tolist()], pa.binary()),
                        pa.array([lists[i] for i in row.tolist()], pa.binary()),
                    ],
                    ["label", "dim", "leaf", "rep", "members", "vector", "leaves"],
                )

    return run


def sets_before(lists: list[np.ndarray], leaf: int) -> np.ndarray:
    """Of each list of leaves those before leaf as bits of 64-bit words; only leaves that several lists hold count."""
    flat, row = np.concatenate(lists), np.repeat(np.arange(len(lists)), [*map(len, lists)])
    row, flat = row[flat < leaf], flat[flat < leaf]
    _, code, often = np.unique(flat, return_inverse=True, return_counts=True)
    row, code = row[often[code] > 1], code[often[code] > 1]
    code = (np.cumsum(often > 1) - 1)[code]
    out = np.zeros((len(lists), int(code.max(initial=0)) // 64 + 1), np.uint64)
    np.bitwise_or.at(out, (row, code >> 6), np.uint64(1) << (code & 63).astype(np.uint64))
    return out


def share_any(sets: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs have a bit in common."""
    step, out = max(1, (1 << 22) // sets.shape[1]), np.zeros(len(i), bool)
    for at in range(0, len(i), step):
        out[at : at + step] = (sets[i[at : at + step]] & sets[j[at : at + step]]).any(axis=1)
    return out


def compared(threshold: float, block: int, kind: str):
    """mapInArrow function over rows sorted by key: links that belong to this leaf and the smallest vec_id tied to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.by_key(batches):
            rep, first = np.unique(table.column("rep").to_numpy(), return_index=True)
            table = table.take(pa.array(first))
            members, side = (table.column(c).to_numpy() for c in ("members", "side"))
            leaf = table.column("leaf")[0].as_py()
            vectors = unit(np.stack([np.frombuffer(v, kind) for v in table.column("vector").to_pylist()]))
            before = sets_before([np.frombuffer(x, np.int64) for x in table.column("leaves").to_pylist()], leaf)
            links, a, b = np.zeros(len(rep), np.int64), [], []
            across = (side != side[0]).any()
            for at in range(0, len(rep), block):
                close = vectors[at : at + block] @ vectors.T >= threshold
                if across:
                    close &= side[at : at + block, None] != side[None]
                i, j = np.nonzero(close)
                i += at
                i, j = i[i < j], j[i < j]
                own = ~share_any(before, i, j)
                i, j = i[own], j[own]
                np.add.at(links, i, members[j])
                np.add.at(links, j, members[i])
                a.append(i)
                b.append(j)
            root = common.roots(len(rep), np.concatenate(a), np.concatenate(b))
            some = np.flatnonzero(links)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(links[some]), pa.array(rep[root[some]])], ["rep", "links", "root"])

    return run


def embedding_dedup(embeddings: DataFrame, threshold: float = 0.93, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Vectors of the same label link when their cosine in double precision is threshold or more. Null labels, null,
    empty and zero vectors and such with a null or non-finite component link with nothing, nor do vectors of
    different length. n_links counts the other rows linked directly, component_id is the smallest vec_id that links
    reach. A null vec_id keeps its own row and is otherwise left out; rows repeated with their vec_id link with each
    other. An empty table gives no rows. Other columns, whatever their names, stay behind.
    """
    common.bound_batches(embeddings.sparkSession)
    kind = "<f4" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "<f8"
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vector", lambda x: x != 0)
    rows = rows.select("vec_id", "label", F.when(fine & F.col("vec_id").isNotNull(), F.col("vector")).alias("vector"))
    # -0.0 and 0.0 are the same component.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    whole = rows.filter("vector is not null")
    groups = common.save(whole.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("members")))
    part = groups.withColumn("dim", F.size("vector"))
    forest = embeddings.sparkSession.sparkContext.broadcast(fit(part, threshold, settings))
    leaves = part.mapInArrow(common.task(routed(forest, kind)), LEAVES)
    # Crowded leaves (at most one in settings.block rows) are dealt out as pairs of blocks.
    counts = leaves.groupBy("label", "dim", "leaf").agg(F.count("*").alias("n"))
    crowded = common.save(counts.filter(F.col("n") > 2 * settings.block).select("label", "dim", "leaf", F.ceil(F.col("n") / F.lit(settings.block)).cast("long").alias("wide")))
    tasks = leaves.join(crowded, ["label", "dim", "leaf"], "left").withColumn("wide", F.coalesce("wide", F.lit(1).cast("long")))
    tasks = tasks.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("wide")))
    tasks = tasks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("wide") - 1)))
    tasks = tasks.withColumn("key", F.xxhash64("label", "dim", "leaf", F.least("side", "other"), F.greatest("side", "other"))).drop("other", "wide", "label", "dim")
    checked = tasks.repartition("key").sortWithinPartitions("key").mapInArrow(common.task(compared(threshold, settings.block, kind)), "rep long, links long, root long")
    checked = common.save(checked)
    components = common.components(checked.filter("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    named = groups.join(links, "rep", "left").join(components.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("label", "vector", F.coalesce("component", "rep").alias("found"), (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    named = common.save(named)
    common.discard(groups, crowded, checked, components)
    out = rows.join(named, ["label", "vector"], "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("found", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(common.read_table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
    SELECT a, b FROM pairs
    UNION
    SELECT r.a, p.b FROM reach AS r JOIN pairs AS p ON r.b = p.a
), least AS (SELECT a, min(b) AS m FROM reach GROUP BY a), degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN degree ON degree.a = vec_id
"""
