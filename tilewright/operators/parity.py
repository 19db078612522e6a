"""Comparison of results row by row, and of published runs from the root of their digests down.

A tile has a digest of its records, in any order, and one of its head. They are rolled up by the digits of tiles, six
deep at most, so the tree of a run has fewer than 5,500 nodes at any size; where two trees agree nothing is read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tile_files, tile_source
from ..sources.hadoop import Files

TILES = "tile_qk string, n long, head string, digest string"
#: Copies of a row that are listed at once.
MANY = 10_000
#: What can differ: kinds of the rows that compare_runs() gives.
KINDS = ("tile only left", "tile only right", "record only left", "record only right", "record differs", "head differs", "manifest differs", "manifest row only left", "manifest row only right")


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """side ("left" or "right") and the rows that only that side has, as often as it has them more."""
    names = left.columns
    both = left.select("*", F.lit(1).alias("_more")).union(right.select("*", F.lit(-1)))
    # Dealt out before they are counted: few rows repeat, and a count of a task's own would hold nearly all that it reads.
    net = both.repartition(*names).groupBy(*names).agg(F.sum("_more").alias("_more")).filter("_more != 0")
    often = net.withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.abs("_more") - 1, F.lit(MANY).cast("long"))))
    often = often.withColumn("_one", F.explode(F.array_repeat(F.lit(0), F.least(F.abs("_more") - F.col("_first"), F.lit(MANY)).cast("int"))))
    return often.select(F.when(F.col("_more") > 0, "left").otherwise("right").alias("side"), *names)


def tile_digests(spark: SparkSession, run: str) -> DataFrame:
    """tile_qk, n, head, digest of a run: as published with it, else from its tiles."""
    if Files(spark).exists(f"{run}/tiles"):
        found = spark.read.parquet(f"{run}/tiles")
        if "digest" in found.columns:
            return found

    def digested(batches):
        import pyarrow as pa

        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                rows = []
                for tile in tile_files.tiles(run, folder):
                    n = total = 0
                    for head, record in tile_files.read(run, tile):
                        if record is not None:
                            n, total = n + 1, (total + tile_files.record_digest(record)) % (1 << 128)
                    rows.append((tile, n, tile_files.head_digest(head), f"{total:032x}"))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["tile_qk", "n", "head", "digest"])

    names = tile_files.folders(run)
    folders = spark.createDataFrame([(n,) for n in names], "folder string")
    return folders.repartition(max(1, min(len(names), 4096)), "folder").mapInArrow(digested, TILES)


def tree(tiles: DataFrame) -> DataFrame:
    """level, prefix, tiles, a, b: how many tiles begin with each prefix of up to six digits, and 128 bits of them all.

    tiles: tile_qk, head, digest. Each level adds up the one below; a tile of fewer digits counts at its own level and
    above.
    """
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "tile_qk", "head", "digest"))
    prefix = F.substring("tile_qk", 1, tile_files.PREFIX)
    rows = tiles.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("tiles"), mark(0).alias("a"), mark(1).alias("b"))
    level = F.explode(F.sequence(F.lit(0), F.length("prefix"))).alias("level")
    every = rows.select(level, "prefix", "tiles", "a", "b").withColumn("prefix", F.substring(F.col("prefix"), F.lit(1), F.col("level")))
    return every.groupBy("level", "prefix").agg(F.sum("tiles").alias("tiles"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def differing(left: DataFrame, right: DataFrame) -> list[str]:
    """Folders, by the trees of two runs, that differ: from the root down, below what differs only."""
    nodes = [{r.prefix: (r.tiles, r.a, r.b) for r in side.collect()} for side in (left, right)]  # fewer than 5,500 rows each
    if nodes[0].get("") == nodes[1].get(""):
        return []
    found, todo = [], [""]
    while todo:
        prefix = todo.pop()
        if len(prefix) == tile_files.PREFIX:
            found.append(prefix)
            continue
        below = [n for n in (prefix + d for d in "0123") if nodes[0].get(n) != nodes[1].get(n)]
        # What the children don't account for is the tile of this name itself; comparing it costs one file.
        if prefix:
            found.append(prefix)
        todo += below
    return sorted(found)


def told(path: str, spark: SparkSession) -> dict:
    """manifest.json without its time."""
    files = Files(spark)
    text = files.read_text(f"{path}/manifest.json") if files.exists(f"{path}/manifest.json") else "null"
    data = json.loads(text)
    return {k: v for k, v in data.items() if k != "generated_at"} if data else data


def compare_runs(spark: SparkSession, left: str, right: str) -> DataFrame:
    """kind (of KINDS), tile_qk, rkey: everything in which two published runs differ but for their times.

    Tiles are opened only where both runs have them and their digests differ, and only in folders that differ.
    """
    tile_source.register(spark)
    rows = [spark.createDataFrame([("manifest differs", None, None)] if told(left, spark) != told(right, spark) else [], "kind string, tile_qk string, rkey string")]
    tables = [tile_digests(spark, run) for run in (left, right)]
    found = differing(*map(tree, tables))
    if found:
        own = [t.filter(F.substring("tile_qk", 1, tile_files.PREFIX).isin(found) & F.col("tile_qk").between(found[0], found[-1] + tile_source.END)) for t in tables]
        a, b = (t.select("tile_qk", F.struct("head", "digest").alias(side)) for t, side in zip(own, ("a", "b")))
        both = a.join(b, "tile_qk", "full")
        for side, other in (("left", "b"), ("right", "a")):
            rows.append(both.filter(F.col(other).isNull()).select(F.lit(f"tile only {side}").alias("kind"), "tile_qk", F.lit(None).cast("string").alias("rkey")))
        changed = both.filter("a is not null and b is not null")
        rows.append(changed.filter("a.head != b.head").select(F.lit("head differs").alias("kind"), "tile_qk", F.lit(None).cast("string").alias("rkey")))
        changed = changed.filter("a.digest != b.digest").select("tile_qk")
        folders = [r.prefix for r in changed.select(F.substring("tile_qk", 1, tile_files.PREFIX).alias("prefix")).distinct().collect()]  # of found
        if folders:
            read = lambda run: spark.read.format("tiles").load(run).filter(F.col("prefix").isin(folders)).join(changed, "tile_qk", "left_semi")
            texts = [read(run).groupBy("tile_qk", "rkey").agg(F.array_sort(F.collect_list(sorted_json)).alias(side)) for run, side in ((left, "a"), (right, "b")) for sorted_json in [ordered(F.struct("uri", "value"))]]
            records = texts[0].join(texts[1], (texts[0]["tile_qk"] == texts[1]["tile_qk"]) & texts[0]["rkey"].eqNullSafe(texts[1]["rkey"]), "full")
            kind = F.when(F.col("b").isNull(), "record only left").when(F.col("a").isNull(), "record only right").when(F.col("a") != F.col("b"), "record differs")
            named = [F.coalesce(texts[0][c], texts[1][c]).alias(c) for c in ("tile_qk", "rkey")]
            rows.append(records.select(kind.alias("kind"), *named).filter("kind is not null"))
    manifests = [spark.read.parquet(f"{run}/record_tiles") if Files(spark).exists(f"{run}/record_tiles") else spark.createDataFrame([], "rkey string, tile_qk string") for run in (left, right)]
    sums = [m.agg(F.count("*"), F.bit_xor(F.xxhash64("rkey", "tile_qk")), F.bit_xor(F.xxhash64("tile_qk", "rkey"))).first() for m in manifests]
    if sums[0] != sums[1]:
        rows.append(differences(*(m.select("rkey", "tile_qk") for m in manifests)).select(F.concat(F.lit("manifest row only "), "side").alias("kind"), "tile_qk", "rkey"))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def ordered(record) -> F.Column:
    """A record's address and JSON text, keys in order."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def text(values):
        return values.map(lambda v: tile_files.canonical(json.loads(v)))

    return F.concat(F.coalesce(record["uri"], F.lit("")), F.lit(" "), text(record["value"]))
