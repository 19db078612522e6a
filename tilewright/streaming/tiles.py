"""Tiles that split while records arrive.

A place lies in the tile of the coarsest level that holds few enough, so what arrives can only make tiles split, and
what happens in one tile of the lowest level concerns no other. Each micro-batch therefore works on the prefixes that
it touches: it folds into their records, assigns them anew, writes their tiles and carries the other folders over.
Whatever the order and the batches in which records arrive, the tiles are those of one build over all of them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import quadkey as qk
from ..operators import tiles
from ..sources import scratch, sinks, tile_files
from ..sources.hadoop import Files

ROW = "place_id string, qk17 string, rkey string, record_json string, version long"


def maintain(stream: DataFrame, root: str, head: sinks.Head, most: int = 1000) -> DataStreamWriter:
    """A writer that keeps root/tiles/current in step with a stream of place_id, qk17, rkey, record_json and version.

    Of rows of one place the greatest version counts, wherever it comes from; one without record_json takes the place
    out. A place that moves is taken out where it was. start() it with a trigger of the wanted interval.
    """
    flush = lambda batch, number: fold(batch, number, root, head, most)
    return stream.writeStream.outputMode("append").foreachBatch(flush).option("checkpointLocation", f"{root}/checkpoint")


def known(spark: SparkSession, root: str, before: int) -> tuple[dict[str, int], int | None]:
    """Of each prefix the batch that wrote its records last, and the last batch before this one: from its state, one
    entry for each of 4,096 prefixes at most. A batch that comes again sees what it saw at first."""
    names = [n for n in Files(spark).names(f"{root}/state") if n.endswith(".json") and int(n[:-5]) < before]
    return (json.loads(Files(spark).read_text(f"{root}/state/{names[-1]}")), int(names[-1][:-5])) if names else ({}, None)


def fold(batch: DataFrame, number: int, root: str, head: sinks.Head, most: int) -> None:
    """Folds a micro-batch into the records of the prefixes that it touches, and publishes a run of its number."""
    spark, low = batch.sparkSession, tile_files.PREFIX
    state, last = known(spark, root, number)
    prefix = F.substring("qk17", 1, low).alias("prefix")
    typed = [F.col(c).cast(kind) for c, kind in (field.split(" ") for field in ROW.split(", "))]
    fresh = scratch.saved(batch.filter(qk.is_full(F.col("qk17"))).select(*typed, prefix))
    dirty = sorted(r.prefix for r in fresh.select("prefix").distinct().collect())  # 4**low at most
    if not dirty:
        return
    rows = fresh
    if paths := [f"{root}/index/{state[p]:020d}/prefix={p}" for p in dirty if p in state]:
        before = spark.read.schema(ROW).parquet(*paths).withColumn("prefix", F.substring("qk17", 1, low))
        rows = rows.unionByName(before)
    newest = rows.groupBy("prefix", "place_id").agg(F.max(F.struct("version", "record_json", "rkey", "qk17")).alias("r"))
    kept = newest.select("place_id", "r.qk17", "r.rkey", "r.record_json", "r.version", "prefix")
    kept.repartition("prefix", F.pmod(F.xxhash64("place_id"), F.lit(16))).write.mode("overwrite").partitionBy("prefix").parquet(f"{root}/index/{number:020d}")
    index = spark.read.schema(ROW).option("recursiveFileLookup", "true").parquet(f"{root}/index/{number:020d}").filter("record_json is not null")
    assigned = tiles.assign(index, most, low)
    records = index.join(assigned, "place_id").select("tile_qk", "place_id", "rkey", "record_json")
    run = f"{root}/tiles/{number:020d}"
    sinks.publish(records, run, head)
    clean = sorted(set(state) - set(dirty))
    if clean and last is not None:
        sinks.carried(spark, f"{root}/tiles/{last:020d}", run, clean)
    Files(spark).write_text(f"{root}/state/{number:020d}.json", json.dumps(state | dict.fromkeys(dirty, number)))
    total = spark.read.parquet(f"{run}/tiles").agg(F.count("*").alias("tiles"), F.sum("n").alias("n")).first()
    sinks.write_json(spark, f"{run}/manifest.json", {"collection": head.collection, "generated_at": head.generated_at, "tiles": total.tiles, "records": total.n or 0})
    sinks.make_current(spark, f"{root}/tiles", f"{number:020d}")
    sinks.retain(spark, f"{root}/tiles")
