"""What builds write: tables, tiles, manifests, and the marks that say what is still fresh."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quadkey as qk
from ..operators import export
from . import tile_files
from .hadoop import Files
from .tile_files import Head


def write_sorted(frame: DataFrame, path: str, key: str, partitions: int | None = None) -> None:
    """Parquet in order of key over all files, nulls last, so that row groups prune by it."""
    order = F.col(key).asc_nulls_last()
    dealt = frame.repartitionByRange(partitions, order) if partitions else frame.repartitionByRange(order)
    dealt.sortWithinPartitions(order).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_along_curve(frame: DataFrame, path: str, key: str, zoom: int = 9, partitions: int | None = None) -> None:
    """Parquet along the Hilbert curve of the tiles of a level over all files, by key within, nulls last: what lies near
    each other stands in few row groups, so the statistics of coordinates prune for a box."""
    place = F.when(F.col(key).isNotNull(), qk.hilbert(F.substring(key, 1, zoom)))
    rows = frame.withColumn("_curve", place)
    order = [F.asc_nulls_last("_curve"), F.asc_nulls_last(key)]
    dealt = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).drop("_curve").write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_by_prefix(frame: DataFrame, path: str, key: str, length: int, *order: str) -> None:
    """Parquet in folders by the first digits of a quadkey, sorted within."""
    prefix = f"{key}{length}"
    rows = frame.withColumn(prefix, F.substring(key, 1, length))
    # Prefixes of crowded areas are large: a range of (prefix, key) splits them over several files.
    rows.repartitionByRange(prefix, key, *order).sortWithinPartitions(prefix, key, *order).write.mode("overwrite").partitionBy(prefix).parquet(path)


def promote(spark: SparkSession, built: str, path: str) -> None:
    """Puts a finished folder in the place of another, which stays as path.old until the swap is done."""
    files = Files(spark)
    files.delete(f"{path}.old")
    if files.exists(path):
        files.move(path, f"{path}.old")
    files.move(built, path)
    files.delete(f"{path}.old")


def state(spark: SparkSession, inputs: list[str]) -> tuple[str, int]:
    """A digest of the files that inputs (paths or globs) name, with sizes and times, and the newest time; files that
    come, go or are replaced change it. FileNotFoundError where an input names none."""
    files, digest, newest = Files(spark), hashlib.sha256(), 0
    for pattern in inputs:
        found = files.listing(pattern)
        if not found:
            raise FileNotFoundError(f"nothing matches {pattern}")
        for path, size, time in found:
            digest.update(f"{path}\t{size}\t{time}\n".encode())
            newest = max(newest, time)
    return digest.hexdigest(), newest


def is_fresh(spark: SparkSession, path: str, inputs: list[str], parameters: dict) -> bool:
    """Whether an artifact may stay: it and its mark exist, the mark names the same inputs (paths or globs) with the
    same files and the same parameters, no file is as new as the mark, and the artifact is no newer than it."""
    files, mark = Files(spark), f"{path}.meta.json"
    if not files.exists(path) or not files.exists(mark):
        return False
    try:
        known = json.loads(files.read_text(mark))
        now, newest = state(spark, inputs)
    except (ValueError, FileNotFoundError):
        return False
    if known.get("inputs") != inputs or known.get("parameters") != parameters or known.get("state") != now:
        return False
    made = files.modified(mark)
    return newest < made and files.modified(path) <= made


def make_artifact(spark: SparkSession, write: Callable[[str], None], path: str, inputs: list[str], parameters: dict) -> None:
    """Calls write with a path beside, promotes what stands there, and marks last: a build that stops half-way leaves
    no fresh artifact. The mark holds the inputs as they were before: what changes meanwhile makes it stale."""
    files = Files(spark)
    before, _ = state(spark, inputs)
    files.delete(f"{path}.meta.json")
    write(f"{path}.tmp")
    promote(spark, f"{path}.tmp", path)
    files.write_text(f"{path}.meta.json", json.dumps({"inputs": inputs, "state": before, "parameters": parameters}))


def build_artifact(frame: DataFrame, path: str, inputs: list[str], parameters: dict, key: str) -> None:
    """An artifact in order of key."""
    make_artifact(frame.sparkSession, lambda to: write_sorted(frame, to, key), path, inputs, parameters)


def publish(records: DataFrame, root: str, head: Head, folders: list[str] | None = None) -> DataFrame:
    """Writes one file a tile, root/<first six digits>/<tile>.json.gz, and returns tile_qk, n (its records) and digests
    of head and records, also kept as root/tiles. With folders only those are written.

    records: tile_qk, place_id, rkey, record_json; within a tile in order of place_id. root is a path or an address of
    a file system that every executor reaches. Records run through a file that is open, so a task never holds a tile,
    however large. The same records give the same bytes: a task that runs twice replaces its files by equal ones.
    """
    root = everywhere(records.sparkSession, root)
    if folders is not None:
        records = records.filter(F.substring("tile_qk", 1, tile_files.PREFIX).isin(folders))
    rows = records.select("tile_qk", F.col("place_id").cast("string").alias("place_id"), export.wrapped(head.repo, head.collection).alias("value"))
    dealt = rows.repartitionByRange(F.substring("tile_qk", 1, tile_files.PREFIX), "tile_qk").sortWithinPartitions("tile_qk", "place_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = tile_files.Writer(root, head)
        one = lambda done: pa.RecordBatch.from_arrays([pa.array([x]) for x in done], ["tile_qk", "n", "head", "digest"])
        for batch in batches:
            for tile, value in zip(batch.column("tile_qk").to_pylist(), batch.column("value").to_pylist()):
                if done := out.add(tile, value):
                    yield one(done)
        if done := out.finish():
            yield one(done)

    dealt.mapInArrow(write, TILES).write.mode("overwrite").parquet(f"{root}/tiles")
    return records.sparkSession.read.schema(TILES).parquet(f"{root}/tiles")


TILES = "tile_qk string, n long, head string, digest string"


def everywhere(spark: SparkSession, root: str) -> str:
    """A path that means the same folder to every task."""
    if "://" in root or root.startswith("/"):
        return root
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError(f"{root}: a relative path means another folder to every executor")
    return os.path.abspath(root)


def folder_states(records: DataFrame) -> DataFrame:
    """prefix, n, a, b: how many records each folder of tiles has, and 128 bits of them in any order."""
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "tile_qk", F.col("place_id").cast("string"), "rkey", "record_json"))
    return records.groupBy(F.substring("tile_qk", 1, tile_files.PREFIX).alias("prefix")).agg(F.count("*").alias("n"), mark(0).alias("a"), mark(1).alias("b"))


def publish_changed(records: DataFrame, root: str, head: Head, last: str | None) -> tuple[DataFrame, list[str]]:
    """As publish(), but folders whose records are those of the run at last, under a head that differs in its time at
    most, are carried over file by file; such tiles keep the time at which they were made. Returns what publish()
    returns, and the folders that were written anew.

    Every run keeps root/folders, a row for each folder: 5,460 at most, at any size.
    """
    spark, root = records.sparkSession, everywhere(records.sparkSession, root)
    named = {"collection": head.collection, "source": head.source, "license": head.license, "repo": head.repo}
    states = folder_states(records).withColumn("head", F.lit(json.dumps(named)))
    states.coalesce(1).write.mode("overwrite").parquet(f"{root}/folders")
    states = spark.read.parquet(f"{root}/folders")
    same: list[str] = []
    if last and Files(spark).exists(f"{last}/folders") and Files(spark).exists(f"{last}/tiles"):
        same = sorted(r.prefix for r in states.join(spark.read.parquet(f"{last}/folders"), states.columns, "left_semi").select("prefix").collect())
    fresh = sorted({r.prefix for r in states.select("prefix").collect()} - set(same))
    if not same:
        return publish(records, root, head), fresh
    publish(records, root, head, fresh)
    carried(spark, last, root, same)
    return spark.read.schema(TILES).parquet(f"{root}/tiles"), fresh


def carried(spark: SparkSession, last: str, run: str, folders: list[str]) -> None:
    """Takes folders of tiles, and what is known of them, over from another run."""
    a, b = everywhere(spark, last), everywhere(spark, run)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("prefix").to_pylist():
                tile_files.carry(a, b, folder)
            yield batch

    todo = spark.createDataFrame([(p,) for p in folders], "prefix string").repartition(min(len(folders), 1024), "prefix")
    todo.mapInArrow(carry, "prefix string").count()
    kept = spark.read.schema(TILES).parquet(f"{last}/tiles").filter(F.substring("tile_qk", 1, tile_files.PREFIX).isin(folders))
    kept.write.mode("append").parquet(f"{run}/tiles")


def make_current(spark: SparkSession, root: str, run: str) -> None:
    """Points root/current at a run: a link where root is a local folder, else a file that holds the run's name."""
    if "://" in root:
        Files(spark).write_text(f"{root}/current", run)
        return
    link = f"{root}/current.{uuid.uuid4().hex}"
    os.symlink(run, link)
    os.replace(link, f"{root}/current")


def current(spark: SparkSession, root: str) -> str | None:
    """The run that root/current points at."""
    if "://" not in root:
        return os.readlink(f"{root}/current") if os.path.islink(f"{root}/current") else None
    return Files(spark).read_text(f"{root}/current") if Files(spark).exists(f"{root}/current") else None


def read_tile(spark: SparkSession, run: str, tile: str) -> dict | None:
    """A published tile; None where there is none."""
    path = f"{run}/{tile[:6]}/{tile}.json.gz"
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())) if Files(spark).exists(path) else None


def get_record(spark: SparkSession, run: str, rkey: str) -> dict | None:
    """A published record by its key: uri, source, license, importance apart from it, and value; None if unknown.

    Any tile of a record holds the same text, so the first that record_tiles names will do.
    """
    found = spark.read.parquet(f"{run}/record_tiles").filter(F.col("rkey") == rkey).select("tile_qk").first()
    tile = found and read_tile(spark, run, found.tile_qk)
    for record in (tile or {"records": []})["records"]:
        value = record["value"]
        if value["rkey"] == rkey:
            score = {"importance": value.pop("importance")} if "importance" in value else {}
            return {"uri": record["uri"], "source": tile["source"], "license": tile["license"], **score, "value": value}
    return None


def write_counts(counts: DataFrame, path: str) -> None:
    """category, n as JSON lines, the most frequent first over all files."""
    counts.orderBy(F.desc("n"), "category").write.mode("overwrite").json(path)


def write_json(spark: SparkSession, path: str, data: dict) -> None:
    Files(spark).write_text(path, json.dumps(data, indent=2))


def write_described(spark: SparkSession, path: str, described: dict, counts: DataFrame | None, written: str) -> None:
    """A description with its categories, the most frequent first. They run from their table (written) into the file,
    a partition's rows at a time on the driver, however many there are."""
    text = json.dumps(described, indent=2)
    if counts is None:
        Files(spark).write_text(path, text)
        return
    rows = spark.read.json(written, schema="category string, n long").orderBy(F.desc("n"), "category").toLocalIterator()

    def pieces() -> Iterator[str]:
        yield text[:-2] + ',\n  "categories": ['
        for k, r in enumerate(rows):
            yield ("," if k else "") + "\n    " + json.dumps({"value": r.category, "count": r.n})
        yield "\n  ]\n}"

    Files(spark).write_pieces(path, pieces())


def write_manifest(records: DataFrame, path: str, metadata: dict) -> None:
    """rkey, tile_qk sorted by rkey, and manifest.json last: without it the run isn't complete."""
    write_sorted(records.select("rkey", "tile_qk").distinct(), f"{path}/record_tiles", "rkey")
    write_json(records.sparkSession, f"{path}/manifest.json", metadata)


#: Collections of records that aren't places; fixed values.
SCHEMAS, COLLECTIONS = "com.atproto.lexicon.schema", "org.atgeo.collection"


def serve_record(spark: SparkSession, repo: str, runs: dict[str, str], schemas: dict[str, dict], collection: str, rkey: str) -> dict:
    """Any record that a gazetteer has: a schema by its id, the description of a collection by its name, or a record of
    one of runs (collection -> folder of the run). KeyError where there is none: CollectionNotFound or RecordNotFound.
    """
    missing = KeyError("RecordNotFound", collection, rkey)
    if collection == SCHEMAS:
        if rkey not in schemas:
            raise missing
        return {"uri": f"at://did:web:{repo}/{SCHEMAS}/{rkey}", "value": schemas[rkey]}
    if collection == COLLECTIONS:
        path = f"{runs.get(rkey)}/collection.json"
        if rkey not in runs or not Files(spark).exists(path):
            raise missing
        value = json.loads(Files(spark).read_text(path))
        return {"uri": f"https://{repo}/{COLLECTIONS}/{rkey}", "source": value["source"], "license": value["license"], "value": value}
    if collection not in runs:
        raise KeyError("CollectionNotFound", collection)
    found = get_record(spark, runs[collection], rkey)
    if found is None:
        raise missing
    return found


def find_record(manifest: DataFrame, records: DataFrame, rkey: str) -> str | None:
    """A record's JSON by its key: the manifest names its tiles, any of which holds the same text."""
    tile = manifest.filter(F.col("rkey") == rkey).select("tile_qk").first()
    if tile is None:
        return None
    found = records.filter((F.col("tile_qk") == tile.tile_qk) & (F.col("rkey") == rkey)).select("record_json").first()
    return found and found.record_json


def retain(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes runs under root but the newest `keep` complete ones; returns what stays. Names sort by time."""
    files = Files(spark)
    runs = [n for n in files.names(root) if not n.startswith("current")]
    complete = [n for n in runs if files.exists(f"{root}/{n}/manifest.json")]
    stay = complete[-keep:]
    for name in runs:
        if name not in stay:
            files.delete(f"{root}/{name}")
    return stay
