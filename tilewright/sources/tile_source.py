"""A published run as a Spark data source: spark.read.format("tiles").load(run), after register(spark).

Read: a row for each record, a partition for each folder of tiles. Filters on prefix and tile_qk choose folders and
files before any is opened. Written: rows with tile_qk and value (a record's JSON), the rows of a tile next to each
other in one task; all files go to a folder beside and become the run in one step, or nothing stays.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, In, InputPartition, LessThanOrEqual, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from . import tile_files

SCHEMA = "prefix string, tile_qk string, collection string, source string, license string, generated_at string, rkey string, uri string, value string"
ROWS = 2000
#: Sorts after every quadkey that begins with what stands before it.
END = "~"


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Tiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


class Tiles(DataSource):
    """Options: path; reading also ranges, "low-high" pairs of quadkeys joined by commas of which a tile must lie in
    one; writing also collection, source, license, generated_at and repo."""

    @classmethod
    def name(cls) -> str:
        return "tiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if missing := {"tile_qk", "value"} - set(schema.names):
            raise ValueError(f"no column {sorted(missing)}")
        return TileWriter(self.options, overwrite)


class Folder(InputPartition):
    def __init__(self, name: str):
        self.name = name


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        #: Each a list of closed intervals; a tile must lie in one of every list.
        self.tile: list[list[tuple[str, str]]] = []
        self.prefix: list[set[str]] = []
        if ranges := options.get("ranges"):
            self.tile.append([tuple(r.split("-")) for r in ranges.split(",")])

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = set(f.value) if isinstance(f, In) else {f.value} if isinstance(f, EqualTo) else None
            if column == "prefix" and values is not None:
                self.prefix.append(values)
            elif column == "tile_qk" and values is not None:
                self.tile.append([(v, v) for v in values])
            elif column == "tile_qk" and isinstance(f, StringStartsWith):
                self.tile.append([(f.value, f.value + END)])
            elif column == "tile_qk" and isinstance(f, GreaterThanOrEqual):
                self.tile.append([(f.value, END)])
            elif column == "tile_qk" and isinstance(f, LessThanOrEqual):
                self.tile.append([("", f.value)])
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        # A folder of six digits holds tiles that begin with them, a shorter one the tile of its name alone.
        whole = lambda p: p + END if len(p) == tile_files.PREFIX else p
        some = [p for p in tile_files.folders(self.root) if all(p in s for s in self.prefix) and all(any(a <= whole(p) and p <= b for a, b in t) for t in self.tile)]
        return [Folder(p) for p in some] or [Folder("")]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        names = ["prefix", "tile_qk", "collection", "source", "license", "generated_at", "rkey", "uri", "value"]
        rows: list[tuple] = []
        if partition.name:
            for tile in tile_files.tiles(self.root, partition.name):
                if not all(any(a <= tile <= b for a, b in t) for t in self.tile):
                    continue
                for head, record in tile_files.read(self.root, tile):
                    if record is not None:
                        value = record["value"]
                        text = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
                        rows.append((partition.name, tile, *(head.get(k) for k in names[2:6]), value.get("rkey"), record.get("uri"), text))
                    if len(rows) == ROWS:
                        yield batch_of(rows, names)
                        rows = []
        if rows:
            yield batch_of(rows, names)


def batch_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names)


class Written(WriterCommitMessage):
    def __init__(self, tiles: int, records: int):
        self.tiles, self.records = tiles, records


class TileWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.root, self.overwrite = options["path"].rstrip("/"), overwrite
        self.beside = f"{self.root}.{uuid.uuid4().hex}.tmp"
        self.head = tile_files.Head(*(options.get(k, "") for k in ("collection", "source", "license", "generated_at", "repo")))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        out, tiles, records, seen = tile_files.Writer(self.beside, self.head), 0, 0, set()
        try:
            for batch in iterator:
                for tile, value in zip(batch.column("tile_qk").to_pylist(), batch.column("value").to_pylist()):
                    if tile != out.at:
                        if tile in seen:
                            raise ValueError(f"the records of tile {tile} don't stand together")
                        seen.add(tile)
                    tiles += out.add(tile, value) is not None
                    records += 1
            tiles += out.finish() is not None
        except BaseException:
            out.drop()
            raise
        return Written(tiles, records)

    def commit(self, messages: list[Written | None]) -> None:
        """Puts the run in its place, with a manifest. A tile that two tasks wrote shows in the number of files."""
        system, base = fs.FileSystem.from_uri(self.root)
        _, beside = fs.FileSystem.from_uri(self.beside)
        system.create_dir(beside, recursive=True)
        tiles, records = sum(m.tiles for m in messages if m), sum(m.records for m in messages if m)
        there = sum(len(tile_files.tiles(self.beside, p)) for p in tile_files.folders(self.beside))
        if there != tiles:
            self.abort(messages)
            raise ValueError(f"{tiles - there} tiles were written by more than one task; deal rows out by tile_qk")
        if system.get_file_info(base).type != fs.FileType.NotFound:
            if not self.overwrite:
                self.abort(messages)
                raise FileExistsError(f"{self.root} is there already")
            system.delete_dir(base)
        manifest = {"collection": self.head.collection, "generated_at": self.head.generated_at, "tiles": tiles, "records": records}
        with system.open_output_stream(f"{beside}/manifest.json", compression=None) as out:
            out.write(json.dumps(manifest, indent=2).encode())
        system.move(beside, base)

    def abort(self, messages: list[Written | None]) -> None:
        system, beside = fs.FileSystem.from_uri(self.beside)
        if system.get_file_info(beside).type != fs.FileType.NotFound:
            system.delete_dir(beside)
