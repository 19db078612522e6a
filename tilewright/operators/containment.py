"""Which boundaries contain which places."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions import json_text as js
from ..functions import quadkey as qk


def keyed(points: DataFrame, low: int, high: int) -> DataFrame:
    """place_id, lon, lat and tile_qk for every tile from level low to high that holds the point."""
    rows = points.filter(qk.is_full(F.col("qk17"))).select("place_id", "lon", "lat", "qk17", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("z"))
    return rows.select("place_id", "lon", "lat", F.substring(F.col("qk17"), F.lit(1), F.col("z")).alias("tile_qk"))


def candidates(points: DataFrame, covering: DataFrame, low: int = 4, high: int = 16) -> DataFrame:
    """Pairs of a point and a covering tile that holds it, by equality of prefixes: place_id, lon, lat and the columns
    of covering."""
    return keyed(points, low, high).join(covering, "tile_qk")


def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over rows sorted by tile, salt and kind, covering tiles (kind 0) before points: the points
    that lie in a boundary. Each shape is parsed once a tile and meets all points of a batch at a time; a tile inside a
    boundary has none and takes every point."""
    at, shapes = None, []
    for batch in batches:
        tile, salt, kind = (batch.column(c).to_pylist() for c in ("tile_qk", "salt", "kind"))
        x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lon", "lat"))
        bounds, levels, interior, geom = (batch.column(c) for c in ("boundary_id", "level", "interior", "geom"))
        start = 0
        while start < len(tile):
            end = start + 1
            while end < len(tile) and tile[end] == tile[start] and salt[end] == salt[start] and kind[end] == kind[start]:
                end += 1
            if (tile[start], salt[start]) != at:
                at, shapes = (tile[start], salt[start]), []
            if kind[start] == 0:
                shapes += [(bounds.slice(i, 1), levels.slice(i, 1), None if interior[i].as_py() else geometry.parse(geom[i].as_py())) for i in range(start, end)]
            else:
                for boundary, level, shape in shapes:
                    hit = np.arange(start, end) if shape is None else np.flatnonzero(geometry.covers_each(shape, x[start:end], y[start:end])) + start
                    if len(hit):
                        first = pa.array(np.zeros(len(hit), np.int64))
                        yield pa.RecordBatch.from_arrays([batch.column("place_id").take(pa.array(hit)), boundary.take(first), level.take(first)], ["place_id", "boundary_id", "level"])
            start = end


def matches(points: DataFrame, covering: DataFrame, low: int = 4, high: int = 16, most: int = 50_000) -> DataFrame:
    """place_id, boundary_id, level, once for each point and boundary that holds it.

    Covering tiles and points meet once, by tile: a point goes out under each of its tiles from level low to high, a
    covering tile under its own, and as no two tiles of a boundary overlap no pair comes twice. A tile of over `most`
    points is dealt out in several parts, its covering tiles to each of them.
    """
    keys = keyed(points, low, high)
    crowded = keys.groupBy("tile_qk").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("tile_qk", F.ceil(F.col("n") / F.lit(most)).cast("long").alias("parts"))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    none = lambda c, of: F.lit(None).cast(of.schema[c].dataType).alias(c)
    shapes = covering.join(crowded, "tile_qk", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    shapes = shapes.select("tile_qk", "salt", F.lit(0).alias("kind"), none("place_id", points), none("lon", points), none("lat", points), "boundary_id", "level", "interior", "geom")
    spots = keys.join(crowded, "tile_qk", "left").withColumn("salt", F.pmod(F.xxhash64("place_id"), parts))
    spots = spots.select("tile_qk", "salt", F.lit(1).alias("kind"), "place_id", "lon", "lat", *[none(c, covering) for c in ("boundary_id", "level", "interior", "geom")])
    met = shapes.union(spots).repartition("tile_qk", "salt").sortWithinPartitions("tile_qk", "salt", "kind")
    kinds = ", ".join(f"{c} {of.schema[c].dataType.simpleString()}" for c, of in (("place_id", points), ("boundary_id", covering), ("level", covering)))
    return met.mapInArrow(covered, kinds)


def relations(matched: DataFrame, assignments: DataFrame, names: DataFrame, prefix: str) -> DataFrame:
    """tile_qk, place_id, relations_json: {"within": [{rkey, name, level}]} in order of level, then id.

    names: boundary_id, name.
    """
    entry = F.struct(F.col("level"), F.col("boundary_id").alias("id"), F.col("name"))
    rows = matched.join(names, "boundary_id").join(assignments, "place_id")
    grouped = rows.groupBy("tile_qk", "place_id").agg(F.array_sort(F.collect_list(entry)).alias("within"))
    shaped = F.transform("within", lambda w: F.struct(F.concat(F.lit(f"{prefix}:"), w["id"].cast("string")).alias("rkey"), w["name"].alias("name"), w["level"].alias("level")))
    return grouped.select("tile_qk", "place_id", js.whole_object({"within": F.to_json(shaped, js.KEEP_NULLS)}).alias("relations_json"))


def hierarchy(divisions: DataFrame, places: DataFrame) -> DataFrame:
    """place_id, boundary_id, level: ancestors from the chains that divisions carry.

    divisions: id, hierarchies (array of arrays of structs with division_id). An ancestor without a row of its own in
    places (id, level) goes; the division itself is none.
    """
    chain = divisions.select(F.col("id").alias("place_id"), F.explode("hierarchies").alias("chain"))
    link = chain.select("place_id", F.explode("chain.division_id").alias("boundary_id"))
    pairs = link.filter("boundary_id != place_id").distinct()
    return pairs.join(places.select(F.col("id").alias("boundary_id"), "level"), "boundary_id").select("place_id", "boundary_id", "level")
