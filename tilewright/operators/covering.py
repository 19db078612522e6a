"""Boundaries broken down into quadtree tiles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions import quadkey as qk

COVERING = "tile_qk string, boundary_id string, level int, interior boolean, geom binary, points long"


def tile_box(x: int, y: int, zoom: int) -> tuple[float, float, float, float]:
    """The envelope of a tile, as quadkey.envelope() has it."""
    n = 1 << zoom
    lat = lambda row: math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * row / n))))
    return x / n * 360 - 180, -90.0 if y == n - 1 else lat(y + 1), (x + 1) / n * 360 - 180, 90.0 if y == 0 else lat(y)


def quadkey_of(x: int, y: int, zoom: int) -> str:
    return "".join(str((x >> i & 1) + 2 * (y >> i & 1)) for i in range(zoom - 1, -1, -1))


def wider(box: tuple[float, float, float, float]) -> tuple[float, float, float, float]:
    """A box with a sixteenth of its size more on every side. Shapes are kept clipped to that, so that the edges which
    clipping adds lie where no point of the tile is."""
    dx, dy = (box[2] - box[0]) / 16, (box[3] - box[1]) / 16
    return box[0] - dx, box[1] - dy, box[2] + dx, box[3] + dy


def seeds(boundaries: DataFrame, zoom: int = 4) -> DataFrame:
    """Each boundary with every tile of the first level whose box it meets.

    boundaries: boundary_id, level, geom, xmin, ymin, xmax, ymax; xmin > xmax runs over the antimeridian. There are
    4**zoom tiles whatever the input, so every boundary is compared with all of them.
    """
    n = 1 << zoom
    tiles = boundaries.sparkSession.range(n * n, numPartitions=1).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y"))
    tiles = tiles.withColumn("box", qk.envelope(qk.child_quadkey(F.col("x"), F.col("y"), F.lit(zoom))))
    lat = (F.col("ymin") <= F.col("box.ymax")) & (F.col("ymax") >= F.col("box.ymin"))
    east, west = F.col("xmin") <= F.col("box.xmax"), F.col("xmax") >= F.col("box.xmin")
    lon = F.when(F.col("xmin") <= F.col("xmax"), east & west).otherwise(east | west)
    return boundaries.join(F.broadcast(tiles), lat & lon).select("boundary_id", "level", "geom", "x", "y")


#: Levels that a task goes down before what is still open is dealt out anew.
STEP = 4
OPEN = COVERING + ", x long, y long, zoom int"


def descend(stop: int, leaf: int, last: int, capacity: int):
    """mapInArrow function over rows of OPEN: tiles (with tile_qk) go through; of the others, a boundary's part in tile
    x, y at a zoom, the tiles below as far as level stop, from which on they are left open again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = batch.column("tile_qk").is_valid()
            yield pa.RecordBatch.from_arrays(batch.filter(done).columns, batch.schema.names)
            for row in batch.filter(pc.invert(done)).to_pylist():
                out, stack = [], [(row["x"], row["y"], row["zoom"], geometry.parse(row["geom"]))]
                while stack:
                    x, y, zoom, shape = stack.pop()
                    box = tile_box(x, y, zoom)
                    shape = geometry.clip(shape, *wider(box))
                    part = geometry.clip(shape, *box)
                    if not part or not geometry.area(part) > 0:
                        continue
                    if geometry.fills(part, *box):
                        out.append((quadkey_of(x, y, zoom), True, None, 5, x, y, zoom))
                    elif zoom >= last or (zoom >= leaf and geometry.points(part) <= capacity):
                        out.append((quadkey_of(x, y, zoom), False, geometry.write(shape), geometry.points(part), x, y, zoom))
                    elif zoom >= stop:
                        out += [(None, None, geometry.write(shape), None, 2 * x + dx, 2 * y + dy, zoom + 1) for dx in (0, 1) for dy in (0, 1)]
                    else:
                        stack += [(2 * x + dx, 2 * y + dy, zoom + 1, shape) for dx in (0, 1) for dy in (0, 1)]
                    if len(out) >= 1000:
                        yield tiles_of(row, out)
                        out = []
                if out:
                    yield tiles_of(row, out)

    return run


def tiles_of(row: dict, out: list[tuple]) -> pa.RecordBatch:
    tile, interior, geom, points, x, y, zoom = zip(*out)
    kinds = [(tile, pa.string()), ([str(row["boundary_id"])] * len(out), pa.string()), ([row["level"]] * len(out), pa.int32()), (interior, pa.bool_()), (geom, pa.binary()), (points, pa.int64()), (x, pa.int64()), (y, pa.int64()), (zoom, pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in kinds], ["tile_qk", "boundary_id", "level", "interior", "geom", "points", "x", "y", "zoom"])


def stats(covering: DataFrame, last: int = 16, capacity: int = 5000) -> DataFrame:
    """zoom, tiles, over_capacity: of each level how many tiles it has, and how many of the last level hold more
    points than capacity."""
    zoom = F.length("tile_qk")
    over = F.sum(F.when((zoom == last) & (F.col("points") > capacity), 1).otherwise(0))
    return covering.groupBy(zoom.alias("zoom")).agg(F.count("*").alias("tiles"), over.alias("over_capacity"))


def cover(boundaries: DataFrame, first: int = 4, leaf: int = 12, last: int = 16, capacity: int = 5000) -> DataFrame:
    """tile_qk, boundary_id, level, interior, geom, points: tiles inside a boundary, and tiles on its border with geom,
    the boundary's part there and a little around (see wider()). points: vertices of the part in the tile itself.

    Tiles stop at level `last`, from level `leaf` on where the part has at most `capacity` points. No tile of a
    boundary lies in another of its tiles.
    """
    if not 0 <= first <= leaf <= last <= qk.ZOOM:
        raise ValueError(f"levels must rise: {first}, {leaf}, {last}")
    rows = seeds(boundaries, first)
    none = lambda kind: F.lit(None).cast(kind)
    rows = rows.select(
        none("string").alias("tile_qk"), F.col("boundary_id").cast("string").alias("boundary_id"), F.col("level").cast("int").alias("level"), none("boolean").alias("interior"),
        "geom", none("long").alias("points"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.lit(first).alias("zoom"),
    )
    # What is open goes to different tasks every few levels: the largest polygons are no single row's work.
    for stop in range(first + STEP - 1, last + STEP, STEP):
        rows = rows.repartition("boundary_id", "x", "y").mapInArrow(descend(stop, leaf, last, capacity), OPEN)
    return rows.drop("x", "y", "zoom")


def cover_boxes(boxes: DataFrame, first: int, last: int) -> DataFrame:
    """The covering of axis-parallel boxes by expressions alone: tile_qk, boundary_id, interior.

    boxes: boundary_id, xmin, ymin, xmax, ymax. A tile is taken inside the box where its parent is not, or at the last
    level where it shares area with the box.
    """
    n = F.pow(F.lit(2), F.col("z"))
    rows = boxes.withColumn("z", F.explode(F.sequence(F.lit(first), F.lit(last))))
    column = lambda lon: F.floor((lon + 180) / 360 * n)
    clamp = lambda v: F.least(F.greatest(v, F.lit(0).cast("long")), (n - 1).cast("long"))
    rad = lambda lat: F.radians(F.least(F.greatest(lat, F.lit(-qk.MAX_LATITUDE)), F.lit(qk.MAX_LATITUDE)))
    line = lambda lat: F.floor((0.5 - F.log((1 + F.sin(rad(lat))) / (1 - F.sin(rad(lat)))) / (4 * math.pi)) * n)
    rows = rows.withColumn("x", F.explode(F.sequence(clamp(column(F.col("xmin"))), clamp(column(F.col("xmax"))))))
    rows = rows.withColumn("y", F.explode(F.sequence(clamp(line(F.col("ymax"))), clamp(line(F.col("ymin"))))))
    rows = rows.withColumn("tile_qk", qk.child_quadkey(F.col("x"), F.col("y"), F.col("z")))
    rows = rows.withColumn("e", qk.envelope(F.col("tile_qk"))).withColumn("p", qk.envelope(F.substring(F.col("tile_qk"), F.lit(1), F.col("z") - 1)))
    inside = lambda e: (F.col(f"{e}.xmin") >= F.col("xmin")) & (F.col(f"{e}.xmax") <= F.col("xmax")) & (F.col(f"{e}.ymin") >= F.col("ymin")) & (F.col(f"{e}.ymax") <= F.col("ymax"))
    area = (F.col("e.xmin") < F.col("xmax")) & (F.col("e.xmax") > F.col("xmin")) & (F.col("e.ymin") < F.col("ymax")) & (F.col("e.ymax") > F.col("ymin"))
    whole = inside("e") & ((F.col("z") == first) | ~inside("p"))
    edge = (F.col("z") == last) & ~inside("e") & area
    return rows.filter(whole | edge).select("tile_qk", "boundary_id", inside("e").alias("interior"))
