"""Quadkeys as column expressions.

A quadkey is a number while it is worked with: its digits 0 to 3 are read as decimal ones, so that an ancestor is a
division by a power of ten and seventeen digits fit a long. Text, with its leading zeros, is made at the edge. The
digits of x and y come from bin(), read as decimal: adding x and twice y carries nothing, and neither is written out
twice.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ZOOM = 17
Box = tuple[float, float, float, float]
#: Latitude of the last row of tiles that the Mercator square holds; beyond it points count as on that row.
MAX_LATITUDE = 85.05101030905541


def column_of(lon: Column, zoom: int) -> Column:
    """Column of tiles; longitude 180 belongs to the last one."""
    n = 1 << zoom
    return F.least(F.floor((lon + 180) / 360 * n), F.lit(n - 1).cast("long"))


def row_of(lat: Column, zoom: int) -> Column:
    """Row of tiles from the north; the outermost ones reach to the poles."""
    n = 1 << zoom
    s = F.sin(F.radians(F.least(F.greatest(lat, F.lit(-MAX_LATITUDE)), F.lit(MAX_LATITUDE))))
    y = F.floor((F.lit(0.5) - F.log((1 + s) / (1 - s)) / (4 * math.pi)) * n)
    return F.greatest(F.least(y, F.lit(n - 1).cast("long")), F.lit(0).cast("long"))


def woven(x: Column, y: Column) -> Column:
    """The number of a tile: digits of x and twice those of y."""
    return F.bin(x).cast("long") + 2 * F.bin(y).cast("long")


def number(lon: Column, lat: Column, zoom: int = ZOOM) -> Column:
    """Quadkey of a point as a number, null outside lon -180..180 or lat -90..90. The clamp of latitude comes after
    the check of its range."""
    inside = lon.between(-180, 180) & lat.between(-90, 90)
    return F.when(inside, woven(column_of(lon, zoom), row_of(lat, zoom)))


def text(number: Column, zoom: int | Column) -> Column:
    """A number of so many digits as text."""
    return F.lpad(number.cast("string"), zoom, F.lit("0"))


def ancestor(number: Column, steps: Column) -> Column:
    """The number of the tile so many levels up. Whole numbers throughout: seventeen digits are too many for a double."""
    power = F.element_at(F.array(*[F.lit(10**k).cast("long") for k in range(ZOOM + 1)]), (steps + 1).cast("int"))
    return F.call_function("div", number, power)


def quadkey(lon: Column, lat: Column, zoom: int = ZOOM) -> Column:
    """Quadkey of a point as text, digits 0 NW, 1 NE, 2 SW, 3 SE; null outside lon -180..180 or lat -90..90."""
    return text(number(lon, lat, zoom), zoom)


def _axis(qk: Column, bits: str) -> Column:
    """Tile number along one axis: every digit stands for one bit of it."""
    return F.when(qk == "", F.lit(0).cast("long")).otherwise(F.conv(F.translate(qk, "0123", bits), 2, 10).cast("long"))


def tile_x(qk: Column) -> Column:
    return _axis(qk, "0101")


def tile_y(qk: Column) -> Column:
    return _axis(qk, "0011")


def envelope(qk: Column) -> Column:
    """struct<xmin, ymin, xmax, ymax> in degrees; the outermost rows reach to the poles."""
    n = F.pow(F.lit(2.0), F.length(qk))
    x, y = tile_x(qk), tile_y(qk)
    lat = lambda row: F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * row / n))))
    return F.struct(
        (x / n * 360 - 180).alias("xmin"),
        F.when(y == n - 1, -90.0).otherwise(lat(y + 1)).alias("ymin"),
        ((x + 1) / n * 360 - 180).alias("xmax"),
        F.when(y == 0, 90.0).otherwise(lat(y)).alias("ymax"),
    )


def is_full(qk: Column) -> Column:
    return F.coalesce(F.rlike(qk, F.lit("^[0-3]{17}$")), F.lit(False))


def overlaps(a: Column, b: tuple[float, float, float, float]) -> Column:
    """Whether box a (struct) meets box b, edges included; a box with xmin > xmax runs over the antimeridian."""
    xmin, ymin, xmax, ymax = b
    over = a["xmin"] > a["xmax"]
    east, west = a["xmin"] <= xmax, a["xmax"] >= xmin
    lat = (a["ymin"] <= ymax) & (a["ymax"] >= ymin)
    lon = F.when(over, F.lit(True) if xmin > xmax else east | west).otherwise((east | west) if xmin > xmax else (east & west))
    return lat & lon


def child_quadkey(x: Column, y: Column, zoom: Column) -> Column:
    """Quadkey of tile x, y at a zoom given as a column."""
    return F.when(zoom > 0, text(woven(x.cast("long"), y.cast("long")), zoom.cast("int"))).otherwise("")


def within(key: Column, prefix: str) -> Column:
    """Whether a full quadkey lies in a tile, as a range that reaches the scan of a table sorted by it."""
    return key.between(F.lit(prefix.ljust(ZOOM, "0")), F.lit(prefix.ljust(ZOOM, "3")))


def _tile_bounds(x: int, y: int, zoom: int) -> Box:
    """The envelope of a tile, as envelope() has it."""
    n = 1 << zoom
    lat = lambda row: math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * row / n))))
    return x / n * 360 - 180, -90.0 if y == n - 1 else lat(y + 1), (x + 1) / n * 360 - 180, 90.0 if y == 0 else lat(y)


def _meets(a: Box, b: Box) -> bool:
    lat = a[1] <= b[3] and a[3] >= b[1]
    return lat and (a[0] <= b[2] and a[2] >= b[0] if b[0] <= b[2] else a[0] <= b[2] or a[2] >= b[0])


def box_tiles(box: Box, most: int = 32, zoom: int = ZOOM) -> list[str]:
    """At most so many tiles (four at least) that hold all of a box, edges included; one with xmin > xmax runs over the
    antimeridian and falls into two lobes. The largest tile that only part of the box is in is split first, as long as
    that leaves few enough."""
    inside = lambda e: box[1] <= e[1] and e[3] <= box[3] and (box[0] <= e[0] and e[2] <= box[2] if box[0] <= box[2] else box[0] <= e[0] or e[2] <= box[2])
    whole, todo = [], [(0, "", 0, 0)]
    while todo:
        level, key, x, y = heapq.heappop(todo)
        e = _tile_bounds(x, y, level)
        if level == zoom or (level and inside(e)):
            whole.append(key)
            continue
        below = [(level + 1, f"{key}{dx + 2 * dy}", 2 * x + dx, 2 * y + dy) for dy in (0, 1) for dx in (0, 1)]
        below = [t for t in below if _meets(_tile_bounds(t[2], t[3], t[0]), box)]
        if level and len(whole) + len(todo) + len(below) > max(most, 4):
            whole.append(key)
        else:
            for t in below:
                heapq.heappush(todo, t)
    return sorted(whole)


def box_ranges(box: Box, most: int = 32, zoom: int = ZOOM) -> list[tuple[str, str]]:
    """Few closed ranges of quadkeys of any length, in order, that hold every tile below those of box_tiles(); where one
    ends at the next one's start they are one."""
    out: list[tuple[str, str]] = []
    for key in box_tiles(box, most, zoom):
        low, high = key, key.ljust(zoom, "3")
        if out and _successor(out[-1][1]) == low.rstrip("0").ljust(1, "0"):
            low = out.pop()[0]
        out.append((low, high))
    return out


def _successor(high: str) -> str:
    """The shortest quadkey after a full one, without the zeros at its end."""
    head = high.rstrip("3")
    return head[:-1] + str(int(head[-1]) + 1) if head else ""


def in_box(key: Column, box: Box, most: int = 32, zoom: int = ZOOM) -> Column:
    """Whether a tile of any level may meet a box, as ranges and names that reach the scan of a table sorted by key.
    Names are those of the tiles above the ranges. Tiles near the box pass too: overlaps() settles them."""
    found = box_tiles(box, most, zoom)
    above = sorted({k[:n] for k in found for n in range(1, len(k))})
    test = key.isin(above) if above else F.lit(False)
    for low, high in box_ranges(box, most, zoom):
        test = test | key.between(F.lit(low), F.lit(high))
    return test


def hilbert(key: Column) -> Column:
    """The place of a tile on the Hilbert curve of its level, in digits 0 to 3 like its quadkey, so that keys in order
    follow the curve: tiles next to each other in it share an edge.

    At each digit the two bits of x and y, swapped and complemented as the digits before have left them, say which
    quarter of the curve comes; the lower quarters swap what follows, the right one of them complements it too.
    """
    digits = F.filter(F.split(key, ""), lambda d: d != "")
    start = F.struct(F.lit(0).alias("swap"), F.lit(0).alias("turn"), F.lit("").alias("out"))

    def step(state: Column, digit: Column) -> Column:
        d = digit.cast("int")
        east, south = d.bitwiseAND(F.lit(1)), F.shiftright(d, 1)
        x = F.when(state["swap"] == 1, south).otherwise(east).bitwiseXOR(state["turn"])
        y = F.when(state["swap"] == 1, east).otherwise(south).bitwiseXOR(state["turn"])
        low = 1 - y
        return F.struct(
            state["swap"].bitwiseXOR(low).alias("swap"), state["turn"].bitwiseXOR(low.bitwiseAND(x)).alias("turn"),
            F.concat(state["out"], (3 * x).bitwiseXOR(y).cast("string")).alias("out"),
        )

    return F.aggregate(digits, start, step, lambda state: state["out"])
