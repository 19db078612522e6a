"""Score lookups: density by tile, rarity by category, and guards for their keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import osm_rules
from ..functions import quadkey as qk
from . import tiles


def density(points: DataFrame, lon: Column, lat: Column, zoom: int = 15) -> DataFrame:
    """tile_qk15, density_score = ln(1 + points), and the tile's bounds.

    Points without a quadkey share one null tile, which no join ever finds.
    """
    counted = points.groupBy(qk.number(lon, lat, zoom).alias("tile")).agg(F.log(1 + F.count("*")).alias("density_score"))
    counted = counted.select(qk.text(F.col("tile"), zoom).alias("tile_qk15"), "density_score")
    # exploding one box works it out once; a plain column would be repeated in every expression over its sides
    box = counted.select("*", F.explode(F.array(F.when(F.col("tile_qk15").isNotNull(), qk.envelope(F.col("tile_qk15"))))).alias("box"))
    return box.select("tile_qk15", "density_score", *[F.col(f"box.{c}").alias(f"tile_{c}") for c in ("xmin", "ymin", "xmax", "ymax")])


def rarity(rows: DataFrame, category: Column) -> DataFrame:
    """category, n_places, idf_score = ln(all / n) over rows with a category."""
    counts = rows.select(category.alias("category")).filter("category is not null").groupBy("category").agg(F.count("*").alias("n_places"))
    # One row of a total, not a window over everything.
    total = counts.agg(F.sum("n_places").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("category", "n_places", F.log(F.col("total") / F.col("n_places")).alias("idf_score"))


def osm_rarity(*elements: DataFrame) -> DataFrame:
    """rarity() over the named, categorised elements of all kinds together."""
    arms = [e.select("tags").filter(osm_rules.named(F.col("tags"))).select(osm_rules.category(F.col("tags")).alias("category")) for e in elements]
    every = arms[0]
    for arm in arms[1:]:
        every = every.unionByName(arm)
    return rarity(every, F.col("category"))


def one_per_key(lookup: DataFrame, key: str, *values: str) -> DataFrame:
    """A lookup that can't multiply the rows it is joined to."""
    return lookup.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.any_value(v).alias(v) for v in values])


def repeated_keys(lookup: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand more than once; nulls don't count."""
    rows = lookup.filter(" and ".join(f"`{k}` is not null" for k in keys))
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(lookup: DataFrame, name: str, *keys: str) -> None:
    """Raises ValueError where a key stands more than once."""
    if found := repeated_keys(lookup, *keys).first():
        raise ValueError(f"{name}: key {tuple(found[k] for k in keys)} stands {found['n']} times")


def with_scores(places: DataFrame, densities: DataFrame | None, rarities: DataFrame | None, category: str = "category") -> DataFrame:
    """places with density_score and idf_score, null where a lookup has none or is missing altogether."""
    if densities is None:
        places = places.withColumn("density_score", F.lit(None).cast("double"))
    else:
        tiles = one_per_key(densities, "tile_qk15", "density_score")
        places = places.withColumn("tile_qk15", F.substring("qk17", 1, 15)).join(tiles, "tile_qk15", "left").drop("tile_qk15")
    if rarities is None:
        return places.withColumn("idf_score", F.lit(None).cast("double"))
    scores = one_per_key(rarities, "category", "idf_score").withColumnRenamed("category", "_category")
    return places.join(scores, F.col(category) == F.col("_category"), "left").drop("_category")


def box_density(boxes: DataFrame, densities: DataFrame, zoom: int = 15) -> DataFrame:
    """id, avg_density over the tiles that a box meets, edges included; 0 where it meets none.

    boxes: id, xmin, ymin, xmax, ymax, no box over the antimeridian. A box goes to the tiles, four at most, of the
    finest level at which it is no wider and no higher than one of them, and the tiles of densities to their ancestors
    at the levels that boxes have taken (no more than zoom + 1). So a small box meets the tiles of a small area only,
    and every pair meets once.
    """
    one, last = F.lit(1).cast("long"), F.lit((1 << zoom) - 1).cast("long")
    # A tile that only touches the box's edge is met too: one more on each side.
    ends = {
        "west": F.greatest(qk.column_of(F.col("xmin"), zoom) - one, F.lit(0).cast("long")),
        "east": F.least(qk.column_of(F.col("xmax"), zoom) + one, last),
        "north": F.greatest(qk.row_of(F.col("ymax"), zoom) - one, F.lit(0).cast("long")),
        "south": F.least(qk.row_of(F.col("ymin"), zoom) + one, last),
    }
    left = boxes.select("id", "xmin", "ymin", "xmax", "ymax", *[c.alias(n) for n, c in ends.items()])
    wide = F.greatest(F.col("east") - F.col("west"), F.col("south") - F.col("north")) + 1
    left = left.withColumn("up", F.least(F.ceil(F.log2(wide.cast("double"))).cast("int"), F.lit(zoom)))
    at = lambda c: F.expr(f"shiftright({c}, up)")
    left = left.withColumn("x", F.explode(F.sequence(at("west"), at("east")))).withColumn("y", F.explode(F.sequence(at("north"), at("south"))))
    left = left.withColumn("cell", qk.woven(F.col("x"), F.col("y"))).select("id", "xmin", "ymin", "xmax", "ymax", "up", "cell")
    levels = sorted(r.up for r in left.select("up").distinct().collect())  # zoom + 1 at most
    right = densities.filter("tile_qk15 is not null").withColumn("up", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
    right = right.withColumn("cell", qk.ancestor(F.col("tile_qk15").cast("long"), F.col("up")))
    meet = (F.col("tile_xmin") <= F.col("xmax")) & (F.col("tile_xmax") >= F.col("xmin")) & (F.col("tile_ymin") <= F.col("ymax")) & (F.col("tile_ymax") >= F.col("ymin"))
    found = left.join(right, ["up", "cell"]).filter(meet).groupBy("id").agg(F.avg("density_score").alias("avg_density"))
    return boxes.select("id").join(found, "id", "left").select("id", F.coalesce("avg_density", F.lit(0.0)).alias("avg_density"))


def pyramid(densities: DataFrame, zoom: int = 15) -> DataFrame:
    """level, tile, n, total: number and sum of the densities below every tile from level 0 on; a table."""
    cells = densities.filter("tile_qk15 is not null").select(F.col("tile_qk15").cast("long").alias("cell"), F.lit(1).cast("long").alias("n"), F.col("density_score").alias("total"))
    return tiles.level_sums(cells, 0, zoom, "n", "total")


def box_average(boxes: DataFrame, sums: DataFrame, zoom: int = 15) -> DataFrame:
    """id, avg_density as box_density() has it, from a pyramid: a box takes whole tiles inside it and finer ones along
    its rim, so a box of any size meets as many tiles as its sides are long, not as its area holds.

    boxes: id, xmin, ymin, xmax, ymax, no box over the antimeridian.
    """
    n = 1 << zoom
    side = lambda column: F.lit(360.0) * column / n - 180
    line = lambda row: F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * row / n))))
    one = F.lit(1).cast("long")
    west, east, north, south = qk.column_of(F.col("xmin"), zoom), qk.column_of(F.col("xmax"), zoom), qk.row_of(F.col("ymax"), zoom), qk.row_of(F.col("ymin"), zoom)
    rows = boxes.select("id", "xmin", "ymin", "xmax", "ymax", F.greatest(west, F.lit(0).cast("long")).alias("w"), east.alias("e"), north.alias("t"), south.alias("b"))
    # A tile that only touches the box's edge is met too.
    touch = {
        "x0": F.when((F.col("w") > 0) & (side(F.col("w")) >= F.col("xmin")), F.col("w") - one).otherwise(F.col("w")),
        "x1": F.when((F.col("e") < n - 1) & (side(F.col("e") + 1) <= F.col("xmax")), F.col("e") + one).otherwise(F.col("e")),
        "y0": F.when((F.col("t") > 0) & (line(F.col("t")) <= F.col("ymax")), F.col("t") - one).otherwise(F.col("t")),
        "y1": F.when((F.col("b") < n - 1) & (line(F.col("b") + 1) >= F.col("ymin")), F.col("b") + one).otherwise(F.col("b")),
    }
    rows = rows.filter("xmin <= xmax and ymin <= ymax and xmax >= -180 and xmin <= 180").select("id", *[c.alias(k) for k, c in touch.items()])
    rows = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(zoom)))).withColumn("k", F.lit(zoom) - F.col("level"))
    # Of each level the tiles inside the box (a..c by d..f), without those whose parents are (ap..cp by dp..fp).
    first = lambda c, k: F.expr(f"shiftright({c} + shiftleft(1L, {k}) - 1, {k})")
    last = lambda c, k: F.expr(f"shiftright({c} + 1, {k}) - 1")
    rows = rows.select("id", "level", first("x0", "k").alias("a"), last("x1", "k").alias("c"), first("y0", "k").alias("d"), last("y1", "k").alias("f"), *[(2 * first(x, "(k + 1)")).alias(y) for x, y in (("x0", "ap"), ("y0", "dp"))], *[(2 * last(x, "(k + 1)") + 1).alias(y) for x, y in (("x1", "cp"), ("y1", "fp"))])
    rows = rows.filter("a <= c and d <= f").withColumn("y", F.explode(F.sequence("d", "f")))
    span = lambda a, b: f"CASE WHEN {a} <= {b} THEN sequence({a}, {b}) ELSE cast(array() AS array<bigint>) END"
    inner = "level > 0 AND ap <= cp AND y BETWEEN dp AND fp"
    rows = rows.withColumn("x", F.explode(F.expr(f"CASE WHEN {inner} THEN concat({span('a', 'ap - 1')}, {span('cp + 1', 'c')}) ELSE sequence(a, c) END")))
    met = rows.select("id", "level", qk.woven(F.col("x"), F.col("y")).alias("tile")).join(sums, ["level", "tile"])
    found = met.groupBy("id").agg((F.sum("total") / F.sum("n")).alias("avg_density"))
    return boxes.select("id").join(found, "id", "left").select("id", F.coalesce("avg_density", F.lit(0.0)).alias("avg_density"))
