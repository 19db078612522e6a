"""Imports of places, map elements and divisions into one shape of table."""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, osm_rules, overlay, scoring
from ..functions import quadkey as qk
from ..sources import scratch
from . import lookups

Box = tuple[float, float, float, float]
WORLD: Box = (-180.0, -90.0, 180.0, 90.0)


def in_box(lon: Column, lat: Column, box: Box) -> Column:
    return lon.between(box[0], box[2]) & lat.between(box[1], box[3])


def meets_box(bbox: Column, box: Box) -> Column:
    """Overlap with edges; deliberately blind to the antimeridian. Reaches the scan as pushed filters."""
    return (bbox["xmax"] >= box[0]) & (bbox["xmin"] <= box[2]) & (bbox["ymax"] >= box[1]) & (bbox["ymin"] <= box[3])


def import_places(source: DataFrame, box: Box = WORLD, densities: DataFrame | None = None, rarities: DataFrame | None = None, density_norm: float = 10, idf_norm: float = 18) -> DataFrame:
    """Source columns without geometry, and qk17, importance, variants.

    source: id, bbox, names (primary, common, rules), categories (primary). Rows outside the box, with a blank or null
    name, or without geometry go.
    """
    rows = source.filter(meets_box(F.col("bbox"), box) & F.col("geometry").isNotNull() & (F.trim("names.primary") != "")).drop("geometry")
    rows = rows.withColumn("qk17", qk.quadkey((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2, (F.col("bbox.ymin") + F.col("bbox.ymax")) / 2))
    rows = lookups.with_scores(rows, densities, rarities, "categories.primary")
    rows = rows.withColumn("importance", scoring.place_importance(F.col("density_score"), F.col("idf_score"), density_norm, idf_norm))
    return rows.drop("density_score", "idf_score").withColumn("variants", osm_rules.name_variants(F.col("names.common"), F.col("names.rules")))


def elements(source: DataFrame, building: bool) -> DataFrame:
    """The elements that count as places, with name and category."""
    tags = F.col("tags")
    rows = source.filter(osm_rules.qualifies(tags, building)).withColumn("category", osm_rules.category(tags))
    return rows.filter("category is not null").select(F.col("id").alias("osm_id"), tags["name"].alias("name"), "tags", "category", *[c for c in source.columns if c not in ("id", "tags")])


def way_points(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """osm_id, latitude, longitude: the mean of a way's nodes, each as often as the way names it.

    ways: osm_id, nds. Only nodes that a way names are carried into the join.
    """
    refs = ways.select("osm_id", F.explode("nds.ref").alias("id"))
    found = located(nodes).join(refs.select("id").distinct(), "id", "left_semi")
    return refs.join(found, "id").groupBy("osm_id").agg(F.avg("lat").alias("latitude"), F.avg("lon").alias("longitude"))


def located(nodes: DataFrame) -> DataFrame:
    return nodes.select("id", "lat", "lon").filter("lat is not null and lon is not null")


def relation_points(relations: DataFrame, ways: DataFrame, nodes: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """osm_id, latitude, longitude and the extent of members: nodes of a relation itself and of its member ways.

    relations: osm_id, members; ways: id, nds. A member named twice counts once; a node that several ways share counts
    with each. Members that are relations lead nowhere. members: relation_members() of them, where they are worked out
    already.
    """
    members = relation_members(relations) if members is None else members
    own = members.filter("type = 'node'").select("osm_id", F.col("ref").alias("id"))
    ways_named = members.filter("type = 'way'").select("osm_id", F.col("ref").alias("way"))
    needed = ways.select(F.col("id").alias("way"), "nds").join(ways_named.select("way").distinct(), "way", "left_semi")
    through = ways_named.join(needed.select("way", F.explode("nds.ref").alias("id")), "way").select("osm_id", "id")
    refs = own.unionByName(through)
    found = located(nodes).join(refs.select("id").distinct(), "id", "left_semi")
    stats = [f("lat").alias(a) for f, a in ((F.avg, "latitude"), (F.min, "ext_ymin"), (F.max, "ext_ymax"))]
    stats += [f("lon").alias(a) for f, a in ((F.avg, "longitude"), (F.min, "ext_xmin"), (F.max, "ext_xmax"))]
    return refs.join(found, "id").groupBy("osm_id").agg(*stats)


def relation_members(relations: DataFrame) -> DataFrame:
    return relations.select("osm_id", F.explode("members").alias("m")).select("osm_id", "m.type", "m.ref").distinct()


def finished(rows: DataFrame, kind: str, box: Box, densities, rarities, density_norm: float, idf_norm: float) -> DataFrame:
    """The columns of the places table from osm_id, name, tags, category, latitude and longitude."""
    lon, lat, tags = F.col("longitude"), F.col("latitude"), F.col("tags")
    rows = rows.filter(in_box(lon, lat, box)).withColumn("qk17", qk.quadkey(lon, lat))
    rows = lookups.with_scores(rows, densities, rarities)
    around = F.struct((lon - 0.0001).alias("xmin"), (lat - 0.0001).alias("ymin"), (lon + 0.0001).alias("xmax"), (lat + 0.0001).alias("ymax"))
    return rows.select(
        F.lit(kind).alias("osm_type"),
        "osm_id",
        F.concat(F.lit(kind), F.col("osm_id").cast("string")).alias("rkey"),
        "name",
        "latitude",
        "longitude",
        F.col("category").alias("primary_category"),
        osm_rules.kept_tags(tags, F.col("category")).alias("tags"),
        around.alias("bbox"),
        scoring.place_importance(F.col("density_score"), F.col("idf_score"), density_norm, idf_norm).alias("importance"),
        "qk17",
        osm_rules.osm_variants(tags, F.col("name")).alias("variants"),
        *[c for c in rows.columns if c.startswith("ext_")],
    )


def without_doubles(relations: DataFrame, members: DataFrame, places: DataFrame) -> DataFrame:
    """Relations that no node or way already stands for: none of their node or way members bears their trimmed name,
    and no place of that name lies within the extent of their members.

    relations: osm_id, name, ext_*; members: osm_id, type, ref; places: osm_type, osm_id, name, longitude, latitude.
    """
    kind = F.when(F.col("type") == "node", "n").when(F.col("type") == "way", "w")
    linked = members.select("osm_id", kind.alias("osm_type"), F.col("ref").alias("ref")).filter("osm_type is not null")
    stand = places.select("osm_type", F.col("osm_id").alias("ref"), F.trim("name").alias("trimmed"))
    doubled = linked.join(stand, ["osm_type", "ref"]).select("osm_id", "trimmed").distinct()
    rows = scratch.saved(relations.withColumn("trimmed", F.trim("name")).join(doubled, ["osm_id", "trimmed"], "left_anti"))
    return rows.join(holding(rows, places), "osm_id", "left_anti").drop("trimmed")


def holding(extents: DataFrame, places: DataFrame) -> DataFrame:
    """osm_id of those extents that hold a place of their name, edges included.

    extents: osm_id, trimmed, ext_*; places: name, longitude, latitude. They meet by name and cell: an extent goes to
    the tiles, four at most, of the finest level of which one is as large as it, and a place to the tiles over it at
    the levels that extents of its name have. So a frequent name isn't compared with all of its kind, but with those
    nearby, and only until one is found.
    """
    zoom = qk.ZOOM
    first = lambda c: F.greatest(c, F.lit(0).cast("long"))
    ends = {
        "west": first(qk.column_of(F.col("ext_xmin"), zoom)), "east": first(qk.column_of(F.col("ext_xmax"), zoom)),
        "north": qk.row_of(F.col("ext_ymax"), zoom), "south": qk.row_of(F.col("ext_ymin"), zoom),
    }
    left = extents.select("osm_id", "trimmed", "ext_xmin", "ext_ymin", "ext_xmax", "ext_ymax", *[c.alias(n) for n, c in ends.items()])
    wide = F.greatest(F.col("east") - F.col("west"), F.col("south") - F.col("north")) + 1
    left = left.filter("ext_xmin <= ext_xmax and ext_ymin <= ext_ymax").withColumn("up", F.least(F.ceil(F.log2(wide.cast("double"))).cast("int"), F.lit(zoom)))
    at = lambda c: F.expr(f"shiftright({c}, up)")
    left = left.withColumn("x", F.explode(F.sequence(at("west"), at("east")))).withColumn("y", F.explode(F.sequence(at("north"), at("south"))))
    left = left.withColumn("cell", qk.woven(F.col("x"), F.col("y"))).drop("west", "east", "north", "south", "x", "y")
    spots = leveled(places, left.select("trimmed", "up").distinct())
    same = [left[c] == spots[c] for c in ("trimmed", "up", "cell")]
    within = spots["px"].between(left["ext_xmin"], left["ext_xmax"]) & spots["py"].between(left["ext_ymin"], left["ext_ymax"])
    return left.join(spots, [*same, within], "left_semi").select("osm_id").distinct()


def leveled(places: DataFrame, levels: DataFrame) -> DataFrame:
    """trimmed, px, py, up, cell: every place in the tiles over it at the levels of its name, counted up from the finest.

    levels: trimmed, up.
    """
    spots = places.select(F.trim("name").alias("trimmed"), F.col("longitude").alias("px"), F.col("latitude").alias("py"))
    spots = spots.withColumn("number", qk.number(F.col("px"), F.col("py"))).filter("number is not null").join(levels, "trimmed")
    return spots.select("trimmed", "px", "py", "up", qk.ancestor(F.col("number"), F.col("up")).alias("cell"))


def import_osm(nodes: DataFrame, ways: DataFrame, relations: DataFrame, box: Box = WORLD, densities: DataFrame | None = None, rarities: DataFrame | None = None, density_norm: float = 10, idf_norm: float = 18) -> DataFrame:
    """Places from nodes (id, tags, lat, lon), ways (id, tags, nds) and relations (id, tags, members)."""
    done = lambda rows, kind: finished(rows, kind, box, densities, rarities, density_norm, idf_norm)
    own = elements(nodes, False).withColumnsRenamed({"lat": "latitude", "lon": "longitude"}).filter("latitude is not null and longitude is not null")
    lines = elements(ways, True)
    flat = done(own, "n").unionByName(done(lines.join(way_points(lines, nodes), "osm_id"), "w"))
    groups = elements(relations, True)
    members = scratch.saved(relation_members(groups))
    placed = done(groups.join(relation_points(groups, ways, nodes, members), "osm_id"), "r")
    kept = without_doubles(placed, members, flat)
    return flat.unionByName(kept.drop("ext_xmin", "ext_xmax", "ext_ymin", "ext_ymax"))


#: Level of the tiles in which areas of a division become one first.
NEAR = 6
MEASURED = "id {id}, parts int, unusable int, geom binary, xmin double, ymin double, xmax double, ymax double, interior_lon double, interior_lat double"


def joined(parts: list[bytes]) -> tuple[geometry.Polygons, int]:
    """The union of areas, and how many of them are unusable. Equal areas are looked at once."""
    found, bad = [], 0
    for part, times in Counter(parts).items():
        try:
            shape = overlay.usable(geometry.parse(part))
        except (ValueError, IndexError, struct.error):
            shape = []
        found += shape
        bad += 0 if shape else times
    return overlay.union(found), bad


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Areas of a division that lie close together as one."""
    for batch in batches:
        parts = batch.column("parts").to_pylist()
        shapes = [joined(p) for p in parts]
        kinds = [(list(map(len, parts)), pa.int32()), ([bad for _, bad in shapes], pa.int32()), ([geometry.write(shape) if shape else None for shape, _ in shapes], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(v, k) for v, k in kinds]], ["id", "n", "bad", "near"])


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The union of the areas of each division with bounds and a point inside; null where none of them has an inside.
    unusable: areas that are no polygons, or flat, empty, broken off or not finite. n, bad: areas and unusable ones
    among them, where parts are made of others."""
    names = ["id", "parts", "unusable", "geom", "xmin", "ymin", "xmax", "ymax", "interior_lon", "interior_lat"]
    for batch in batches:
        rows = {k: [] for k in names}
        counts = zip(*(batch.column(c).to_pylist() for c in ("n", "bad"))) if "n" in batch.schema.names else repeat((None, 0))
        for key, parts, (n, gone) in zip(batch.column("id").to_pylist(), batch.column("parts").to_pylist(), counts):
            shape, bad = joined(parts)
            values = (geometry.write(shape), *geometry.bounds(shape), *geometry.interior_point(shape)) if shape else (None,) * 7
            for k, v in zip(rows, (key, len(parts) if n is None else n, gone + bad, *values)):
                rows[k].append(v)
        kinds = [batch.schema.field("id").type, pa.int32(), pa.int32(), pa.binary(), *[pa.float64()] * 6]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names)


def area_shapes(areas: DataFrame, box: Box = WORLD) -> DataFrame:
    """id, parts, unusable, geom, bounds and interior point: the land areas of each division that meet the box as one.

    areas: division_id, is_land, geometry (WKB), bbox. Overlapping and adjoining areas become one without inner edges;
    unusable ones are counted and left out, and a division with no other keeps a row without geom. They become one in
    two steps, near ones first, so that the areas of a large division are no single task's work.
    """
    land = areas.filter(F.col("is_land") & F.col("geometry").isNotNull() & meets_box(F.col("bbox"), box))
    middle = lambda axis: (F.col(f"bbox.{axis}min") + F.col(f"bbox.{axis}max")) / 2
    near = land.groupBy(F.col("division_id").alias("id"), qk.number(middle("x"), middle("y"), NEAR).alias("cell")).agg(F.collect_list("geometry").alias("parts"))
    kind = near.schema["id"].dataType.simpleString()
    shapes = near.mapInArrow(gathered, f"id {kind}, n int, bad int, near binary")
    whole = shapes.groupBy("id").agg(F.collect_list("near").alias("parts"), F.sum("n").cast("int").alias("n"), F.sum("bad").cast("int").alias("bad"))
    return whole.mapInArrow(measured, MEASURED.format(id=kind))


def import_divisions(divisions: DataFrame, areas: DataFrame, box: Box = WORLD, densities: DataFrame | None = None, density_norm: float = 10, pop_norm: float = 20, shapes: DataFrame | None = None) -> DataFrame:
    """Divisions with land area: geom, level, population, bounds, interior point, qk17, importance, variants.

    divisions: id, names, subtype, country, region, wikidata, population, parent_division_id; areas: division_id,
    is_land, geometry (WKB), bbox; shapes: area_shapes() of them, where they are worked out already. A division whose
    areas are all unusable goes. A subtype without a level raises ValueError.
    """
    unknown = divisions.filter(scoring.level(F.col("subtype")).isNull()).select("subtype").limit(1).collect()
    if unknown:
        raise ValueError(f"no level for subtype {unknown[0].subtype!r}")
    shapes = (area_shapes(areas, box) if shapes is None else shapes).filter("geom is not null").drop("parts", "unusable")
    keep = ["id", "names", "subtype", "country", "region", "wikidata", "parent_division_id"]
    rows = divisions.select(*keep, scoring.level(F.col("subtype")).alias("level"), scoring.population(F.col("population")).alias("population")).join(shapes, "id")
    rows = rows.withColumn("qk17", qk.quadkey(F.col("interior_lon"), F.col("interior_lat")))
    if densities is None:
        rows = rows.withColumn("avg_density", F.lit(0.0))
    else:
        local = rows.filter("subtype = 'locality'").select("id", "xmin", "ymin", "xmax", "ymax")
        rows = rows.join(lookups.box_density(local, densities), "id", "left")
    rows = rows.withColumn("importance", scoring.division_importance(F.col("subtype"), F.col("avg_density"), F.col("population"), density_norm, pop_norm))
    return rows.drop("avg_density").withColumn("variants", osm_rules.name_variants(F.col("names.common"), F.col("names.rules")))
