"""Records as JSON, tiles of records, and what is looked up in them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_text as js
from ..functions import quadkey as qk
from ..functions import scoring
from ..sources import scratch


def text(value: str) -> Column:
    return js.quoted(F.lit(value))


def geo(lat: Column, lon: Column) -> Column:
    fields = {"$type": text("community.lexicon.location.geo"), "latitude": js.quoted(js.fixed(lat)), "longitude": js.quoted(js.fixed(lon))}
    return js.whole_object(fields)


def bbox(north: Column, south: Column, east: Column, west: Column) -> Column:
    sides = {"north": north, "south": south, "east": east, "west": west}
    return js.whole_object({"$type": text("community.lexicon.location.bbox")} | {k: js.quoted(js.fixed(v)) for k, v in sides.items()})


def address(a: Column) -> Column:
    """An address as JSON: nulls left out, of a region US-CA only CA."""
    region = F.when(F.instr(a["region"], "-") > 0, F.substring(a["region"], F.instr(a["region"], "-") + 1, F.length(a["region"]))).otherwise(a["region"])
    parts = {"country": a["country"], "region": region, "locality": a["locality"], "street": a["freeform"], "postalCode": a["postcode"]}
    return js.shallow_object({"$type": (F.lit("community.lexicon.location.address"), "string")} | {k: (v, "string") for k, v in parts.items()})


def listed(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def variants(column: Column) -> Column:
    """Each variant without its null fields, which to_json leaves out by itself: they are flat."""
    return listed(F.transform(F.coalesce(column, F.array().cast("array<struct<name:string,type:string,language:string>>")), lambda v: F.to_json(v)))


def record(rkey: Column, name: Column, importance: Column, locations: Column, variants_json: Column, attributes: Column, relations: Column) -> Column:
    """A record's JSON, keys in their fixed order."""
    fields = {
        "$type": text("org.atgeo.place"),
        "rkey": js.quoted(rkey),
        "name": F.coalesce(js.quoted(name), F.lit("null")),
        "importance": F.coalesce(importance.cast("string"), F.lit("null")),
        "locations": locations,
        "variants": variants_json,
        "attributes": attributes,
        "relations": F.coalesce(relations, F.lit("{}")),
    }
    return js.whole_object(fields)


def osm_rkey(rkey: Column) -> Column:
    rest = F.substring(rkey, F.lit(2), F.length(rkey))
    kind = F.substring(rkey, 1, 1)
    return F.when(kind == "n", F.concat(F.lit("node:"), rest)).when(kind == "w", F.concat(F.lit("way:"), rest)).when(kind == "r", F.concat(F.lit("relation:"), rest)).otherwise(rkey)


def osm_record() -> Column:
    """Of a place made by import_osm(): its tags with the category back among them."""
    tags = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    category = F.create_map(F.split_part("primary_category", F.lit("="), F.lit(1)), F.split_part("primary_category", F.lit("="), F.lit(2)))
    full = F.when(F.col("primary_category").isNotNull(), F.map_concat(tags, category)).otherwise(tags)
    where = listed(F.array(geo(F.col("latitude"), F.col("longitude"))))
    return record(osm_rkey(F.col("rkey")), F.col("name"), F.col("importance"), where, variants(F.col("variants")), F.to_json(full), F.col("relations_json"))


def place_record(kinds: dict[str, str], attributes: tuple[str, ...] = ("id", "names", "categories", "websites", "socials", "emails", "phones", "brand")) -> Column:
    """Of a place made by import_places(); kinds: its columns' types."""
    middle = lambda a, b: (F.col(f"bbox.{a}") + F.col(f"bbox.{b}")) / 2
    known = F.filter(F.coalesce("addresses", F.array().cast(kinds["addresses"])), lambda a: a["country"].isNotNull())
    where = listed(F.concat(F.array(geo(middle("ymin", "ymax"), middle("xmin", "xmax"))), F.transform(known, address)))
    fields = {a: (F.col(a), kinds[a]) for a in attributes if a in kinds}
    if "confidence" in kinds:
        fields["confidence"] = (js.fixed(F.col("confidence"), "decimal(4,3)"), "string")
    fields |= {a: (F.col(a), kinds[a]) for a in ("version", "sources") if a in kinds}
    return record(F.col("id").cast("string"), F.col("names.primary"), F.col("importance"), where, variants(F.col("variants")), js.shallow_object(fields), F.col("relations_json"))


def division_record() -> Column:
    where = listed(F.array(bbox(F.col("ymax"), F.col("ymin"), F.col("xmax"), F.col("xmin"))))
    kinds = {"subtype": "string", "country": "string", "region": "string", "level": "int", "wikidata": "string", "population": "bigint"}
    attributes = js.shallow_object({k: (F.col(k), kind) for k, kind in kinds.items()})
    return record(F.col("id").cast("string"), F.col("names.primary"), F.col("importance"), where, variants(F.col("variants")), attributes, F.col("relations_json"))


def tile_records(places: DataFrame, key: str, assignments: DataFrame, relations: DataFrame | None, record_json: Column, rkey: Column) -> DataFrame:
    """tile_qk, place_id, rkey, record_json.

    A place may stand in several tiles, each with relations of its own, so both joins are on place and tile.
    """
    rows = assignments.select("place_id", "tile_qk").join(places.withColumn("place_id", F.col(key)), "place_id")
    if relations is None:
        rows = rows.withColumn("relations_json", F.lit(None).cast("string"))
    else:
        rows = rows.join(relations.select("place_id", "tile_qk", "relations_json"), ["place_id", "tile_qk"], "left")
    return rows.select("tile_qk", "place_id", rkey.alias("rkey"), record_json.alias("record_json"))


def wrapped(repo: str, collection: str) -> Column:
    """A record with its address, from columns rkey and record_json."""
    return js.whole_object({"uri": js.quoted(F.concat(F.lit(f"https://{repo}/{collection}/"), F.col("rkey"))), "cid": F.lit("null"), "value": F.col("record_json")})


def tile_url(base: str) -> Column:
    return F.concat(F.lit(f"{base.rstrip('/')}/"), F.substring("tile_qk", 1, 6), F.lit("/"), F.col("tile_qk"), F.lit(".json.gz"))


class BadBox(ValueError):
    """A request's box is malformed, too fine or too large; code says which."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


def parse_box(text: str) -> tuple[float, float, float, float]:
    """xmin,ymin,xmax,ymax on a grid of 0.01 degrees. Fineness is judged by the characters, before the numbers."""
    parts = text.split(",")
    if len(parts) == 4 and any("e" in p.lower() or len(p.strip().partition(".")[2]) > 2 for p in parts):
        raise BadBox("BboxTooPrecise", "coordinates have at most two decimal places")
    try:
        xmin, ymin, xmax, ymax = map(float, parts)
    except ValueError:
        raise BadBox("InvalidBbox", "four numbers are needed: xmin,ymin,xmax,ymax") from None
    if not all(map(math.isfinite, (xmin, ymin, xmax, ymax))):
        raise BadBox("InvalidBbox", "coordinates must be finite")
    if ymin >= ymax or (xmin >= xmax and not (xmin > 0 > xmax)):
        raise BadBox("InvalidBbox", "ymin < ymax and xmin < xmax, but for a box over the antimeridian")
    return xmin, ymin, xmax, ymax


def coverage(tiles: DataFrame, box: tuple[float, float, float, float], most: int = 50, regular: int = 6) -> DataFrame:
    """tile_qk of the tiles that meet the box: regular ones, or where those are over `most`, summary ones.

    tiles: tile_qk, best a table sorted by it: the box becomes a few ranges of keys that the scan prunes by, so a small
    box reads few row groups. What is found there is saved, as one job counts it and the result reads it again. Raises
    BadBox where there are too many and no summary tiles at all.
    """
    near = tiles.filter(qk.in_box(F.col("tile_qk"), box)).select("tile_qk").distinct()
    # Exploding one box works it out once for all comparisons.
    boxed = near.select("tile_qk", F.explode(F.array(qk.envelope(F.col("tile_qk")))).alias("box"))
    found = scratch.saved(boxed.filter(qk.overlaps(F.col("box"), box)).select("tile_qk"))
    fine = F.length("tile_qk") >= regular
    if found.filter(fine).count() <= most:
        return found.filter(fine)
    if tiles.filter(~fine).isEmpty():
        raise BadBox("BboxTooLarge", f"the box meets more than {most} tiles")
    return found.filter(~fine)


def category_counts(places: DataFrame, category: Column) -> DataFrame:
    """category, n: how many places each category has; places without one don't count."""
    return places.groupBy(category.alias("category")).agg(F.count("*").alias("n")).filter("category is not null")


#: The kinds of places that records of a source carry; fixed values.
LOCATION_TYPES = {
    "places": ["community.lexicon.location.geo"],
    "osm": ["community.lexicon.location.geo"],
    "divisions": ["community.lexicon.location.bbox"],
}
ADDRESS = "community.lexicon.location.address"


def extent(tiles: DataFrame, regular: int = 6) -> dict[str, str] | None:
    """Bounds of the regular tiles, or of all where there are none, as text of six decimals; None without tiles."""
    box = tiles.select("tile_qk").distinct().select((F.length("tile_qk") >= regular).alias("regular"), F.explode(F.array(qk.envelope(F.col("tile_qk")))).alias("e"))
    sides = {"north": F.max("e.ymax"), "south": F.min("e.ymin"), "east": F.max("e.xmax"), "west": F.min("e.xmin")}
    found = box.groupBy("regular").agg(*[F.format_string("%.6f", v).alias(k) for k, v in sides.items()]).orderBy(F.desc("regular")).first()
    return found and {k: found[k] for k in sides}


def attribute_keys(records: DataFrame) -> DataFrame:
    """key: every key that stands in the attributes of a record's JSON."""
    return records.select(F.explode(F.json_object_keys(F.get_json_object("record_json", "$.attributes"))).alias("key")).distinct()


def tag_keys(tagged: DataFrame) -> DataFrame:
    """key: every key that stands in a map of tags; a null map has none."""
    tags = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    return tagged.select(F.explode(F.map_keys(tags)).alias("key")).distinct()


def containment_levels(relations: DataFrame) -> DataFrame:
    """level: every level that stands in relations_json."""
    within = F.from_json("relations_json", "within array<struct<level:int>>")["within"]["level"]
    return relations.select(F.explode(within).alias("level")).distinct().filter("level is not null")


def collection(records: DataFrame, relations: DataFrame | None, source: str, about: dict, attribution: str = "") -> dict | None:
    """What describes a published collection, but for its categories; None where it has no tile and so no extent.

    records: tile_qk, rkey, record_json. relations: relations_json. about: collection, source, license, generatedAt.
    Everything that comes to the driver is bounded by the schema: keys, levels, one row of counts.
    """
    sides = extent(records)
    if sides is None:
        return None
    kinds = list(LOCATION_TYPES[source])
    if source == "places" and not records.filter(F.contains("record_json", F.lit(ADDRESS))).isEmpty():
        kinds.append(ADDRESS)
    names = {v: k for k, v in scoring.LEVELS.items()}
    levels = sorted(r.level for r in containment_levels(relations).collect()) if relations is not None else []
    out = about | {"recordCount": records.agg(F.countDistinct("rkey").alias("n")).first().n, "extent": sides, "locationTypes": kinds}
    more = {"attribution": attribution, "containmentLevels": [names[x] for x in levels if x in names], "attributes": sorted(r.key for r in attribute_keys(records).collect())}
    return out | {k: v for k, v in more.items() if v}


def describe(repo: str, collections: dict[str, bool]) -> dict:
    """The collections that are served; the value says whether a description of one is there to link to."""
    link = lambda name: {"metadata": f"https://{repo}/org.atgeo.collection/{name}"}
    return {"did": f"did:web:{repo}", "collections": [{"collection": name, **(link(name) if known else {})} for name, known in collections.items()]}
