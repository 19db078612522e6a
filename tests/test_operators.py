"""Operators on small tables, with invariants and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import geometry
from tilewright.functions import quadkey as qk
from tilewright.operators import containment, covering, export, importers, lookups, parity, tiles


def places(spark, keys, **more):
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "place_id long, qk17 string")


def test_assignment_takes_the_coarsest_tile_that_holds_few_enough(spark):
    rng = random.Random(1)
    keys = ["".join(rng.choice("0123") for _ in range(17)) for _ in range(300)] + ["0" * 17] * 40 + [None, "012", "9" * 17]
    got = {r.place_id: r.tile_qk for r in tiles.assign(places(spark, keys), 20, 2, 9).collect()}
    full = {i: k for i, k in enumerate(keys) if k and len(k) == 17 and set(k) <= set("0123")}
    assert got.keys() == full.keys()
    for i, k in full.items():
        fits = [z for z in range(2, 10) if sum(o.startswith(k[:z]) for o in full.values()) <= 20]
        assert got[i] == k[: fits[0] if fits else 9]


def test_summary_band(spark):
    rows = [(1, "0" * 17, 90, "city"), (2, "1" * 17, 80, "b"), (3, "2" * 17, 80, "c"), (4, "3" * 17, 10, "country"), (5, "3" * 17, None, "x")]
    frame = spark.createDataFrame(rows, "place_id long, qk17 string, importance int, subtype string")
    assert {r.place_id for r in tiles.top(frame, 2).collect()} == {1, 2}
    assert {r.place_id for r in tiles.top(frame, 1, tiles.always_shown(F.col("subtype"))).collect()} == {1, 4}
    assert all(len(r.tile_qk) <= 5 for r in tiles.assign_summary(frame, 3).collect())
    assert tiles.repeated(tiles.bands(tiles.assign(frame), tiles.assign_summary(frame))).count() == 0


def test_lookup_keys_must_be_unique(spark):
    lookup = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 1.0), (None, 2.0)], "k string, v double")
    with pytest.raises(ValueError):
        lookups.require_unique(lookup, "lookup", "k")
    lookups.require_unique(lookup.filter("v = 1"), "lookup", "k")
    assert lookups.one_per_key(lookup, "k", "v").count() == 1


POLYGONS = {
    "star": [[(-60, -50), (50, -40), (70, 60), (5, 10), (-70, 55)]],
    "ring": [[(100, -40), (150, -40), (150, 40), (100, 40)], [(120, -10), (130, -10), (130, 10), (120, 10)]],
}


@pytest.fixture(scope="module")
def boundaries(spark):
    rows = []
    for name, rings in POLYGONS.items():
        shape = [[geometry.open_ring(r) for r in rings]]
        rows.append((name, 10, bytearray(geometry.write(shape)), *map(float, geometry.bounds(shape))))
    return spark.createDataFrame(rows, "boundary_id string, level int, geom binary, xmin double, ymin double, xmax double, ymax double")


def test_covering_invariants(boundaries):
    rows = covering.cover(boundaries, first=2, leaf=4, last=7, capacity=5).collect()
    bit = lambda k, digits: sum(1 << i for i, d in enumerate(reversed(k)) if d in digits)
    box = lambda r: covering.tile_box(bit(r.tile_qk, "13"), bit(r.tile_qk, "23"), len(r.tile_qk))
    for name, rings in POLYGONS.items():
        own = [r for r in rows if r.boundary_id == name]
        shape = [[geometry.open_ring(r) for r in rings]]
        part = lambda r: geometry.box(*box(r)) if r.interior else geometry.clip(geometry.parse(r.geom), *box(r))
        assert np.isclose(sum(geometry.area(part(r)) for r in own), geometry.area(shape))  # nothing lost, nothing twice
        keys = {r.tile_qk for r in own}
        assert len(keys) == len(own) and not any(k[:n] in keys for k in keys for n in range(len(k)))  # no tile in another
        assert all(r.interior or len(r.tile_qk) == 7 or (len(r.tile_qk) >= 4 and r.points == geometry.points(part(r)) <= 5) for r in own)
        assert any(r.interior for r in own)


def test_containment_equals_direct_tests(spark, boundaries):
    rng = random.Random(2)
    spots = [(i, rng.uniform(-180, 180), rng.uniform(-85, 85)) for i in range(1500)] + [(9000, 100.0, 0.0), (9001, 0.0, 0.0), (9002, 120.0, 5.0), (9003, 125.0, 0.0)]
    points = spark.createDataFrame(spots, "place_id long, lon double, lat double").withColumn("qk17", qk.quadkey(F.col("lon"), F.col("lat")))
    cover = covering.cover(boundaries, first=2, leaf=4, last=7, capacity=5)
    matched = containment.matches(points, cover, 2, 7)
    got = {(r.place_id, r.boundary_id) for r in matched.collect()}
    want = {(i, n) for i, x, y in spots for n, rings in POLYGONS.items() if geometry.covers([[geometry.open_ring(r) for r in rings]], x, y)}
    assert got == want and (9000, "ring") in got and (9003, "ring") not in got
    plan = matched._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in matched._jdf.queryExecution().executedPlan().toString().split("BroadcastNestedLoopJoin BuildRight, Inner")[0]


def test_boxes_and_polygons_cover_alike(spark):
    shape = geometry.box(-30, -20, 45, 33)
    frame = spark.createDataFrame([("b", 10, bytearray(geometry.write(shape)), -30.0, -20.0, 45.0, 33.0)], "boundary_id string, level int, geom binary, xmin double, ymin double, xmax double, ymax double")
    one = {(r.tile_qk, r.interior) for r in covering.cover(frame, 1, 6, 6).collect()}
    two = {(r.tile_qk, r.interior) for r in covering.cover_boxes(frame, 1, 6).collect()}
    assert one == two


def test_osm_import(spark):
    nodes = spark.createDataFrame(
        [(1, {"name": "Cafe", "amenity": "cafe", "alt_name": "Koffee"}, 10.0, 20.0), (2, {}, 10.0, 22.0), (3, {"amenity": "bench", "name": "B"}, 1.0, 1.0), (4, {"name": "Lost", "shop": "x"}, None, None), (5, {"name": "Park", "leisure": "park"}, 10.5, 21.0)],
        "id long, tags map<string,string>, lat double, lon double",
    )
    ways = spark.createDataFrame([(7, {"name": "Hall", "building": "hall"}, [(1,), (2,), (1,)]), (8, {"name": "House", "building": "house"}, [(1,)])], "id long, tags map<string,string>, nds array<struct<ref:long>>")
    relations = spark.createDataFrame(
        [(20, {"name": " Hall ", "building": "hall"}, [("way", 7, "outer")]), (21, {"name": "Park", "leisure": "park"}, [("node", 1, ""), ("node", 5, ""), ("node", 2, "")]), (22, {"name": "Zoo", "tourism": "zoo"}, [("way", 7, ""), ("way", 7, "inner"), ("node", 2, "")]), (23, {"name": "Nested", "tourism": "zoo"}, [("relation", 22, "")])],
        "id long, tags map<string,string>, members array<struct<type:string,ref:long,role:string>>",
    )
    got = {r.rkey: r for r in importers.import_osm(nodes, ways, relations).collect()}
    assert got.keys() == {"n1", "n5", "w7", "r22"}
    assert np.isclose(got["w7"].longitude, (20 + 22 + 20) / 3) and np.isclose(got["r22"].longitude, (20 + 22 + 20 + 22) / 4)
    assert [v.name for v in got["n1"].variants] == ["Koffee"] and got["n1"].tags == {"alt_name": "Koffee"}
    frame = importers.import_osm(nodes, ways, relations).withColumn("relations_json", F.lit(None).cast("string"))
    record = frame.filter("rkey = 'n1'").select(export.osm_record().alias("j")).first().j
    assert record == '{"$type":"org.atgeo.place","rkey":"node:1","name":"Cafe","importance":0,"locations":[{"$type":"community.lexicon.location.geo","latitude":"10.000000","longitude":"20.000000"}],"variants":[{"name":"Koffee","type":"alternate"}],"attributes":{"alt_name":"Koffee","amenity":"cafe"},"relations":{}}'


NAMES = "struct<primary:string,common:map<string,string>,rules:array<struct<language:string,value:string,variant:string>>>"
BOX = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"


def test_place_import_and_record(spark):
    kind = f"id string, bbox {BOX}, geometry binary, names {NAMES}, categories struct<primary:string>, addresses array<struct<country:string,postcode:string,locality:string,freeform:string,region:string>>, websites array<string>, confidence double, version int"
    rows = [
        ("p1", (1.0, 2.0, 1.0, 2.0), b"g", ("Bar", {"fr": "Barre"}, [("en", "B", "short")]), ("bar",), [("US", None, "SF", None, "US-CA"), (None, None, "no", None, None)], None, 0.98765, 3),
        ("p2", (1.0, 2.0, 1.0, 2.0), None, ("No geometry", None, None), ("bar",), None, None, None, 1),
        ("p3", (1.0, 2.0, 1.0, 2.0), b"g", ("  ", None, None), ("bar",), None, None, None, 1),
    ]
    out = importers.import_places(spark.createDataFrame(rows, kind))
    assert [r.id for r in out.collect()] == ["p1"] and "geometry" not in out.columns
    record = out.withColumn("relations_json", F.lit('{"within":[]}')).select(export.place_record(dict(out.dtypes)).alias("j")).first().j
    assert '{"$type":"community.lexicon.location.address","country":"US","region":"CA","locality":"SF"}]' in record
    assert '"variants":[{"name":"B","type":"short","language":"en"},{"name":"Barre","type":"alternate","language":"fr"}]' in record
    assert '"confidence":"0.988","version":3}' in record and '"websites"' not in record and record.endswith('"relations":{"within":[]}}')


def test_division_import(spark):
    area = lambda x: bytearray(geometry.write(geometry.box(x, 0, x + 2, 2)))
    divisions = spark.createDataFrame([("d1", ("Town", None, None), "locality", "US", None, None, -5, None), ("d2", ("No land", None, None), "region", "US", None, None, 10, None)], f"id string, names {NAMES}, subtype string, country string, region string, wikidata string, population long, parent_division_id string")
    areas = spark.createDataFrame([("d1", True, area(0), (0.0, 0.0, 2.0, 2.0)), ("d1", True, area(4), (4.0, 0.0, 6.0, 2.0)), ("d1", False, area(40), (40.0, 0.0, 42.0, 2.0)), ("d2", True, None, None)], f"division_id string, is_land boolean, geometry binary, bbox {BOX}")
    rows = importers.import_divisions(divisions, areas).collect()
    assert [(r.id, r.level, r.population, r.xmin, r.xmax, r.importance) for r in rows] == [("d1", 50, 0, 0.0, 6.0, 0)]
    assert geometry.covers(geometry.parse(rows[0].geom), rows[0].interior_lon, rows[0].interior_lat)
    with pytest.raises(ValueError):
        importers.import_divisions(divisions.withColumn("subtype", F.lit("odd")), areas)


def test_parity(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert sorted(map(tuple, parity.differences(a, b).collect())) == [("left", 1), ("left", 2), ("right", 3)]


def bounded(spark, shapes):
    rows = [(name, 10, bytearray(geometry.write(shape)), *map(float, geometry.bounds(shape))) for name, shape in shapes.items()]
    return spark.createDataFrame(rows, "boundary_id string, level int, geom binary, xmin double, ymin double, xmax double, ymax double")


def test_points_on_tile_borders_and_overlapping_parts(spark):
    """A C open to the west, whose arms clipping joins along a tile's border, and two equal parts that fill no tile."""
    c = geometry.parse(geometry.write([[np.array([(-30.0, 0.0), (60.0, 0.0), (60.0, 60.0), (-30.0, 60.0), (-30.0, 40.0), (40.0, 40.0), (40.0, 20.0), (-30.0, 20.0)])]]))
    part = geometry.box(90, 0, 144, 66)
    two = geometry.merge([part, part, geometry.box(90, 0, 100, 66)])
    assert not geometry.fills(geometry.clip(two, 90, 0, 180, 66), 90, 0, 180, 66)
    lines = [-22.5, 0.0, 22.5, 45.0, 90.0, 135.0, 157.5]  # borders of tiles
    spots = [(x, y) for x in [*lines, -30.0, 12.3, 40.0, 60.0, 144.0] for y in (0.0, 10.0, 20.0, 30.0, 40.0, 40.97989806962013, 50.0, 60.0, 65.9, 70.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "place_id long, lon double, lat double").withColumn("qk17", qk.quadkey(F.col("lon"), F.col("lat")))
    cover = covering.cover(bounded(spark, {"c": c, "two": two}), first=1, leaf=2, last=5, capacity=4)
    got = {(r.place_id, r.boundary_id) for r in containment.matches(points, cover, 1, 5, most=7).collect()}
    want = {(i, n) for i, (x, y) in enumerate(spots) for n, shape in (("c", c), ("two", two)) if geometry.covers(shape, x, y)}
    # Tiles own their western and southern borders alone, so a point on a boundary's far edge may lie in none of its tiles.
    edge = {(i, n) for i, n in want if (n == "c" and spots[i][1] == 0.0) or (n == "two" and spots[i][1] == 0.0)}
    assert got - want == set() and want - got <= edge and (lines.index(0.0) * 10 + 3, "c") not in got


def test_covering_stats(spark, boundaries):
    cover = covering.cover(boundaries, first=2, leaf=4, last=7, capacity=5)
    got = {r.zoom: r.tiles for r in covering.stats(cover, 7, 5).collect()}
    assert sum(got.values()) == cover.count() and set(got) <= set(range(2, 8))
    assert covering.stats(cover, 7, 3).filter("over_capacity > 0").count() == 1


def test_ranges_of_a_prefix_reach_the_scan(spark, tmp_path):
    places(spark, ["0" * 17, "01" + "2" * 15, "01" + "3" * 15, "02" + "0" * 15]).write.parquet(f"{tmp_path}/p")
    found = spark.read.parquet(f"{tmp_path}/p").filter(qk.within(F.col("qk17"), "01"))
    assert {r.place_id for r in found.collect()} == {1, 2}
    assert "GreaterThanOrEqual(qk17" in found._jdf.queryExecution().executedPlan().toString()
