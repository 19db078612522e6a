"""Column expressions against expected values and against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tilewright.functions import geometry, osm_rules, scoring
from tilewright.functions import json_text as js
from tilewright.functions import quadkey as qk
from tilewright.operators import covering, export, importers


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_quadkey_of_known_points_and_edges(spark):
    f = lambda lon, lat: one(spark, qk.quadkey(F.lit(float(lon)), F.lit(float(lat))))
    assert f(-0.001, 0.001)[0] == "0" and f(0.001, 0.001)[0] == "1" and f(-0.001, -0.001)[0] == "2" and f(0.001, -0.001)[0] == "3"
    assert f(180, 89) == "1" * 17 and f(-180, -89) == "2" * 17 and f(-180, 89) == "0" * 17 and f(180, -89) == "3" * 17
    assert f(180.001, 0) is None and f(0, 90.001) is None and f(0, 90) is not None
    assert one(spark, qk.quadkey(F.lit(None).cast("double"), F.lit(1.0))) is None


def test_envelopes_agree_with_the_kernel(spark):
    rng = random.Random(42)
    keys = ["".join(rng.choice("0123") for _ in range(rng.randrange(1, 18))) for _ in range(2000)]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", qk.envelope(F.col("k")).alias("e"), qk.tile_x(F.col("k")).alias("x"), qk.tile_y(F.col("k")).alias("y")).collect()
    for r in rows:
        assert covering.quadkey_of(r.x, r.y, len(r.k)) == r.k
        assert max(abs(a - b) for a, b in zip(r.e, covering.tile_box(r.x, r.y, len(r.k)))) < 1e-9
    assert [round(v, 6) for v in one(spark, qk.envelope(F.lit("0")))] == [-180, 0, 0, 90]


@pytest.mark.parametrize(
    "a, b, want",
    [((0, 0, 1, 1), (1, 1, 2, 2), True), ((0, 0, 1, 1), (1.1, 0, 2, 1), False), ((170, 0, -170, 1), (175, 0, 179, 1), True), ((170, 0, -170, 1), (-160, 0, 160, 1), False), ((0, 0, 1, 1), (170, 0, -170, 1), False), ((-175, 0, -172, 1), (170, 0, -170, 1), True), ((170, 0, -170, 1), (160, 0, -160, 1), True), ((170, 0, -170, 1), (160, 2, -160, 3), False)],
)
def test_boxes_over_the_antimeridian(spark, a, b, want):
    box = F.struct(*[F.lit(float(v)).alias(n) for v, n in zip(a, ("xmin", "ymin", "xmax", "ymax"))])
    assert one(spark, qk.overlaps(box, b)) is want


def tags(**values):
    return F.create_map(*[F.lit(x) for k, v in values.items() for x in (k.replace("__", ":"), v)])


@pytest.mark.parametrize(
    "values, node, way",
    [
        ({"amenity": "cafe"}, True, True), ({"amenity": "bench"}, False, False), ({"amenity": "bench", "shop": "bakery"}, True, True),
        ({"shop": "vacant"}, False, False), ({"tourism": "hotel"}, True, True), ({"leisure": "park"}, True, True), ({"leisure": "track"}, False, False),
        ({"office": "yes"}, False, False), ({"building": "hotel"}, False, True), ({"building": "house"}, False, False), ({"public_transport": "station"}, True, True),
    ],
)
def test_whitelist(spark, values, node, way):
    full = tags(name="X", **values)
    assert one(spark, osm_rules.qualifies(full)) is node and one(spark, osm_rules.qualifies(full, True)) is way
    assert one(spark, osm_rules.qualifies(tags(name=" ", **values), True)) is False
    assert one(spark, osm_rules.qualifies(tags(**values), True)) is False


def test_category_and_kept_tags(spark):
    t = tags(name="X", amenity="bench", shop="bakery", cuisine="thai", ref="1", name__fr="Y")
    assert one(spark, osm_rules.category(t)) == "amenity=bench"
    assert one(spark, osm_rules.kept_tags(t, F.lit("amenity=bench"))) == {"cuisine": "thai", "name:fr": "Y"}


def test_variants(spark):
    t = tags(name="Main", alt_name="Foo; Bar;;Main", name__fr="Rue", name__etymology="no", name__abbr="Mn", **{"name__-1990": "Old", "old_name__de": "Alt", "int_name__en": "no", "name__prefix:ru": "no"})
    got = [(v.name, v.type, v.language) for v in one(spark, osm_rules.osm_variants(t, F.lit("Main")))]
    assert got == [("Alt", "historical", "de"), ("Bar", "alternate", None), ("Foo", "alternate", None), ("Mn", "short", None), ("Old", "historical", None), ("Rue", "alternate", "fr")]


def test_scores(spark):
    assert one(spark, scoring.place_importance(F.lit(5.0), F.lit(9.0))) == 50
    assert one(spark, scoring.place_importance(F.lit(None).cast("double"), F.lit(99.0))) == 40
    assert one(spark, scoring.population(F.lit(-5))) == 0
    assert one(spark, scoring.division_importance(F.lit("locality"), F.lit(10.0), F.lit(0))) == 60
    assert one(spark, scoring.level(F.lit("region"))) == 25 and one(spark, scoring.level(F.lit("nowhere"))) is None
    with pytest.raises(ValueError):
        scoring.place_importance(F.lit(1.0), F.lit(1.0), 0)


def test_json_drops_nulls_at_the_top_only(spark):
    nested = F.struct(F.lit(None).cast("int").alias("a"), F.lit(1).alias("b"))
    got = one(spark, js.shallow_object({"x": (F.lit(None).cast("string"), "string"), "n": (nested, "struct<a:int,b:int>"), "q": (F.lit('a"\nb'), "string")}))
    assert got == '{"n":{"a":null,"b":1},"q":"a\\"\\nb"}'


STAR = [[(0, 0), (10, 0), (10, 10), (5, 4), (0, 10)]]


def test_kernel(spark):
    shape = [[geometry.open_ring(r) for r in STAR]]
    assert geometry.area(shape) == 70 and geometry.parse(geometry.write(shape))[0][0].tolist() == [list(map(float, p)) for p in STAR[0]]
    assert geometry.covers(shape, 5, 4) and geometry.covers(shape, 0, 5) and not geometry.covers(shape, 5, 5) and geometry.covers(shape, 1, 8)
    x, y = geometry.interior_point(shape)
    assert geometry.covers(shape, x, y)
    parts = [geometry.clip(shape, i, j, i + 2.5, j + 2.5) for i in (0, 2.5, 5, 7.5) for j in (0, 2.5, 5, 7.5)]
    assert math.isclose(sum(map(geometry.area, parts)), 70) and geometry.fills(parts[0], 0, 0, 2.5, 2.5)
    ring = [[geometry.open_ring([(0, 0), (9, 0), (9, 9), (0, 9)]), geometry.open_ring([(3, 3), (6, 3), (6, 6), (3, 6)])]]
    assert geometry.area(ring) == 72 and not geometry.covers(ring, 4, 4) and geometry.covers(ring, 3, 4)
    assert geometry.covers(ring, *geometry.interior_point(ring))
    many = geometry.merge([shape, ring])
    assert len(geometry.parse(geometry.write(many))) == 2


@pytest.mark.parametrize("text, code", [("1,2,3", "InvalidBbox"), ("1e2,0,1,1", "BboxTooPrecise"), ("37.770,0,38,1", "BboxTooPrecise"), ("a,0,1,1", "InvalidBbox"), ("0,1,1,0", "InvalidBbox"), ("2,0,1,1", "InvalidBbox"), ("nan,0,1,1", "InvalidBbox")])
def test_refused_boxes(text, code):
    with pytest.raises(export.BadBox) as e:
        export.parse_box(text)
    assert e.value.code == code


def test_box_over_the_antimeridian_is_fine():
    assert export.parse_box("170.5,-1,-170.25,1") == (170.5, -1, -170.25, 1)


def test_scan_filters_are_pushed(spark, tmp_path):
    rows = [("a", (0.0, 0.0, 1.0, 1.0), b"x")]
    frame = spark.createDataFrame(rows, "id string, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>, geometry binary")
    frame.write.parquet(str(tmp_path / "p"))
    found = spark.read.parquet(str(tmp_path / "p")).filter(importers.meets_box(F.col("bbox"), (0, 0, 1, 1))).select("id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(bbox.xmax)" in plan and "geometry" not in plan.split("ReadSchema")[1]
