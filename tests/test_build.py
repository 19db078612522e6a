"""Sources, sinks, freshness and a whole build on small tables."""

import dataclasses
import gzip
import json
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import geometry
from tilewright.functions import quadkey as qk
from tilewright.operators import export
from tilewright.plans import build, queries
from tilewright.sources import scans, sinks
from tilewright.sources.hadoop import Files
from tilewright.streaming import density

from .test_operators import BOX, NAMES

SF = "/root/testdata/sf0.001"


def test_scans(spark, tmp_path):
    for release in ("2024-01", "2024-02", "2024-03"):
        spark.range(3).write.parquet(f"{tmp_path}/{release}/a")
        if release != "2024-03":
            spark.range(2).write.parquet(f"{tmp_path}/{release}/b")
    one, two = scans.newest_release(spark, f"{tmp_path}/*/a", f"{tmp_path}/*/b")
    assert "2024-02" in one and scans.scan(spark, one).count() == 3 and scans.scan(spark, [one, two]).count() == 5
    with pytest.raises(FileNotFoundError):
        scans.scan(spark, f"{tmp_path}/none/*")
    assert scans.scan(spark, f"{tmp_path}/none/*", "id long", required=False).count() == 0
    with pytest.raises(RuntimeError):
        scans.newest_release(spark, f"{tmp_path}/*/c")


def test_freshness(spark, tmp_path):
    source, path = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.range(5).write.parquet(source)
    os.utime(source, (1, 1))
    for name in os.listdir(source):
        os.utime(f"{source}/{name}", (1, 1))
    fresh = lambda **p: sinks.is_fresh(spark, path, [source], p)
    assert not fresh()
    sinks.build_artifact(spark.read.parquet(source), path, [source], {}, "id")
    assert fresh() and not fresh(n=1)
    Files(spark).write_text(f"{path}.meta.json", "{broken")
    assert not fresh()
    sinks.build_artifact(spark.read.parquet(source), path, [source], {}, "id")
    later = os.stat(f"{path}.meta.json").st_mtime + 10
    os.utime(f"{source}/_SUCCESS", (later, later))
    assert not fresh()
    assert spark.read.parquet(path).count() == 5 and not Files(spark).exists(f"{path}.old")


def test_tiles_and_manifest(spark, tmp_path):
    rows = [("012301", "b", "b", '{"rkey":"b"}'), ("012301", "a", "a", '{"rkey":"a"}'), ("0123012", "c", "c", '{"rkey":"c"}')]
    records = spark.createDataFrame(rows, "tile_qk string, place_id string, rkey string, record_json string")
    head = sinks.Head("things", "src", "lic", "now", "repo.example")
    written = sinks.publish(records, f"{tmp_path}/pub", head)
    assert {(r.tile_qk, r.n) for r in written.collect()} == {("012301", 2), ("0123012", 1)}
    path = f"{tmp_path}/pub/012301/012301.json.gz"
    first = open(path, "rb").read()
    sinks.publish(records, f"{tmp_path}/pub", head)
    assert open(path, "rb").read() == first and sorted(os.listdir(f"{tmp_path}/pub/012301")) == ["012301.json.gz", "0123012.json.gz"]
    got = json.loads(gzip.decompress(first))
    assert list(got) == ["collection", "source", "license", "generated_at", "records"]
    assert [r["value"]["rkey"] for r in got["records"]] == ["a", "b"] and got["records"][0]["uri"] == "https://repo.example/things/a" and got["records"][0]["cid"] is None
    sinks.write_by_prefix(records, f"{tmp_path}/records", "tile_qk", 4, "place_id")
    back = scans.text_keys(spark, f"{tmp_path}/records")
    assert {r.tile_qk4 for r in back.collect()} == {"0123"}
    for run in ("run1", "run2", "run3"):
        sinks.write_manifest(records, f"{tmp_path}/runs/{run}", {"run": run})
    os.makedirs(f"{tmp_path}/runs/run4")
    assert sinks.retain(spark, f"{tmp_path}/runs") == ["run2", "run3"] and Files(spark).names(f"{tmp_path}/runs") == ["run2", "run3"]
    manifest = spark.read.parquet(f"{tmp_path}/runs/run3/record_tiles")
    assert sinks.find_record(manifest, records, "c") == '{"rkey":"c"}' and sinks.find_record(manifest, records, "zz") is None


@pytest.mark.parametrize("files", ["", "/*.parquet"])
def test_whole_build(spark, tmp_path, files):
    shape = lambda *box: bytearray(geometry.write(geometry.box(*box)))
    spark.createDataFrame(
        [(f"p{i}", (float(i), 1.0, float(i), 1.0), b"g", (f"Place {i}", None, None), ("bar" if i % 2 else "inn",), None) for i in range(30)],
        f"id string, bbox {BOX}, geometry binary, names {NAMES}, categories struct<primary:string>, addresses array<struct<country:string,postcode:string,locality:string,freeform:string,region:string>>",
    ).write.parquet(f"{tmp_path}/places")
    chain = "array<array<struct<division_id:string>>>"
    spark.createDataFrame(
        [("c", ("Country", None, None), "country", "US", None, None, 100, None, [[("c",)]]), ("r", ("Region", None, None), "region", "US", None, None, 10, "c", [[("c",), ("r",)]])],
        f"id string, names {NAMES}, subtype string, country string, region string, wikidata string, population long, parent_division_id string, hierarchies {chain}",
    ).write.parquet(f"{tmp_path}/divisions")
    # The country comes in two overlapping parts and one that has no inside; "gone" has nothing else.
    flat = bytearray(geometry.write([[np.array([(0, 0), (5, 5), (9, 9)], float)]]))
    areas = [("c", True, shape(0, 0, 12, 10), (0.0, 0.0, 12.0, 10.0)), ("c", True, shape(8, 0, 20, 10), (8.0, 0.0, 20.0, 10.0)), ("c", True, flat, (0.0, 0.0, 9.0, 9.0)), ("gone", True, flat, (0.0, 0.0, 9.0, 9.0))]
    spark.createDataFrame([*areas, ("r", True, shape(0, 0, 10, 10), (0.0, 0.0, 10.0, 10.0))], f"division_id string, is_land boolean, geometry binary, bbox {BOX}").write.parquet(f"{tmp_path}/areas")
    config = build.Config(f"{tmp_path}/out", {n: f"{tmp_path}/{n}{files}" for n in ("places", "divisions", "areas")}, most=5, summary=10, names={"divisions": "org.divisions"})
    made = build.Build(spark, config)
    out = made.run("places")
    records = scans.text_keys(spark, f"{tmp_path}/out/places_records")
    one = {r.place_id: json.loads(r.record_json) for r in records.collect()}
    assert len(one) == 30
    within = lambda i: [w["rkey"] for w in one[f"p{i}"]["relations"].get("within", [])]
    assert within(5) == ["org.divisions:c", "org.divisions:r"] and within(15) == ["org.divisions:c"] and within(25) == []
    manifest = json.loads(Files(spark).read_text(f"{out}/manifest.json"))
    files = [f for _, _, names in os.walk(out) for f in names if f.endswith(".json.gz")]
    assert manifest["tiles"] == len(files) > 1 and manifest["records"] == records.count()
    about = json.loads(Files(spark).read_text(f"{out}/collection.json"))
    assert about["recordCount"] == 30 and about["containmentLevels"] == ["country", "region"] and about["locationTypes"] == ["community.lexicon.location.geo"]
    assert about["categories"] == [{"value": "bar", "count": 15}, {"value": "inn", "count": 15}] and {"id", "names", "categories"} <= set(about["attributes"])
    assert float(about["extent"]["west"]) <= 0 <= 29 <= float(about["extent"]["east"]) < 45
    assert os.readlink(f"{tmp_path}/out/tiles/places/current") == made.when
    found = sinks.get_record(spark, f"{tmp_path}/out/tiles/places/current", "p7")
    assert found["uri"] == "https://places.example/places/p7" and found["importance"] >= 0 and found["value"]["name"] == "Place 7" and "importance" not in found["value"]
    assert sinks.get_record(spark, out, "none") is None and sinks.read_tile(spark, out, "333333") is None
    assert about["license"].startswith("https://") and about["attribution"]
    first = ["density", "idf", "places", "places_assignments", "shapes", "divisions", "covering", "places_containment", "places_records", "tiles/places"]
    assert made.made == first
    run = made.run("divisions")
    assert made.made == [*first, "divisions_assignments", "divisions_containment", "divisions_records", "tiles/divisions"]
    about = json.loads(Files(spark).read_text(f"{run}/manifest.json"))
    assert (about["unusable_areas"], about["divisions_without_area"]) == (2, 1)
    country = spark.read.parquet(f"{tmp_path}/out/divisions").filter("id = 'c'").first()
    assert geometry.area(geometry.parse(country.geom)) == 200 and len(geometry.parse(country.geom)) == 1
    again = build.Build(spark, dataclasses.replace(config, generated_at="99990101T000000Z"))
    assert again.run("places") == out and again.run("divisions") == run and again.made == []
    extra = spark.read.parquet(f"{tmp_path}/places").filter("id = 'p1'").selectExpr("'more' as id", "* except (id)")
    extra.write.mode("append").parquet(f"{tmp_path}/places")
    third = build.Build(spark, dataclasses.replace(config, generated_at="99990101T000000Z"))
    assert third.run("places") != out and "shapes" not in third.made and {"density", "places", "tiles/places"} <= set(third.made)
    assert sinks.get_record(spark, f"{tmp_path}/out/tiles/places/current", "more") is not None
    divisions = scans.text_keys(spark, f"{tmp_path}/out/divisions_records").collect()
    assert {r.place_id for r in divisions} == {"c", "r"} and len(divisions) == len({(r.place_id, r.tile_qk) for r in divisions})
    about = json.loads(Files(spark).read_text(f"{run}/collection.json"))
    assert about["locationTypes"] == ["community.lexicon.location.bbox"] and about["categories"] == [{"value": "country", "count": 1}, {"value": "region", "count": 1}]
    with made.alone():
        with pytest.raises(RuntimeError), made.alone():
            pass
    assert not Files(spark).exists(f"{tmp_path}/out/.lock")


def test_newest_release_is_built_from(spark, tmp_path):
    for release in ("1", "2"):
        spark.range(1).write.parquet(f"{tmp_path}/{release}/division")
        spark.range(1).write.parquet(f"{tmp_path}/{release}/area")
    config = build.Config("x", {"divisions": f"{tmp_path}/*/division", "areas": f"{tmp_path}/*/area", "osm": f"{tmp_path}/osm"})
    got = build.Build(spark, config).config.inputs
    assert got["areas"].endswith("/2/area") and got["divisions"].endswith("/2/division") and got["ways"].endswith("osm/type=way")


def test_description_of_nothing_and_of_summary_tiles(spark):
    records = spark.createDataFrame([("01", "a", '{"attributes":{"x":1,"y":null}}'), ("01", "b", '{"attributes":{"z":1}}')], "tile_qk string, rkey string, record_json string")
    about = export.collection(records, None, "osm", {"collection": "c"})
    assert about["extent"] == {"north": "85.051129", "south": "66.513260", "east": "0.000000", "west": "-90.000000"} or about["extent"]["east"] == "0.000000"
    assert about["attributes"] == ["x", "y", "z"] and about["recordCount"] == 2 and "containmentLevels" not in about
    assert export.collection(records.limit(0), None, "osm", {}) is None
    assert export.describe("r", {"a": True, "b": False}) == {"did": "did:web:r", "collections": [{"collection": "a", "metadata": "https://r/org.atgeo.collection/a"}, {"collection": "b"}]}


def test_sql_takes_the_parameters_that_it_names(spark):
    assert scans.execute(spark, "select :a + 1 as x, ':b' as y, cast('1' as int) z", {"a": 1, "b": 2}).first().x == 2


def test_density_of_a_stream(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", 1.0, 1.0), ("2024-01-01 00:20:00", 1.0, 1.0), ("2024-01-01 05:00:00", 1.0, 1.0), ("2024-01-01 09:00:00", 50.0, 1.0)]
    frame = spark.createDataFrame(rows, "t string, lon double, lat double").selectExpr("to_timestamp(t) ts", "lon", "lat")
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    query = density.tile_counts(stream, F.col("lon"), F.col("lat"), "ts").writeStream.outputMode("append").format("memory").queryName("counts").option("checkpointLocation", f"{tmp_path}/ck").start()
    query.processAllAvailable()
    query.stop()
    got = {(str(r.start), r.n) for r in spark.table("counts").collect()}
    assert ("2024-01-01 00:00:00", 2) in got
    assert len(density.tile_counts(frame, F.col("lon"), F.col("lat"), "ts").collect()) == 3
    assert len(spark.table("counts").first().tile_qk) == 9 and qk.ZOOM == 17


def test_sources_have_their_own_licences():
    one = build.Build.about
    of = lambda tiles: (lambda s: one(type("B", (), {"config": build.Config("o", {}, tiles=tiles)})(), s))
    assert of({})("osm") == build.ABOUT["osm"] and of({"source": "s", "license": "l"})("osm") == {"source": "s", "license": "l", "attribution": build.ABOUT["osm"]["attribution"]}
    assert of({"osm": {"license": "mine"}})("osm")["license"] == "mine" and of({"osm": {"license": "mine"}})("places") == build.ABOUT["places"]


def test_config_from_json_and_yaml(tmp_path, monkeypatch):
    fields = {"output": "o", "inputs": {"places": "p/*.parquet"}, "most": 7}
    (tmp_path / "c.json").write_text(json.dumps(fields))
    assert build.load(f"{tmp_path}/c.json") == build.Config("o", {"places": "p/*.parquet"}, most=7)
    # JSON is YAML; any reader with safe_load will do.
    monkeypatch.setitem(sys.modules, "yaml", type(sys)("yaml"))
    sys.modules["yaml"].safe_load = json.loads
    (tmp_path / "c.yaml").write_text(json.dumps(fields))
    assert build.load(f"{tmp_path}/c.yaml") == build.load(f"{tmp_path}/c.json")


def test_categories_run_into_the_description(spark, tmp_path):
    counts = spark.range(3000).selectExpr("concat('k\"', id) as category", "id + 1 as n")
    sinks.write_counts(counts, f"{tmp_path}/counts")
    sinks.write_described(spark, f"{tmp_path}/c.json", {"collection": "c"}, counts, f"{tmp_path}/counts")
    got = json.loads((tmp_path / "c.json").read_text())
    assert got["collection"] == "c" and len(got["categories"]) == 3000 and got["categories"][0] == {"value": 'k"2999', "count": 3000}
    sinks.write_described(spark, f"{tmp_path}/d.json", {"collection": "c"}, None, "")
    assert json.loads((tmp_path / "d.json").read_text()) == {"collection": "c"}


def test_every_category_is_counted(spark, tmp_path):
    places = spark.range(4000).selectExpr("id", "case when id % 4 < 3 then concat('k=', id % 1999) end category")
    sinks.write_counts(export.category_counts(places, F.col("category")), f"{tmp_path}/categories")
    want = {r.category: r.n for r in places.filter("category is not null").groupBy("category").agg(F.count("*").alias("n")).collect()}
    got = spark.read.json(f"{tmp_path}/categories").collect()
    assert {r.category: r.n for r in got} == want and len(got) == len(want) > 1000
    rows = queries.tile_assignment(spark, SF).join(queries.scored(spark, SF).select("place_id", "category"), "place_id")
    plain = rows.filter("category is not null").groupBy("category").agg(F.countDistinct("place_id").alias("n"), F.countDistinct("tile_qk").alias("n_tiles"))
    assert sorted(map(tuple, queries.collection_stats(spark, SF).collect())) == sorted(map(tuple, plain.collect()))
