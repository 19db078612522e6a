"""Published runs: the data source, what only changed folders cost, and parity."""

import itertools
import json
import os
import random
import shutil
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tilewright.functions import quadkey as qk
from tilewright.operators import export, importers, lookups, parity, tiles
from tilewright.sources import scans, scratch, sinks, tile_files, tile_source
from tilewright.streaming import tiles as tiles_stream

HEAD = sinks.Head("things", "src", "lic", "t1", "repo.example")
SCHEMA = "tile_qk string, place_id string, rkey string, record_json string"


def record(key, name="x"):
    return json.dumps({"rkey": key, "name": name, "z": {"b": 1, "a": ["ü", None]}}, ensure_ascii=False, separators=(",", ":"))


ROWS = [(tile, f"p{k}", f"p{k}", record(f"p{k}")) for k in range(40) for tile in (("0123012", "012301", "012302", "31", "3102223")[k % 5],)]


@pytest.fixture
def run(spark, tmp_path):
    sinks.publish_changed(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/run", HEAD, None)
    sinks.write_manifest(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/run", {"collection": "things", "generated_at": "t1", "tiles": 5})
    tile_source.register(spark)
    return f"{tmp_path}/run"


def test_a_run_as_a_table(spark, run):
    got = spark.read.format("tiles").load(run)
    assert sorted((r.tile_qk, r.rkey, r.value) for r in got.collect()) == sorted((t, k, v) for t, _, k, v in ROWS)
    one = got.first()
    assert (one.collection, one.source, one.license, one.generated_at) == ("things", "src", "lic", "t1") and one.prefix == one.tile_qk[:6] and one.uri == f"https://repo.example/things/{one.rkey}"


def test_filters_choose_files_before_they_are_opened(spark, run):
    """All files but those asked for are spoilt: reading one would fail."""
    whole = spark.read.format("tiles").load(run)
    for tile in ("012302", "310222/3102223", "012301/0123012"):
        path = f"{run}/{tile if '/' in tile else tile + '/' + tile}.json.gz"
        open(path, "wb").write(b"spoilt")
    with pytest.raises(Exception):
        whole.count()
    read = lambda: spark.read.format("tiles").load(run)
    assert read().filter("prefix = '31'").count() == 8
    assert read().filter("tile_qk = '012301'").count() == 8
    assert read().filter(F.col("tile_qk").isin("012301", "31", "none")).count() == 16
    assert read().filter("tile_qk >= '30' and tile_qk <= '31'").count() == 8
    assert read().filter("tile_qk like '2%'").count() == 0
    assert read().filter("prefix = '31' and rkey = 'p3'").count() == 1
    assert spark.read.format("tiles").option("ranges", "012301-012301,31-31").load(run).count() == 16
    assert read().filter("prefix = '31'").rdd.getNumPartitions() == 1


def test_writing_commits_all_or_nothing(spark, tmp_path, run):
    rows = spark.createDataFrame(ROWS, SCHEMA).orderBy("tile_qk", "place_id")
    wrapped = rows.select("tile_qk", F.concat(F.lit('{"uri":"https://repo.example/things/'), "rkey", F.lit('","cid":null,"value":'), "record_json", F.lit("}")).alias("value"))
    options = {"collection": "things", "source": "src", "license": "lic", "generated_at": "t1", "repo": "repo.example"}
    write = lambda frame, mode="append": frame.write.format("tiles").options(**options).mode(mode).save(f"{tmp_path}/out/run2")
    write(wrapped.coalesce(1))
    for tile in {r[0] for r in ROWS}:
        name = f"{tile[:6]}/{tile}.json.gz"
        assert open(f"{tmp_path}/out/run2/{name}", "rb").read() == open(f"{run}/{name}", "rb").read()
    assert json.loads(open(f"{tmp_path}/out/run2/manifest.json").read()) == {"collection": "things", "generated_at": "t1", "tiles": 5, "records": 40}
    with pytest.raises(Exception, match="there already"):
        write(wrapped.coalesce(1))
    with pytest.raises(Exception, match="more than one task"):
        write(wrapped.withColumn("r", F.xxhash64("value")).repartition(4, "r").sortWithinPartitions("tile_qk").drop("r"), "overwrite")
    bad = wrapped.coalesce(1).withColumn("value", F.when(F.col("tile_qk") == "3102223", F.raise_error(F.lit("stop"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="stop"):
        write(bad, "overwrite")
    with pytest.raises(Exception, match="together"):
        write(wrapped.coalesce(1).orderBy(F.get_json_object("value", "$.value.rkey")).coalesce(1), "overwrite")
    assert sorted(os.listdir(f"{tmp_path}/out")) == ["run2"] and spark.read.format("tiles").load(f"{tmp_path}/out/run2").count() == 40
    write(wrapped.coalesce(1).filter("tile_qk = '31'"), "overwrite")
    assert spark.read.format("tiles").load(f"{tmp_path}/out/run2").count() == 8


def test_long_tiles_are_read_in_parts(tmp_path, monkeypatch):
    monkeypatch.setattr(tile_files, "CHUNK", 7)
    out = tile_files.Writer(str(tmp_path), HEAD)
    values = [{"uri": f"u{k}", "cid": None, "value": {"rkey": f"k{k}", "t": 'a"],}{[ü😀' * k}} for k in range(20)]
    assert all(out.add("0123012", json.dumps(v, ensure_ascii=bool(k % 2))) is None for k, v in enumerate(values))
    tile, n, _, digest = out.finish()
    assert (tile, n) == ("0123012", 20) and digest == f"{sum(map(tile_files.record_digest, values)) % (1 << 128):032x}"
    assert [r for _, r in tile_files.read(str(tmp_path), "0123012")] == values
    with pytest.raises(ValueError):
        path = f"{tmp_path}/012301/0123012.json.gz"
        import gzip

        text = gzip.decompress(open(path, "rb").read())
        open(path, "wb").write(gzip.compress(text[:-20]))
        list(tile_files.read(str(tmp_path), "0123012"))


def test_only_changed_folders_are_written(spark, tmp_path, run):
    changed = [r if r[1] != "p3" else (*r[:3], record("p3", "new name")) for r in ROWS]  # p3 is in tile 31
    written, fresh = sinks.publish_changed(spark.createDataFrame(changed, SCHEMA), f"{tmp_path}/next", HEAD, run)
    assert fresh == ["31"] and written.count() == 5
    sinks.publish(spark.createDataFrame(changed, SCHEMA), f"{tmp_path}/full", HEAD)
    for tile in {r[0] for r in ROWS}:
        a, b = (open(f"{tmp_path}/{x}/{tile[:6]}/{tile}.json.gz", "rb").read() for x in ("next", "full"))
        assert a == b
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, spark.read.parquet(f"{tmp_path}/full/tiles").collect()))
    gone = [r for r in ROWS if r[0] != "012302"]
    written, fresh = sinks.publish_changed(spark.createDataFrame(gone, SCHEMA), f"{tmp_path}/third", HEAD, f"{tmp_path}/next")
    assert fresh == ["31"] and written.count() == 4 and not os.path.exists(f"{tmp_path}/third/012302")
    other = sinks.Head("things", "src", "another licence", "t1", "repo.example")
    assert len(sinks.publish_changed(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/fourth", other, run)[1]) == 4


def test_parity_names_every_difference(spark, tmp_path, run):
    assert parity.compare_runs(spark, run, run).count() == 0
    rows = [r for r in ROWS if r[0] != "012302"]  # a tile less
    rows = [(*r[:3], record("p3", "new name")) if r[1] == "p3" else r for r in rows if r[1] != "p8"]  # a value; a record less
    rows += [("3102223", "more", "more", record("more")), ("20", "p1", "p1", record("p1"))]  # a record more; a tile more
    rows = rows[::-1]
    sinks.publish_changed(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/b", sinks.Head("things", "src", "lic", "t2", "repo.example"), None)
    sinks.write_manifest(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/b", {"collection": "things", "generated_at": "t2", "tiles": 5})
    # Another head in one tile, by hand; its digests are worked out again from the tiles.
    other = tile_files.Writer(f"{tmp_path}/b", sinks.Head("things", "src", "other", "t2", "repo.example"))
    for _, r in list(tile_files.read(f"{tmp_path}/b", "012301")):
        other.add("012301", json.dumps(r, ensure_ascii=False, separators=(",", ":")))
    other.finish()
    shutil.rmtree(f"{tmp_path}/b/tiles")
    got = {tuple(r) for r in parity.compare_runs(spark, run, f"{tmp_path}/b").collect()}
    lost = {("manifest row only left", "012302", f"p{k}") for k in range(2, 40, 5)}
    assert got == lost | {
        ("tile only left", "012302", None), ("tile only right", "20", None), ("head differs", "012301", None), ("record differs", "31", "p3"), ("record only left", "31", "p8"),
        ("record only right", "3102223", "more"), ("manifest row only left", "31", "p8"), ("manifest row only right", "3102223", "more"), ("manifest row only right", "20", "p1"),
    }
    assert {k for k, *_ in got} | {"manifest differs"} == set(parity.KINDS)
    sinks.write_json(spark, f"{tmp_path}/b/manifest.json", {"collection": "things", "tiles": 6})
    assert ("manifest differs", None, None) in {tuple(r) for r in parity.compare_runs(spark, run, f"{tmp_path}/b").collect()}


def test_equal_folders_are_not_read(spark, tmp_path, run):
    changed = [r if r[1] != "p3" else (*r[:3], record("p3", "new name")) for r in ROWS]
    sinks.publish_changed(spark.createDataFrame(changed, SCHEMA), f"{tmp_path}/next", HEAD, None)
    sinks.write_manifest(spark.createDataFrame(changed, SCHEMA), f"{tmp_path}/next", {"collection": "things", "tiles": 5})
    for tile in ("012302/012302", "310222/3102223", "012301/0123012"):
        for root in (run, f"{tmp_path}/next"):
            open(f"{root}/{tile}.json.gz", "wb").write(b"spoilt")
    assert [tuple(r) for r in parity.compare_runs(spark, run, f"{tmp_path}/next").collect()] == [("record differs", "31", "p3")]


def read_rows(frame):
    """Rows that the scan of a frame gave, after row groups were left out by their statistics."""
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_a_box_as_ranges(spark, tmp_path):
    rng = random.Random(4)
    tiles = sorted({"".join(rng.choices("0123", k=rng.randint(1, 17))) for _ in range(4000)})
    table = spark.createDataFrame([(t,) for t in tiles], "tile_qk string")
    for _ in range(12):
        x, y = round(rng.uniform(-180, 150), 2), round(rng.uniform(-85, 70), 2)
        w, h = rng.choice([(0.5, 0.5), (30, 15), (90, 5), (0.01, 0.01)])
        for box in ((x, y, x + w, y + h), (179 - w, y, -179.0, y + h)):
            want = {r.tile_qk for r in table.filter(qk.overlaps(qk.envelope(F.col("tile_qk")), box)).collect()}
            for most in (4, 32):
                keys = qk.box_tiles(box, most)
                assert len(keys) <= max(most, 4) and len(qk.box_ranges(box, most)) <= len(keys)
                got = {r.tile_qk for r in table.filter(qk.in_box(F.col("tile_qk"), box, most)).collect()}
                assert want <= got
    assert qk.box_ranges((-180, -90, 180, 90)) == [("0", "3" * 17)] and qk.box_ranges((0.0, 0.1, 10, 10), most=1)


def test_a_small_box_reads_few_row_groups(spark, tmp_path):
    rows = spark.range(60_000).select(qk.quadkey((F.col("id") * 7919 % 3600) / 10 - 180, (F.col("id") * 104729 % 1700) / 10 - 85, 9).alias("tile_qk")).distinct()
    sorted_ = rows.coalesce(1).sortWithinPartitions("tile_qk")
    sorted_.write.option("parquet.block.size", 4096).option("parquet.page.size", 1024).option("parquet.block.size.row.check.min", 10).option("parquet.page.size.row.check.min", 10).option("parquet.enable.dictionary", "false").parquet(f"{tmp_path}/tiles")
    table = spark.read.parquet(f"{tmp_path}/tiles")
    small = table.filter(qk.in_box(F.col("tile_qk"), (10.25, 47.75, 13.5, 50.5)))
    found = small.count(), len(small.collect())
    plan = small._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(" in plan or "Or(Or(" in plan
    assert 0 < found[1] <= read_rows(small) < table.count() / 10
    found_tiles = {r.tile_qk for r in export.coverage(table, (10.25, 47.75, 13.5, 50.5), most=1000).collect()}
    assert found_tiles == {r.tile_qk for r in table.filter(qk.overlaps(qk.envelope(F.col("tile_qk")), (10.25, 47.75, 13.5, 50.5))).collect()}


def test_the_curve_has_no_jumps(spark):
    tiles = [f"{n:0>5}" for n in ("".join(d) for d in itertools.product("0123", repeat=5))]
    rows = spark.createDataFrame([(t,) for t in tiles], "qk string").select("qk", qk.hilbert(F.col("qk")).alias("h"), qk.tile_x(F.col("qk")).alias("x"), qk.tile_y(F.col("qk")).alias("y")).orderBy("h").collect()
    assert len({r.h for r in rows}) == len(tiles) and all(len(r.h) == 5 for r in rows)
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(rows, rows[1:]))
    assert all(a.h[:3] == b.h[:3] for a in rows for b in rows if a.qk[:3] == b.qk[:3])  # the curve of a tile's parent holds it
    assert spark.sql("select '' as qk").select(qk.hilbert(F.col("qk")).alias("h")).first().h == ""


def test_a_box_touches_fewer_files_along_the_curve(spark, tmp_path):
    lon, lat = (F.col("id") * 7919 % 3600) / 10 - 180, (F.col("id") * 104729 % 1700) / 10 - 85
    rows = spark.range(40_000).select(lon.alias("lon"), lat.alias("lat"), qk.quadkey(lon, lat).alias("qk17"))
    sinks.write_sorted(rows, f"{tmp_path}/keys", "qk17", 64)
    sinks.write_along_curve(rows, f"{tmp_path}/curve", "qk17", 9, 64)
    touched = {"keys": 0, "curve": 0}
    for name in touched:
        files = spark.read.parquet(f"{tmp_path}/{name}").groupBy(F.input_file_name()).agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n")).collect()
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == 40_000
        for k in range(40):
            x, y = k * 37 % 340 - 175, k * 23 % 120 - 65
            touched[name] += sum(f.w <= x + 12 and f.e >= x and f.s <= y + 8 and f.n >= y for f in files)
    assert touched["curve"] < touched["keys"]


def test_any_kind_of_record_is_served(spark, tmp_path, run):
    sinks.write_json(spark, f"{run}/collection.json", {"collection": "things", "source": "src", "license": "lic", "recordCount": 40})
    os.makedirs(f"{tmp_path}/schemas")
    for name, text in (("a.json", '{"id":"org.a","lexicon":1}'), ("b.json", "{}"), ("c.txt", "no")):
        open(f"{tmp_path}/schemas/{name}", "w").write(text)
    schemas = scans.schemas(spark, f"{tmp_path}/schemas")
    assert schemas == {"org.a": {"id": "org.a", "lexicon": 1}}
    get = lambda c, k: sinks.serve_record(spark, "repo.example", {"things": run}, schemas, c, k)
    assert get("com.atproto.lexicon.schema", "org.a") == {"uri": "at://did:web:repo.example/com.atproto.lexicon.schema/org.a", "value": schemas["org.a"]}
    found = get("org.atgeo.collection", "things")
    assert (found["uri"], found["source"], found["license"], found["value"]["recordCount"]) == ("https://repo.example/org.atgeo.collection/things", "src", "lic", 40)
    assert get("things", "p7")["value"]["name"] == "x"
    for c, k in (("com.atproto.lexicon.schema", "x"), ("org.atgeo.collection", "x"), ("things", "x"), ("other", "p7")):
        with pytest.raises(KeyError, match="NotFound"):
            get(c, k)


@pytest.mark.parametrize("rows", [7, 10_000])
def test_tiles_over_the_ends_of_batches(spark, rows):
    """Few rows a batch and many partitions: counts of tiles are put together from many pieces."""
    rng = random.Random(rows)
    near = ["".join(rng.choices("0123", [8, 1, 1, 1], k=17)) for _ in range(1500)] + ["0" * 17] * 60
    frame = spark.createDataFrame([(k, q) for k, q in enumerate([*near, None, "0123", "4" * 17])], "place_id long, qk17 string")
    counts = Counter(q[:n] for q in near for n in range(1, 18))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        for most, low, high in ((20, 1, 17), (20, 3, 9), (5000, 2, 4), (1, 1, 17)):
            got = {r.place_id: r.tile_qk for r in tiles.assign(frame, most, low, high).collect()}
            assert got == {k: next((q[:n] for n in range(low, high + 1) if counts[q[:n]] <= most), q[:high]) for k, q in enumerate(near)}
        assert {(r.level, r.qk): r.cnt for r in tiles.cell_counts(frame, 2, 11).collect()} == {(len(q), q): n for q, n in counts.items() if 2 <= len(q) <= 11}
        assert tiles.assign(frame.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_frequent_names_meet_by_place(spark):
    rng = random.Random(8)
    extents = [(k, f"n{k % 3}", *sorted(rng.uniform(-180, 180) for _ in range(2)), *sorted(rng.uniform(-89, 89) for _ in range(2))) for k in range(60)]
    extents += [(100 + k, "n0", x := rng.uniform(-179, 179), x + 0.001 * k, y := rng.uniform(-80, 80), y + 0.002 * k) for k in range(60)] + [(300, "n0", -185.0, 190.0, -89.9, 89.9), (301, "n1", None, None, None, None), (302, "n1", -180.0, -180.0, 90.0, 90.0)]
    places = [(f" n{k % 4} ", rng.uniform(-180, 180), rng.uniform(-90, 90)) for k in range(300)] + [("n0", a, c) for _, _, a, _, c, _ in extents[60:90]] + [("n1", -180.0, 90.0), ("n1", 180.0, -90.0)]
    left = spark.createDataFrame(extents, "osm_id long, trimmed string, ext_xmin double, ext_xmax double, ext_ymin double, ext_ymax double")
    right = spark.createDataFrame(places, "name string, longitude double, latitude double")
    want = {k for k, n, a, b, c, d in extents if a is not None for m, x, y in places if m.strip() == n and a <= x <= b and c <= y <= d}
    assert {r.osm_id for r in importers.holding(left, right).collect()} == want


def test_places_go_to_the_levels_of_their_name(spark):
    places = spark.createDataFrame([(f" n{k % 4}", k - 90.0, k / 4) for k in range(180)] + [("n1", 0.0, 91.0)], "name string, longitude double, latitude double")
    levels = spark.createDataFrame([("n1", 13), ("n1", 2), ("n2", 17), ("n9", 4)], "trimmed string, up int")
    got = Counter((r.trimmed, r.up) for r in importers.leveled(places, levels).collect())
    assert got == {("n1", 13): 45, ("n1", 2): 45, ("n2", 17): 45}


def test_a_pyramid_answers_boxes(spark):
    """The same averages as from all tiles, for boxes of any size, on the borders of tiles and beyond the world's edge;
    a box meets as many tiles as its rim is long."""
    rng = random.Random(6)
    points = spark.createDataFrame([(rng.uniform(-180, 180), rng.uniform(-88, 88)) for _ in range(4000)] + [(0.001 * k, 0.002 * k) for k in range(500)], "lon double, lat double")
    dens = scratch.saved(lookups.density(points, F.col("lon"), F.col("lat")))
    boxes = [(k, x := rng.uniform(-180, 170), y := rng.uniform(-89, 80), min(180.0, x + rng.choice((0.0, 0.01, 3, 200))), min(90.0, y + rng.choice((0.0, 0.01, 3, 120)))) for k in range(60)]
    boxes += [(100, -180.0, -90.0, 180.0, 90.0), (101, 0.0, 0.0, 0.0, 0.0), (102, 45.0, 0.0, 90.0, 66.51326044311186), (103, -0.02197265625, -5.0, 0.0, 5.0), (104, 10.0, 85.06, 11.0, 90.0)]
    frame = spark.createDataFrame(boxes, "id long, xmin double, ymin double, xmax double, ymax double")
    sums = scratch.saved(lookups.pyramid(dens))
    want = {r.id: r.avg_density for r in lookups.box_density(frame, dens).collect()}
    got = {r.id: r.avg_density for r in lookups.box_average(frame, sums).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    top = sums.filter("level = 0").first()
    assert top.n == dens.count() and sums.filter("level = 15").count() == top.n


def test_tiles_split_as_records_arrive(spark, tmp_path):
    """Any order of arrival gives the tiles of one build over all records; a batch that comes again changes nothing."""
    rng = random.Random(5)
    rows = [(f"p{k}", "".join(rng.choices("0123", [9, 1, 1, 1], k=6)) + "".join(rng.choices("0123", [5, 1, 1, 1], k=11)), f"p{k}", record(f"p{k}"), 1) for k in range(400)]
    rows += [(p, q, k, record(k, "newer"), 2) for p, q, k, _, _ in rows[:40]] + [(p, q, k, None, 3) for p, q, k, _, _ in rows[50:60]] + [("nowhere", None, "n", "{}", 1)]
    last = {}
    for r in rows[:-1]:
        last[r[0]] = max(r, last.get(r[0], r), key=lambda x: x[4])
    kept = spark.createDataFrame([r for r in last.values() if r[3]], tiles_stream.ROW)
    records = kept.join(tiles.assign(kept, 12, 6), "place_id").select("tile_qk", "place_id", "rkey", "record_json")
    sinks.publish(records, f"{tmp_path}/whole", HEAD)
    assert records.filter("length(tile_qk) > 6").count() > 0
    for name, seed, parts in (("a", 1, 3), ("b", 2, 2)):
        dealt = random.Random(seed).sample(rows, len(rows))
        for k in range(parts):
            spark.createDataFrame(dealt[k::parts], tiles_stream.ROW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in_{name}")
        root = f"{tmp_path}/{name}"
        stream = spark.readStream.schema(tiles_stream.ROW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in_{name}")
        query = tiles_stream.maintain(stream, root, HEAD, most=12).trigger(availableNow=True).start()
        query.awaitTermination()
        found = f"{root}/tiles/{sinks.current(spark, f'{root}/tiles')}"
        assert {r.kind for r in parity.compare_runs(spark, f"{tmp_path}/whole", found).collect()} == {"manifest differs"}
        for tile in [r.tile_qk for r in spark.read.parquet(f"{found}/tiles").collect()][:20]:
            assert open(f"{found}/{tile[:6]}/{tile}.json.gz", "rb").read() == open(f"{tmp_path}/whole/{tile[:6]}/{tile}.json.gz", "rb").read()
    again = spark.createDataFrame(dealt[1::2], tiles_stream.ROW)
    tiles_stream.fold(again, 1, root, HEAD, 12)
    assert parity.compare_runs(spark, found, f"{root}/tiles/{1:020d}").count() == 0
    one = [r for r in dealt if r[1] and r[3]][:1]
    tiles_stream.fold(spark.createDataFrame([(*one[0][:4], 9)], tiles_stream.ROW), 2, root, HEAD, 12)
    assert os.listdir(f"{root}/index/{2:020d}") and sum(n.startswith("prefix=") for n in os.listdir(f"{root}/index/{2:020d}")) == 1


def test_counts_of_cells_are_kept_by_batch(spark):
    (out,) = tiles._counted([pa.RecordBatch.from_pydict({"cell": [3, 1, 3, 3]})])
    assert out.to_pydict() == {"cell": [1, 3], "n": [1, 3]}


def test_rows_that_differ_often_are_listed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(parity, "MANY", 2)
    left, right = (spark.createDataFrame([(None, "x")] * n + [(1, "y")] * m, "a long, b string") for n, m in ((5, 1), (0, 4)))
    got = Counter(map(tuple, parity.differences(left, right).collect()))
    assert got == {("left", None, "x"): 5, ("right", 1, "y"): 3}


def test_assignment_in_sql_lists_no_place_at_every_level(spark):
    from tilewright.plans.queries import QUERIES

    own, other = (QUERIES[n](spark, "/root/testdata/sf0.001") for n in ("sql_assignment", "tile_assignment"))
    assert "16,17]" not in own._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(own.collect()) == sorted(other.collect())
