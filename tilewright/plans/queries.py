"""Registered queries of the gazetteer operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_text as js
from ..functions import osm_rules, schemas, scoring
from ..functions import quadkey as qk
from ..functions import sql as sql_functions
from ..operators import containment, covering, export, importers, lookups, tiles
from ..sources import scratch
from . import proxies as px

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


FULL = "qk17 IS NOT NULL AND length(qk17) = 17 AND regexp_matches(qk17, '^[0-3]{17}$')"


def assigned_sql(source: str, most: int, low: int, high: int) -> str:
    """A query (place_id, tile_qk) for source: the coarsest level whose tile holds at most `most`."""
    return f"""SELECT p.place_id, left(p.qk17, CAST(coalesce(b.level, {high}) AS BIGINT)) AS tile_qk
    FROM {source} AS p LEFT JOIN (
        SELECT p.place_id, min(t.level) AS level FROM {source} AS p, generate_series({low}, {high}) AS t(level)
        JOIN (SELECT t.level, left(qk17, t.level) AS qk, count(*) AS n FROM {source}, generate_series({low}, {high}) AS t(level)
              WHERE {FULL} GROUP BY 1, 2) AS c ON c.level = t.level AND c.qk = left(p.qk17, t.level)
        WHERE c.n <= {most} GROUP BY p.place_id) AS b USING (place_id)
    WHERE {FULL}"""


@query(f"WITH {px.POINTS_SQL} SELECT place_id, round(lon, 6) AS lon, round(lat, 6) AS lat, qk17 FROM pts")
def qk17_points(spark, sf_dir):
    return px.points(spark, sf_dir).select("place_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "qk17")


EDGES = [(180.0, 0.0), (-180.0, 90.0), (180.0, -90.0), (0.0, 85.06), (0.0, -85.06), (181.0, 0.0), (0.0, 90.5), (0.0, 0.0), (-0.0001, 0.0001)]


@query(
    "WITH e AS (" + px.quadkey_sql("(SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(list_extract([" + ", ".join(str(x) for x, _ in EDGES) + f"], n_nationkey % {len(EDGES)} + 1) AS DOUBLE) AS lon, CAST(list_extract([" + ", ".join(str(y) for _, y in EDGES) + f"], n_nationkey % {len(EDGES)} + 1) AS DOUBLE) AS lat FROM nation)") + ") SELECT id, qk17 FROM e"
)
def quadkey_edges(spark, sf_dir):
    pick = lambda i: F.element_at(F.array(*[F.lit(float(e[i])) for e in EDGES]), F.col("n_nationkey") % len(EDGES) + 1)
    rows = px.table(spark, sf_dir, "nation")
    return rows.select(F.col("n_nationkey").cast("long").alias("id"), qk.quadkey(pick(0), pick(1)).alias("qk17"))


@query(
    f"WITH {px.POINTS_SQL}, t AS (SELECT DISTINCT left(qk17, 1 + CAST(place_id % 17 AS INTEGER)) AS tile_qk FROM pts), e AS ({px.envelope_sql('tile_qk', 't')}) "
    "SELECT tile_qk, _x AS x, _y AS y, round(xmin, 9) AS xmin, round(ymin, 9) AS ymin, round(xmax, 9) AS xmax, round(ymax, 9) AS ymax FROM e"
)
def quadkey_bbox(spark, sf_dir):
    rows = px.points(spark, sf_dir).select(F.substring(F.col("qk17"), F.lit(1), (1 + F.col("place_id") % 17).cast("int")).alias("tile_qk")).distinct()
    rows = rows.withColumn("e", qk.envelope(F.col("tile_qk")))
    return rows.select("tile_qk", qk.tile_x(F.col("tile_qk")).alias("x"), qk.tile_y(F.col("tile_qk")).alias("y"), *[F.round(f"e.{c}", 9).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query(f"WITH {px.POINTS_SQL} {assigned_sql('pts', 50, 1, 17)}")
def tile_assignment(spark, sf_dir):
    return tiles.assign(px.points(spark, sf_dir), 50, 1, 17)


@query(f"WITH {px.POINTS_SQL} SELECT CAST(t.level AS INTEGER) AS level, left(qk17, t.level) AS qk, count(*) AS cnt FROM pts, generate_series(4, 9) AS t(level) WHERE {FULL} GROUP BY 1, 2")
def tile_counts(spark, sf_dir):
    return tiles.cell_counts(px.points(spark, sf_dir), 4, 9)


DENSITY_SQL = "dens AS (SELECT left(qk17, 15) AS tile_qk15, ln(1 + count(*)) AS density_score FROM pts GROUP BY 1)"


def densities(spark, sf_dir):
    return lookups.density(px.points(spark, sf_dir), F.col("lon"), F.col("lat"))


@query(f"WITH {px.POINTS_SQL}, {DENSITY_SQL}, e AS ({px.envelope_sql('tile_qk15', 'dens')}) SELECT tile_qk15, round(density_score, 9) AS density_score, round(xmin, 6) AS tile_xmin, round(ymin, 6) AS tile_ymin, round(xmax, 6) AS tile_xmax, round(ymax, 6) AS tile_ymax FROM e")
def density_z15(spark, sf_dir):
    return densities(spark, sf_dir).select("tile_qk15", F.round("density_score", 9).alias("density_score"), *[F.round(f"tile_{c}", 6).alias(f"tile_{c}") for c in ("xmin", "ymin", "xmax", "ymax")])


@query("SELECT p_type AS category, count(*) AS n_places, round(ln((SELECT count(*) FROM part WHERE p_type IS NOT NULL) / count(*)), 9) AS idf_score FROM part WHERE p_type IS NOT NULL GROUP BY 1")
def idf_category(spark, sf_dir):
    return lookups.rarity(px.table(spark, sf_dir, "part"), F.col("p_type")).withColumn("idf_score", F.round("idf_score", 9))


@query(
    "WITH u AS (SELECT p_type AS category FROM part UNION ALL SELECT 'nation=' || s_nationkey FROM supplier UNION ALL SELECT 'segment=' || c_mktsegment FROM customer) "
    "SELECT category, count(*) AS n_places, round(ln((SELECT count(*) FROM u WHERE category IS NOT NULL) / count(*)), 9) AS idf_score FROM u WHERE category IS NOT NULL GROUP BY 1"
)
def idf_union3(spark, sf_dir):
    arms = [
        px.table(spark, sf_dir, "part").select(F.col("p_type").alias("category")),
        px.table(spark, sf_dir, "supplier").select(F.concat(F.lit("nation="), F.col("s_nationkey").cast("string")).alias("category")),
        px.table(spark, sf_dir, "customer").select(F.concat(F.lit("segment="), F.col("c_mktsegment")).alias("category")),
    ]
    return lookups.rarity(arms[0].unionByName(arms[1]).unionByName(arms[2]), F.col("category")).withColumn("idf_score", F.round("idf_score", 9))


CATEGORY_OF_ORDER = "CASE WHEN place_id % 41 > 0 THEN 'kind=' || (place_id % 40) END"
IMPORTANCE_SQL = f"""{px.POINTS_SQL}, {DENSITY_SQL}, cat AS (SELECT *, {CATEGORY_OF_ORDER} AS category FROM pts),
    idf AS (SELECT category, ln((SELECT count(*) FROM cat WHERE category IS NOT NULL) / count(*)) AS idf_score FROM cat WHERE category IS NOT NULL GROUP BY 1),
    scored AS (SELECT place_id, lon, lat, qk17, category, CAST(round(60 * least(coalesce(density_score, 0) / 10, 1.0) + 40 * least(coalesce(idf_score, 0) / 18, 1.0)) AS INTEGER) AS importance
               FROM cat LEFT JOIN dens ON dens.tile_qk15 = left(qk17, 15) LEFT JOIN idf USING (category))"""


def scored(spark, sf_dir):
    category = F.when(F.col("place_id") % 41 > 0, F.concat(F.lit("kind="), (F.col("place_id") % 40).cast("string")))
    places = px.points(spark, sf_dir).withColumn("category", category)
    out = lookups.with_scores(places, densities(spark, sf_dir), lookups.rarity(places, F.col("category")))
    return out.withColumn("importance", scoring.place_importance(F.col("density_score"), F.col("idf_score")))


@query(f"WITH {IMPORTANCE_SQL} SELECT place_id, category, importance FROM scored")
def importance_places(spark, sf_dir):
    return scored(spark, sf_dir).select("place_id", "category", "importance")


@query("SELECT c_custkey AS id, CAST(round(40 * least(ln(1 + greatest(coalesce(CAST(trunc(c_acctbal * 1000) AS BIGINT), 0), 0)) / 20, 1.0)) AS INTEGER) AS importance FROM customer")
def division_importance(spark, sf_dir):
    people = scoring.population((F.col("c_acctbal") * 1000).cast("long"))
    return px.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), scoring.division_importance(F.lit("region"), F.lit(None).cast("double"), people).alias("importance"))


TOP_SQL = "top AS (SELECT * FROM scored ORDER BY importance DESC, place_id LIMIT 500)"


@query(f"WITH {IMPORTANCE_SQL}, {TOP_SQL} SELECT place_id, importance FROM top UNION SELECT place_id, importance FROM scored WHERE place_id % 1000 = 7")
def summary_topn(spark, sf_dir):
    return tiles.top(scored(spark, sf_dir), 500, F.col("place_id") % 1000 == 7).select("place_id", "importance")


@query(f"WITH {IMPORTANCE_SQL}, {TOP_SQL} {assigned_sql('pts', 200, 6, 17)} UNION ALL {assigned_sql('top', 200, 1, 5)}")
def band_union(spark, sf_dir):
    return tiles.bands(tiles.assign(px.points(spark, sf_dir), 200), tiles.assign_summary(scored(spark, sf_dir), 500, 200))


def node_points(spark, sf_dir):
    """Parts as nodes: id, lat, lon; some have none."""
    key = F.col("p_partkey")
    hole = lambda c: F.when(key % 29 != 0, c)
    return px.table(spark, sf_dir, "part").select(key.alias("id"), hole(px.lat(key)).alias("lat"), hole(px.lon(key)).alias("lon"))


NODES_SQL = f"nodes AS (SELECT p_partkey AS id, {px.lat_sql('p_partkey')} AS lat, {px.lon_sql('p_partkey')} AS lon FROM part WHERE p_partkey % 29 <> 0)"


def ways(spark, sf_dir):
    """Orders as ways of the parts in their lines: id, nds."""
    rows = px.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id"))
    return rows.agg(F.collect_list(F.struct(F.col("l_partkey").alias("ref"))).alias("nds"))


@query(f"WITH {NODES_SQL} SELECT l_orderkey AS osm_id, round(avg(lat), 9) AS latitude, round(avg(lon), 9) AS longitude FROM lineitem JOIN nodes ON id = l_partkey GROUP BY 1")
def way_centroid(spark, sf_dir):
    out = importers.way_points(ways(spark, sf_dir).withColumnRenamed("id", "osm_id"), node_points(spark, sf_dir))
    return out.select("osm_id", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


def relations(spark, sf_dir):
    """Customers as relations of their orders (ways), of one node, and of a relation that leads nowhere."""
    order = F.struct(F.lit("way").alias("type"), F.col("o_orderkey").alias("ref"), F.lit("outer").alias("role"))
    node = F.struct(F.lit("node").alias("type"), (F.col("osm_id") % 500 + 1).alias("ref"), F.lit("label").alias("role"))
    nested = F.struct(F.lit("relation").alias("type"), (F.col("osm_id") + 1).alias("ref"), F.lit("").alias("role"))
    rows = px.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("osm_id")).agg(F.collect_list(order).alias("own"))
    return rows.select("osm_id", F.concat("own", F.array(node, node, nested)).alias("members"))


RELATION_SQL = f"""{NODES_SQL}, members AS (
        SELECT DISTINCT o_custkey AS osm_id, 'way' AS type, o_orderkey AS ref FROM orders
        UNION SELECT DISTINCT o_custkey, 'node', o_custkey % 500 + 1 FROM orders),
    refs AS (SELECT osm_id, l_partkey AS id FROM members JOIN lineitem ON type = 'way' AND l_orderkey = ref
             UNION ALL SELECT osm_id, ref FROM members WHERE type = 'node'),
    extents AS (SELECT osm_id, avg(lat) AS latitude, avg(lon) AS longitude, min(lon) AS ext_xmin, max(lon) AS ext_xmax, min(lat) AS ext_ymin, max(lat) AS ext_ymax
                FROM refs JOIN nodes USING (id) GROUP BY 1)"""


@query(f"WITH {RELATION_SQL} SELECT osm_id, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, ext_xmin, ext_xmax, ext_ymin, ext_ymax FROM extents")
def relation_extent(spark, sf_dir):
    out = importers.relation_points(relations(spark, sf_dir), ways(spark, sf_dir), node_points(spark, sf_dir))
    return out.select("osm_id", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"), "ext_xmin", "ext_xmax", "ext_ymin", "ext_ymax")


STANDING_SQL = f"""standing AS (SELECT 'w' AS osm_type, o_orderkey AS osm_id, ' n' || (o_orderkey % 60) AS name, {px.lon_sql('o_orderkey')} AS longitude, {px.lat_sql('o_orderkey')} AS latitude FROM orders
    UNION ALL SELECT 'n', id, 'n' || (id % 60), lon, lat FROM nodes)"""


@query(
    f"""WITH {RELATION_SQL}, {STANDING_SQL}
    SELECT r.osm_id, 'n' || (r.osm_id % 60) AS name FROM extents AS r
    WHERE NOT EXISTS (SELECT 1 FROM members AS m JOIN standing AS p ON p.osm_id = m.ref AND p.osm_type = CASE m.type WHEN 'node' THEN 'n' ELSE 'w' END
                      WHERE m.osm_id = r.osm_id AND trim(p.name) = 'n' || (r.osm_id % 60))
      AND NOT EXISTS (SELECT 1 FROM standing AS p WHERE trim(p.name) = 'n' || (r.osm_id % 60)
                      AND p.longitude BETWEEN (r.longitude - 8) AND (r.longitude + 8) AND p.latitude BETWEEN (r.latitude - 4) AND (r.latitude + 4))"""
)
def relation_suppression(spark, sf_dir):
    name = lambda c: F.concat(F.lit("n"), (F.col(c) % 60).cast("string"))
    rels, nodes = relations(spark, sf_dir), node_points(spark, sf_dir)
    members = scratch.saved(importers.relation_members(rels))
    placed = importers.relation_points(rels, ways(spark, sf_dir), nodes, members).withColumn("name", name("osm_id"))
    # A member extent spans half the world here, so the test uses a box around the centre.
    for c, mid, d in (("ext_xmin", "longitude", -8), ("ext_xmax", "longitude", 8), ("ext_ymin", "latitude", -4), ("ext_ymax", "latitude", 4)):
        placed = placed.withColumn(c, F.col(mid) + d)
    key = F.col("o_orderkey")
    lines = px.table(spark, sf_dir, "orders").select(F.lit("w").alias("osm_type"), key.alias("osm_id"), F.concat(F.lit(" "), name("o_orderkey")).alias("name"), px.lon(key).alias("longitude"), px.lat(key).alias("latitude"))
    spots = nodes.filter("lat is not null").select(F.lit("n").alias("osm_type"), F.col("id").alias("osm_id"), name("id").alias("name"), F.col("lon").alias("longitude"), F.col("lat").alias("latitude"))
    return importers.without_doubles(placed, members, lines.unionByName(spots)).select("osm_id", "name")


CATEGORY_SQL = "CASE " + " ".join(f"WHEN tags['{k}'] IS NOT NULL THEN '{k}=' || tags['{k}']" for k in osm_rules.CATEGORY_KEYS) + " END"


@query(f"WITH {px.TAGS_SQL} SELECT id, {CATEGORY_SQL} AS category FROM tagged")
def category_case(spark, sf_dir):
    return px.tagged(spark, sf_dir).select("id", osm_rules.category(F.col("tags")).alias("category"))


def whitelist_sql(building: bool) -> str:
    quote = lambda values: ", ".join(f"'{v}'" for v in values)
    tests = []
    for key, (kind, values) in {**osm_rules.WHITELIST, **({"building": osm_rules.BUILDING} if building else {})}.items():
        test = f"tags['{key}'] {'NOT ' if kind == 'not' else ''}IN ({quote(values)})" if values else "TRUE"
        tests.append(f"(tags['{key}'] IS NOT NULL AND {test})")
    return f"tags['name'] IS NOT NULL AND trim(tags['name']) <> '' AND ({' OR '.join(tests)})"


@query(f"WITH {px.TAGS_SQL} SELECT id, coalesce({whitelist_sql(False)}, FALSE) AS node_place, coalesce({whitelist_sql(True)}, FALSE) AS way_place FROM tagged")
def whitelist_filter(spark, sf_dir):
    tags = F.col("tags")
    return px.tagged(spark, sf_dir).select("id", osm_rules.qualifies(tags).alias("node_place"), osm_rules.qualifies(tags, True).alias("way_place"))


KEPT_SQL = ", ".join(f"'{k}'" for k in osm_rules.KEPT_TAGS)


@query(
    f"WITH {px.TAGS_SQL}, c AS (SELECT *, {CATEGORY_SQL} AS category FROM tagged) SELECT id, array_to_string(list_sort(list_transform(list_filter(map_entries(tags), "
    f"lambda e: e.key <> split_part(category, '=', 1) AND (starts_with(e.key, 'name:') OR e.key IN ({KEPT_SQL}))), lambda e: e.key || '=' || e.value)), '|') AS kept FROM c WHERE category IS NOT NULL"
)
def tag_projection(spark, sf_dir):
    rows = px.tagged(spark, sf_dir).withColumn("category", osm_rules.category(F.col("tags"))).filter("category is not null")
    kept = osm_rules.kept_tags(F.col("tags"), F.col("category"))
    return rows.select("id", F.array_join(F.array_sort(F.transform(F.map_entries(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "|").alias("kept"))


VARIANT_SQL = f"""WITH {px.TAGS_SQL}, e AS (SELECT id, tags['name'] AS name, unnest(map_entries(tags)) AS e FROM tagged),
k AS (SELECT id, name, e.value AS value, e.key AS key, CASE WHEN contains(e.key, ':') THEN split_part(e.key, ':', 1) ELSE e.key END AS head, CASE WHEN contains(e.key, ':') THEN substr(e.key, instr(e.key, ':') + 1) END AS rest FROM e),
t AS (SELECT *, CASE WHEN rest IS NULL THEN CASE head WHEN 'alt_name' THEN 'alternate' WHEN 'int_name' THEN 'alternate' WHEN 'official_name' THEN 'official' WHEN 'short_name' THEN 'short' WHEN 'loc_name' THEN 'colloquial' WHEN 'old_name' THEN 'historical' END
        WHEN regexp_matches(rest, '^(prefix|etymology|signed|pronunciation|adjective|genitive)(:|$)|word_stress$') THEN NULL
        WHEN head = 'name' THEN CASE WHEN rest = 'abbr' THEN 'short' WHEN regexp_matches(rest, '^-[0-9]{{4}}(-[0-9]{{4}})?$') THEN 'historical' WHEN rest = 'carnaval' THEN 'colloquial' ELSE 'alternate' END
        ELSE CASE head WHEN 'alt_name' THEN 'alternate' WHEN 'official_name' THEN 'official' WHEN 'short_name' THEN 'short' WHEN 'loc_name' THEN 'colloquial' WHEN 'old_name' THEN 'historical' END END AS type,
    CASE WHEN rest IS NULL OR (head = 'name' AND (rest IN ('abbr', 'carnaval') OR regexp_matches(rest, '^-[0-9]{{4}}(-[0-9]{{4}})?$'))) THEN NULL ELSE rest END AS language FROM k),
v AS (SELECT id, name, type, language, trim(unnest(str_split(value, ';'))) AS v FROM t WHERE type IS NOT NULL)
SELECT id, string_agg(v || '/' || type || '/' || coalesce(language, '-'), '|' ORDER BY v, type, language NULLS LAST) AS variants FROM v WHERE v <> '' AND (name IS NOT NULL AND v <> trim(name)) GROUP BY id"""


@query(VARIANT_SQL)
def osm_variants(spark, sf_dir):
    rows = px.tagged(spark, sf_dir).select("id", osm_rules.osm_variants(F.col("tags"), F.col("tags")["name"]).alias("v")).filter(F.size("v") > 0)
    one = lambda v: F.concat_ws("/", v["name"], v["type"], F.coalesce(v["language"], F.lit("-")))
    return rows.select("id", F.array_join(F.transform("v", one), "|").alias("variants"))


@query(
    """WITH v AS (SELECT p_partkey AS id, p_name AS name, 'alternate' AS type, 'en' AS language FROM part UNION ALL SELECT p_partkey, p_brand, CASE p_partkey % 4 WHEN 0 THEN 'official' WHEN 1 THEN 'short' ELSE 'alternate' END, NULL FROM part
    UNION ALL SELECT p_partkey, p_type, 'alternate', 'fr' FROM part WHERE p_partkey % 5 = 0)
    SELECT id, string_agg(name || '/' || type || '/' || coalesce(language, '-'), '|' ORDER BY name, type, language NULLS LAST) AS variants FROM v WHERE name IS NOT NULL AND trim(name) <> '' GROUP BY id"""
)
def name_variants(spark, sf_dir):
    kind = F.when(F.col("p_partkey") % 4 == 0, "official").when(F.col("p_partkey") % 4 == 1, "short").when(F.col("p_partkey") % 4 == 2, "common").otherwise("odd")
    rule = F.array(F.struct(F.lit(None).cast("string").alias("language"), F.col("p_brand").alias("value"), kind.alias("variant")), F.struct(F.lit("xx").alias("language"), F.lit("  ").alias("value"), F.lit("short").alias("variant")))
    common = F.when(F.col("p_partkey") % 5 == 0, F.create_map(F.lit("en"), F.col("p_name"), F.lit("fr"), F.col("p_type"))).otherwise(F.create_map(F.lit("en"), F.col("p_name")))
    rows = px.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), osm_rules.name_variants(common, rule).alias("v")).filter(F.size("v") > 0)
    one = lambda v: F.concat_ws("/", v["name"], v["type"], F.coalesce(v["language"], F.lit("-")))
    return rows.select("id", F.array_join(F.transform("v", one), "|").alias("variants"))


@query(
    """WITH a AS (SELECT 's' || s_suppkey AS place_id, 'n' || n_nationkey AS id, 25 AS level, n_name AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey
        UNION ALL SELECT 's' || s_suppkey, 'r' || r_regionkey, 10, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)
    SELECT place_id, '{"within":[' || string_agg('{"rkey":"division:' || id || '","name":"' || name || '","level":' || level || '}', ',' ORDER BY level, id) || ']}' AS relations_json FROM a GROUP BY place_id"""
)
def division_hierarchy_within(spark, sf_dir):
    nation, region = px.table(spark, sf_dir, "nation"), px.table(spark, sf_dir, "region")
    tag = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    link = lambda c: F.struct(c.alias("division_id"))
    own = px.table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    chain = F.array(link(tag("s", "s_suppkey")), link(tag("n", "n_nationkey")), link(tag("r", "n_regionkey")), link(F.lit("missing")))
    divisions = own.select(tag("s", "s_suppkey").alias("id"), F.array(chain, chain).alias("hierarchies"))
    places = nation.select(tag("n", "n_nationkey").alias("id"), F.lit(25).alias("level"), F.col("n_name").alias("name")).union(region.select(tag("r", "r_regionkey"), F.lit(10), F.col("r_name")))
    matched = containment.hierarchy(divisions, places)
    assigned = divisions.select(F.col("id").alias("place_id"), F.lit("0").alias("tile_qk"))
    return containment.relations(matched, assigned, places.select(F.col("id").alias("boundary_id"), "name"), "division").select("place_id", "relations_json")


COVER_SQL = f"""{px.BOXES_SQL}, digits AS (SELECT unnest(['0', '1', '2', '3']) AS d), tree AS (
        SELECT '' AS qk UNION ALL SELECT tree.qk || d FROM tree, digits WHERE length(tree.qk) < 5),
    env AS ({px.envelope_sql('qk', "(SELECT qk FROM tree WHERE qk <> '')")}),
    hit AS (SELECT b.boundary_id, e.qk AS tile_qk, e.xmin >= b.xmin AND e.xmax <= b.xmax AND e.ymin >= b.ymin AND e.ymax <= b.ymax AS interior
            FROM boxes AS b JOIN env AS e ON e.xmin < b.xmax AND e.xmax > b.xmin AND e.ymin < b.ymax AND e.ymax > b.ymin),
    cover AS (SELECT h.* FROM hit AS h WHERE (h.interior OR length(h.tile_qk) = 5)
              AND NOT EXISTS (SELECT 1 FROM hit AS p WHERE p.boundary_id = h.boundary_id AND p.interior AND p.tile_qk = left(h.tile_qk, length(h.tile_qk) - 1)))"""


def box_cover(spark, sf_dir):
    return covering.cover_boxes(px.boxes(spark, sf_dir), 1, 5)


@query(f"WITH RECURSIVE {COVER_SQL} SELECT tile_qk, boundary_id, interior FROM cover")
def box_covering(spark, sf_dir):
    return box_cover(spark, sf_dir)


@query(f"WITH {px.POINTS_SQL}, {px.BOXES_SQL} SELECT place_id, boundary_id, level FROM pts JOIN boxes ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax")
def containment_prefix_join(spark, sf_dir):
    boxes = px.boxes(spark, sf_dir)
    cover = box_cover(spark, sf_dir).join(boxes, "boundary_id")
    pairs = containment.candidates(px.points(spark, sf_dir), cover, 1, 5)
    inside = F.col("lon").between(F.col("xmin"), F.col("xmax")) & F.col("lat").between(F.col("ymin"), F.col("ymax"))
    return pairs.filter(F.col("interior") | inside).select("place_id", "boundary_id", "level").distinct()


#: Fixed polygons over the points: a star, a concave L and a square with a hole.
POLYGONS = {
    1: [[(-100.03, -40.07), (-20.11, -10.13), (60.17, -42.19), (20.23, 5.29), (80.31, 40.37), (0.41, 25.43), (-90.47, 45.53), (-45.59, 3.61)]],
    2: [[(100.03, -60.07), (160.11, -60.13), (160.17, 10.19), (130.23, 10.29), (130.31, -30.37), (100.41, -30.43)]],
    3: [[(-170.03, -20.07), (-110.11, -20.13), (-110.17, 60.19), (-170.23, 60.29)], [(-150.31, 0.37), (-130.41, 0.43), (-130.47, 40.53), (-150.59, 40.61)]],
}


def polygon_sql() -> str:
    """Even-odd rule over all edges of a polygon."""
    edges = []
    for key, rings in POLYGONS.items():
        for ring in rings:
            edges += [f"({key}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(ring, ring[1:] + ring[:1])]
    return f"""WITH {px.POINTS_SQL}, e(boundary_id, ax, ay, bx, b_y) AS (VALUES {', '.join(edges)})
    SELECT place_id, CAST(boundary_id AS VARCHAR) AS boundary_id, CAST(10 AS INTEGER) AS level FROM pts JOIN e ON (ay > lat) <> (b_y > lat) AND lon < ax + (lat - ay) / (b_y - ay) * (bx - ax)
    GROUP BY place_id, boundary_id HAVING count(*) % 2 = 1"""


def polygon_boundaries(spark):
    from ..functions import geometry

    rows = []
    for key, rings in POLYGONS.items():
        shape = [[geometry.open_ring(r) for r in rings]]
        rows.append((str(key), 10, bytearray(geometry.write(shape)), *map(float, geometry.bounds(shape))))
    return spark.createDataFrame(rows, "boundary_id string, level int, geom binary, xmin double, ymin double, xmax double, ymax double")


@query(polygon_sql())
def polygon_containment(spark, sf_dir):
    cover = covering.cover(polygon_boundaries(spark), first=2, leaf=5, last=7, capacity=6)
    return containment.matches(px.points(spark, sf_dir), cover, 2, 7)


@query(f"WITH RECURSIVE {px.POINTS_SQL}, {COVER_SQL}, grid AS (SELECT DISTINCT tile_qk FROM ({assigned_sql('pts', 50, 1, 17)})) SELECT DISTINCT c.boundary_id AS place_id, g.tile_qk FROM cover AS c JOIN grid AS g ON starts_with(c.tile_qk, g.tile_qk) OR starts_with(g.tile_qk, c.tile_qk)")
def tile_references(spark, sf_dir):
    return tiles.references(box_cover(spark, sf_dir), tile_assignment(spark, sf_dir))


@query(
    f"WITH {px.POINTS_SQL}, {px.BOXES_SQL}, {DENSITY_SQL}, e AS ({px.envelope_sql('tile_qk15', 'dens')}) SELECT b.boundary_id AS id, round(coalesce(avg(e.density_score), 0), 9) AS avg_density "
    "FROM boxes AS b LEFT JOIN e ON e.xmin <= b.xmax AND e.xmax >= b.xmin AND e.ymin <= b.ymax AND e.ymax >= b.ymin GROUP BY 1"
)
def density_bbox_overlap_avg(spark, sf_dir):
    out = lookups.box_density(px.boxes(spark, sf_dir).withColumnRenamed("boundary_id", "id"), densities(spark, sf_dir))
    return out.select("id", F.round("avg_density", 9).alias("avg_density"))


RECORD_SQL = """'{"$type":"org.atgeo.place","rkey":"' || place_id || '","name":"' || o_orderpriority || '","importance":' || importance ||
    ',"locations":[{"$type":"community.lexicon.location.geo","latitude":"' || CAST(CAST(lat AS DECIMAL(10,6)) AS VARCHAR) || '","longitude":"' || CAST(CAST(lon AS DECIMAL(10,6)) AS VARCHAR) || '"}],"variants":[],"attributes":{' ||
    concat_ws(',', CASE WHEN place_id % 3 = 0 THEN '"category":"' || category || '"' END, '"status":"' || o_orderstatus || '"') || '},"relations":{}}'"""


@query(f"WITH {IMPORTANCE_SQL}, a AS ({assigned_sql('pts', 50, 1, 17)}) SELECT a.tile_qk, a.place_id, CAST(place_id AS VARCHAR) AS rkey, {RECORD_SQL} AS record_json FROM a JOIN scored USING (place_id) JOIN orders ON o_orderkey = place_id")
def tile_export_json(spark, sf_dir):
    orders = px.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("place_id"), "o_orderpriority", "o_orderstatus")
    places = scored(spark, sf_dir).join(orders, "place_id")
    rkey = F.col("place_id").cast("string")
    attributes = js.shallow_object({"category": (F.when(F.col("place_id") % 3 == 0, F.col("category")), "string"), "status": (F.col("o_orderstatus"), "string")})
    where = export.listed(F.array(export.geo(F.col("lat"), F.col("lon"))))
    record = export.record(rkey, F.col("o_orderpriority"), F.col("importance"), where, F.lit("[]"), attributes, F.col("relations_json"))
    return export.tile_records(places, "place_id", tile_assignment(spark, sf_dir), None, record, rkey)


@query(f"WITH {px.POINTS_SQL}, {px.BOXES_SQL}, a AS ({assigned_sql('pts', 50, 1, 17)}) SELECT a.tile_qk, p.place_id, '{{\"within\":[' || string_agg('{{\"rkey\":\"division:' || boundary_id || '\",\"name\":\"' || name || '\",\"level\":' || level || '}}', ',' ORDER BY level, boundary_id) || ']}}' AS relations_json FROM pts AS p JOIN boxes ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax JOIN a USING (place_id) GROUP BY 1, 2")
def containment_relations(spark, sf_dir):
    matched = containment_prefix_join(spark, sf_dir)
    return containment.relations(matched, tile_assignment(spark, sf_dir), px.boxes(spark, sf_dir).select("boundary_id", "name"), "division")


@query(f"WITH {px.POINTS_SQL} SELECT CASE CAST(place_id % 3 AS INTEGER) WHEN 0 THEN 'node:' WHEN 1 THEN 'way:' ELSE 'relation:' END || place_id AS rkey, tile_qk FROM ({assigned_sql('pts', 50, 1, 17)})")
def record_tiles(spark, sf_dir):
    kind = F.element_at(F.array(*map(F.lit, "nwr")), (F.col("place_id") % 3 + 1).cast("int"))
    return tile_assignment(spark, sf_dir).select(export.osm_rkey(F.concat(kind, F.col("place_id").cast("string"))).alias("rkey"), "tile_qk")


@query(f"WITH {IMPORTANCE_SQL}, a AS ({assigned_sql('pts', 50, 1, 17)}) SELECT category, count(DISTINCT place_id) AS n, count(DISTINCT tile_qk) AS n_tiles FROM a JOIN scored USING (place_id) WHERE category IS NOT NULL GROUP BY 1")
def collection_stats(spark, sf_dir):
    rows = tile_assignment(spark, sf_dir).join(scored(spark, sf_dir).select("place_id", "category"), "place_id")
    counts = export.category_counts(rows.select("place_id", "category").distinct(), F.col("category"))
    return counts.join(rows.groupBy("category").agg(F.countDistinct("tile_qk").alias("n_tiles")), "category")


def coverage_sql(where: str) -> str:
    return f"WITH {px.POINTS_SQL}, t AS (SELECT DISTINCT tile_qk FROM ({assigned_sql('pts', 20, 6, 17)} UNION ALL {assigned_sql('pts', 2000, 1, 5)})), e AS ({px.envelope_sql('tile_qk', 't')}) SELECT tile_qk FROM e WHERE {where}"


def all_tiles(spark, sf_dir):
    points = px.points(spark, sf_dir)
    return tiles.bands(tiles.assign(points, 20), tiles.assign(points, 2000, 1, 5))


def tile_list(spark, sf_dir):
    """The tiles as a table in order."""
    rows = all_tiles(spark, sf_dir).select("tile_qk").distinct()
    return scratch.saved(rows.repartitionByRange("tile_qk").sortWithinPartitions("tile_qk"))


@query(coverage_sql("length(tile_qk) >= 6 AND xmin <= 13.5 AND xmax >= 10.25 AND ymin <= 50.5 AND ymax >= 47.75"))
def coverage_bbox(spark, sf_dir):
    return export.coverage(tile_list(spark, sf_dir), export.parse_box("10.25,47.75,13.5,50.5"), most=100_000)


@query(coverage_sql("length(tile_qk) >= 6 AND (xmin <= -178.5 OR xmax >= 177.25) AND ymin <= 20.5 AND ymax >= -15.75"))
def coverage_antimeridian(spark, sf_dir):
    return export.coverage(tile_list(spark, sf_dir), export.parse_box("177.25,-15.75,-178.5,20.5"), most=100_000)


@query(coverage_sql("length(tile_qk) >= 6 AND xmin <= -68.5 AND xmax >= -75.25 AND ymin <= 45.5 AND ymax >= 40.25"))
def coverage_small_box(spark, sf_dir):
    return export.coverage(tile_list(spark, sf_dir), export.parse_box("-75.25,40.25,-68.5,45.5"), most=100_000)


@query(coverage_sql("length(tile_qk) < 6 AND xmin <= 120.5 AND xmax >= -100.25 AND ymin <= 60.5 AND ymax >= -60.75"))
def coverage_summary_fallback(spark, sf_dir):
    return export.coverage(tile_list(spark, sf_dir), export.parse_box("-100.25,-60.75,120.5,60.5"), most=10)


@query(f"WITH {px.POINTS_SQL} SELECT place_id, tile_qk, 'https://tiles.example/' || left(tile_qk, 6) || '/' || tile_qk || '.json.gz' AS url FROM ({assigned_sql('pts', 50, 1, 17)}) WHERE place_id IN (7, 39, 4000)")
def record_lookup(spark, sf_dir):
    return tile_assignment(spark, sf_dir).filter(F.col("place_id").isin(7, 39, 4000)).select("place_id", "tile_qk", export.tile_url("https://tiles.example").alias("url"))


@query("SELECT o_custkey AS key, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def lookup_uniqueness(spark, sf_dir):
    return lookups.repeated_keys(px.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), "key")


@query("SELECT o_custkey AS place_id, o_orderstatus AS tile_qk, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def assignment_duplicates(spark, sf_dir):
    return tiles.repeated(px.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("place_id"), F.col("o_orderstatus").alias("tile_qk")))


@query(f"WITH {px.POINTS_SQL}, a AS ({assigned_sql('pts', 50, 1, 17)}), b AS ({assigned_sql('pts', 60, 1, 17)}) SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def parity_diff(spark, sf_dir):
    from ..operators import parity

    points = px.points(spark, sf_dir)
    return parity.differences(tiles.assign(points, 50, 1, 17), tiles.assign(points, 60, 1, 17))


@query("SELECT l_partkey AS id FROM lineitem UNION SELECT l_suppkey FROM lineitem")
def union_distinct(spark, sf_dir):
    rows = px.table(spark, sf_dir, "lineitem")
    return rows.select(F.col("l_partkey").alias("id")).union(rows.select("l_suppkey")).distinct()


@query("SELECT n_nationkey AS id, unnest(CASE n_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST([] AS VARCHAR[]) ELSE [n_name, 'x'] END) AS item FROM nation")
def null_explode(spark, sf_dir):
    none = F.lit(None).cast("array<string>")
    items = F.when(F.col("n_nationkey") % 3 == 0, none).when(F.col("n_nationkey") % 3 == 1, F.array().cast("array<string>")).otherwise(F.array("n_name", F.lit("x")))
    return px.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.explode(items).alias("item"))


@query("SELECT c_custkey AS id, CASE WHEN c_mktsegment IS NULL THEN NULL WHEN contains(c_mktsegment, 'U') THEN substr(c_mktsegment, instr(c_mktsegment, 'U') + 1) ELSE c_mktsegment END AS region, CAST(CAST(c_acctbal / 1000 AS DECIMAL(10,6)) AS VARCHAR) AS fixed FROM customer")
def scalar_strings(spark, sf_dir):
    c = F.col("c_mktsegment")
    region = F.when(F.instr(c, "U") > 0, F.substring(c, F.instr(c, "U") + 1, F.length(c))).otherwise(c)
    return px.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), region.alias("region"), js.fixed(F.col("c_acctbal") / 1000).alias("fixed"))


@query("SELECT n_nationkey AS id, '{' || concat_ws(',', '\"a\":\"' || n_name || '\"', CASE WHEN n_nationkey % 2 = 0 THEN '\"b\":' || n_regionkey END, '\"c\":{\"x\":null,\"y\":' || n_regionkey || '}') || '}' AS json FROM nation")
def shallow_json(spark, sf_dir):
    nested = F.struct(F.lit(None).cast("int").alias("x"), F.col("n_regionkey").alias("y"))
    fields = {"a": (F.col("n_name"), "string"), "b": (F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")), "int"), "c": (nested, "struct<x:int,y:int>"), "d": (F.lit(None).cast("string"), "string")}
    return px.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), js.shallow_object(fields).alias("json"))


@query(f"WITH {px.POINTS_SQL} SELECT place_id, qk17 FROM pts WHERE starts_with(qk17, '120')")
def qk_range(spark, sf_dir):
    return px.points(spark, sf_dir).filter(qk.within(F.col("qk17"), "120")).select("place_id", "qk17")


PEOPLE_SQL = "greatest(coalesce(CAST(trunc(c_acctbal * 1000) AS BIGINT), 0), 0)"


@query(
    f"SELECT c_custkey AS id, CAST(round(CASE WHEN c_custkey % 3 = 0 THEN 60 * least(coalesce(CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 14 END, 0) / 10, 1.0) ELSE 0 END + 40 * least(ln(1 + {PEOPLE_SQL}) / 20, 1.0)) AS INTEGER) AS importance FROM customer"
)
def locality_importance(spark, sf_dir):
    key = F.col("c_custkey")
    subtype = F.when(key % 3 == 0, "locality").when(key % 3 == 1, "region")
    density = F.when(key % 5 > 0, (key % 14).cast("double"))
    people = scoring.population((F.col("c_acctbal") * 1000).cast("long"))
    return px.table(spark, sf_dir, "customer").select(key.alias("id"), scoring.division_importance(subtype, density, people).alias("importance"))


@query(
    f"""WITH {px.POINTS_SQL}, {px.BOXES_SQL}, a AS ({assigned_sql('pts', 50, 1, 17)}), r AS (
        SELECT a.tile_qk, p.place_id, '{{"within":[' || string_agg('{{"rkey":"division:' || boundary_id || '","name":"' || name || '","level":' || level || '}}', ',' ORDER BY level, boundary_id) || ']}}' AS relations_json
        FROM pts AS p JOIN boxes ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax JOIN a USING (place_id) GROUP BY 1, 2)
    SELECT a.tile_qk, a.place_id, '{{"rkey":"' || a.place_id || '","relations":' || coalesce(r.relations_json, '{{}}') || '}}' AS record_json FROM a LEFT JOIN r ON r.tile_qk = a.tile_qk AND r.place_id = a.place_id"""
)
def tile_records_with_relations(spark, sf_dir):
    assigned = tile_assignment(spark, sf_dir)
    matched = containment_prefix_join(spark, sf_dir)  # points outside every box have no relations
    related = containment.relations(matched, assigned, px.boxes(spark, sf_dir).select("boundary_id", "name"), "division")
    rkey = F.col("place_id").cast("string")
    record = js.whole_object({"rkey": js.quoted(rkey), "relations": F.coalesce("relations_json", F.lit("{}"))})
    return export.tile_records(px.points(spark, sf_dir), "place_id", assigned, related, record, rkey).select("tile_qk", "place_id", "record_json")


@query(f"WITH RECURSIVE {COVER_SQL} SELECT CAST(length(tile_qk) AS INTEGER) AS zoom, count(*) AS tiles, CAST(sum(CASE WHEN length(tile_qk) = 5 AND boundary_id % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS over_capacity FROM cover GROUP BY 1")
def covering_stats(spark, sf_dir):
    return covering.stats(box_cover(spark, sf_dir).withColumn("points", F.col("boundary_id") % 2), last=5, capacity=0)


@query("SELECT DISTINCT unnest(CASE WHEN n_nationkey % 2 = 0 THEN ['id', 'even'] ELSE ['id', 'odd', 'nation=' || n_regionkey] END) AS key FROM nation")
def attribute_keys(spark, sf_dir):
    odd = F.concat(F.lit('{"attributes":{"id":1,"odd":{"deep":1},"nation='), F.col("n_regionkey").cast("string"), F.lit('":null}}'))
    record = F.when(F.col("n_nationkey") % 2 == 0, F.lit('{"attributes":{"id":1,"even":[2]}}')).otherwise(odd)
    return export.attribute_keys(px.table(spark, sf_dir, "nation").select(record.alias("record_json")))


@query(f"WITH {px.TAGS_SQL} SELECT DISTINCT unnest(map_keys(CASE WHEN id % 3 > 0 THEN tags END)) AS key FROM tagged")
def tag_keys(spark, sf_dir):
    return export.tag_keys(px.tagged(spark, sf_dir).withColumn("tags", F.when(F.col("id") % 3 > 0, F.col("tags"))))


@query(f"WITH {px.POINTS_SQL}, {px.BOXES_SQL} SELECT DISTINCT level FROM pts JOIN boxes ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax")
def containment_levels(spark, sf_dir):
    return export.containment_levels(containment_relations(spark, sf_dir))


@query(coverage_sql("TRUE").replace("SELECT tile_qk FROM e WHERE TRUE", "SELECT printf('%.6f', max(ymax)) AS north, printf('%.6f', min(ymin)) AS south, printf('%.6f', max(xmax)) AS east, printf('%.6f', min(xmin)) AS west FROM e WHERE length(tile_qk) >= 6 AND xmin > 0 AND ymin > 0"))
def tile_extent(spark, sf_dir):
    boxed = all_tiles(spark, sf_dir).distinct().withColumn("e", qk.envelope(F.col("tile_qk")))
    sides = export.extent(boxed.filter("length(tile_qk) < 6 or (e.xmin > 0 and e.ymin > 0)"))
    return spark.createDataFrame([tuple(sides.values())], ", ".join(f"{k} string" for k in sides))


#: A C open to the west over the borders of tiles, and a boundary of two parts that overlap: (boundary, part) -> ring.
PARTS = {
    ("c", 0): [(-100.03, -40.07), (60.17, -42.19), (60.31, 50.37), (-100.41, 50.43), (-100.47, 30.53), (30.59, 30.61), (30.67, -10.71), (-100.73, -10.79)],
    ("two", 0): [(90.03, -30.07), (144.11, -30.13), (144.17, 40.19), (90.23, 40.29)],
    ("two", 1): [(90.03, -30.07), (144.11, -30.13), (144.17, 40.19), (90.23, 40.29)],
    ("two", 2): [(120.31, 20.37), (170.41, 20.43), (170.47, 60.53), (120.59, 60.61)],
}
BORDER_POINTS_SQL = f"on_lines AS ({px.quadkey_sql('(SELECT o_orderkey AS place_id, CAST(o_orderkey % 32 AS DOUBLE) * 11.25 - 180 AS lon, ' + px.lat_sql('o_orderkey') + ' AS lat FROM orders)')})"


def border_sql() -> str:
    """Even-odd rule over the edges of each part; any part will do."""
    edges = [f"('{name}', {part}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for (name, part), ring in PARTS.items() for a, b in zip(ring, ring[1:] + ring[:1])]
    return f"""WITH {BORDER_POINTS_SQL}, e(boundary_id, part, ax, ay, bx, b_y) AS (VALUES {', '.join(edges)}), hit AS (
        SELECT place_id, boundary_id, part FROM on_lines JOIN e ON (ay > lat) <> (b_y > lat) AND lon < ax + (lat - ay) / (b_y - ay) * (bx - ax) GROUP BY ALL HAVING count(*) % 2 = 1)
    SELECT DISTINCT place_id, boundary_id, CAST(10 AS INTEGER) AS level FROM hit"""


@query(border_sql())
def containment_on_tile_borders(spark, sf_dir):
    from ..functions import geometry

    rows = []
    for name in ("c", "two"):
        shape = geometry.merge([[[geometry.open_ring(ring)]] for (own, _), ring in PARTS.items() if own == name])
        rows.append((name, 10, bytearray(geometry.write(shape)), *map(float, geometry.bounds(shape))))
    bounds = spark.createDataFrame(rows, "boundary_id string, level int, geom binary, xmin double, ymin double, xmax double, ymax double")
    key = F.col("o_orderkey")
    points = px.table(spark, sf_dir, "orders").select(key.alias("place_id"), ((key % 32).cast("double") * 11.25 - 180).alias("lon"), px.lat(key).alias("lat"))
    points = points.withColumn("qk17", qk.quadkey(F.col("lon"), F.col("lat")))
    return containment.matches(points, covering.cover(bounds, first=2, leaf=4, last=6, capacity=4), 2, 6)


GEO_SQL = "'{\"$type\":\"community.lexicon.location.geo\",\"latitude\":\"' || CAST(CAST(lat AS DECIMAL(10,6)) AS VARCHAR) || '\",\"longitude\":\"' || CAST(CAST(lon AS DECIMAL(10,6)) AS VARCHAR) || '\"}'"


@query(
    f"""WITH p AS (SELECT *, {px.lat_sql('p_partkey')} AS lat, {px.lon_sql('p_partkey')} AS lon FROM part)
    SELECT p_partkey AS id, '{{"$type":"org.atgeo.place","rkey":"' || CASE p_partkey % 3 WHEN 0 THEN 'node:' WHEN 1 THEN 'way:' ELSE 'relation:' END || p_partkey || '","name":"' || p_name || '","importance":' || p_size || ',"locations":[' || {GEO_SQL} || '],"variants":[' ||
        CASE WHEN p_partkey % 2 = 0 THEN '{{"name":"' || p_brand || '","type":"alternate"}},{{"name":"x","type":"short","language":"en"}}' ELSE '' END || '],"attributes":{{"ref":"R' || p_size || '"' || CASE WHEN p_partkey % 5 > 0 THEN ',"shop":"' || p_type || '"' ELSE '' END || '}},"relations":{{}}}}' AS record_json FROM p"""
)
def osm_records(spark, sf_dir):
    key, none = F.col("p_partkey"), F.lit(None).cast("string")
    kind = F.element_at(F.array(*map(F.lit, "nwr")), (key % 3 + 1).cast("int"))
    variant = lambda name, kind, language: F.struct(name.alias("name"), F.lit(kind).alias("type"), language.alias("language"))
    variants = F.when(key % 2 == 0, F.array(variant(F.col("p_brand"), "alternate", none), variant(F.lit("x"), "short", F.lit("en"))))
    rows = px.table(spark, sf_dir, "part").select(
        key.alias("id"), F.concat(kind, key.cast("string")).alias("rkey"), F.col("p_name").alias("name"), F.col("p_size").alias("importance"), px.lat(key).alias("latitude"), px.lon(key).alias("longitude"),
        F.when(key % 5 > 0, F.concat(F.lit("shop="), F.col("p_type"))).alias("primary_category"), F.create_map(F.lit("ref"), F.concat(F.lit("R"), F.col("p_size").cast("string"))).alias("tags"), variants.alias("variants"), none.alias("relations_json"),
    )
    return rows.select("id", export.osm_record().alias("record_json"))


@query(
    f"""WITH p AS (SELECT *, ({px.lat_sql('c_custkey')} + ({px.lat_sql('c_custkey')} + 0.5)) / 2 AS lat, ({px.lon_sql('c_custkey')} + ({px.lon_sql('c_custkey')} + 0.25)) / 2 AS lon FROM customer)
    SELECT c_custkey AS id, '{{"$type":"org.atgeo.place","rkey":"' || c_custkey || '","name":"' || c_name || '","importance":' || c_nationkey || ',"locations":[' || {GEO_SQL} ||
        CASE WHEN c_custkey % 2 = 0 THEN ',{{"$type":"community.lexicon.location.address","country":"US","region":"CA","street":"' || c_name || '"}}' ELSE '' END || '],"variants":[],"attributes":{{"id":"' || c_custkey || '","names":{{"primary":"' || c_name || '","extra":null}},"categories":{{"primary":"' || c_mktsegment || '"}}' ||
        CASE WHEN c_custkey % 3 = 0 THEN ',"websites":["http://x",null]' ELSE '' END || ',"confidence":"' || CAST(CAST(0.0625 * (c_custkey % 16) AS DECIMAL(4,3)) AS VARCHAR) || '"}},"relations":{{"within":[]}}}}' AS record_json FROM p"""
)
def place_records(spark, sf_dir):
    key, none = F.col("c_custkey"), F.lit(None).cast("string")
    address = lambda country: F.struct(country.alias("country"), F.lit("US-CA").alias("region"), none.alias("locality"), F.col("c_name").alias("freeform"), none.alias("postcode"))
    rows = px.table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"), F.struct(px.lon(key).alias("xmin"), (px.lon(key) + 0.25).alias("xmax"), px.lat(key).alias("ymin"), (px.lat(key) + 0.5).alias("ymax")).alias("bbox"),
        F.struct(F.col("c_name").alias("primary"), none.alias("extra")).alias("names"), F.struct(F.col("c_mktsegment").alias("primary")).alias("categories"), F.col("c_nationkey").alias("importance"),
        F.when(key % 2 == 0, F.array(address(F.lit("US")), address(none))).alias("addresses"), F.when(key % 3 == 0, F.array(F.lit("http://x"), none)).alias("websites"), (0.0625 * (key % 16)).alias("confidence"),
        F.lit(None).cast("array<struct<name:string,type:string,language:string>>").alias("variants"), F.lit('{"within":[]}').alias("relations_json"),
    )
    return rows.select(F.col("id").cast("long").alias("id"), export.place_record(dict(rows.dtypes)).alias("record_json"))


@query(
    f"""WITH {px.BOXES_SQL} SELECT boundary_id AS id, '{{"$type":"org.atgeo.place","rkey":"' || boundary_id || '","name":"' || name || '","importance":' || level || ',"locations":[{{"$type":"community.lexicon.location.bbox","north":"' || CAST(CAST(ymax AS DECIMAL(10,6)) AS VARCHAR) || '","south":"' || CAST(CAST(ymin AS DECIMAL(10,6)) AS VARCHAR)
        || '","east":"' || CAST(CAST(xmax AS DECIMAL(10,6)) AS VARCHAR) || '","west":"' || CAST(CAST(xmin AS DECIMAL(10,6)) AS VARCHAR) || '"}}],"variants":[],"attributes":{{"subtype":"country",' || CASE WHEN boundary_id % 2 = 0 THEN '"country":"US",' ELSE '' END || '"level":' || level || ',"population":' || boundary_id * 1000 || '}},"relations":{{}}}}' AS record_json FROM boxes"""
)
def division_records(spark, sf_dir):
    none = F.lit(None).cast("string")
    rows = px.boxes(spark, sf_dir).select(
        F.col("boundary_id").alias("id"), F.struct(F.col("name").alias("primary")).alias("names"), F.col("level").alias("importance"), "xmin", "xmax", "ymin", "ymax", F.lit("country").alias("subtype"), F.when(F.col("boundary_id") % 2 == 0, "US").alias("country"),
        none.alias("region"), "level", none.alias("wikidata"), (F.col("boundary_id") * 1000).alias("population"), F.lit(None).cast("array<struct<name:string,type:string,language:string>>").alias("variants"), none.alias("relations_json"),
    )
    return rows.select("id", export.division_record().alias("record_json"))


#: A box for every supplier, in whole degrees, overlapping others of its nation: the same text in both dialects.
PLOT = {
    "xmin": "(s_nationkey * 37 % 300 - 150) + s_suppkey * 7 % 12",
    "xmax": "(s_nationkey * 37 % 300 - 150) + s_suppkey * 7 % 12 + 2 + s_suppkey % 5",
    "ymin": "(s_nationkey * 23 % 120 - 60) + s_suppkey * 11 % 10",
    "ymax": "(s_nationkey * 23 % 120 - 60) + s_suppkey * 11 % 10 + 2 + s_suppkey % 4",
}
PLOTS_SQL = (
    "plots AS (SELECT CAST(s_nationkey AS BIGINT) AS id, " + ", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in PLOT.items()) + " FROM supplier), "
    + ", ".join(
        f"{c}s AS (SELECT id, {c} AS {c}0, lead({c}) OVER (PARTITION BY id ORDER BY {c}) AS {c}1 FROM (SELECT id, {c}min AS {c} FROM plots UNION SELECT id, {c}max FROM plots))"
        for c in "xy"
    )
    + ", cells AS (SELECT xs.id, x0, x1, y0, y1 FROM xs JOIN ys ON ys.id = xs.id WHERE x1 IS NOT NULL AND y1 IS NOT NULL AND EXISTS "
    "(SELECT 1 FROM plots AS p WHERE p.id = xs.id AND p.xmin <= x0 AND p.xmax >= x1 AND p.ymin <= y0 AND p.ymax >= y1))"
)


def plots(spark, sf_dir):
    """Land areas of nations: division_id, is_land, geometry, bbox."""

    def drawn(batches):
        import pyarrow as pa

        from ..functions import geometry

        for batch in batches:
            sides = [batch.column(c).to_pylist() for c in PLOT]
            shapes = [geometry.write(geometry.box(x, y, v, w)) for x, v, y, w in zip(*sides)]
            yield pa.RecordBatch.from_arrays([batch.column("division_id"), pa.array(shapes, pa.binary()), *[batch.column(c) for c in PLOT]], ["division_id", "geometry", *PLOT])

    boxes = px.table(spark, sf_dir, "supplier").selectExpr("cast(s_nationkey as long) as division_id", *[f"cast({v} as double) as {k}" for k, v in PLOT.items()])
    rows = boxes.mapInArrow(drawn, "division_id long, geometry binary, xmin double, xmax double, ymin double, ymax double")
    return rows.select("division_id", F.lit(True).alias("is_land"), "geometry", F.struct("xmin", "ymin", "xmax", "ymax").alias("bbox"))


@query(f"WITH {PLOTS_SQL}, p AS (SELECT id, count(*) AS parts, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM plots GROUP BY id) SELECT p.*, round(area, 6) AS area FROM p JOIN (SELECT id, sum((x1 - x0) * (y1 - y0)) AS area FROM cells GROUP BY id) USING (id)")
def united_areas(spark, sf_dir):
    def sized(batches):
        import pyarrow as pa

        from ..functions import geometry

        for batch in batches:
            sizes = [geometry.area(geometry.parse(g)) for g in batch.column("geom").to_pylist()]
            kept = [batch.column(c) for c in ("id", "parts", "xmin", "ymin", "xmax", "ymax")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sizes, pa.float64())], ["id", "parts", "xmin", "ymin", "xmax", "ymax", "area"])

    rows = importers.area_shapes(plots(spark, sf_dir)).mapInArrow(sized, "id long, parts int, xmin double, ymin double, xmax double, ymax double, area double")
    return rows.withColumn("parts", F.col("parts").cast("long")).withColumn("area", F.round("area", 6))


@query(
    f"""WITH RECURSIVE {PLOTS_SQL}, digits AS (SELECT unnest(['0', '1', '2', '3']) AS d), tree AS (
        SELECT '' AS qk UNION ALL SELECT tree.qk || d FROM tree, digits WHERE length(tree.qk) < 6),
    env AS ({px.envelope_sql('qk', "(SELECT qk FROM tree WHERE length(qk) = 6)")}),
    hit AS (SELECT c.id AS boundary_id, e.qk AS tile_qk, any_value((e.xmax - e.xmin) * (e.ymax - e.ymin)) AS whole,
                sum((least(x1, e.xmax) - greatest(x0, e.xmin)) * (least(y1, e.ymax) - greatest(y0, e.ymin))) AS part
            FROM cells AS c JOIN env AS e ON e.xmin < x1 AND e.xmax > x0 AND e.ymin < y1 AND e.ymax > y0 GROUP BY 1, 2)
    SELECT CAST(boundary_id AS VARCHAR) AS boundary_id, tile_qk, part >= whole * (1 - 1e-9) AS interior FROM hit"""
)
def united_covering(spark, sf_dir):
    shapes = importers.area_shapes(plots(spark, sf_dir)).select(F.col("id").alias("boundary_id"), F.lit(10).alias("level"), "geom", "xmin", "ymin", "xmax", "ymax")
    return covering.cover(shapes, first=6, leaf=6, last=6).select("boundary_id", "tile_qk", "interior")


@query(
    f"""WITH RECURSIVE {px.POINTS_SQL}, t AS (SELECT DISTINCT left(qk17, 8) AS tile_qk FROM pts), h AS (
        SELECT tile_qk, 1 AS i, 0 AS swap, 0 AS turn, '' AS curve FROM t
        UNION ALL SELECT tile_qk, i + 1, CASE WHEN y = 0 THEN 1 - swap ELSE swap END, CASE WHEN y = 0 AND x = 1 THEN 1 - turn ELSE turn END, curve || CAST(xor(3 * x, y) AS VARCHAR)
        FROM (SELECT *, xor(CASE swap WHEN 1 THEN d >> 1 ELSE d & 1 END, turn) AS x, xor(CASE swap WHEN 1 THEN d & 1 ELSE d >> 1 END, turn) AS y
              FROM (SELECT *, CAST(substr(tile_qk, i, 1) AS INTEGER) AS d FROM h WHERE i <= 8)))
    SELECT tile_qk, curve FROM h WHERE i = 9"""
)
def hilbert_order(spark, sf_dir):
    rows = px.points(spark, sf_dir).select(F.substring("qk17", 1, 8).alias("tile_qk")).distinct()
    return rows.select("tile_qk", qk.hilbert(F.col("tile_qk")).alias("curve"))


@query(f"WITH {px.POINTS_SQL} {assigned_sql('pts', 50, 1, 17)}")
def sql_assignment(spark, sf_dir):
    """tile_assignment in plain SQL with the functions of the session."""
    sql_functions.register(spark)
    rows = px.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("place_id"), px.lon(F.col("o_orderkey")).alias("lon"), px.lat(F.col("o_orderkey")).alias("lat"))
    return spark.sql(
        # In the order of cells, tiles of more than 50 are what 51 neighbours have in common; only those above the ninth level are counted.
        """WITH p AS (SELECT place_id, qk17(lon, lat) AS qk FROM {places}),
           q AS (SELECT place_id, qk, left(qk, 9) AS head, cast(conv(qk, 4, 10) AS BIGINT) AS cell FROM p WHERE length(qk) = 17),
           heads AS (SELECT head, count(*) AS n FROM q GROUP BY head),
           levels AS (SELECT head, n, level, left(head, level) AS tile_qk FROM heads LATERAL VIEW explode(sequence(1, 9)) AS level),
           crowded AS (SELECT tile_qk FROM levels GROUP BY tile_qk HAVING sum(n) > 50),
           above AS (SELECT head, max(level) AS level FROM levels LEFT SEMI JOIN crowded USING (tile_qk) GROUP BY head),
           pairs AS (SELECT *, cell ^ lead(cell, 50) OVER (PARTITION BY head ORDER BY cell, place_id) AS apart FROM q),
           shared AS (SELECT *, CASE WHEN apart = 0 THEN 17 WHEN apart > 0 THEN 17 - cast(ceil(length(bin(apart)) / 2) AS INT) END AS level FROM pairs),
           below AS (SELECT place_id, qk, head, max(level) OVER (PARTITION BY head ORDER BY cell, place_id ROWS BETWEEN 50 PRECEDING AND CURRENT ROW) AS level FROM shared)
           SELECT place_id, left(qk, least(coalesce(greatest(below.level, above.level), 0) + 1, 17)) AS tile_qk FROM below LEFT JOIN above USING (head)""",
        places=rows,
    )


@query(
    f"WITH {px.POINTS_SQL}, t AS (SELECT DISTINCT left(qk17, 5) AS tile_qk FROM pts), c AS (SELECT tile_qk || d AS child FROM t, (SELECT unnest(['0', '1', '2', '3']) AS d)), e AS ({px.envelope_sql('child', 'c')}) "
    "SELECT child, left(child, 5) AS parent, _x AS x, _y AS y, round(xmin, 9) AS xmin, round(ymin, 9) AS ymin, round(xmax, 9) AS xmax, round(ymax, 9) AS ymax FROM e"
)
def sql_children(spark, sf_dir):
    """Tiles below others, with their numbers and sides, by the functions of the session."""
    sql_functions.register(spark)
    rows = px.table(spark, sf_dir, "orders").select(px.lon(F.col("o_orderkey")).alias("lon"), px.lat(F.col("o_orderkey")).alias("lat"))
    return spark.sql(
        """WITH t AS (SELECT DISTINCT qk_at(lon, lat, 17) AS qk FROM {places}), five AS (SELECT DISTINCT left(qk, 5) AS tile FROM t),
           e AS (SELECT c.tile_qk AS child, qk_env(c.tile_qk) AS e FROM five, LATERAL qk_children(five.tile) AS c)
           SELECT child, qk_parent(child) AS parent, qk_tile_x(child) AS x, qk_tile_y(child) AS y, round(e.xmin, 9) AS xmin, round(e.ymin, 9) AS ymin, round(e.xmax, 9) AS xmax, round(e.ymax, 9) AS ymax FROM e""",
        places=rows,
    )


#: Boxes of nations made six times as wide and high, as far as the world goes.
WIDE_SQL = "wide AS (SELECT boundary_id AS id, greatest(-180.0, xmin - 2.5 * (xmax - xmin)) AS xmin, least(180.0, xmax + 2.5 * (xmax - xmin)) AS xmax, greatest(-90.0, ymin - 2.5 * (ymax - ymin)) AS ymin, least(90.0, ymax + 2.5 * (ymax - ymin)) AS ymax FROM boxes)"


@query(
    f"WITH {px.POINTS_SQL}, {px.BOXES_SQL}, {WIDE_SQL}, {DENSITY_SQL}, e AS ({px.envelope_sql('tile_qk15', 'dens')}) SELECT b.id, round(coalesce(avg(e.density_score), 0), 9) AS avg_density "
    "FROM wide AS b LEFT JOIN e ON e.xmin <= b.xmax AND e.xmax >= b.xmin AND e.ymin <= b.ymax AND e.ymax >= b.ymin GROUP BY 1"
)
def density_of_large_boxes(spark, sf_dir):
    wide = lambda a, b, end, f: f(F.lit(end), F.col(a) - 2.5 * (F.col(b) - F.col(a)))
    sides = {"xmin": wide("xmin", "xmax", -180.0, F.greatest), "xmax": wide("xmax", "xmin", 180.0, F.least), "ymin": wide("ymin", "ymax", -90.0, F.greatest), "ymax": wide("ymax", "ymin", 90.0, F.least)}
    boxes = px.boxes(spark, sf_dir).select(F.col("boundary_id").alias("id"), *[c.alias(k) for k, c in sides.items()])
    return lookups.box_average(boxes, lookups.pyramid(densities(spark, sf_dir))).withColumn("avg_density", F.round("avg_density", 9))


#: A schema for the records below: a name is required, importance ends at 100, variants have names.
NAMED = {
    "things": {
        "id": "things",
        "defs": {
            "variant": {"type": "object", "required": ["name"], "properties": {"name": {"type": "string"}}},
            "main": {
                "type": "record",
                "record": {
                    "type": "object",
                    "required": ["name"],
                    "properties": {
                        "rkey": {"type": "string", "format": "record-key"}, "name": {"type": "string", "maxLength": 16},
                        "importance": {"type": "integer", "maximum": 100}, "variants": {"type": "array", "items": {"type": "ref", "ref": "#variant"}},
                    },
                },
            },
        },
    }
}


@query(
    "SELECT 'p' || p_partkey AS rkey, v.path, v.rule FROM part, (VALUES (1, '$.name', 'required'), (2, '$.name', 'too long'), (3, '$.importance', 'too large'), (4, '$.variants[].name', 'required')) AS v(k, path, rule) "
    "WHERE CASE k WHEN 1 THEN p_partkey % 5 = 0 WHEN 2 THEN p_partkey % 5 > 0 AND length(p_name) > 16 WHEN 3 THEN p_partkey % 150 > 100 ELSE p_partkey % 3 = 0 END"
)
def record_violations(spark, sf_dir):
    key = F.col("p_partkey")
    fields = {
        "rkey": js.quoted(F.concat(F.lit("p"), key.cast("string"))), "name": F.when(key % 5 > 0, js.quoted(F.col("p_name"))),
        "importance": (key % 150).cast("string"), "variants": F.when(key % 3 == 0, F.lit('[{"name":"a"},{"type":"b"}]')),
    }
    text = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in fields.items()]), F.lit("}"))
    records = px.table(spark, sf_dir, "part").select(F.concat(F.lit("p"), key.cast("string")).alias("rkey"), text.alias("record_json"))
    return schemas.violations(records, NAMED, "things")
