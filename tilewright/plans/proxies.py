"""The driver's tables seen as places, map elements and divisions, in Spark and in SQL alike.

Coordinates follow from integer keys by the same arithmetic on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quadkey as qk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lon(key: Column) -> Column:
    return (key * 7919 % 3600000).cast("double") / 10000 - 180


def lat(key: Column) -> Column:
    return (key * 104729 % 1700000).cast("double") / 10000 - 85


def lon_sql(key: str) -> str:
    return f"(CAST({key} * 7919 % 3600000 AS DOUBLE) / 10000 - 180)"


def lat_sql(key: str) -> str:
    return f"(CAST({key} * 104729 % 1700000 AS DOUBLE) / 10000 - 85)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """place_id, lon, lat, qk17 of every order."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("place_id"), lon(F.col("o_orderkey")).alias("lon"), lat(F.col("o_orderkey")).alias("lat"))
    return rows.withColumn("qk17", qk.quadkey(F.col("lon"), F.col("lat")))


def quadkey_sql(source: str, zoom: int = 17) -> str:
    """A query for source with qk17 from its lon and lat."""
    n = 1 << zoom
    return f"""SELECT * EXCLUDE (_s, _x, _y),
        CASE WHEN lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 THEN array_to_string(list_transform(
            generate_series({zoom - 1}, 0, -1), lambda b: CAST(((_x >> b) & 1) + 2 * ((_y >> b) & 1) AS VARCHAR)), '') END AS qk17
    FROM (SELECT *, least(CAST(floor((lon + 180) / 360 * {n}) AS BIGINT), {n - 1}) AS _x,
                 greatest(least(CAST(floor((0.5 - ln((1 + _s) / (1 - _s)) / (4 * pi())) * {n}) AS BIGINT), {n - 1}), 0) AS _y
          FROM (SELECT *, sin(radians(least(greatest(lat, -{qk.MAX_LATITUDE}), {qk.MAX_LATITUDE}))) AS _s FROM {source}))"""


POINTS_SQL = f"""pts AS ({quadkey_sql(f"(SELECT o_orderkey AS place_id, {lon_sql('o_orderkey')} AS lon, {lat_sql('o_orderkey')} AS lat FROM orders)")})"""


def envelope_sql(column: str, source: str) -> str:
    """A query for source with the tile numbers and bounds of a quadkey column."""
    digit = lambda two: f"list_sum(list_transform(generate_series(1, length({column})), lambda i: CASE WHEN substr({column}, i, 1) IN {two} THEN 1 << (length({column}) - i) ELSE 0 END))"
    lat = lambda row: f"degrees(atan((exp(pi() * (1 - 2 * ({row}) / _n)) - exp(-pi() * (1 - 2 * ({row}) / _n))) / 2))"
    return f"""SELECT * EXCLUDE (_n), _x / _n * 360 - 180 AS xmin, CASE WHEN _y = _n - 1 THEN -90.0::DOUBLE ELSE {lat('_y + 1')} END AS ymin,
        (_x + 1) / _n * 360 - 180 AS xmax, CASE WHEN _y = 0 THEN 90.0::DOUBLE ELSE {lat('_y')} END AS ymax
    FROM (SELECT *, CAST({digit("('1', '3')")} AS BIGINT) AS _x, CAST({digit("('2', '3')")} AS BIGINT) AS _y, pow(2.0, length({column})) AS _n FROM {source})"""


#: A box for every nation: (name, expression over n_nationkey), the same text in both dialects.
BOX = {
    "xmin": "((n_nationkey * 37 % 300) - 150) - (5 + n_nationkey % 7)",
    "xmax": "((n_nationkey * 37 % 300) - 150) + (5 + n_nationkey % 7)",
    "ymin": "((n_nationkey * 23 % 120) - 60) - (4 + n_nationkey % 5)",
    "ymax": "((n_nationkey * 23 % 120) - 60) + (4 + n_nationkey % 5)",
}
BOXES_SQL = "boxes AS (SELECT CAST(n_nationkey AS BIGINT) AS boundary_id, CAST(10 + 5 * (n_nationkey % 3) AS INTEGER) AS level, n_name AS name, " + ", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in BOX.items()) + " FROM nation)"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """boundary_id, level, name and bounds."""
    bounds = [f"cast({v} as double) as {k}" for k, v in BOX.items()]
    return table(spark, sf_dir, "nation").selectExpr("cast(n_nationkey as long) as boundary_id", "cast(10 + 5 * (n_nationkey % 3) as int) as level", "n_name as name", *bounds)


#: Tags for every part: key -> the same CASE in both dialects; null values are left out of the map.
TAG_VALUES = {
    "name": "CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN '  ' ELSE p_name END",
    "amenity": "CASE p_partkey % 7 WHEN 0 THEN 'cafe' WHEN 1 THEN 'bench' WHEN 2 THEN 'parking' END",
    "shop": "CASE p_partkey % 5 WHEN 0 THEN 'bakery' WHEN 1 THEN 'yes' END",
    "leisure": "CASE p_partkey % 17 WHEN 3 THEN 'park' WHEN 4 THEN 'track' END",
    "natural": "CASE p_partkey % 19 WHEN 5 THEN 'peak' WHEN 6 THEN 'tree' END",
    "office": "CASE p_partkey % 23 WHEN 1 THEN 'lawyer' WHEN 2 THEN 'yes' END",
    "building": "CASE p_partkey % 3 WHEN 0 THEN 'house' WHEN 1 THEN 'hotel' END",
    "alt_name": "CASE WHEN p_partkey % 4 = 0 THEN 'Foo;Bar ; ;' || p_name END",
    "name:fr": "CASE WHEN p_partkey % 6 = 0 THEN 'Le ' || p_name END",
    "name:etymology": "CASE WHEN p_partkey % 8 = 0 THEN 'a story' END",
    "name:abbr": "CASE WHEN p_partkey % 9 = 0 THEN p_brand END",
    "name:-1990-2001": "CASE WHEN p_partkey % 10 = 0 THEN 'Old ' || p_brand END",
    "old_name:de": "CASE WHEN p_partkey % 12 = 0 THEN 'Alt;Älter' END",
    "int_name:en": "CASE WHEN p_partkey % 14 = 0 THEN 'not a variant' END",
    "cuisine": "CASE WHEN p_partkey % 15 = 0 THEN 'thai' END",
    "ref": "CASE WHEN p_partkey % 16 = 0 THEN 'R1' END",
}
TAGS_SQL = (
    "tagged AS (SELECT p_partkey AS id, map_from_entries(list_filter(["
    + ", ".join(f"{{'k': '{k}', 'v': {v}}}" for k, v in TAG_VALUES.items())
    + "], lambda e: e.v IS NOT NULL)) AS tags FROM part)"
)


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, tags of every part."""
    entries = F.array(*[F.struct(F.lit(k).alias("k"), F.expr(v).cast("string").alias("v")) for k, v in TAG_VALUES.items()])
    rows = table(spark, sf_dir, "part")
    return rows.select(F.col("p_partkey").alias("id"), F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull())).alias("tags"))
