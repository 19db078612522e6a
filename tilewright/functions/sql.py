"""The quadkey expressions as SQL functions of a session, so that a build's steps can be written in plain SQL.

After register(spark): qk_at(lon, lat, zoom), qk17(lon, lat), qk_tile_x(qk), qk_tile_y(qk), qk_env(qk) (a struct),
qk_parent(qk), qk_in(qk, tile), and the table functions qk_children(tile) and qk_levels(qk, low, high).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .quadkey import MAX_LATITUDE, ZOOM

_X = "least(floor((lon + 180) / 360 * shiftleft(1L, zoom)), shiftleft(1L, zoom) - 1)"
_S = f"sin(radians(least(greatest(lat, -{MAX_LATITUDE}D), {MAX_LATITUDE}D)))"
_Y = f"greatest(least(floor((0.5D - ln((1 + {_S}) / (1 - {_S})) / (4 * pi())) * shiftleft(1L, zoom)), shiftleft(1L, zoom) - 1), 0L)"
_LAT = "degrees(atan(sinh(pi() * (1 - 2 * {row} / shiftleft(1L, length(qk))))))"

FUNCTIONS = {
    "qk_at(lon DOUBLE, lat DOUBLE, zoom INT) RETURNS STRING": f"CASE WHEN lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 THEN lpad(cast(cast(bin({_X}) AS BIGINT) + 2 * cast(bin({_Y}) AS BIGINT) AS STRING), zoom, '0') END",
    "qk17(lon DOUBLE, lat DOUBLE) RETURNS STRING": f"qk_at(lon, lat, {ZOOM})",
    "qk_tile_x(qk STRING) RETURNS BIGINT": "CASE WHEN qk = '' THEN 0L ELSE cast(conv(translate(qk, '0123', '0101'), 2, 10) AS BIGINT) END",
    "qk_tile_y(qk STRING) RETURNS BIGINT": "CASE WHEN qk = '' THEN 0L ELSE cast(conv(translate(qk, '0123', '0011'), 2, 10) AS BIGINT) END",
    "qk_env(qk STRING) RETURNS STRUCT<xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE>": "named_struct("
    "'xmin', qk_tile_x(qk) / shiftleft(1L, length(qk)) * 360 - 180, "
    f"'ymin', CASE WHEN qk_tile_y(qk) = shiftleft(1L, length(qk)) - 1 THEN -90.0D ELSE {_LAT.format(row='(qk_tile_y(qk) + 1)')} END, "
    "'xmax', (qk_tile_x(qk) + 1) / shiftleft(1L, length(qk)) * 360 - 180, "
    f"'ymax', CASE WHEN qk_tile_y(qk) = 0 THEN 90.0D ELSE {_LAT.format(row='qk_tile_y(qk)')} END)",
    "qk_parent(qk STRING) RETURNS STRING": "left(qk, greatest(length(qk) - 1, 0))",
    "qk_in(qk STRING, tile STRING) RETURNS BOOLEAN": "startswith(qk, tile)",
    "qk_children(tile STRING) RETURNS TABLE (tile_qk STRING)": "SELECT concat(tile, digit) FROM VALUES ('0'), ('1'), ('2'), ('3') AS digits(digit)",
    "qk_levels(qk STRING, low INT, high INT) RETURNS TABLE (level INT, tile_qk STRING)": "SELECT level, left(qk, level) FROM (SELECT explode(sequence(low, high)) AS level)",
}


def register(spark: SparkSession) -> None:
    """Makes FUNCTIONS known to the session; names that are taken are replaced."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
