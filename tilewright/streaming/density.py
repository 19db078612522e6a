"""Density while points arrive: an extension of the batch operator to streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quadkey as qk


def tile_counts(points: DataFrame, lon: Column, lat: Column, ts: str, zoom: int = 9, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """start, tile_qk, n: points of each window of time and tile; what comes later than `late` is left out.

    Works on a stream (append mode: a window comes out when it can't change any more) and on a table alike.
    """
    rows = points.withWatermark(ts, late).withColumn("tile_qk", F.substring(qk.quadkey(lon, lat), 1, zoom)).filter("tile_qk is not null")
    counts = rows.groupBy(F.window(ts, window).alias("w"), "tile_qk").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("start"), "tile_qk", "n")
