"""Assignment of places to tiles, and references between divisions and tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quadkey as qk
from ..sources import scratch


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cell, n = np.unique(batch.column("cell").to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])


def _cells(places: DataFrame, high: int) -> DataFrame:
    """cell (a number), n: how many places each tile of the finest level has, in as many rows as batches held some.

    Most cells hold few places, so a task that counted all of its own would keep nearly as many counts as it reads.
    """
    cell = F.substring("qk17", 1, high).cast("long")
    return scratch.saved(places.filter(qk.is_full(F.col("qk17"))).select(cell.alias("cell")).mapInArrow(_counted, "cell long, n long"))


def _tile_runs(cell: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Tiles so many levels above cells in order, and where the run of each begins."""
    tile = cell // 10**steps
    return tile, np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1])))


def _summed(low: int, high: int, values: list[str]):
    """mapInArrow function over cells in order: level, tile, the sums of values, open. A tile at either end of a batch
    is open: it may go on in the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, *numbers = (batch.column(c).to_numpy() for c in ("cell", *values))
            for level in range(low, high + 1) if len(cell) else ():
                tile, starts = _tile_runs(cell, high - level)
                outer = np.zeros(len(starts), bool)
                outer[[0, -1]] = True
                sums = [pa.array(np.add.reduceat(n, starts)) for n in numbers]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), level, np.int32)), pa.array(tile[starts]), *sums, pa.array(outer)], ["level", "tile", *values, "open"])

    return run


def level_sums(cells: DataFrame, low: int, high: int, *values: str) -> DataFrame:
    """level, tile (a number) and the sums of values for every tile from level low to high.

    cells: cell (a tile's number at level high) and values, long or double. They are put in order, and one pass adds
    them up for all levels; only tiles at the ends of its batches are added up again.
    """
    kinds = dict(cells.dtypes)
    dealt = cells.select("cell", *values).repartitionByRange("cell").sortWithinPartitions("cell")
    rows = scratch.saved(dealt.mapInArrow(_summed(low, high, list(values)), "level int, tile long, " + "".join(f"{v} {kinds[v]}, " for v in values) + "open boolean"))
    parts = rows.filter("open").groupBy("level", "tile").agg(*[F.sum(v).alias(v) for v in values])
    return rows.filter("not open").select("level", "tile", *values).union(parts)


def _placed(low: int, high: int, most: int):
    """mapInArrow function over cells in order: cell, full, level, tile, n.

    A row for each cell under a tile of more than `most`: full is the finest level of such a tile, as far as the batch
    tells; level and tile name the finest open tile above the cell (see _summed()) where that has the last word. And a
    row without cell for each open tile, with what the batch has of it. A cell may stand in several rows; those at
    either end of a batch, which may go on in the next one, are open tiles and have no row of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, n = (batch.column(c).to_numpy() for c in ("cell", "n"))
            if not len(cell):
                continue
            cell, starts = _tile_runs(cell, 0)
            cell, n = cell[starts], np.add.reduceat(n, starts)
            full, level, above = np.zeros(len(cell), np.int32), np.zeros(len(cell), np.int32), np.zeros(len(cell), np.int64)
            ends = []
            for k in range(low, high + 1):
                tile, starts = _tile_runs(cell, high - k)
                count, size = np.add.reduceat(n, starts), np.diff(starts, append=len(cell))
                outer = np.zeros(len(starts), bool)
                outer[[0, -1]] = True
                full[np.repeat(~outer & (count > most), size)] = k
                at_end = np.repeat(outer, size)
                level[at_end], above[at_end] = k, tile[at_end]
                ends += [(k, int(tile[s]), int(c)) for s, c in zip(starts[outer], count[outer])]
            some = np.flatnonzero(((full > 0) | (level > 0)) & (level < high))
            known = pa.array(full[some] > 0)
            none = lambda kind: pa.nulls(len(ends), kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[some]), pc.if_else(known, pa.array(full[some]), None), pc.if_else(known, None, pa.array(level[some])), pc.if_else(known, None, pa.array(above[some])), pa.nulls(len(some), pa.int64())], _PLACED
            )
            k, tile, count = zip(*ends)
            yield pa.RecordBatch.from_arrays([none(pa.int64()), none(pa.int32()), pa.array(k, pa.int32()), pa.array(tile, pa.int64()), pa.array(count, pa.int64())], _PLACED)

    return run


_PLACED = ["cell", "full", "level", "tile", "n"]


def cell_counts(places: DataFrame, low: int, high: int) -> DataFrame:
    """level, qk, cnt for every tile from level low to high. Places are counted once, at the finest level."""
    every = level_sums(_cells(places, high), low, high, "n")
    return every.select("level", qk.text(F.col("tile"), F.col("level")).alias("qk"), F.col("n").alias("cnt"))


def assign(places: DataFrame, most: int = 1000, low: int = 6, high: int = 17) -> DataFrame:
    """place_id, tile_qk: the coarsest tile from level low to high that holds at most `most` places, else the finest.

    places: place_id, qk17. The level is chosen per cell of the finest level, so places join once, on their cell. A
    tile that holds too many has only ancestors that do, so a cell's tile lies one level below the finest of those. One
    pass over the cells in order finds it; a few cells ask the tiles that lie over the ends of batches.
    """
    if most < 1 or not 1 <= low <= high <= qk.ZOOM:
        raise ValueError(f"no tiles with most={most}, low={low}, high={high}")
    cells = _cells(places, high).repartitionByRange("cell").sortWithinPartitions("cell")
    found = scratch.saved(cells.mapInArrow(_placed(low, high, most), "cell long, full int, level int, tile long, n long"))
    ends = found.filter("cell is null").groupBy("level", "tile").agg(F.sum("n").alias("n"))
    chain = ends.select("level", "tile", F.explode(F.sequence(F.lit(low), F.col("level"))).alias("up"))
    chain = chain.select("level", "tile", "up", qk.ancestor(F.col("tile"), F.col("level") - F.col("up")).alias("over"))
    crowded = ends.filter(F.col("n") > most).select(F.col("level").alias("up"), F.col("tile").alias("over"))
    asked = chain.join(crowded, ["up", "over"]).groupBy("level", "tile").agg(F.max("up").alias("deepest"))
    told = found.filter("cell is not null").join(asked, ["level", "tile"], "left").select("cell", F.coalesce("full", "deepest").alias("full"))
    outer = asked.filter(F.col("level") == high).select(F.col("tile").alias("cell"), F.col("deepest").alias("full"))
    depth = told.filter("full is not null").union(outer)
    rows = places.filter(qk.is_full(F.col("qk17"))).select("place_id", "qk17", F.substring("qk17", 1, high).cast("long").alias("cell"))
    level = F.least(F.coalesce(F.col("full") + 1, F.lit(low)), F.lit(high))
    return rows.join(depth, "cell", "left").select("place_id", F.substring(F.col("qk17"), F.lit(1), level).alias("tile_qk"))


def top(places: DataFrame, n: int = 10_000, always: Column | None = None) -> DataFrame:
    """The n places of highest importance, ties by place_id, and besides them all for which `always` holds."""
    best = places.orderBy(F.desc_nulls_last("importance"), F.asc("place_id")).limit(n)
    if always is None:
        return best
    ids = best.select("place_id").withColumn("_best", F.lit(True))
    return places.join(ids, "place_id", "left").filter(F.coalesce("_best", F.lit(False)) | F.coalesce(always, F.lit(False))).drop("_best")


def always_shown(subtype: Column) -> Column:
    """Divisions that every summary holds."""
    return subtype.isin("country", "region", "dependency")


def assign_summary(places: DataFrame, n: int = 10_000, most: int = 1000, always: Column | None = None) -> DataFrame:
    """The summary band: the top places in tiles of levels 1 to 5."""
    return assign(top(places, n, always), most, 1, 5)


def bands(regular: DataFrame, summary: DataFrame) -> DataFrame:
    """Both bands; a place may stand in a tile of each."""
    return regular.select("place_id", "tile_qk").unionByName(summary.select("place_id", "tile_qk"))


def repeated(assignments: DataFrame) -> DataFrame:
    """(place_id, tile_qk) that stand more than once: there should be none."""
    return assignments.groupBy("place_id", "tile_qk").agg(F.count("*").alias("n")).filter("n > 1")


def references(covering: DataFrame, tiles: DataFrame) -> DataFrame:
    """place_id, tile_qk: every tile that a boundary's covering reaches.

    A covering tile reaches its ancestors and descendants among the tiles. Both directions are equality joins on
    prefixes of the lengths that occur, never a comparison of every pair.
    """
    cover = covering.select(F.col("boundary_id").alias("place_id"), F.col("tile_qk").alias("cover"))
    grid = tiles.select("tile_qk").distinct()
    up = lambda c: F.explode(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1)))).alias("n")
    head = lambda c: F.substring(F.col(c), F.lit(1), F.col("n"))
    above = cover.select("place_id", "cover", up("cover")).select("place_id", head("cover").alias("tile_qk")).distinct().join(grid, "tile_qk").select("place_id", "tile_qk")
    below = grid.select("tile_qk", up("tile_qk")).select("tile_qk", head("tile_qk").alias("cover")).join(cover, "cover").select("place_id", "tile_qk")
    return above.union(below).distinct()
