"""Rasters sampled at moved places by B-splines of order 0 to 5; beyond the edges the nearest edge counts.

Coefficients are made along rows, then along columns, by strips, and kept as square tiles. The places that one tile of the result asks
of one tile of coefficients travel together, no more than a tile has cells, so that no task holds a raster, whatever the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.algebra import finite
from .grids import at_points, nearest
from .resize import STRIP, spline_coefficients

TILE = 64
#: Cells by which edges are repeated before the inverse filter, whose weight over them is down to 2e-9 (order 5); places farther out are held at their end.
PAD = 24


def basis(order: int, t: np.ndarray) -> np.ndarray:
    """The centred B-spline of an order."""
    half = (order + 1) / 2
    parts = ((-1) ** j * math.comb(order + 1, j) * np.maximum(t + half - j, 0.0) ** order for j in range(order + 2))
    return np.where(np.abs(t) < half, sum(parts) / math.factorial(order), 0.0)


def first_cell(order: int, at: np.ndarray) -> np.ndarray:
    """The first of the order + 1 cells whose splines reach a place."""
    return np.floor(at - (order - 1) / 2).astype(int)


def coefficient_tiles(grid: DataFrame, keys: list[str], height: int, width: int, order: int) -> DataFrame:
    """(keys, tr, tc, tile): tiles of coefficients as bytes of doubles, of the raster with PAD more cells on each side. Missing cells are 0."""
    fields = [grid.schema[k] for k in keys]

    def keyed(frame: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        for k in reversed(keys):
            frame.insert(0, k, part[k].iloc[0])
        return frame

    def across(part: pd.DataFrame) -> pd.DataFrame:
        here, at = np.unique(part["r"].to_numpy(), return_inverse=True)
        x = np.zeros((len(here), width))
        x[at, part["c"].to_numpy()] = part["v"].to_numpy(float)
        c = spline_coefficients(np.pad(x, ((0, 0), (PAD, PAD)), mode="edge"), order)
        n = c.shape[1]
        # one row a strip of columns, so that the exchange moves arrays and not cells
        starts = range(0, n, STRIP)
        rows = [(r, s // STRIP, np.ascontiguousarray(c[i, s : s + STRIP]).tobytes()) for i, r in enumerate(here) for s in starts]
        return keyed(pd.DataFrame(rows, columns=["r", "tc", "line"]), part)

    def down(part: pd.DataFrame) -> pd.DataFrame:
        lines = [np.frombuffer(x) for x in part["line"]]
        x = np.zeros((len(lines[0]), height))
        x[:, part["r"].to_numpy()] = np.stack(lines).T
        c = spline_coefficients(np.pad(x, ((0, 0), (PAD, PAD)), mode="edge"), order).T
        rows = []
        for s in range(0, c.shape[0], TILE):
            tile = np.zeros((TILE, TILE))
            piece = c[s : s + TILE]
            tile[: piece.shape[0], : piece.shape[1]] = piece
            rows.append((s // TILE, int(part["tc"].iloc[0]), tile.tobytes()))
        return keyed(pd.DataFrame(rows, columns=["tr", "tc", "tile"]), part)

    whole = lambda name: F.col(name).cast("int").alias(name)
    rows = grid.where(finite(F.col("v").cast("double"))).select(*keys, whole("r"), whole("c"), F.col("v").cast("double").alias("v"))
    between = T.StructType([*fields, T.StructField("r", T.IntegerType()), T.StructField("tc", T.IntegerType()), T.StructField("line", T.BinaryType())])
    tiles = T.StructType([*fields, T.StructField("tr", T.IntegerType()), T.StructField("tc", T.IntegerType()), T.StructField("tile", T.BinaryType())])
    lines = rows.groupBy(*keys, F.floor(F.col("r") / STRIP).alias("__s")).applyInPandas(across, between)
    return lines.groupBy(*keys, "tc").applyInPandas(down, tiles)


def warped(grid: DataFrame, offsets: DataFrame, keys: list[str], height: int, width: int, order: int = 1, whole_numbers: bool = False) -> DataFrame:
    """(keys, r, c, v): the raster (keys, r, c, v) sampled at (r + dr, c + dc) for each row of offsets (keys, r, c, dr, dc), one a cell.

    Missing offsets are 0; missing cells are 0 under order 2 and more, and leave the others' weights below. Keys are not null.
    ``whole_numbers`` cuts fractions off, as a cast to the raster's own type does.
    """
    if order not in range(6):
        raise ValueError("order must be 0 to 5")
    zero = lambda name: F.when(finite(F.col(name)), F.col(name)).otherwise(0.0)
    places = offsets.select(*keys, "r", "c", (F.col("r") + zero("dr")).cast("double").alias("y"), (F.col("c") + zero("dc")).cast("double").alias("x"))
    if order == 0:
        cell = lambda name: F.floor(F.col(name) + 0.5)
        out = nearest(places, grid.select(*keys, "r", "c", "v"), keys, cell("y"), cell("x"), height, width).select(*keys, "r", "c", "v")
    elif order == 1:
        out = at_points(places, grid, keys, F.col("y"), F.col("x"), height, width).select(*keys, "r", "c", "v")
    else:
        out = _by_splines(places, coefficient_tiles(grid, keys, height, width, order), keys, height, width, order)
    cut = F.when(F.col("v") >= 0, F.floor("v")).otherwise(F.ceil("v")).cast("double")
    return out.withColumn("v", cut) if whole_numbers else out


def _by_splines(places: DataFrame, tiles: DataFrame, keys: list[str], height: int, width: int, order: int) -> DataFrame:
    ends = {"y": height + 2 * PAD - 1, "x": width + 2 * PAD - 1}
    held = lambda name: F.least(F.greatest(F.col(name) + PAD, F.lit(0.0)), F.lit(float(ends[name])))
    asked = places.withColumns({"y": held("y"), "x": held("x")})
    for name, tile in (("y", "tr"), ("x", "tc")):
        first = F.floor(F.col(name) - (order - 1) / 2).cast("int")
        to_tile = lambda c, name=name: F.floor(F.least(F.greatest(c, F.lit(0)), F.lit(ends[name])) / TILE).cast("int")
        asked = asked.withColumn(tile, F.explode(F.sequence(to_tile(first), to_tile(first + order))))
    own = [F.floor(F.col(n) / TILE).cast("int").alias(f"__{n}") for n in ("r", "c")]
    lists = [F.collect_list(F.col(n).cast("int" if n in "rc" else "double")).alias(n) for n in ("r", "c", "y", "x")]
    packed = asked.groupBy(*keys, "tr", "tc", *own).agg(*lists).drop("__r", "__c")
    schema = T.StructType([*(places.schema[k] for k in keys), T.StructField("r", T.IntegerType()), T.StructField("c", T.IntegerType()), T.StructField("part", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                tr, tc = columns["tr"][i].as_py(), columns["tc"][i].as_py()
                tile = np.frombuffer(columns["tile"][i].as_buffer()).reshape(TILE, TILE)
                r, c, y, x = (columns[n][i].values.to_numpy(zero_copy_only=False) for n in ("r", "c", "y", "x"))
                total = np.zeros(len(r))
                top, left = first_cell(order, y), first_cell(order, x)
                for a in range(order + 1):
                    row = np.clip(top + a, 0, ends["y"]) - tr * TILE
                    wy = basis(order, y - (top + a)) * ((row >= 0) & (row < TILE))
                    for b in range(order + 1):
                        col = np.clip(left + b, 0, ends["x"]) - tc * TILE
                        w = wy * basis(order, x - (left + b)) * ((col >= 0) & (col < TILE))
                        total += w * tile[np.clip(row, 0, TILE - 1), np.clip(col, 0, TILE - 1)]
                given = [pa.array([columns[k][i].as_py()] * len(r), arrow.field(k).type) for k in keys]
                yield pa.RecordBatch.from_arrays([*given, pa.array(r, pa.int32()), pa.array(c, pa.int32()), pa.array(total)], schema=arrow)

    met = packed.join(tiles, [*keys, "tr", "tc"]).select(*keys, "tr", "tc", "r", "c", "y", "x", "tile")
    return met.mapInArrow(weighed, schema).groupBy(*keys, "r", "c").agg(F.sum("part").alias("v"))
