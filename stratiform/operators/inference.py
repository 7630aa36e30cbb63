"""Models over pixels and windows: the caller's ``predict`` takes and returns NumPy arrays, batch by batch.

Weights are the caller's; they travel with the function. Batches are Arrow's, so memory does not follow the raster's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .grids import in_windows

Layers = list[tuple[np.ndarray, np.ndarray]]


def mlp(layers: Layers, last: Callable[[np.ndarray], np.ndarray] | None = None) -> Callable[[np.ndarray], np.ndarray]:
    """A multilayer perceptron with ReLU between its layers (weights, biases)."""

    def predict(x: np.ndarray) -> np.ndarray:
        for i, (w, b) in enumerate(layers):
            x = x @ w + b
            if i < len(layers) - 1:
                x = np.maximum(x, 0.0)
        return last(x) if last else x

    return predict


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def predicted(features: Column, predict: Callable[[np.ndarray], np.ndarray]) -> Column:
    """The model's outputs, as an array, of a column of feature arrays; null for null."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            ok = batch.notna().to_numpy()
            out = pd.Series([None] * len(batch), dtype=object)
            if ok.any():
                found = predict(np.stack(batch[ok].to_numpy()).astype(np.float64))
                out[ok] = pd.Series(list(found), index=out.index[ok])
            yield out

    return run(features)


def windowed(grid: DataFrame, keys: list[str], height: int, width: int, window: int, overlap: int, predict: Callable[[np.ndarray], np.ndarray], context: int = 0, only_where: str | None = None, batch: int = 8, known_only: bool = False) -> DataFrame:
    """A model over overlapping windows, merged by their mean: (keys, r, c, v).

    v is a number or, of several channels, an array; predict takes and returns (n, side, side) or (n, channels, side, side), of
    at most ``batch`` windows. Windows begin every window - overlap cells until the raster is covered. What a window and its
    ``context`` cells lack at the raster's edge is reflected, or, where the slice is no larger than what it lacks on a side,
    repeated from its edge. Windows in which ``only_where`` holds nowhere are left out before anything is exchanged.
    ``known_only`` gives predictions only of cells that the grid has; else those it lacks, which count as 0, have theirs too.

    Cells are packed into square tiles of the stride, tiles go to the windows that need them, windows are predicted as a stream
    and cut at the tiles' borders, and tiles add up their pieces: no cell is copied by itself and no task holds a raster.
    """
    if overlap >= window:
        raise ValueError(f"overlap ({overlap}) must be less than the window ({window})")
    stride, side = window - overlap, window + 2 * context
    single = not isinstance(grid.schema["v"].dataType, T.ArrayType)
    key_fields = [grid.schema[k] for k in keys]
    place = ["tr", "tc"]
    tile = lambda name: F.floor(F.col(name) / stride).cast("int")

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        tr, tc = int(part["tr"].iloc[0]), int(part["tc"].iloc[0])
        v = part["v"].to_numpy(float)[:, None] if single else np.stack([np.asarray(x, float) for x in part["v"]])
        out = np.full((v.shape[1], stride, stride), np.nan)
        out[:, part["r"].to_numpy() - tr * stride, part["c"].to_numpy() - tc * stride] = v.T
        return pd.DataFrame({**{k: [part[k].iloc[0]] for k in keys}, "tr": [tr], "tc": [tc], "channels": [v.shape[1]], "tile": [out.tobytes()]})

    tile_schema = T.StructType([*key_fields, *(T.StructField(n, T.IntegerType()) for n in (*place, "channels")), T.StructField("tile", T.BinaryType())])
    known = grid.where(F.col("v").isNotNull()).withColumns({"tr": tile("r"), "tc": tile("c")})
    tiles = known.groupBy(*keys, *place).applyInPandas(packed, tile_schema)

    def asking(name: str, n: int) -> Column:
        """The windows whose cells, context included, reach into a tile."""
        first = F.greatest(F.ceil((F.col(name) * stride - window - context + 1) / stride), F.lit(0)).cast("int")
        last = F.least(F.floor((F.col(name) * stride + stride - 1 + context) / stride), F.lit(-(-n // stride) - 1)).cast("int")
        return F.explode(F.sequence(first, last))

    sent = tiles.withColumn("wr", asking("tr", height)).withColumn("wc", asking("tc", width))
    if only_where:
        starts = lambda name: F.explode(F.sequence(F.greatest(F.ceil((F.col(name) - window + 1) / F.lit(stride)), F.lit(0)).cast("int"), tile(name)))
        hits = grid.where(only_where).withColumn("wr", starts("r")).withColumn("wc", starts("c")).select(*keys, "wr", "wc").dropDuplicates()
        sent = sent.join(hits, [*keys, "wr", "wc"], "left_semi")
    order = [*keys, "wr", "wc"]
    named = [*keys, "wr", "wc", "tr", "tc", "channels", "tile"]
    sent = sent.select(*named).repartition(*order).sortWithinPartitions(*order)

    def predicted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[tuple, np.ndarray]] = []

        def flushed() -> Iterator[pa.RecordBatch]:
            given = np.stack([x for _, x in waiting])
            found = predict(given[:, 0] if single else given)
            found = np.asarray(found, float).reshape(len(waiting), -1, side, side)[:, :, context : context + window, context : context + window]
            for (at, _), out in zip(waiting, found, strict=True):
                yield pieces(at, out)
            waiting.clear()

        def pieces(at: tuple, out: np.ndarray) -> pa.RecordBatch:
            *own, wr, wc = at
            rows = []
            for tr in range(wr, -(-(min(wr * stride + window, height)) // stride)):
                for tc in range(wc, -(-(min(wc * stride + window, width)) // stride)):
                    r0, c0 = (tr - wr) * stride, (tc - wc) * stride
                    part = out[:, r0 : min(r0 + stride, window, height - wr * stride), c0 : min(c0 + stride, window, width - wc * stride)]
                    rows.append([*own, tr, tc, *part.shape, np.ascontiguousarray(part).tobytes()])
            return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows, strict=True), piece_arrow, strict=True)], schema=piece_arrow)

        at, parts = None, []
        for record in batches:
            for *here, tr, tc, channels, data in zip(*(x.to_pylist() for x in record.columns), strict=True):
                if at is not None and tuple(here) != at:
                    waiting.append((at, _assembled(parts, at[-2], at[-1], stride, window, context, height, width)))
                    parts = []
                    if len(waiting) >= batch:
                        yield from flushed()
                at = tuple(here)
                parts.append((tr, tc, np.frombuffer(data).reshape(channels, stride, stride)))
        if at is not None:
            waiting.append((at, _assembled(parts, at[-2], at[-1], stride, window, context, height, width)))
        if waiting:
            yield from flushed()

    piece_schema = T.StructType([*key_fields, *(T.StructField(n, T.IntegerType()) for n in (*place, "channels", "h", "w")), T.StructField("piece", T.BinaryType())])
    piece_arrow = to_arrow_schema(piece_schema)
    out_v = T.DoubleType() if single else T.ArrayType(T.DoubleType())

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        channels, h, w = int(part["channels"].iloc[0]), int(part["h"].max()), int(part["w"].max())
        total, n = np.zeros((channels, h, w)), np.zeros((h, w))
        for ph, pw, data in zip(part["h"], part["w"], part["piece"], strict=True):  # pieces begin at the tile's corner
            total[:, :ph, :pw] += np.frombuffer(data).reshape(channels, ph, pw)
            n[:ph, :pw] += 1
        r, c = np.nonzero(n)
        v = (total / np.maximum(n, 1))[:, r, c]
        frame = pd.DataFrame({"r": r + int(part["tr"].iloc[0]) * stride, "c": c + int(part["tc"].iloc[0]) * stride, "v": v[0] if single else list(v.T)})
        for k in reversed(keys):
            frame.insert(0, k, part[k].iloc[0])
        return frame

    schema = T.StructType([*key_fields, T.StructField("r", T.LongType()), T.StructField("c", T.LongType()), T.StructField("v", out_v)])
    out = sent.mapInArrow(predicted_windows, piece_schema).groupBy(*keys, *place).applyInPandas(merged, schema)
    return out.join(grid.select(*keys, F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c")).hint("merge"), [*keys, "r", "c"], "left_semi") if known_only else out


def _assembled(parts: list[tuple[int, int, np.ndarray]], wr: int, wc: int, stride: int, window: int, context: int, height: int, width: int) -> np.ndarray:
    """One window with its context from the tiles that it reaches; missing cells are 0."""
    top, left, side = wr * stride - context, wc * stride - context, window + 2 * context
    r0, r1, c0, c1 = max(top, 0), min(top + side, height), max(left, 0), min(left + side, width)
    out = np.zeros((parts[0][2].shape[0], r1 - r0, c1 - c0))
    for tr, tc, tile in parts:
        a0, a1 = max(tr * stride, r0), min(tr * stride + stride, r1)
        b0, b1 = max(tc * stride, c0), min(tc * stride + stride, c1)
        if a0 < a1 and b0 < b1:
            out[:, a0 - r0 : a1 - r0, b0 - c0 : b1 - c0] = np.nan_to_num(tile[:, a0 - tr * stride : a1 - tr * stride, b0 - tc * stride : b1 - tc * stride])
    lack = ((r0 - top, top + side - r1), (c0 - left, left + side - c1))
    mirror = all(out.shape[k + 1] > max(lack[k]) for k in (0, 1))
    return np.pad(out, ((0, 0), *lack), mode="reflect" if mirror else "edge")


def bags(grid: DataFrame, keys: list[str], height: int, width: int, window: int, stride: int) -> DataFrame:
    """Full windows as bags: (keys, wr, wc, values), the cells in their order; windows with a missing cell are left out."""
    rows = in_windows(grid.where(F.col("v").isNotNull()), height, width, window, stride)
    whole = rows.groupBy(*keys, "wr", "wc").agg(F.array_sort(F.collect_list(F.struct("r", "c", "v"))).alias("b"))
    return whole.where(F.size("b") == window * window).select(*keys, "wr", "wc", F.transform("b", lambda x: x["v"]).alias("values"))


def leaky(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x, 0.01 * x)


def layer_norm(x: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    mean, var = x.mean(-1, keepdims=True), x.var(-1, keepdims=True)
    return (x - mean) / np.sqrt(var + 1e-5) * scale + shift


Weights = dict[str, np.ndarray]


def attention_over_bags(w: Weights, heads: int, layers: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A model of bags (n, size, inputs): a shading for each pixel (n, size) and properties for each bag (n, outputs).

    Pixels are encoded alike, see each other by self-attention, and are then read one by one and, averaged, as a bag. Weights by name:
    ``<part>.w``, ``.b`` of linear maps (inputs by outputs), ``<part>.scale``, ``.shift`` of norms, for the parts enc0, enc1,
    att<k>.q, .k, .v, .o, att<k>.norm, ffn<k>.0, .1, .norm, shade0, shade1, pool, glob0, glob1; norms of enc0, enc1, shade0, pool
    and glob0 bear their names.
    """
    linear = lambda name, x: x @ w[f"{name}.w"] + w[f"{name}.b"]
    norm = lambda name, x: layer_norm(x, w[f"{name}.scale"], w[f"{name}.shift"])
    step = lambda name, x: norm(name, leaky(linear(name, x)))

    def attended(name: str, x: np.ndarray) -> np.ndarray:
        n, size, width = x.shape
        q, k, v = (linear(f"{name}.{part}", x).reshape(n, size, heads, width // heads).transpose(0, 2, 1, 3) for part in "qkv")
        scores = q @ k.transpose(0, 1, 3, 2) / np.sqrt(width // heads)
        scores = np.exp(scores - scores.max(-1, keepdims=True))
        mixed = (scores / scores.sum(-1, keepdims=True)) @ v
        return linear(f"{name}.o", mixed.transpose(0, 2, 1, 3).reshape(n, size, width))

    def predict(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = step("enc1", step("enc0", x))
        for k in range(layers):
            x = norm(f"att{k}.norm", x + attended(f"att{k}", x))
            x = norm(f"ffn{k}.norm", x + linear(f"ffn{k}.1", leaky(linear(f"ffn{k}.0", x))))
        shading = linear("shade1", step("shade0", x))[..., 0]
        return shading, np.tanh(linear("glob1", step("glob0", step("pool", x.mean(1)))))

    return predict


def inverted_bags(bags: DataFrame, keys: list[str], predict: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(keys, shading, properties) of bags (keys, pixels), pixels an array of feature arrays; bags of one size are predicted together,
    an Arrow batch at a time. An empty bag has nulls."""
    schema = T.StructType([*(bags.schema[k] for k in keys), T.StructField("shading", T.ArrayType(T.DoubleType())), T.StructField("properties", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pixels = batch.column(len(keys)).to_pylist()
            shading: list = [None] * len(pixels)
            properties: list = [None] * len(pixels)
            sizes = np.array([len(p) if p else 0 for p in pixels])
            for size in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == size)
                found = predict(np.array([pixels[i] for i in at], float))
                for i, one, whole in zip(at, *found, strict=True):
                    shading[i], properties[i] = one.tolist(), whole.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(shading, pa.list_(pa.float64())), pa.array(properties, pa.list_(pa.float64()))], names=[*keys, "shading", "properties"])

    return bags.select(*keys, "pixels").mapInArrow(run, schema)
