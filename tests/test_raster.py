"""Raster files: every type and predictor there and back, crops that open only their tiles, tags, and jobs that fail."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.sources import raster, tiff

TF = (10.0, 0.0, 600_000.0, 0.0, -10.0, 5_000_000.0)


def arrays(tiles) -> dict:
    out = {}
    for t in tiles.collect():
        a = np.frombuffer(t.data, t.dtype).reshape(t.height, t.width)
        out.setdefault((t.name, t.band), {})[t.r, t.c] = a
    return out


def whole(parts: dict) -> np.ndarray:
    rows = sorted({r for r, _ in parts})
    return np.concatenate([np.concatenate([parts[k] for k in sorted(parts) if k[0] == r], 1) for r in rows], 0)


def written(spark, tmp_path, x: np.ndarray, **more) -> str:
    """x: (bands, H, W)."""
    size, (bands, h, w) = 16, x.shape
    rows = [("a", b + 1, r, c, np.ascontiguousarray(x[b, r : r + size, c : c + size]).tobytes()) for b in range(bands) for r in range(0, h, size) for c in range(0, w, size)]
    tiles = spark.createDataFrame(rows, "name string, band int, r int, c int, data binary").repartition(3)
    raster.write_tiles(tiles, f"{tmp_path}/out", h, w, bands, x.dtype.str, size, **more)
    return f"{tmp_path}/out"


@pytest.mark.parametrize("dtype", ["u1", "i1", "u2", "i2", "u4", "i4", "f4", "f8"])
def test_round_trip(spark, tmp_path, dtype):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2, 37, 50)) * 50 if dtype[0] == "f" else rng.integers(np.iinfo(dtype).min, np.iinfo(dtype).max, (2, 37, 50), endpoint=True)
    x = x.astype(dtype)
    if dtype[0] == "f":
        x[0, 3, 4], x[1, 36, 49] = np.nan, np.inf
    path = written(spark, tmp_path, x, transform=TF, epsg=32632, nodata=7)
    got = arrays(raster.read_tiles(spark, path, tiles_a_task=3))
    assert got.keys() == {("a", 1), ("a", 2)} and len(got["a", 1]) == 12
    for b in (0, 1):
        assert np.array_equal(whole(got["a", b + 1]), x[b], equal_nan=dtype[0] == "f")
    row = raster.read_rasters(spark, path).first()
    assert (row.height, row.width, row.bands, row.dtype, tuple(row.transform), row.epsg, row.nodata) == (37, 50, 2, dtype, TF, 32632, 7.0)


def test_crop_and_bands_open_only_their_tiles(spark, tmp_path):
    x = np.arange(3 * 64 * 64, dtype="f4").reshape(3, 64, 64)
    path = written(spark, tmp_path, x)
    tiles = raster.read_tiles(spark, path, bands=(2,), crop=(20, 30, 10, 40), tiles_a_task=1)
    assert tiles.rdd.getNumPartitions() == 3  # of 48
    assert np.array_equal(whole(arrays(tiles)["a", 2]), x[1, 20:30, 30:64])
    got = {(r.r, r.c): r.v for r in raster.cells(tiles).collect()}
    assert len(got) == 340 and got[20, 30] == x[1, 20, 30] and got[29, 63] == x[1, 29, 63]
    assert raster.read_tiles(spark, path, crop=(200, 0, 5, 5)).count() == 0
    opened = []
    reader = raster.TiffReader({"path": path, "crop": "0,0,16,17"}, False)
    assert list(reader.pushFilters([raster.EqualTo(("band",), 3), raster.In(("r",), (1,))])) == [raster.In(("r",), (1,))]
    for part in reader.partitions():
        opened += part.numbers
    assert opened == [32, 33]


def test_metadata_and_missing_tiles(spark, tmp_path):
    meta = {"scene": "S2A <1> & \"co\"", "offset": -1000, "bands": ["B02", "B03"], "clear": 0.25, "deep": {"x": None}}
    grid = spark.createDataFrame([(7, 1, 0, 0, 5.0), (7, 1, 20, 1, None), (8, 1, 3, 3, 2.5)], "name long, band int, r int, c int, v double")
    tiles = raster.tiled(grid, 40, 20, "i2", 16, missing=-9)
    raster.write_tiles(tiles, f"{tmp_path}/m", 40, 20, 1, "i2", 16, transform=(1.0, 0.5, 3.0, -0.5, -1.0, 4.0), epsg=4326, nodata=-9, metadata=meta, tag="mine")
    rows = {r.name: r for r in raster.read_rasters(spark, f"{tmp_path}/m", "mine").collect()}
    assert rows.keys() == {"7", "8"} and json.loads(rows["7"].metadata) == meta and tuple(rows["8"].transform) == (1.0, 0.5, 3.0, -0.5, -1.0, 4.0) and rows["7"].epsg == 4326
    plain = json.loads(raster.read_rasters(spark, f"{tmp_path}/m", "other").where("name = '7'").first().metadata)
    assert plain["offset"] == "-1000" and json.loads(plain["mine"]) == meta
    cells = {(r.name, r.r, r.c): r.v for r in raster.cells(raster.read_tiles(spark, f"{tmp_path}/m")).collect()}
    assert len(cells) == 1600 and cells["7", 0, 0] == 5 and cells["7", 20, 1] == -9 and cells["8", 3, 3] == 2 and cells["8", 39, 19] == -9


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    written(spark, tmp_path, np.zeros((1, 16, 16), "u1"))
    bad = spark.createDataFrame([("b", 1, 0, 0, b"\x00" * 256), ("c", 1, 0, 0, b"\x00")], "name string, band int, r int, c int, data binary")
    with pytest.raises(Exception, match="reshape|buffer"):
        raster.write_tiles(bad, f"{tmp_path}/out", 16, 16, 1, "u1", 16)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.tif"]


def test_strips_interleaved_bands_and_other_byte_order(spark, tmp_path):
    """A file as other programs write it: big-endian, in strips, bands side by side, horizontally predicted."""
    x = np.random.default_rng(3).integers(0, 60_000, (2, 7, 5)).astype(np.uint16)
    strips = []
    for r in (0, 4):
        rows = x[:, r : r + 4].transpose(1, 2, 0)
        strips.append(zlib.compress(np.diff(rows, axis=1, prepend=np.zeros((len(rows), 1, 2), np.uint16)).astype(">u2").tobytes()))
    at = [8, 8 + len(strips[0])]
    end = at[1] + len(strips[1])
    tags = [(256, 3, 1, 5), (257, 3, 1, 7), (258, 3, 2, (16, 16)), (259, 3, 1, 8), (262, 3, 1, 1), (273, 4, 2, at), (277, 3, 1, 2), (278, 3, 1, 4), (279, 4, 2, [len(s) for s in strips]), (284, 3, 1, 1), (317, 3, 1, 2)]
    out, extra = struct.pack(">H", len(tags)), b""
    base = end + 2 + 12 * len(tags) + 4
    for tag, kind, n, value in tags:
        if n == 1:
            out += struct.pack(">HHIHH", tag, kind, n, value, 0)
        elif kind == 3:
            out += struct.pack(">HHIHH", tag, kind, n, *value)
        else:
            out += struct.pack(">HHII", tag, kind, n, base + len(extra))
            extra += struct.pack(">II", *value)
    (tmp_path / "x.tif").write_bytes(struct.pack(">2sHI", b"MM", 42, end) + b"".join(strips) + out + b"\x00" * 4 + extra)
    got = arrays(raster.read_tiles(spark, f"{tmp_path}/x.tif"))
    assert np.array_equal(whole(got["x", 1]), x[0]) and np.array_equal(whole(got["x", 2]), x[1])
    with pytest.raises(ValueError, match="not a TIFF"), open(__file__, "rb") as f:
        tiff.read_header(f)


def test_large_files_have_wide_offsets(tmp_path):
    with open(tmp_path / "big.tif", "wb") as f:
        w = tiff.Writer(f, 40_000, 40_000, 1, "f4", 512, nodata=float("nan"))
        w.add(0, 39_936, 512, np.full((64, 512), 2.5, "f4"))
        at, data = w.first_bytes(w.close())
        f.seek(at)
        f.write(data)
    with open(tmp_path / "big.tif", "rb") as f:
        h = tiff.read_header(f)
        assert len(h.offsets) == 79 * 79 and (tiff.read_tile(f, h, 78 * 79 + 1) == 2.5).all() and np.isnan(tiff.read_tile(f, h, 0)).all()


def test_a_band_of_layers(spark, tmp_path):
    df = spark.range(3).select(F.concat(F.lit("layer"), "id").alias("name"), F.lit(1).alias("band"), F.lit(0).alias("r"), F.lit(0).alias("c"), F.lit(b"\x01" * 256).alias("data"))
    raster.write_tiles(df, f"{tmp_path}/l", 16, 16, 1, "u1", 16)
    assert sorted(p.name for p in (tmp_path / "l").iterdir()) == ["layer0.tif", "layer1.tif", "layer2.tif"]
    assert raster.read_rasters(spark, f"{tmp_path}/l").count() == 3


def test_cells_that_a_raster_lacks_do_not_come_back(spark, tmp_path):
    rows = [("a", 1, r, c, float(r - c)) for r in range(7) for c in range(20) if r < 5 and c < 12]
    grid = spark.createDataFrame(rows, "name string, band int, r int, c int, v double")
    raster.write_tiles(raster.tiled(grid, 7, 20, "f8", 16, missing=-9e99), str(tmp_path), 7, 20, 1, "f8", 16)
    assert sorted(map(tuple, raster.cells(raster.read_tiles(spark, str(tmp_path), written=True), -9e99).collect())) == rows
    assert raster.cells(raster.read_tiles(spark, str(tmp_path))).count() == 7 * 20


def test_small_files_share_tasks_and_tiles_go_on_over_batches(spark, tmp_path, monkeypatch):
    """70 files of 6 tiles; batches of 7 cells end within tiles, and tiles of an integer type skip cells without a value."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        grid = spark.range(70 * 20 * 40).select((F.col("id") % 70).alias("name"), F.lit(1).alias("band"), (F.col("id") / 70 % 20).cast("int").alias("r"), (F.col("id") / 1400).cast("int").alias("c"))
        grid = grid.withColumn("v", F.when(F.col("c") != 3, (F.col("name") + F.col("r") * 100 + F.col("c")).cast("double")))
        raster.write_tiles(raster.tiled(grid, 20, 40, "i2", 16, missing=-9), str(tmp_path), 20, 40, 1, "i2", 16)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    heads = raster.read_rasters(spark, str(tmp_path))
    assert heads.rdd.getNumPartitions() == 3 and sorted(int(r.name) for r in heads.collect()) == list(range(70))
    tiles = raster.read_tiles(spark, str(tmp_path))
    assert tiles.rdd.getNumPartitions() == 3 and raster.read_tiles(spark, str(tmp_path), tiles_a_task=4).rdd.getNumPartitions() == 105
    got = arrays(tiles)
    r, c = np.mgrid[:20, :40]
    for k in range(70):
        assert np.array_equal(whole(got[str(k), 1]), np.where(c == 3, -9, k + r * 100 + c))
    monkeypatch.setattr(raster, "CELLS_A_TASK", 512)
    assert [len(p.numbers) for p in raster.TiffReader({"path": str(tmp_path)}, False).partitions()] == [2] * 210
