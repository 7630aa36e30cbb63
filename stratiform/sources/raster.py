"""Rasters as a Spark data source: GeoTIFF files read tile by tile and written from tiles.

``read_tiles`` gives a row a tile and band; only tiles of the wanted bands that a crop touches become partitions, and of a
file only the header and their bytes are read. ``write_tiles`` writes one file a raster: a raster's tiles are streamed in
order through one task, which holds one tile, into a file beside the target that is moved there when the whole job commits and
deleted when it fails. Files are reached through Arrow's file systems (local paths and URIs).

Cases: tiles at the right and lower edges are smaller; a crop beyond the raster is cut off, one outside gives no rows; a tile
that was never written is nodata; metadata come back with their types from the JSON text that the writer leaves under ``tag``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from . import tiff

TILES = "name string, band int, r int, c int, height int, width int, dtype string, data binary"
RASTERS = "name string, height int, width int, bands int, dtype string, transform array<double>, epsg int, nodata double, metadata string"
TAG, TILE = "metadata", 512
#: Files and cells that a task reads, whichever is full first, and headers that are read at once when tiles are looked up.
FILES_A_TASK, CELLS_A_TASK, HEADERS = 32, 16 * TILE * TILE, 16


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def _files(path: str) -> list[str]:
    """The file, or all TIFF files below a folder, as paths of its file system."""
    fs, at = _opened(path)
    if fs.get_file_info(at).type == pyarrow.fs.FileType.Directory:
        found = fs.get_file_info(pyarrow.fs.FileSelector(at, recursive=True))
        return sorted(f.path for f in found if f.type == pyarrow.fs.FileType.File and f.path.lower().endswith((".tif", ".tiff")))
    return [at]


def _name(file: str) -> str:
    return file.rsplit("/", 1)[-1].rsplit(".", 1)[0]


@dataclass
class TilePart(InputPartition):
    """Files, each with the tiles that are read of it."""

    files: tuple[tuple[str, tuple[int, ...]], ...]

    @property
    def numbers(self) -> tuple[int, ...]:
        return tuple(n for _, numbers in self.files for n in numbers)


class TiffReader(DataSourceReader):
    def __init__(self, options: dict[str, str], rasters: bool):
        self.path, self.rasters = options["path"], rasters
        self.bands = {int(b) for b in options["bands"].split(",")} if options.get("bands") else None
        self.crop = tuple(int(x) for x in options["crop"].split(",")) if options.get("crop") else None
        self.written = options.get("written", "false") == "true"
        self.a_task, self.tag = int(options["tiles_a_task"]) if options.get("tiles_a_task") else None, options.get("tag", TAG)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Conditions on the band narrow the list of partitions."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("band",) and not self.rasters:
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.bands = wanted if self.bands is None else self.bands & wanted
            else:
                yield f

    def _wanted(self, header: tiff.Header, number: int) -> bool:
        if self.written and not header.sizes[number]:
            return False
        plane, row, col = header.place(number)
        planes = range(header.bands) if header.interleaved else (plane,)
        if self.bands is not None and not any(p + 1 in self.bands for p in planes):
            return False
        if self.crop is None:
            return True
        r, c, h, w = self.crop
        return row < r + h and row + header.tile_height > r and col < c + w and col + header.tile_width > c

    def _header(self, file: str) -> tiff.Header:
        fs, _ = _opened(self.path)
        with fs.open_input_file(file) as f:
            return tiff.read_header(f)

    def partitions(self) -> list[TilePart]:
        files = _files(self.path)
        if self.rasters:
            return [TilePart(tuple((f, ()) for f in files[k : k + FILES_A_TASK])) for k in range(0, len(files), FILES_A_TASK)]
        out, held, tiles = [], [], 0
        with ThreadPoolExecutor(HEADERS) as pool:
            for file, header in zip(files, pool.map(self._header, files), strict=True):
                a_tile = header.tile_height * header.tile_width * (header.bands if header.interleaved else 1)
                most = self.a_task or max(1, CELLS_A_TASK // a_tile)
                numbers = [n for n in range(len(header.offsets)) if self._wanted(header, n)]
                while numbers:
                    # a part goes on with the next file while it has room, by that file's size of tiles
                    if held and (tiles >= most or len(held) >= FILES_A_TASK):
                        out.append(TilePart(tuple(held)))
                        held, tiles = [], 0
                    room = most - tiles
                    held.append((file, tuple(numbers[:room])))
                    tiles, numbers = tiles + len(numbers[:room]), numbers[room:]
        return out + ([TilePart(tuple(held))] if held else [])

    def read(self, partition: TilePart) -> Iterator[tuple]:
        if partition is None:  # a folder without a raster
            return
        fs, _ = _opened(self.path)
        for file, numbers in partition.files:
            with fs.open_input_file(file) as f:
                yield from self._rows(f, file, numbers)

    def _rows(self, f: pa.NativeFile, file: str, numbers: tuple[int, ...]) -> Iterator[tuple]:
        header = tiff.read_header(f)
        if self.rasters:
            meta = json.dumps(tiff.described(header.items, self.tag), sort_keys=True)
            yield (_name(file), header.height, header.width, header.bands, header.dtype, list(header.transform) if header.transform else None, header.epsg, header.nodata, meta)
            return
        for n in numbers:
            plane, row, col = header.place(n)
            tile = tiff.read_tile(f, header, n)
            if self.crop is not None:
                r, c, h, w = self.crop
                tile = tile[:, max(r - row, 0) : r + h - row, max(c - col, 0) : c + w - col]
                row, col = max(row, r), max(col, c)
            for k in range(len(tile)):
                if self.bands is None or plane + k + 1 in self.bands:
                    yield (_name(file), plane + k + 1, row, col, *tile.shape[1:], header.dtype, np.ascontiguousarray(tile[k]).tobytes())


@dataclass
class Written(WriterCommitMessage):
    files: tuple[str, ...]


class TiffWriter(DataSourceWriter):
    """Rows (name, head, band, r, c, data) come in whole rasters, sorted; ``head`` is JSON of the header's fields."""

    def __init__(self, options: dict[str, str]):
        self.path, self.size, self.tag = options["path"].rstrip("/"), int(options.get("tile", TILE)), options.get("tag", TAG)
        self.draft = f"{self.path}/_draft-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        fs, at = _opened(self.draft)
        fs.create_dir(at)
        done: list[str] = []
        name, out, stream = None, None, None
        attempt = uuid.uuid4().hex

        def closed() -> None:
            where = out.first_bytes(out.close())
            stream.close()
            _patched(fs, f"{at}/{attempt}-{name}.body", f"{at}/{attempt}-{name}.tif", *where)
            done.append(f"{attempt}-{name}.tif")

        for row in rows:
            if row["name"] != name:
                if name is not None:
                    closed()
                name, head = row["name"], json.loads(row["head"])
                meta = head.pop("metadata") or {}
                items = {self.tag: json.dumps(meta, sort_keys=True)} | {k: str(v) for k, v in meta.items() if isinstance(v, (str, int, float, bool))} if meta else {}
                stream = fs.open_output_stream(f"{at}/{attempt}-{name}.body")
                out = tiff.Writer(stream, size=self.size, items=items, **head)
            h, w = min(self.size, out.height - row["r"]), min(self.size, out.width - row["c"])
            out.add(row["band"] - 1, row["r"], row["c"], np.frombuffer(row["data"], out.dtype).reshape(h, w))
        if name is not None:
            closed()
        return Written(tuple(done))

    def commit(self, messages: list[Written | None]) -> None:
        fs, at = _opened(self.draft)
        _, target = _opened(self.path)
        for m in messages:
            for f in m.files if m else ():
                fs.move(f"{at}/{f}", f"{target}/{f.split('-', 1)[1]}")
        fs.delete_dir(at)

    def abort(self, messages: list[Written | None]) -> None:
        fs, at = _opened(self.draft)
        if fs.get_file_info(at).type == pyarrow.fs.FileType.Directory:
            fs.delete_dir(at)


def _patched(fs: pyarrow.fs.FileSystem, body: str, target: str, offset: int, data: bytes) -> None:
    """The body with its pointer set, copied in pieces, as streams of many stores cannot go back."""
    with fs.open_input_stream(body) as source, fs.open_output_stream(target) as sink:
        head = bytearray(source.read(16))
        head[offset : offset + len(data)] = data
        sink.write(bytes(head))
        while piece := source.read(8 << 20):
            sink.write(piece)
    fs.delete_file(body)


class TiffSource(DataSource):
    """``format("tiff")``; option ``what`` is tiles (default) or rasters."""

    @classmethod
    def name(cls) -> str:
        return "tiff"

    def _rasters(self) -> bool:
        return self.options.get("what", "tiles") == "rasters"

    def schema(self) -> str:
        return RASTERS if self._rasters() else TILES

    def reader(self, schema) -> TiffReader:
        return TiffReader(dict(self.options), self._rasters())

    def writer(self, schema, overwrite: bool) -> TiffWriter:
        return TiffWriter(dict(self.options))


def registered(spark: SparkSession) -> None:
    """Makes the format known to a session and lets conditions reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TiffSource)


def read_tiles(spark: SparkSession, path: str, bands: tuple[int, ...] | None = None, crop: tuple[int, int, int, int] | None = None, tiles_a_task: int | None = None, written: bool = False) -> DataFrame:
    """(name, band from 1, r, c, height, width, dtype, data) of the tiles that hold a part of the crop (row, col, height, width), cut
    to it; data is the tile's numbers, row by row, little-endian. ``written`` leaves out tiles that were never written. A task
    reads tiles of several files up to CELLS_A_TASK cells, or up to ``tiles_a_task`` tiles."""
    registered(spark)
    reader = spark.read.format("tiff").option("written", str(written).lower())
    if tiles_a_task is not None:
        reader = reader.option("tiles_a_task", tiles_a_task)
    if bands is not None:
        reader = reader.option("bands", ",".join(map(str, bands)))
    if crop is not None:
        reader = reader.option("crop", ",".join(map(str, crop)))
    return reader.load(path)


def read_rasters(spark: SparkSession, path: str, tag: str = TAG) -> DataFrame:
    """A row a file: shape, type, affine transform, EPSG code, nodata and metadata as JSON."""
    registered(spark)
    return spark.read.format("tiff").option("what", "rasters").option("tag", tag).load(path)


def cells(tiles: DataFrame, missing: float | None = None) -> DataFrame:
    """(name, band, r, c, v) of every cell of tiles, in batches of about a tile; of those that hold ``missing`` none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v = np.frombuffer(row["data"], row["dtype"]).astype(np.float64)
                at = np.arange(len(v)) if missing is None else np.flatnonzero(v != missing)
                v = v[at]
                columns = [pa.array([row["name"]] * len(v), pa.string()), pa.array(np.full(len(v), row["band"], np.int32)), pa.array((row["r"] + at // row["width"]).astype(np.int32)), pa.array((row["c"] + at % row["width"]).astype(np.int32)), pa.array(v)]
                yield pa.RecordBatch.from_arrays(columns, names=["name", "band", "r", "c", "v"])

    return tiles.mapInArrow(run, "name string, band int, r int, c int, v double")


def tiled(grid: DataFrame, height: int, width: int, dtype: str, size: int = TILE, missing: float = 0.0) -> DataFrame:
    """Tiles (name, band, r, c, data) of cells (name, band from 1, r, c, v); cells that are not there are ``missing``.

    Cells come sorted by tile and are filled in as they stream by, so that a task holds one open tile.
    """
    kind, place = np.dtype(dtype), ["name", "band", "tr", "tc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tile = None, None
        for batch in batches:
            names, done = batch.column("name"), []
            numbers = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("band", "tr", "tc", "r", "c", "v")}
            codes = [names.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False), numbers["band"], numbers["tr"], numbers["tc"]]
            starts = np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in codes], axis=0)])) if batch.num_rows else []
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                here = (names[int(start)].as_py(), *(int(numbers[n][start]) for n in place[1:]))
                r0, c0 = here[2] * size, here[3] * size
                if here != key:
                    done += [(key, tile)] if key else []
                    key, tile = here, np.full((min(size, height - r0), min(size, width - c0)), missing, kind)
                r, c, v = (numbers[n][start:end] for n in ("r", "c", "v"))
                known = slice(None) if kind.kind == "f" else ~np.isnan(v)
                tile[r[known] - r0, c[known] - c0] = v[known].astype(kind)
            if done:
                yield packed(done)
        if key:
            yield packed([(key, tile)])

    def packed(tiles: list[tuple[tuple, np.ndarray]]) -> pa.RecordBatch:
        name, band, tr, tc = zip(*(k for k, _ in tiles), strict=True)
        ints = lambda x, by=1: pa.array(np.array(x, np.int32) * by, pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(name, pa.string()), ints(band), ints(tr, size), ints(tc, size), pa.array([t.tobytes() for _, t in tiles], pa.binary())], names=["name", "band", "r", "c", "data"])

    rows = grid.select(F.col("name").cast("string").alias("name"), F.col("band").cast("int").alias("band"), "r", "c", F.col("v").cast("double").alias("v"))
    rows = rows.withColumns({"tr": F.floor(F.col("r") / size).cast("int"), "tc": F.floor(F.col("c") / size).cast("int")})
    return rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "name string, band int, r int, c int, data binary")


def write_tiles(tiles: DataFrame, path: str, height: int, width: int, bands: int, dtype: str, size: int = TILE, transform: tuple[float, ...] | None = None, epsg: int | None = None, nodata: float | None = None, metadata: dict | None = None, tag: str = TAG) -> None:
    """Writes each raster of tiles (name, band, r, c, data) of one shape and type to ``<path>/<name>.tif``."""
    registered(tiles.sparkSession)
    head = json.dumps({"height": height, "width": width, "bands": bands, "dtype": np.dtype(dtype).str[1:], "transform": transform, "epsg": epsg, "nodata": None if nodata is None else float(nodata), "metadata": metadata})
    rows = tiles.select("name", F.lit(head).alias("head"), "band", "r", "c", "data").repartition("name").sortWithinPartitions("name", "band", "r", "c")
    rows.write.format("tiff").option("tile", size).option("tag", tag).mode("append").save(path)
