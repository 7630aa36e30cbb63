"""The TIFF container: headers, tiles and predictors as NumPy arrays, one tile at a time. Used by ``raster`` within tasks.

Little- and big-endian files, classic and BigTIFF, tiles and strips, bands apart or interleaved, stored plainly or deflated, with
no, the horizontal or the floating-point predictor are read. Files are written in tiles, bands apart, deflated, with the
predictor that suits the type, as BigTIFF where a classic file could grow too large.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from dataclasses import dataclass, field
from typing import BinaryIO
from xml.sax.saxutils import escape, unescape

import numpy as np

# Fixed values of the format: field types with their struct codes, and the numbers of the tags used here.
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_BYTES, SAMPLE_FORMAT = 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, TRANSFORMATION, GEO_KEYS, ITEMS, NODATA = 33550, 33922, 34264, 34735, 42112, 42113
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946
KINDS = {1: "u", 2: "i", 3: "f"}


@dataclass(frozen=True)
class Header:
    """What a file says of itself. Tiles are numbered band by band (all bands at once where they are interleaved), row by row."""

    height: int
    width: int
    bands: int
    dtype: str
    tile_height: int
    tile_width: int
    compression: int
    predictor: int
    interleaved: bool
    order: str
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]
    transform: tuple[float, ...] | None = None
    epsg: int | None = None
    nodata: float | None = None
    items: dict[str, str] = field(default_factory=dict)

    @property
    def across(self) -> int:
        return -(-self.width // self.tile_width)

    @property
    def down(self) -> int:
        return -(-self.height // self.tile_height)

    def place(self, number: int) -> tuple[int, int, int]:
        """(first band, first row, first column) of a tile."""
        plane, at = divmod(number, self.across * self.down)
        return plane, at // self.across * self.tile_height, at % self.across * self.tile_width


def read_header(f: BinaryIO) -> Header:
    f.seek(0)
    start = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    version = struct.unpack(f"{order}H", start[2:4])[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    at = struct.unpack(f"{order}Q", start[8:16])[0] if big else struct.unpack(f"{order}I", start[4:8])[0]
    count_code, entry, pointer = ("Q", 20, "Q") if big else ("H", 12, "I")
    room = struct.calcsize(pointer)
    f.seek(at)
    n = struct.unpack(order + count_code, f.read(struct.calcsize(count_code)))[0]
    raw, tags = f.read(n * entry), {}
    for k in range(n):
        tag, kind, count = struct.unpack(f"{order}HH{pointer}", raw[k * entry : k * entry + 4 + room])
        if kind not in TYPES:
            continue
        code = f"{order}{count}s" if kind == 2 else order + TYPES[kind] * count
        size, value = struct.calcsize(code), raw[k * entry + 4 + room : (k + 1) * entry]
        if size > room:
            f.seek(struct.unpack(order + pointer, value)[0])
            value = f.read(size)
        tags[tag] = struct.unpack(code, value[:size])
    return _header(tags, order)


def _header(tags: dict[int, tuple], order: str) -> Header:
    one = lambda tag, default=None: tags[tag][0] if tag in tags else default
    height, width, bands = one(HEIGHT), one(WIDTH), one(SAMPLES, 1)
    if len(set(tags.get(BITS, (1,)))) > 1 or len(set(tags.get(SAMPLE_FORMAT, (1,)))) > 1:
        raise ValueError("bands of several types in one file")
    tiled = TILE_OFFSETS in tags
    text = lambda tag: tags[tag][0].split(b"\x00")[0].decode("utf-8", "replace") if tag in tags else ""
    transform = None
    if TRANSFORMATION in tags:
        m = tags[TRANSFORMATION]
        transform = (m[0], m[1], m[3], m[4], m[5], m[7])
    elif PIXEL_SCALE in tags and TIE_POINT in tags:
        (sx, sy, *_), (i, j, _, x, y, *_) = tags[PIXEL_SCALE], tags[TIE_POINT]
        transform = (sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy)
    keys = tags.get(GEO_KEYS, ())
    geo = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    nodata = text(NODATA).strip()
    items = {unescape(k): unescape(v) for k, v in re.findall(r'<Item name="([^"]*)"[^>]*>(.*?)</Item>', text(ITEMS), re.S)}
    return Header(
        height, width, bands, KINDS[one(SAMPLE_FORMAT, 1)] + str(one(BITS, 1) // 8), one(TILE_HEIGHT) if tiled else min(one(ROWS_PER_STRIP, height), height), one(TILE_WIDTH) if tiled else width,
        one(COMPRESSION, PLAIN), one(PREDICTOR, 1), one(PLANAR, 1) == 1 and bands > 1, order, tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tags[TILE_BYTES if tiled else STRIP_BYTES], transform,
        geo.get(3072) or geo.get(2048), float(nodata) if nodata else None, items,
    )


def read_tile(f: BinaryIO, header: Header, number: int) -> np.ndarray:
    """(bands in the tile, rows, columns) without the padding at the raster's right and lower edge; only its bytes are read."""
    _, row, col = header.place(number)
    rows, cols = min(header.tile_height, header.height - row), min(header.tile_width, header.width - col)
    depth = header.bands if header.interleaved else 1
    kind = np.dtype(header.dtype)
    if header.sizes[number] == 0:  # a tile that was never written
        return np.full((depth, rows, cols), 0 if header.nodata is None else header.nodata, kind)
    f.seek(header.offsets[number])
    data = f.read(header.sizes[number])
    if header.compression in (DEFLATE, OLD_DEFLATE):
        data = zlib.decompress(data)
    elif header.compression != PLAIN:
        raise ValueError(f"compression {header.compression} is not read")
    lines = len(data) // (header.tile_width * depth * kind.itemsize)  # a last strip has fewer
    if header.predictor == 3:
        planes = np.frombuffer(data, np.uint8).reshape(lines, -1)
        planes = np.add.accumulate(planes.reshape(lines, -1, depth), axis=1, dtype=np.uint8).reshape(lines, kind.itemsize, -1)
        out = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(lines, header.tile_width, depth).astype(kind)
    else:
        out = np.frombuffer(data, kind.newbyteorder(header.order)).reshape(lines, header.tile_width, depth).astype(kind)
        if header.predictor == 2:
            out = np.add.accumulate(out, axis=1, dtype=kind)
    return np.ascontiguousarray(out[:rows, :cols].transpose(2, 0, 1))


def packed_tile(tile: np.ndarray, size: int, predictor: int) -> bytes:
    """A tile of one band, padded by its edge to size x size, with the predictor applied, deflated."""
    tile = np.pad(tile, [(0, size - n) for n in tile.shape], mode="edge")
    if predictor == 3:
        planes = tile.astype(tile.dtype.newbyteorder(">")).view(np.uint8).reshape(size, size, -1).transpose(0, 2, 1).reshape(size, -1)
        data = np.diff(planes, axis=1, prepend=np.zeros((size, 1), np.uint8))
    else:
        data = np.diff(tile, axis=1, prepend=np.zeros((size, 1), tile.dtype)).astype(tile.dtype.newbyteorder("<"))
    return zlib.compress(data.tobytes(), 6)


class Writer:
    """A file that takes its tiles in any order and ends with its header, so that no more than one tile is held."""

    def __init__(self, f: BinaryIO, height: int, width: int, bands: int, dtype: str, size: int, transform: tuple[float, ...] | None = None, epsg: int | None = None, nodata: float | None = None, items: dict[str, str] | None = None):
        if size % 16:
            raise ValueError("a tile's side must be a multiple of 16")
        self.f, self.height, self.width, self.bands, self.size = f, height, width, bands, size
        self.dtype, self.transform, self.epsg, self.nodata, self.items = np.dtype(dtype), transform, epsg, nodata, items or {}
        self.predictor = 3 if self.dtype.kind == "f" else 2
        self.big = height * width * bands * self.dtype.itemsize > 1 << 31
        self.at, n = 0, -(-height // size) * -(-width // size) * bands
        self.offsets, self.sizes = [0] * n, [0] * n
        self._put(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0) if self.big else struct.pack("<2sHI", b"II", 42, 0))

    def _put(self, data: bytes) -> int:
        at, self.at = self.at, self.at + len(data)
        self.f.write(data)
        return at

    def add(self, band: int, row: int, col: int, tile: np.ndarray) -> None:
        across = -(-self.width // self.size)
        number = (band * -(-self.height // self.size) + row // self.size) * across + col // self.size
        data = packed_tile(np.asarray(tile, self.dtype), self.size, self.predictor)
        self.offsets[number], self.sizes[number] = self._put(data), len(data)

    def close(self) -> int:
        """Writes the header's fields and returns where the file's first bytes must point to, since streams cannot go back."""
        wide, pointer, room = (16, "Q", 8) if self.big else (4, "I", 4)
        kind = {v: k for k, v in KINDS.items()}[self.dtype.kind]
        fields: list[tuple[int, int, tuple]] = [
            (WIDTH, 4, (self.width,)), (HEIGHT, 4, (self.height,)), (BITS, 3, (self.dtype.itemsize * 8,) * self.bands), (COMPRESSION, 3, (DEFLATE,)), (PHOTOMETRIC, 3, (1,)), (SAMPLES, 3, (self.bands,)),
            (PLANAR, 3, (2,)), (PREDICTOR, 3, (self.predictor,)), (TILE_WIDTH, 3, (self.size,)), (TILE_HEIGHT, 3, (self.size,)), (TILE_OFFSETS, wide, tuple(self.offsets)), (TILE_BYTES, wide, tuple(self.sizes)),
            (SAMPLE_FORMAT, 3, (kind,) * self.bands),
        ]
        if self.transform:
            a, b, c, d, e, f = self.transform
            if b == d == 0:
                fields += [(PIXEL_SCALE, 12, (a, -e, 0.0)), (TIE_POINT, 12, (0.0, 0.0, 0.0, c, f, 0.0))]
            else:
                fields.append((TRANSFORMATION, 12, (a, b, 0.0, c, d, e, 0.0, f, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)))
        if self.epsg:
            degrees = self.epsg == 4326
            fields.append((GEO_KEYS, 3, (1, 1, 0, 3, 1024, 0, 1, 2 if degrees else 1, 1025, 0, 1, 1, 2048 if degrees else 3072, 0, 1, self.epsg)))
        if self.items:
            xml = "<GDALMetadata>" + "".join(f'<Item name="{escape(k, {chr(34): "&quot;"})}">{escape(v)}</Item>' for k, v in self.items.items()) + "</GDALMetadata>"
            fields.append((ITEMS, 2, (xml.encode() + b"\x00",)))
        if self.nodata is not None:
            fields.append((NODATA, 2, (repr(float(self.nodata)).encode() + b"\x00",)))
        entries = []
        for tag, code, values in sorted(fields):
            data = values[0] if code == 2 else struct.pack("<" + TYPES[code] * len(values), *values)
            if len(data) > room:
                if self.at % 2:
                    self._put(b"\x00")
                data = struct.pack("<" + pointer, self._put(data))
            entries.append(struct.pack("<HH" + pointer, tag, code, len(values[0]) if code == 2 else len(values)) + data.ljust(room, b"\x00"))
        if self.at % 2:
            self._put(b"\x00")
        return self._put(struct.pack("<Q" if self.big else "<H", len(entries)) + b"".join(entries) + bytes(room))

    def first_bytes(self, at: int) -> tuple[int, bytes]:
        """(offset, bytes) of the pointer to the header's fields."""
        return (8, struct.pack("<Q", at)) if self.big else (4, struct.pack("<I", at))


def described(items: dict[str, str], tag: str) -> dict:
    """The items of a file; those that the JSON text of one item holds come with their types, and go before plain ones."""
    try:
        bundle = json.loads(items.get(tag, ""))
    except ValueError:
        bundle = {}
    bundle = bundle if isinstance(bundle, dict) else {}
    return {k: v for k, v in items.items() if k != tag and k not in bundle} | bundle
