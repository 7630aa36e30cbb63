"""Scene products: folders ``*.SAFE`` found, their XML metadata as columns, crops, point clouds and lookup tables.

Pixel files (JP2, GeoTIFF, GRIB) need a decoder that is not at hand; ``binaryFile`` rows of them can be handed to one.
"""

from __future__ import annotations

import json
import re
from xml.parsers import expat

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import cut


def metadata_files(spark: SparkSession, folder: str) -> DataFrame:
    """(scene, path, xml) of every metadata file of the products below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.SAFE/", 1).alias("scene"), "path", F.decode("content", "UTF-8").alias("xml")).where("scene <> ''")


def exactly_one(files: DataFrame, keys: list[str]) -> DataFrame:
    """One path a key; none or several of them are an error that names the key."""
    n = F.count(F.lit(1))
    return files.groupBy(*keys).agg(F.when(n == 1, F.min("path")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("several files for"), *keys))).alias("path"))


#: Elements whose first appearance counts, by (parent, name) or by name alone.
_ELEMENTS = {
    "SENSING_ORBIT_DIRECTION": "orbit_direction", "PRODUCT_URI": "product_uri", "DATATAKE_SENSING_START": "start", "SENSING_TIME": "sensing", "QUANTIFICATION_VALUE": "quantification",
    ("Mean_Sun_Angle", "ZENITH_ANGLE"): "sun_zenith", ("Mean_Sun_Angle", "AZIMUTH_ANGLE"): "sun_azimuth",
}
_NUMBERS = ("quantification", "sun_zenith", "sun_azimuth")


_OFFSETS = T.ArrayType(T.StructType([T.StructField("band_idx", T.StringType()), T.StructField("offset", T.StringType())]))


@F.udf(T.StructType([*(T.StructField(n, T.DoubleType() if n in _NUMBERS else T.StringType()) for n in _ELEMENTS.values()), T.StructField("offsets", _OFFSETS)]), useArrow=True)
def parsed(xml: str | None) -> dict | None:
    """What the functions below need of a document, which is read once; absent text is null and an absent number NaN."""
    if not xml:
        return None
    path, taking, found, offsets = [], [], {}, []

    def start(name: str, attributes: dict[str, str]) -> None:
        field = _ELEMENTS.get(name) or _ELEMENTS.get((path[-1] if path else "", name))
        path.append(name)
        if field and field not in found:
            found[field] = ""
            taking.append((len(path), field))
        if name == "RADIO_ADD_OFFSET":
            offsets.append({"band_idx": attributes.get("band_id"), "offset": ""})

    def text(data: str) -> None:
        for _, field in taking:
            found[field] += data
        if path[-1] == "RADIO_ADD_OFFSET":
            offsets[-1]["offset"] += data

    def end(_: str) -> None:
        while taking and taking[-1][0] >= len(path):
            taking.pop()
        path.pop()

    reader = expat.ParserCreate()
    reader.StartElementHandler, reader.CharacterDataHandler, reader.EndElementHandler = start, text, end
    reader.Parse(xml, True)
    number = lambda x: float(x) if re.fullmatch(r"\s*-?(\d+\.?\d*|\.\d+)\s*", x) else float("nan")
    values = {field: number(found.get(field, "")) if field in _NUMBERS else found.get(field) or None for field in _ELEMENTS.values()}
    return values | {"offsets": offsets}


def sun_angles(xml: Column) -> dict[str, Column]:
    found = parsed(xml)
    return {"sun_zenith": found["sun_zenith"], "sun_azimuth": found["sun_azimuth"]}


def circular_mean(degrees: Column) -> Column:
    """The direction of the sum of unit vectors, within 0..360 degrees."""
    return F.pmod(F.degrees(F.atan2(F.sum(F.sin(F.radians(degrees))), F.sum(F.cos(F.radians(degrees))))) + 360, F.lit(360.0))


def view_angles(scenes: DataFrame, key: str = "scene", xml: str = "xml") -> DataFrame:
    """Mean zenith and circular mean azimuth over the bands of each scene."""
    each = scenes.select(key, F.explode(F.arrays_zip(F.xpath(xml, F.lit("//Mean_Viewing_Incidence_Angle/ZENITH_ANGLE/text()")), F.xpath(xml, F.lit("//Mean_Viewing_Incidence_Angle/AZIMUTH_ANGLE/text()")))).alias("a"))
    return each.groupBy(key).agg(F.avg(F.col("a")["0"].cast("double")).alias("view_zenith"), circular_mean(F.col("a")["1"].cast("double")).alias("view_azimuth"))


def product_metadata(xml: Column) -> dict[str, Column]:
    """Orbit direction, product name, quantification and sensing time, which has a second place to look in."""
    found = parsed(xml)
    return {
        "orbit_direction": found["orbit_direction"], "product_uri": found["product_uri"], "quantification": found["quantification"],
        "sensing_time": F.to_timestamp(F.coalesce(found["start"], found["sensing"])),
    }


def radiometric_offsets(scenes: DataFrame, key: str = "scene", xml: str = "xml") -> DataFrame:
    """(scene, band_idx, offset) of products that name offsets."""
    return _offset_rows(scenes.select(key, parsed(F.col(xml))["offsets"].alias("offsets")), key)


def _offset_rows(found: DataFrame, key: str) -> DataFrame:
    return found.select(key, F.explode("offsets").alias("o")).select(key, F.col("o.band_idx").cast("int").alias("band_idx"), F.nullif(F.col("o.offset"), F.lit("")).cast("double").alias("offset"))


def radiometry(scenes: DataFrame, key: str = "scene", xml: str = "xml") -> tuple[DataFrame, DataFrame]:
    """Quantification (scene, quantification) and offsets (scene, band_idx, offset) for ``reflectance``; documents are read once for both."""
    found = parsed(F.col(xml))
    read = cut(scenes.select(key, found["quantification"].alias("quantification"), found["offsets"].alias("offsets")))
    return read.select(key, "quantification"), _offset_rows(read, key)


def spectral_bands(scenes: DataFrame, key: str = "scene", xml: str = "xml") -> DataFrame:
    """(scene, band_idx, band, name): which band a number in the metadata stands for, as B02, and as the file names it, as B2."""
    zipped = F.arrays_zip(F.xpath(xml, F.lit("//Spectral_Information/@bandId")), F.xpath(xml, F.lit("//Spectral_Information/@physicalBand")))
    rows = scenes.select(key, F.explode(zipped).alias("b")).select(key, F.col("b")["0"].cast("int").alias("band_idx"), F.col("b")["1"].alias("name"))
    return rows.select(key, "band_idx", F.regexp_replace("name", r"^B(\d)$", "B0$1").alias("band"), "name")


def reflectance(pixels: DataFrame, quantification: DataFrame, offsets: DataFrame, key: str = "scene") -> DataFrame:
    """The pixels (scene, band_idx, dn and more) with their reflectance: offset by band (scene, band_idx, offset; none is 0), over the
    scene's quantification (scene, quantification); null where dn is 0, which is no data.

    Neither is broadcast: Spark takes the size of metadata from files and columns it guesses, and scenes may be millions."""
    rows = pixels.join(offsets.hint("merge"), [key, "band_idx"], "left").join(quantification.hint("merge"), key)
    value = (F.col("dn") + F.coalesce("offset", F.lit(0.0))) / F.col("quantification")
    return rows.withColumn("reflectance", F.when(F.col("dn") != 0, value)).drop("offset", "quantification")


def angle_grid(scenes: DataFrame, path: str, key: str = "scene", xml: str = "xml") -> DataFrame:
    """(scene, r, c, v) of a matrix of VALUES rows; NaN becomes null."""
    rows = scenes.select(key, F.posexplode(F.xpath(xml, F.lit(f"{path}//VALUES/text()"))).alias("r", "line"))
    cells = rows.select(key, "r", F.posexplode(F.split(F.trim("line"), r"\s+")).alias("c", "x"))
    v = F.col("x").cast("double")
    return cells.select(key, "r", "c", F.when(~F.isnan(v), v).alias("v"))


def cropped(pixels: DataFrame, crop: tuple[int, int, int, int], scale: float = 1.0) -> DataFrame:
    """Pixels in a crop (row, col, height, width of the reference band), scaled to a band's own grid and truncated."""
    r, c, h, w = (int(x * scale) for x in crop)
    return pixels.where(F.col("r").between(r, r + h - 1) & F.col("c").between(c, c + w - 1))


def write_points(points: DataFrame, path: str, metadata: dict) -> None:
    """A point cloud as Parquet, its metadata in the schema of every column."""
    text = json.dumps(metadata, sort_keys=True)
    points.select(*(F.col(c).alias(c, metadata={"points": text}) for c in points.columns)).write.parquet(path)


def read_points(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    points = spark.read.parquet(path)
    text = next((f.metadata["points"] for f in points.schema.fields if "points" in f.metadata), "{}")
    return points, json.loads(text)


def direct_transmission(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A transmission table, columns and direct rows only; both reach the scan."""
    return spark.read.parquet(path).where("mode = 'direct' AND angle = 0").select(*columns)


def training_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Rows of one split; of a table partitioned by it, only its files are read."""
    return spark.read.parquet(path).where(F.col("split") == split)


def write_layer(layer: DataFrame, path: str) -> None:
    """Tiles or pixels of bands, one folder a band."""
    layer.write.partitionBy("band").parquet(path)


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Step results of scene manifests: one row a run and step."""
    read = spark.read.option("multiLine", "true").json(folder, schema="run_id string, steps array<struct<step:string, status:string, config_hash:string, duration_seconds:double>>")
    return read.select("run_id", F.explode("steps").alias("s")).select("run_id", "s.*")
