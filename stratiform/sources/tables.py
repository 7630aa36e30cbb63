"""Table sources: Parquet by name below a folder, as DataFrames or as temporary views; lineage cut at checkpoints."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def views(spark: SparkSession, folder: str, names: tuple[str, ...] = TABLES) -> None:
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


#: The temporary folder of each application that runs in one process and names none; by application id.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only for a session of one process without one."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = _OWN.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="shared-")
        _OWN[context.applicationId] = found
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once as Parquet below the shared folder and read from there, so that lost executors lose nothing."""
    path = shared_path(df.sparkSession, "cut")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
