"""What the corpus operators share: the shared folder, tables that cut lineage, word classes."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six white-space characters; bytes.split() has the same six.
SPACE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


#: The temporary folder of each application that runs in one process and names none; by application id.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only in local mode without one."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if context.applicationId not in _OWN:
            _OWN[context.applicationId] = tempfile.mkdtemp(prefix="shared-")
        found = _OWN[context.applicationId]
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from Parquet in the shared folder: lineage is cut and lost executors lose nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*spent: DataFrame) -> None:
    """Deletes tables of ``written`` that no later result reads, in whatever store they are."""
    for df in spent:
        context = df.sparkSession.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def text_key(text: Column) -> Column:
    """A 128-bit key of an unchanged text, by which verdicts find their rows again; empty for null."""
    return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))


def as_struct(docs: DataFrame) -> Column:
    """A whole row as one column, so that no column of an operator's own can clash with one of the table."""
    return F.struct(*(docs[c] for c in docs.columns))


#: A group is hot when it holds more than one in HOT_PARTS of all rows; so there are never more than HOT_PARTS hot groups.
HOT_PARTS = 1000


def given_verdicts(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of rows with one verdict a key, where a key may hold a large part of all rows.

    ``size`` names the column of groups with the number of rows of each. Verdicts of hot groups, HOT_PARTS at most by the
    definition of hot, are broadcast; the rows of all others, none of which is large, meet theirs in a shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) * HOT_PARTS > F.lit(total)
    hot = F.broadcast(groups.where(is_hot))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(groups.where(~is_hot), key))


def picked(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that chosen names, in the columns of docs, one row for each row of chosen.

    chosen: ``id``, ``text_key`` and ``n``, how many rows of docs have both; of several the one with the least hash stays.
    """
    rows = docs.select(as_struct(docs).alias("doc"), docs[id_col].alias("id"), text_key(docs[text_col].cast("string")).alias("text_key"))
    one = chosen.where("n = 1").select(F.col("id").alias("i"), F.col("text_key").alias("t"))
    on = F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("t"))
    out = rows.join(one, on, "left_semi").select("doc.*")
    several = chosen.where("n > 1").select(F.col("id").alias("i"), F.col("text_key").alias("t"))
    if several.isEmpty():
        return out
    first = rows.join(several, on, "left_semi").groupBy("id", "text_key").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    return out.unionByName(first.select("doc.*"))
