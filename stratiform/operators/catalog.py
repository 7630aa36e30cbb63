"""The run catalog as Parquet tables: staging, status, metadata and statistics.

Parquet has no MERGE, so a change writes the whole table beside the old one and then claims the next number: a small file
``<number>.version`` that names the new folder and is renamed into place but never over another. The highest number holds, so
readers see the old table or the new one, whatever breaks off in between, and of two writers that began from one version the
second finds its number taken and begins anew from the other's result. The KEPT last versions stay for readers that are
still at them. Each change is a DataFrame function of its own (``staged``, ``with_status``, ``upserted``, ``evolved``...), so
it can be tried, joined and explained without a catalog.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

RUNS = "run_id string, scene_id string, scene_path string, crop_window string, status string, staged_at timestamp, started_at timestamp, completed_at timestamp, config_hash string, error string, footprint binary"
SCENES = "scene_id string, product_uri string, satellite string, tile_id string, orbit int, sensing_time timestamp, crs string, sun_zenith double, sun_azimuth double, cloud_fraction double, footprint binary"
#: Versions of a table that stay, the newest included.
KEPT = 3
_NAME = re.compile(r"[a-z][a-z0-9_]*")


def checked_name(name: str) -> str:
    """A name fit for a table or column."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a valid name: {name!r}")
    return name


def run_id(scene_id: Column, crop: Column) -> Column:
    return F.substr(F.sha2(F.concat(scene_id.cast("string"), F.lit(":"), F.coalesce(crop.cast("string"), F.lit(""))), 256), F.lit(1), F.lit(16))


def staged(runs: DataFrame, scenes: DataFrame, now: Column) -> DataFrame:
    """The rows that staging scenes (scene_id, scene_path, crop_window) adds: those whose run is not there yet."""
    new = scenes.withColumn("run_id", run_id(F.col("scene_id"), F.col("crop_window"))).dropDuplicates(["run_id"])
    new = new.join(runs.select("run_id"), "run_id", "left_anti")
    return new.select("run_id", "scene_id", "scene_path", "crop_window", F.lit("staged").alias("status"), now.alias("staged_at"))


def with_status(runs: DataFrame, which: Column, status: str, now: Column, config_hash: str | None = None, error: str | None = None) -> DataFrame:
    """Rows of ``which`` in a new status: the error is always replaced, the hash kept only when done."""
    change = lambda name, value: F.when(which, value).otherwise(F.col(name))
    time = "started_at" if status == "started" else "completed_at"
    new = {"status": change("status", F.lit(status)), "error": change("error", F.lit(error).cast("string")), time: change(time, now)}
    if status == "done":
        new["config_hash"] = change("config_hash", F.lit(config_hash).cast("string"))
    return runs.withColumns(new)


def reset_to_staged(runs: DataFrame, which: Column) -> DataFrame:
    null = lambda name: F.when(which, None).otherwise(F.col(name))
    return runs.withColumns({"status": F.when(which, "staged").otherwise(F.col("status")), "completed_at": null("completed_at"), "error": null("error"), "config_hash": null("config_hash")})


def pending(runs: DataFrame, crop: str | None = None, any_crop: bool = True, force: bool = False) -> DataFrame:
    """Staged and failed runs, with force all of them, of one crop (null matches null) or of any; the oldest first."""
    rows = runs if force else runs.where(F.col("status").isin("staged", "failed"))
    rows = rows if any_crop else rows.where(F.col("crop_window").eqNullSafe(F.lit(crop)))
    return rows.orderBy("staged_at", "run_id")


def stale(runs: DataFrame, config_hash: str) -> DataFrame:
    """Done runs made with another configuration, or with an unknown one."""
    return runs.where(_outdated(config_hash))


def _outdated(config_hash: str) -> Column:
    return (F.col("status") == "done") & ~F.col("config_hash").eqNullSafe(F.lit(config_hash))


def gated(runs: DataFrame, config_hash: str, gate: str = "error", force: bool = False) -> DataFrame:
    """The runs as they are before work begins: those that were left started are staged again, and with ``overwrite`` the
    stale ones too. With ``error`` stale runs are refused, with ``ignore`` left as they are; ``force`` asks for no gate."""
    if gate not in ("error", "overwrite", "ignore"):
        raise ValueError(f"no such gate: {gate!r}")
    ready = runs.withColumn("status", F.when(F.col("status") == "started", "staged").otherwise(F.col("status")))
    if force or gate == "ignore":
        return ready
    if gate == "overwrite":
        return reset_to_staged(ready, _outdated(config_hash))
    n = stale(runs, config_hash).count()
    if n:
        some = [r.run_id for r in stale(runs, config_hash).select("run_id").limit(10).collect()]
        raise RuntimeError(f"{n} done run(s) were made with another configuration, such as {', '.join(map(str, some))}; overwrite or ignore them")
    return ready


def upserted(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The table with the columns that changes supplies replaced or added, other columns kept; new keys are added.

    changes holds a key once; columns of either side alone are null where only the other has the row.
    """
    mine, theirs = [c for c in table.columns if c != key], [c for c in changes.columns if c != key]
    right = changes.select(F.col(key).alias("__key"), F.lit(True).alias("__given"), *(F.col(c).alias(f"__{c}") for c in theirs))
    rows = table.join(right, F.col(key) == F.col("__key"), "full")
    pick = lambda c: F.when(F.col("__given"), F.col(f"__{c}")).otherwise(F.col(c)) if c in mine else F.col(f"__{c}")
    return rows.select(F.coalesce(key, "__key").alias(key), *((pick(c) if c in theirs else F.col(c)).alias(c) for c in [*mine, *(x for x in theirs if x not in mine)]))


def evolved(stats: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Statistics with rows written into them: unseen statistics become columns, named ones are replaced, others stay."""
    for name in rows.columns:
        checked_name(name)
    typed = rows.select("run_id", *((F.col(c).cast("bigint") if c.endswith("n_pixels") else F.col(c).cast("double")).alias(c) for c in rows.columns if c != "run_id"))
    return typed if stats is None else upserted(stats, typed, "run_id")


def status_matrix(results: DataFrame, steps: tuple[str, ...]) -> DataFrame:
    """One row a run: done, FAILED or -- for each step. results: run_id, step, status."""
    shown = F.when(F.col("status") == "completed", "done").when(F.col("status") == "failed", "FAILED").otherwise("--")
    each = [F.coalesce(F.max_by(F.when(F.col("step") == s, shown), F.when(F.col("step") == s, 1)), F.lit("--")).alias(s) for s in steps]
    return results.groupBy("run_id").agg(*each)


class Catalog:
    """A folder with the tables runs, scene_metadata and stats_<step>."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str, rest: str = ""):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{checked_name(name)}{rest}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, name: str) -> list[int]:
        """The numbers that were claimed, in order."""
        path, fs = self._path(name)
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.removesuffix(".version")) for n in names if n.endswith(".version"))

    def _data(self, name: str, version: int) -> str:
        path, fs = self._path(name, f"/{version:012d}.version")
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def table(self, name: str, schema: str | None = None, version: int | None = None) -> DataFrame:
        versions = self._versions(name)
        if not versions:
            if schema is None:
                raise ValueError(f"no table {name!r}")
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.folder}/{name}/{self._data(name, version or versions[-1])}")

    def _claim(self, name: str, version: int, data: str) -> bool:
        """Whether the number was still free. The file is written under a name of its own and renamed, which never replaces."""
        target, fs = self._path(name, f"/{version:012d}.version")
        draft, _ = self._path(name, f"/{data}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(data.encode()))
        out.close()
        context, jvm = self.spark.sparkContext, self.spark.sparkContext._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), context._jsc.hadoopConfiguration())
        never = context._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(draft, target, never)
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):  # another writer was faster
                return False
            raise
        return True

    def change(self, name: str, how: Callable[[DataFrame | None], DataFrame | None], schema: str | None = None) -> None:
        """Replaces a table by how(table), again from the newest version if another writer was faster; None changes nothing."""
        while True:
            versions = self._versions(name)
            before = self.table(name, schema) if versions or schema else None
            rows = how(before)
            if rows is None:
                return
            data = f"v-{uuid.uuid4().hex}"
            rows.write.parquet(f"{self.folder}/{checked_name(name)}/{data}")
            if self._claim(name, versions[-1] + 1 if versions else 1, data):
                for old in versions[: 1 - KEPT]:
                    self._forget(name, old)
                return
            self._delete(name, data)

    def _delete(self, name: str, data: str) -> None:
        path, fs = self._path(name, f"/{data}")
        fs.delete(path, True)

    def _forget(self, name: str, version: int) -> None:
        self._delete(name, self._data(name, version))
        self._delete(name, f"{version:012d}.version")

    def replace(self, name: str, rows: DataFrame) -> None:
        self.change(name, lambda _: rows)

    @property
    def runs(self) -> DataFrame:
        return self.table("runs", RUNS)

    @property
    def scenes(self) -> DataFrame:
        return self.table("scene_metadata", SCENES)

    def _change_runs(self, how: Callable[[DataFrame], DataFrame | None]) -> None:
        self.change("runs", how, RUNS)

    def stage(self, scenes: DataFrame) -> int:
        """Adds runs that are not there yet; returns how many."""
        added = 0

        def how(runs: DataFrame) -> DataFrame | None:
            nonlocal added
            new = staged(runs, scenes, F.current_timestamp())
            added = new.count()
            return runs.unionByName(new, allowMissingColumns=True) if added else None

        self._change_runs(how)
        return added

    def set_status(self, run: str, status: str, config_hash: str | None = None, error: str | None = None) -> None:
        self._change_runs(lambda runs: with_status(runs, F.col("run_id") == run, status, F.current_timestamp(), config_hash, error))

    def set_footprint(self, run: str, wkb: bytes) -> None:
        self._change_runs(lambda runs: runs.withColumn("footprint", F.when(F.col("run_id") == run, F.lit(wkb)).otherwise(F.col("footprint"))))

    def upsert_metadata(self, changes: DataFrame) -> None:
        self.change("scene_metadata", lambda scenes: upserted(scenes, changes, "scene_id"), SCENES)

    def _reset(self, which: Column, how: Callable[[DataFrame], DataFrame]) -> int:
        n = 0

        def change(runs: DataFrame) -> DataFrame | None:
            nonlocal n
            n = runs.where(which).count()
            return how(runs) if n else None

        self._change_runs(change)
        return n

    def reset_stale(self) -> int:
        """Runs that were started and never finished are staged again; returns how many."""
        hung = F.col("status") == "started"
        return self._reset(hung, lambda runs: runs.withColumn("status", F.when(hung, "staged").otherwise(F.col("status"))))

    def reset_to_staged(self, ids: list[str]) -> int:
        which = F.col("run_id").isin(ids)
        return self._reset(which, lambda runs: reset_to_staged(runs, which))

    def to_run(self, config_hash: str, gate: str = "error", force: bool = False, scenes: DataFrame | None = None, crop: str | None = None, any_crop: bool = True) -> DataFrame:
        """The runs to work on. Named scenes are staged if need be and pass both the gate and the choice by status."""
        if scenes is not None:
            self.stage(scenes)
            named = scenes.select(run_id(F.col("scene_id"), F.col("crop_window")).alias("run_id"))
            return self.runs.join(named, "run_id", "left_semi")
        self.reset_stale()  # whatever the gate says then
        self._change_runs(lambda runs: gated(runs, config_hash, gate, force))
        return pending(self.runs, crop, any_crop, force)

    def count_by_status(self) -> DataFrame:
        return self.runs.groupBy("status").count()

    def write_stats(self, step: str, rows: DataFrame) -> None:
        """Nothing happens without a statistic."""
        if len(rows.columns) > 1:
            self.change(f"stats_{checked_name(step)}", lambda stats: evolved(stats, rows))

    def has_stats(self, step: str, run: str) -> bool:
        name = f"stats_{step}"
        return self.exists(name) and not self.table(name).where(F.col("run_id") == run).isEmpty()

    def delete(self, run: str) -> None:
        self._change_runs(lambda runs: runs.where(F.col("run_id") != run))
