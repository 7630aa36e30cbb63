"""Projects: a folder with a configuration, a catalog of runs, and the results of a workflow's steps.

A step is a table function: it takes the tables of its inputs and the runs to work on, and returns rows with their run_id. It is
called once for all runs that need it, so that Spark works on scenes side by side. If that fails, the runs are halved until those
that fail stand alone; they are marked as failed with their error, and the others go on. Results are written beside what is
there, and count only once the step's record is committed; so a broken job leaves nothing, and a later one resumes where the
records say.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.catalog import Catalog, run_id
from .workflow import Step, Workflow, config_hash

RESULTS = "run_id string, step string, status string, config_hash string, result string, duration_seconds double, error string, at timestamp"
#: A step's function: (tables by token, runs, configuration) to rows with run_id.
Process = Callable[[dict[str, DataFrame], DataFrame, dict], DataFrame]
PROCESSORS: dict[str, Process] = {}


def processor(name: str) -> Callable[[Process], Process]:
    """Registers the function of the steps of that name."""

    def add(f: Process) -> Process:
        PROCESSORS[name] = f
        return f

    return add


def config_text(config: dict, computed: tuple[str, ...] = ()) -> str:
    """A configuration as YAML, a line a key in order, values in flow style; computed keys are left out."""
    return "".join(f"{k}: {json.dumps(v)}\n" for k, v in sorted(config.items()) if k not in computed)


def parsed_config(text: str) -> dict:
    """Flat YAML: a line a key, values in flow style or plain words; comments and empty lines do not count."""
    out = {}
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        key, mark, value = line.partition(":")
        if not mark or key != key.strip():
            raise ValueError(f"not a line of a configuration: {line!r}")
        try:
            out[key] = json.loads(value)
        except ValueError:
            out[key] = {"": None, "~": None}.get(value.strip(), value.strip().strip("'"))
    return out


@dataclass
class Project:
    spark: SparkSession
    folder: str
    config: dict = field(default_factory=dict)

    @classmethod
    def init(cls, spark: SparkSession, folder: str, name: str, workflow: Workflow, stats: tuple[str, ...] = ()) -> Project:
        """A new project; its folder must not hold one."""
        project = cls(spark, folder.rstrip("/"))
        if project._exists():
            raise FileExistsError(f"{folder} holds a project already")
        steps = [{"name": s.name, "inputs": list(s.inputs), "output": s.output, "ephemeral": s.ephemeral, "config": s.config} for s in workflow.steps]
        project.config = {"name": name, "stats": list(stats), "steps": steps}
        project._save()
        return project

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Project:
        project = cls(spark, folder.rstrip("/"))
        if not project._exists():
            raise FileNotFoundError(f"{folder} holds no project")
        project.config = parsed_config("\n".join(r.value for r in spark.read.text(f"{project.folder}/project.yaml").collect()))
        return project

    def clone(self, folder: str, name: str) -> Project:
        """Configuration and scenes in another folder, all of them staged anew; results stay behind."""
        other = Project.init(self.spark, folder, name, self.workflow, tuple(self.config["stats"]))
        if self.catalog.exists("runs"):
            other.catalog.stage(self.catalog.runs.select("scene_id", "scene_path", "crop_window"))
        return other

    def delete(self) -> None:
        """Removes the folder; only one that holds a project."""
        if not self._exists():
            raise FileNotFoundError(f"{self.folder} holds no project")
        path, fs = self._path("")
        fs.delete(path, True)

    def _path(self, rest: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}{rest}")
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def _exists(self) -> bool:
        path, fs = self._path("/project.yaml")
        return fs.exists(path)

    def _save(self) -> None:
        path, fs = self._path("/project.yaml")
        out = fs.create(path, True)
        out.write(bytearray(config_text(self.config).encode()))
        out.close()

    @property
    def workflow(self) -> Workflow:
        return Workflow(tuple(Step(s["name"], tuple(s["inputs"]), s["output"], s["ephemeral"], s["config"]) for s in self.config["steps"]))

    @property
    def catalog(self) -> Catalog:
        return Catalog(self.spark, f"{self.folder}/catalog")

    @property
    def hash(self) -> str:
        return config_hash("".join(map(self.step_hash, self.workflow.steps)))

    def step_hash(self, step: Step) -> str:
        return config_hash(config_text(step.config))

    def stage(self, scenes: DataFrame) -> int:
        """scenes: scene_id, scene_path, crop_window."""
        return self.catalog.stage(scenes)

    def results(self) -> DataFrame:
        """The last record of each run and step."""
        every = self.catalog.table("results", RESULTS)
        last = F.row_number().over(W.partitionBy("run_id", "step").orderBy(F.desc("at"), F.desc("status")))
        return every.withColumn("__k", last).where("__k = 1").drop("__k")

    def output(self, name: str) -> DataFrame | None:
        """A step's rows of all runs that it is complete for under its present configuration; None if there are none."""
        step = next(s for s in self.workflow.steps if s.name == name)
        done = self.results().where((F.col("step") == name) & (F.col("status") == "completed") & (F.col("config_hash") == self.step_hash(step)))
        folders = [r.result for r in done.select("result").dropDuplicates().collect()]  # one a job, not one a run
        if not folders:
            return None
        parts = [self.spark.read.parquet(f"{self.folder}/{f}").withColumn("__job", F.lit(f)) for f in folders]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        return rows.join(done.select("run_id", F.col("result").alias("__job")), ["run_id", "__job"], "left_semi").drop("__job")

    def run(self, gate: str = "error", force: bool = False, scenes: DataFrame | None = None) -> DataFrame:
        """Works on all pending runs and returns their state: run_id, status, error.

        Of each run the steps before the first incomplete one are not made again, unless ``force`` is given.
        """
        todo = [r.run_id for r in self.catalog.to_run(self.hash, gate, force, scenes).select("run_id").collect()]  # names of runs only
        if not todo:
            return self.catalog.runs.limit(0).select("run_id", "status", "error")
        chosen = F.col("run_id").isin(todo)
        self._mark(chosen, "started")
        start = self._starts(todo, force)
        failed: dict[str, str] = {}
        for ordinal, step in enumerate(self.workflow.steps):
            asked = [r for r in todo if r not in failed and start[r] <= ordinal]
            if asked:
                failed |= self._step(step, asked)
        good = [r for r in todo if r not in failed]
        self._mark(F.col("run_id").isin(good), "done", self.hash)
        for error in sorted(set(failed.values())):
            self._mark(F.col("run_id").isin([r for r in failed if failed[r] == error]), "failed", error=error)
        self.write_manifests(todo)
        return self.catalog.runs.where(chosen).select("run_id", "status", "error")

    def _mark(self, which, status: str, hash_: str | None = None, error: str | None = None) -> None:
        from ..operators.catalog import RUNS, with_status

        self.catalog.change("runs", lambda runs: with_status(runs, which, status, F.current_timestamp(), hash_, error), RUNS)

    def _starts(self, todo: list[str], force: bool) -> dict[str, int]:
        """The first step that each run must go through again; past the last one where all are complete."""
        steps = self.workflow.steps
        if force:
            return dict.fromkeys(todo, 0)
        hashes = {s.name: self.step_hash(s) for s in steps}
        found = self.results().where(F.col("run_id").isin(todo) & (F.col("status") == "completed")).select("run_id", "step", "config_hash").collect()
        done = {(r.run_id, r.step) for r in found if hashes.get(r.step) == r.config_hash}
        out = {}
        for run in todo:
            first = next((k for k, s in enumerate(steps) if (run, s.name) not in done), len(steps))
            lost = [k for k, s in enumerate(steps[:first]) if s.ephemeral] if first < len(steps) else []
            out[run] = min([first, *lost])
        return out

    def _tables(self, step: Step, runs: DataFrame) -> dict[str, DataFrame]:
        made = {s.output or s.name: s.name for s in self.workflow.steps}
        return {t: runs if t == "scene" else self.output(made[t]).join(runs.select("run_id"), "run_id", "left_semi") for t in step.inputs}

    def _step(self, step: Step, asked: list[str]) -> dict[str, str]:
        """Errors of the runs for which the step fails, found by halving."""
        began, name = time.time(), f"results/{step.name}-{uuid.uuid4().hex}"
        runs = self.catalog.runs.where(F.col("run_id").isin(asked))
        try:
            rows = PROCESSORS[step.name](self._tables(step, runs), runs, step.config)
            rows.join(runs.select("run_id"), "run_id", "left_semi").write.parquet(f"{self.folder}/{name}")
        except Exception as e:
            path, fs = self._path(f"/{name}")
            fs.delete(path, True)
            if len(asked) > 1:
                half = len(asked) // 2
                return self._step(step, asked[:half]) | self._step(step, asked[half:])
            error = _first_line(e)
            self._record(asked, step, "failed", None, time.time() - began, error)
            return {asked[0]: f"{step.name}: {error}"}
        self._record(asked, step, "completed", name, time.time() - began, None)
        return {}

    def _record(self, runs: list[str], step: Step, status: str, result: str | None, seconds: float, error: str | None) -> None:
        rows = self.spark.createDataFrame([(r, step.name, status, self.step_hash(step), result, round(seconds, 1), error) for r in runs], RESULTS.rpartition(",")[0]).withColumn("at", F.current_timestamp())
        self.catalog.change("results", lambda have: have.unionByName(rows), RESULTS)

    def write_manifests(self, runs: list[str]) -> None:
        """One JSON file a run below ``manifests``: what each step did, in the workflow's order."""
        order = F.array_position(F.array(*(F.lit(s.name) for s in self.workflow.steps)), F.col("step"))
        each = F.struct(order.alias("k"), F.struct("step", "status", "config_hash", "duration_seconds", "error").alias("s"))
        rows = self.results().where(F.col("run_id").isin(runs)).groupBy("run_id").agg(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["s"]).alias("steps"))
        text = rows.select(F.col("run_id").alias("run"), F.to_json(F.struct("run_id", "steps")).alias("value"))
        text.repartition("run").write.mode("append").partitionBy("run").text(f"{self.folder}/manifests/{uuid.uuid4().hex}")

    def status(self) -> DataFrame:
        """One row a run: done, FAILED or -- for each step."""
        from ..operators.catalog import status_matrix

        runs = self.catalog.runs.select("run_id")
        matrix = status_matrix(self.results(), tuple(s.name for s in self.workflow.steps))
        return runs.join(matrix, "run_id", "left").fillna("--")

    def statistics(self, force: bool = False) -> dict[str, Exception]:
        """Writes the configured statistics of done runs; functions that fail are returned with their errors."""
        from ..operators.stats import run_stats, unprefixed

        failures: dict[str, Exception] = {}
        by_step: dict[str, list[str]] = {}
        for identifier in self.config["stats"]:
            by_step.setdefault(identifier.partition("::")[0], []).append(identifier)
        for step, identifiers in by_step.items():
            pixels = self.output(step)
            if pixels is None:
                continue
            table = f"stats_{step}"
            have = {step: self.catalog.table(table)} if self.catalog.exists(table) else {}
            try:
                found = run_stats(pixels, self.catalog.runs, tuple(identifiers), have, force, failures=failures)
                if step in found:
                    self.catalog.write_stats(step, unprefixed(found[step]))
            except Exception as e:
                failures[step] = e
        return failures


def _first_line(e: Exception) -> str:
    """What went wrong, in one line, without the traces of the engine: the last exception's own words."""
    lines = [x.strip() for x in str(e).splitlines() if re.match(r"\s*([\w.]+(Error|Exception)): ", x)]
    return (lines[-1] if lines else (str(e).splitlines() or [type(e).__name__])[0])[:500]


def new_run(scene_id: str, crop: str | None = None):
    """The id of a run, as a column."""
    return run_id(F.lit(scene_id), F.lit(crop))
