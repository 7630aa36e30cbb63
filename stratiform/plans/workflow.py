"""Workflows: steps over named tokens, which of them a run still needs, and whether files are what they claim.

Steps are few and live on the driver; what is judged about runs is judged for all runs at once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


@dataclass(frozen=True)
class Step:
    name: str
    inputs: tuple[str, ...] = ()
    output: str = ""
    ephemeral: bool = False
    config: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Workflow:
    steps: tuple[Step, ...]

    def __post_init__(self) -> None:
        known: set[str] = {"scene"}
        for step in self.steps:
            missing = [t for t in step.inputs if t not in known]
            if missing:
                raise ValueError(f"step {step.name!r} needs {missing[0]!r}, which no earlier step makes")
            known.add(step.output or step.name)

    def lifetimes(self) -> dict[str, str]:
        """The last step that reads each token; what follows it may be unpersisted."""
        return {token: step.name for step in self.steps for token in step.inputs}


def config_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def combined_hash(ordered_hashes: Column) -> Column:
    """The hash of a pipeline: that of its steps' hashes, joined in their order."""
    return F.substr(F.sha2(F.array_join(ordered_hashes, ""), 256), F.lit(1), F.lit(16))


def token_lifetimes(uses: DataFrame) -> DataFrame:
    """(workflow, token, last_step) of uses (workflow, ordinal, step, token)."""
    return uses.groupBy("workflow", "token").agg(F.max_by("step", "ordinal").alias("last_step"))


def is_complete(status: Column, file_exists: Column, found_hash: Column, wanted_hash: Column) -> Column:
    return F.coalesce((status == "completed") & file_exists & (found_hash == wanted_hash), F.lit(False))


def resume_points(states: DataFrame) -> DataFrame:
    """(run_id, resume_at): the first ordinal that must run again; null when nothing must.

    states: run_id, ordinal, complete, ephemeral. From the first incomplete step everything is made again; completed steps
    before it whose results were never kept (ephemeral) pull the point back to the earliest of them.
    """
    broken = F.min(F.when(~F.col("complete"), F.col("ordinal"))).over(W.partitionBy("run_id"))
    rows = states.withColumn("broken", broken)
    lost = F.min(F.when(F.col("ephemeral") & (F.col("ordinal") < F.col("broken")), F.col("ordinal")))
    return rows.groupBy("run_id").agg(F.coalesce(lost, F.min("broken")).alias("resume_at"))


def changed_keys(old: Column, new: Column) -> Column:
    """Sorted keys that only one of two maps has or that differ."""
    keys = F.array_union(F.map_keys(old), F.map_keys(new))
    return F.array_sort(F.filter(keys, lambda k: ~F.element_at(old, k).eqNullSafe(F.element_at(new, k))))


def provenance_problem(file_exists: Column, provenance: Column, project: Column, product: Column, scene: Column, config: Column, crop: Column, has_output: Column | bool = True) -> Column:
    """The first thing wrong with a step's file, or null. provenance: struct(project, product, scene, config, crop).

    Steps without an output have no file to be wrong. Of what a file names, an empty project or scene and a missing configuration
    are not compared; the product counts before the scene's path, and ``.SAFE`` at its end does not.
    """
    named = lambda name: F.nullif(provenance[name], F.lit(""))
    other = lambda name, current: named(name).isNotNull() & ~named(name).eqNullSafe(current)
    bare = lambda c: F.regexp_replace(c, r"\.SAFE$", "")
    diff = changed_keys(provenance["config"], config)
    return F.when(F.lit(has_output) if isinstance(has_output, bool) else has_output, (
        F.when(~file_exists, "missing file").when(provenance.isNull(), "no provenance").when(other("project", project), "other project")
        .when(F.when(named("product").isNotNull(), ~bare(named("product")).eqNullSafe(bare(product))).otherwise(other("scene", scene)), "other scene")
        .when(provenance["config"].isNotNull() & (F.size(diff) > 0), F.concat(F.lit("config: "), F.array_join(diff, ","))).when(~provenance["crop"].eqNullSafe(crop), "other crop")
    ))
