"""The initial dataset built in stages that a later run takes up where an earlier one stopped.

Every stage writes its table and then its mark, a row of the manifest with the settings and the number of rows. A run begins
at the first stage without a mark: a table that was being written when a run died has none and is written anew. A build
whose last stage is marked is reused. Tables are told apart by a hash of the settings, so that other settings are another
build and never go on from this one's tables.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.operators import structures
from lacuna.plans import lifecycle

Tables = dict[str, DataFrame]
Stage = tuple[str, Callable[[Tables], DataFrame]]
MARK = "stage string, place int, settings string, n long"


@dataclass(frozen=True)
class Built:
    """The last stage's table, and what the run did: built the stages `made`, went on after `found`."""

    table: DataFrame
    made: list[str]
    found: list[str]
    counts: dict[str, int]

    @property
    def reused(self) -> bool:
        return not self.made


class StagedBuild:
    def __init__(self, spark: SparkSession, folder: str, settings: dict):
        self.spark = spark
        text = json.dumps(settings, sort_keys=True, default=str)
        self.settings = hashlib.sha256(text.encode()).hexdigest()[:16]
        self.folder = f"{folder.rstrip('/')}/{self.settings}"

    def marks(self) -> dict[str, int]:
        """Rows of each finished stage."""
        try:
            return {r.stage: r.n for r in self.spark.read.schema(MARK).json(f"{self.folder}/manifest").orderBy("place").collect()}  # a row a stage
        except AnalysisException:
            return {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/tables/{name}")

    def run(self, stages: list[Stage], reuse: bool = True, before: Callable[[str], None] | None = None) -> Built:
        """Makes what is missing, in order; reuse=False makes all anew. `before` is told each step: a stage's name before it
        is made, and "mark of ..." between its table and its mark."""
        if not reuse:
            self.remove("")
        marks, tables, made = self.marks(), {}, []
        for place, (name, make) in enumerate(stages):
            if made or name not in marks:  # what comes after a stage that is made anew is made anew too
                before and before(name)
                make(tables).write.mode("overwrite").parquet(f"{self.folder}/tables/{name}")
                before and before(f"mark of {name}")
                n = self.table(name).count()
                self.spark.createDataFrame([(name, place, self.settings, n)], MARK).coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest/place={place}")
                marks[name] = n
                made.append(name)
            tables[name] = self.table(name)
        names = [name for name, _ in stages]
        return Built(tables[names[-1]], made, [n for n in names if n not in made], {n: marks[n] for n in names})

    def remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Settings:
    """What the initial dataset is made of. strains, rattle_count, rattle_step and seed give the random displacements; with
    a phonon length, sites that have rotations are displaced by it; every n-th snapshot is taken; labelled frames pass a
    force threshold."""

    include_source: bool = True
    repeats: tuple[int, int, int] = (1, 1, 1)
    strains: tuple[float, ...] = (1.0,)
    rattle_count: int = 0
    rattle_step: float = 0.01
    seed: int = 0
    phonon_length: float | None = None
    phonon_in_dataset: bool = True
    every: int = 1
    force_threshold: float | None = None


COLUMNS = ["symbols", "positions", "cell", "n_atoms"]


def numbered(parts: list[tuple[str, DataFrame]], counts: dict[str, int]) -> DataFrame:
    """The parts one after another with kind and consecutive ranges of structure_id."""
    out, offset = None, 0
    for kind, part in parts:
        rows = part.select((F.col("structure_id") + offset).alias("structure_id"), *COLUMNS, F.lit(kind).alias("kind"))
        out = rows if out is None else out.unionByName(rows)
        offset += counts[kind]
    return out


def displaced(base: DataFrame, sites: DataFrame, length: float) -> DataFrame:
    """A structure for each displacement of each site of sites(structure_id, atom_idx, cell, rotations): the site's atom moves."""
    moves = structures.displacements(sites, length)
    moved = base.join(moves, "structure_id").withColumn("positions", F.transform("positions", lambda p, i: F.when(i == F.col("atom_idx"), F.zip_with(p, F.array("dx", "dy", "dz"), lambda x, d: x + d)).otherwise(p)))
    key = F.struct("structure_id", "atom_idx", "k")
    return moved.withColumn("key", key).drop("direction", "dx", "dy", "dz")


def stages(base: DataFrame, settings: Settings, snapshots: DataFrame | None = None, sites: DataFrame | None = None, labels: Callable[[DataFrame], DataFrame] | None = None) -> list[Stage]:
    """source, random_displacement, phonon_displacement, trajectory, candidates (each structure once by fingerprint) and, with
    `labels`, labelled: labels(candidates) has their forces, and those above the threshold go."""
    from lacuna.operators import lineage

    def dense(df: DataFrame, order: list) -> DataFrame:
        return lineage.ranked(df.drop("rank"), order).withColumn("structure_id", F.col("rank")).select("structure_id", *COLUMNS)

    def random(_: Tables) -> DataFrame:
        made = structures.strain_and_rattle(structures.supercell(base, settings.repeats), list(settings.strains), settings.rattle_count, settings.rattle_step, settings.seed)
        return dense(made, [F.col("candidate_idx")])

    def candidates(tables: Tables) -> DataFrame:
        kinds = [k for k in tables if (k != "source" or settings.include_source) and (k != "phonon_displacement" or settings.phonon_in_dataset)]
        return structures.dedup(numbered([(k, tables[k]) for k in kinds], {k: tables[k].count() for k in kinds}))

    out: list[Stage] = [("source", lambda _: dense(base, [F.col("structure_id")])), ("random_displacement", random)]
    if settings.phonon_length is not None and sites is not None:
        out.append(("phonon_displacement", lambda _: dense(displaced(structures.supercell(base, settings.repeats), sites, settings.phonon_length), [F.col("key")])))
    if snapshots is not None:
        out.append(("trajectory", lambda _: dense(structures.step_snapshots(snapshots, settings.every), [F.col("step"), F.col("structure_id")])))
    out.append(("candidates", candidates))
    if labels is not None:
        threshold = settings.force_threshold if settings.force_threshold is not None else float("inf")
        out.append(("labelled", lambda tables: lifecycle.labelled(labels(tables["candidates"]), threshold)))
    return out


def ensure_dataset(spark: SparkSession, folder: str, base: DataFrame, settings: Settings, snapshots: DataFrame | None = None, sites: DataFrame | None = None, labels: Callable[[DataFrame], DataFrame] | None = None, reuse: bool = True, before: Callable[[str], None] | None = None) -> Built:
    """The initial dataset of base(structure_id, symbols, positions, cell, n_atoms): built, gone on with, or reused."""
    return StagedBuild(spark, folder, asdict(settings)).run(stages(base, settings, snapshots, sites, labels), reuse, before)
