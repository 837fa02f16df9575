"""Dataset lifecycle: initial build, bundle, export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.operators import lineage, structures


def initial_dataset(base: DataFrame, strains: list[float], rattle_count: int, rattle_step: float, seed: int, snapshots: DataFrame | None = None, every: int = 1, repeats: tuple[int, int, int] = (1, 1, 1)) -> DataFrame:
    """Strained and rattled supercells of the base structures and every n-th snapshot, each once by fingerprint, with their
    kind. base and snapshots: structure_id, symbols, positions, cell, n_atoms (snapshots also step)."""
    columns = ["symbols", "positions", "cell", "n_atoms"]
    made = structures.strain_and_rattle(structures.supercell(base, repeats), strains, rattle_count, rattle_step, seed)
    out = made.select(F.col("candidate_idx").alias("structure_id"), *columns, F.lit("random_displacement").alias("kind"))
    if snapshots is not None:
        offset = out.agg(F.coalesce(F.max("structure_id") + 1, F.lit(0))).first()[0]
        taken = structures.step_snapshots(snapshots, every)
        out = out.union(taken.select(F.col("structure_id") + offset, *columns, F.lit("trajectory").alias("kind")))
    return structures.dedup(out)


def summary(dataset: DataFrame, parent: str = "parent") -> DataFrame:
    named = dataset.withColumn("formula", structures.formula(F.col("symbols")))
    columns = ["kind", *([parent] if parent in dataset.columns else []), "formula"]
    return structures.collection_summary(named, columns)


def labelled(frames: DataFrame, threshold: float, forces: str = "forces", order: str = "structure_id") -> DataFrame:
    """Labelled frames below the force threshold, or the first of the least force where none is."""
    from lacuna.functions.tensors import max_force

    return structures.force_filter(frames.withColumn("max_f", max_force(F.col(forces))), threshold, order=order).drop("max_f")


def bundle(initial: DataFrame, final: DataFrame, key: list[str], order: str = "structure_id") -> tuple[DataFrame, DataFrame]:
    """(initial with main -1, what final has beyond it, by exact fingerprint and multiplicity)."""
    return lineage.relabel(initial), lineage.multiset_subtract(final, initial, key, order)


def export(final: DataFrame, counts: DataFrame, index: str = "frame_idx") -> DataFrame:
    """The last training set with the loop each frame came from."""
    return lineage.segment_labels(final, counts, index)
