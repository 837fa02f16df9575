"""Compression of a dataset by coverage: candidate-only and reference-guided selection.

Tables are long descriptor tables: structure_id, atom_idx, body, elem, features. Values are exploded once to (body, elem,
dim, value); statistics and memberships are one shuffle each on these keys, the cover one on the class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.numeric import bin_index
from lacuna.operators import cover, histogram, intervals, lineage, stats
from lacuna.operators.stats import stored

KEYS = ["body", "elem", "dim"]


@dataclass(frozen=True)
class Binning:
    method: str = "fd"
    factor: float = 1.0
    width: float | None = None
    state_population: int = 0


def long_values(descriptors: DataFrame) -> DataFrame:
    keep = [c for c in ("body", "elem", "structure_id", "atom_idx") if c in descriptors.columns]
    out = stats.explode_features(descriptors, keep=keep)
    return out if "body" in keep else out.withColumn("body", F.lit("all"))


def stats_of(values: DataFrame, binning: Binning, widths: DataFrame | None = None) -> DataFrame:
    if widths is not None:
        return stats.fixed_width_stats(values, widths, KEYS)
    return stats.dim_stats(values, KEYS, method=binning.method, factor=binning.factor, width=binning.width)


def numbered(memberships: DataFrame) -> DataFrame:
    """class_seq in order of body, element, dimension and interval, with structure_id and atom_idx."""
    return intervals.with_class_id(memberships, [*KEYS, "interval_id"]).select(F.col("class_id").alias("class_seq"), "structure_id", "atom_idx")


def self_classes(candidate: DataFrame, binning: Binning) -> DataFrame:
    """Occupied intervals of the candidates themselves. An interval's members are those of its histogram bin, so that a value's
    class is computed and not searched. class_seq counts bins in order of body, element and dimension; empty bins are no classes,
    but count."""
    of = stored(stats_of(candidate, binning))
    before = F.coalesce(F.sum("nbins").over(Window.orderBy(*KEYS).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a dimension
    firsts = of.select(*KEYS, "vmin", "vmax", "nbins", before.alias("before"))
    joined = candidate.where(F.col("value").isNotNull()).join(F.broadcast(firsts) if of.count() <= lineage.FEW else firsts, KEYS)
    at = bin_index(F.col("value"), F.col("vmin"), F.col("vmax"), F.col("nbins"))
    return joined.select((F.col("before") + at).alias("class_seq"), "structure_id", "atom_idx")


def novelty_classes(reference: DataFrame, candidate: DataFrame, binning: Binning, widths: DataFrame | None = None) -> DataFrame:
    """Classes of candidates in the reference's zero intervals and outside its range."""
    ref = stored(stats_of(reference, binning, widths))
    zero = histogram.low_intervals(histogram.counts(reference, ref, KEYS), binning.state_population).select(*KEYS, "lo", "hi")
    ends = candidate.groupBy(*KEYS).agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    return numbered(intervals.classes(candidate, intervals.novelty_intervals(ref, ends, zero, KEYS), KEYS))


def ids(df: DataFrame) -> DataFrame:
    return df.select("structure_id").distinct()


def select_guided(reference: DataFrame, candidate: DataFrame, binning: Binning, widths: DataFrame | None = None) -> DataFrame:
    """structure_id selected: all where there is no reference, none where there are no candidates."""
    if not reference.head(1):
        return ids(candidate)
    return cover.min_cover(novelty_classes(reference, candidate, binning, widths)).select("structure_id")


def to_global(local: DataFrame, start: int, size: int) -> DataFrame:
    """Places in a chunk to places in the whole: places outside the chunk are left out, and each counts once."""
    inside = local.where((F.col("place") >= 0) & (F.col("place") < size))
    return inside.select((F.col("place") + start).alias("place")).distinct()


def flagged(candidate: DataFrame, selected: DataFrame) -> DataFrame:
    """structure_id and selected for every candidate structure: disjoint parts that make up the input."""
    return ids(candidate).join(selected.select("structure_id", F.lit(True).alias("selected")), "structure_id", "left").fillna({"selected": False})


def candidate_only(candidate: DataFrame, binning: Binning = Binning(), current: DataFrame | None = None, interval_ref: DataFrame | None = None) -> DataFrame:
    """Without a reference the candidates' own occupied intervals are covered; else one guided selection against
    interval_ref, or against current where that is not given."""
    values = long_values(candidate)
    reference = interval_ref if interval_ref is not None else current
    if reference is None:
        picked = cover.min_cover(self_classes(values, binning)).select("structure_id")
    else:
        picked = select_guided(long_values(reference), values, binning)
    return flagged(values, picked)


def reference_guided(candidate: DataFrame, chunk_size: int, binning: Binning = Binning(), current: DataFrame | None = None, interval_ref: DataFrame | None = None, dynamic_width: bool = True) -> DataFrame:
    """Chunk after chunk, each against the current set and what earlier chunks gave; widths come anew from that set, or stay
    those of interval_ref (or current). With nothing to compare to, a chunk is compared with itself."""
    values = long_values(candidate)
    base = long_values(current) if current is not None else values.limit(0)
    source = interval_ref if interval_ref is not None else current
    widths = None
    if not dynamic_width:
        if source is None:
            raise ValueError("fixed widths need interval_ref or current")
        widths = stats.widths(stats_of(long_values(source), binning), KEYS)
    structures = lineage.reduce_chunks(ids(values), n := ids(values).count(), chunk_size, "structure_id")
    chosen = stored(ids(values).limit(0))
    has_base = bool(base.head(1))
    for k in range(max(1, n // chunk_size) if n else 0):
        chunk = values.join(structures.where(F.col("chunk") == k).select("structure_id"), "structure_id", "left_semi")
        reference = base.unionByName(values.join(chosen, "structure_id", "left_semi"))
        reference = reference if has_base or chosen.head(1) else chunk
        chosen = stored(chosen.union(select_guided(reference, chunk, binning, widths)))  # state of the fold: selected ids
    return flagged(values, chosen)
