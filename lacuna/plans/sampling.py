"""Generation sampling: coverage-driven, mean-descriptor and disagreement-driven selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.operators import cover, coverage, histogram, intervals, metrics, pca, select, stats
from lacuna.operators.stats import stored
from lacuna.plans import reduce


def coverage_of(reference: DataFrame, query: DataFrame, binning: reduce.Binning, how: str = "mean", on_missing: str = "raise", group: list[str] | None = None) -> DataFrame:
    """elem (and group) and coverage of long query values by long reference values."""
    ref = stored(reduce.stats_of(reference, binning))
    zero = histogram.low_intervals(histogram.counts(reference, ref, reduce.KEYS), binning.state_population)
    labelled = intervals.label_covered(query, ref, zero, reduce.KEYS, on_missing=on_missing)
    return coverage.coverage_rate(labelled, [*(group or []), "elem"], how=how)


def sample(reference: DataFrame, candidate: DataFrame, thresholds: list, budgets: list[int], binning: reduce.Binning = reduce.Binning(), how: str = "mean", generation: DataFrame | None = None, configs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(selected, coverage). Elements below their highest threshold keep their classes; these are covered greedily, and the
    cover is strided to the budget of the first stage not reached. Converged elements give nothing. `generation` is the
    reference that coverage is measured against where it differs from that of the classes; with configs(structure_id,
    config), coverage is the minimum over configurations."""
    ref, cand = reduce.long_values(reference), reduce.long_values(candidate)
    against = reduce.long_values(generation) if generation is not None else ref
    if configs is None:
        rates = coverage_of(against, cand, binning, how)
    else:
        rates = coverage.across_batches(coverage_of(against, cand.join(configs, "structure_id"), binning, how, group=["config"]), ["elem"])
    rates = stored(coverage.fill_absent(rates, against, ["elem"]))
    elements = sorted(r.elem for r in rates.select("elem").collect())
    rows, scalar = select.schedule(thresholds, len(elements))
    spark = reference.sparkSession
    kind = rates.schema["elem"].dataType.simpleString()
    stages = spark.createDataFrame([(s, e, row[i], budgets[s]) for s, row in enumerate(rows) for i, e in enumerate(elements)], f"stage int, elem {kind}, threshold double, budget int")
    plan = select.budget(rates, stages, scalar).first()
    zero = histogram.low_intervals(histogram.counts(ref, of := stored(reduce.stats_of(ref, binning)), reduce.KEYS), binning.state_population).select(*reduce.KEYS, "lo", "hi")
    ends = cand.groupBy(*reduce.KEYS).agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    members = intervals.classes(cand, intervals.novelty_intervals(of, ends, zero, reduce.KEYS), reduce.KEYS)
    gated = select.element_gate(members, rates, stages.groupBy("elem").agg(F.max("threshold").alias("threshold")))
    covered = cover.min_cover(reduce.numbered(gated))
    empty = plan["converged"] or not plan["budget"]
    return (select.fwss(covered.limit(0), 1) if empty else select.fwss(covered, plan["budget"])), rates


def mean_sample(reference: DataFrame, candidate: DataFrame, thresholds: list, budgets: list[int], binning: reduce.Binning = reduce.Binning(), how: str = "mean") -> tuple[DataFrame, DataFrame]:
    """The same over mean descriptors: one pseudo-element, one body, no element gate."""

    def means(df: DataFrame) -> DataFrame:
        return stats.mean_descriptor(df, ["structure_id"]).select("structure_id", F.lit(0).alias("atom_idx"), F.lit(0).alias("elem"), "features")

    ref, cand = reduce.long_values(means(reference)), reduce.long_values(means(candidate))
    rates = stored(coverage_of(ref, cand, binning, how))
    rows, scalar = select.schedule(thresholds, 1)
    stages = reference.sparkSession.createDataFrame([(s, 0, row[0], budgets[s]) for s, row in enumerate(rows)], "stage int, elem int, threshold double, budget int")
    plan = select.budget(rates, stages, scalar).first()
    covered = cover.min_cover(reduce.novelty_classes(ref, cand, binning))
    empty = plan["converged"] or not plan["budget"]
    return (select.fwss(covered.limit(0), 1) if empty else select.fwss(covered, plan["budget"])), rates


def ambiguity_sample(forces: DataFrame, vectors: DataFrame, low: float, high: float, clusters: int, per_cluster: int, num: int) -> DataFrame:
    """Frames whose largest disagreement lies strictly between low and high; clustered and thinned to the most ambiguous of
    each cluster where there are more than num, else all. vectors(structure_id, features)."""
    per_atom = metrics.ensemble_ambiguity(forces, ["structure_id", "atom_idx", "elem"])
    frames = per_atom.groupBy("structure_id").agg(F.max("ambiguity").alias("ambiguity"))
    inside = stored(metrics.ambiguity_window(frames, low, high))
    n = inside.count()
    if n == 0 or clusters * per_cluster > num or n <= clusters:
        return inside
    points = vectors.join(inside, "structure_id")
    sampled = pca.cluster_sample(points, "features", clusters, points.count(), "structure_id")
    k = sampled.groupBy("cluster").agg(F.least(F.count("*"), F.lit(per_cluster)).alias("k"))
    return select.topk_in_cluster(sampled, "cluster", "ambiguity", "structure_id", k).select("structure_id", "ambiguity", "cluster")
