"""Budgets, convergence, strided and clustered selection."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators import lineage

MEAN_COVERAGE = 90


def strided(r: Column, length: Column, num: int) -> Column:
    """Frequency-weighted stride: with a = num // 5 the first a, then every c-th from there, c = max(1, (length - a) //
    max(1, num - a)); the first num where num covers all. It may pass the budget, and takes one even for num 0."""
    a = num // 5
    c = F.greatest(F.lit(1), F.floor((length - a) / F.lit(max(1, num - a)))).cast("long")
    return F.when(length <= num, r < num).otherwise((r < a) | ((r >= a) & (F.pmod(r - a, c) == 0)))


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """df with place, from 0 by `order`, and length, without a task that sorts all rows."""
    length = df.count()
    return lineage.ranked(df, order).withColumnRenamed("rank", "place").withColumn("length", F.lit(length))


def fwss(cover: DataFrame, num: int) -> DataFrame:
    """The rows of cover(structure_id, freq, ...) that the stride keeps, with place; order: freq desc, id asc."""
    placed = _placed(cover.drop("rank"), [-F.col("freq"), F.col("structure_id")])
    kept = placed.where(strided(F.col("place"), F.col("length"), num)).drop("length")
    return kept.join(cover.select("structure_id", "rank"), "structure_id") if "rank" in cover.columns else kept


def fwss_with_mean(cover: DataFrame, mean_selected: DataFrame, num: int, mean_coverage: float) -> DataFrame:
    """Structures of the mean pre-selection come first (mean_selected: structure_id, pos), then the cover. Above 90 % mean
    coverage the stride; else the tail: the last fifth if that is below num, or the last num. in_mean and in_cover tell
    where a kept row comes from."""
    m = mean_selected.select("structure_id", "pos").withColumn("in_mean", F.lit(True))
    c = cover.select("structure_id", "freq").withColumn("in_cover", F.lit(True))
    both = m.join(c, "structure_id", "full").fillna({"in_mean": False, "in_cover": False})
    # nulls come first in a range's order: structures of the cover alone come last by in_mean, those of the mean alone by freq
    placed = _placed(both, [~F.col("in_mean"), F.col("pos"), F.col("freq").isNull(), -F.col("freq"), F.col("structure_id")])
    if mean_coverage > MEAN_COVERAGE:
        keep = strided(F.col("place"), F.col("length"), num)
    else:
        short = F.col("length") * 0.2 < num
        keep = F.when(short, F.col("place") >= F.floor(F.col("length") * 0.8)).otherwise(F.col("place") >= F.col("length") - num)
    return placed.where(keep).drop("length")


def intersection_counts(kept: DataFrame) -> DataFrame:
    one = lambda c: F.count_if(c)
    return kept.agg(one(F.col("in_mean")).alias("n_mean"), one(F.col("in_cover")).alias("n_cover"), one(F.col("in_mean") & F.col("in_cover")).alias("n_both"))


def topk_in_cluster(df: DataFrame, cluster: str, score: str, idx: str, k: DataFrame) -> DataFrame:
    """The k rows of highest score of each cluster, ties to the smaller idx; k(cluster, k)."""
    order = Window.partitionBy(cluster).orderBy(F.col(score).desc(), idx)
    return df.withColumn("_r", F.row_number().over(order)).join(k.select(cluster, F.col("k").alias("_k")), cluster).where("_r <= _k").drop("_r", "_k")


def element_gate(memberships: DataFrame, coverage: DataFrame, limits: DataFrame, elem: str = "elem") -> DataFrame:
    """Memberships of elements whose coverage is below their limit."""
    below = coverage.join(limits, elem).where("coverage < threshold").select(elem)
    return memberships.join(below, elem, "left_semi")


def schedule(thresholds: Sequence[Any], elements: int) -> tuple[list[list[float]], bool]:
    """Stages as one threshold per element, and whether all were scalars. An inner list has 1 or `elements` numbers."""
    rows, scalar = [], True
    for x in thresholds:
        row = [float(v) for v in x] if isinstance(x, (list, tuple)) else [float(x)]
        if len(row) not in (1, elements):
            raise ValueError(f"a stage has 1 or {elements} thresholds, not {len(row)}")
        scalar = scalar and not isinstance(x, (list, tuple))
        rows.append(row * elements if len(row) == 1 else row)
    return rows, scalar


def target(thresholds: Sequence[Any] | None) -> float:
    """The highest threshold of all, 100 without any."""
    flat = [float(v) for x in thresholds or [] for v in (x if isinstance(x, (list, tuple)) else [x])]
    return max(flat, default=100.0)


def budget(coverage: DataFrame, stages: DataFrame, scalar: bool = True) -> DataFrame:
    """One row: budget of the first stage in which any element is below its threshold, 0 if none is; converged if all are
    above their highest threshold. coverage(elem, coverage), stages(stage, elem, threshold, budget)."""
    joined = stages.join(coverage, "elem")
    order = F.struct("threshold", "stage") if scalar else F.struct("stage", "threshold")
    first = joined.agg(F.min_by(F.when(F.col("coverage") < F.col("threshold"), F.col("budget")), F.when(F.col("coverage") < F.col("threshold"), order)).alias("budget"))
    highest = joined.groupBy("elem").agg(F.max("threshold").alias("t"), F.first("coverage").alias("c")).agg(F.every(F.col("c") > F.col("t")).alias("converged"))
    return first.crossJoin(highest).select(F.coalesce("budget", F.lit(0)).alias("budget"), "converged")


def convergence(history: DataFrame, goal: float, generations: int, min_delta: float) -> DataFrame:
    """history(metric_key, gen, metric) with delta, plateau and converged: at the goal, or with all of the last
    generations' changes (2 generations at least) below min_delta."""
    by = Window.partitionBy("metric_key").orderBy("gen")
    last = by.rowsBetween(-(generations - 2), 0)
    delta = F.col("metric") - F.lag("metric").over(by)
    out = history.withColumn("delta", delta)
    if generations >= 2:
        plateau = (F.count("delta").over(last) == generations - 1) & (F.max("delta").over(last) < min_delta)
    else:
        plateau = F.lit(False)
    return out.withColumn("plateau", plateau).withColumn("converged", (F.col("metric") >= goal) | F.col("plateau"))


def upsert(history: DataFrame, rows: DataFrame, keys: tuple[str, ...] = ("metric_key", "gen")) -> DataFrame:
    return history.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows)
