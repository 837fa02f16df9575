"""Coverage rates, grid coverage, monotonic labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.numeric import grid_bins, isclose
from lacuna.operators import lineage
from lacuna.operators.stats import order_statistics, stored


def coverage_rate(labelled: DataFrame, elem: list[str], dim: str = "dim", how: str = "mean") -> DataFrame:
    """elem and coverage: 100 times the mean label of each dimension, then their mean or minimum."""
    if how not in ("mean", "min"):
        raise ValueError("how is mean or min")
    by_dim = labelled.groupBy(*elem, dim).agg((F.lit(100.0) * F.avg(F.col("covered").cast("double"))).alias("rate"))
    return by_dim.groupBy(*elem).agg((F.avg if how == "mean" else F.min)("rate").alias("coverage"))


def fill_absent(rates: DataFrame, elements: DataFrame, elem: list[str]) -> DataFrame:
    """Elements without query rows count as fully covered."""
    return elements.select(*elem).distinct().join(rates, elem, "left").fillna({"coverage": 100.0})


def point_scores(labelled: DataFrame, point: list[str]) -> DataFrame:
    """How many dimensions of a point are covered."""
    return labelled.groupBy(*point).agg(F.sum(F.col("covered").cast("long")).alias("score"))


def across_batches(rates: DataFrame, elem: list[str]) -> DataFrame:
    """The minimum over batches, at most 100."""
    return rates.groupBy(*elem).agg(F.least(F.lit(100.0), F.min("coverage")).alias("coverage"))


def summary(rates: DataFrame, elem: list[str], digits: int = 4) -> DataFrame:
    return rates.select(*elem, F.bround("coverage", digits).alias("coverage"))


def selected_by_config(structure_config: DataFrame, selected: DataFrame) -> DataFrame:
    """Number of selected structures of every configuration, 0 kept."""
    mark = selected.select("structure_id").distinct().withColumn("one", F.lit(1))
    return structure_config.join(mark, "structure_id", "left").groupBy("config").agg(F.count("one").alias("n_selected"))


def grid_stats(df: DataFrame, keys: list[str], dim: str, value: str, factor: float = 1.0) -> DataFrame:
    """keys, dim, gmin, gmax, gbins and gwidth of a coverage grid."""
    ends = df.groupBy(*keys, dim).agg(F.count(value).alias("n"), F.min(value).alias("gmin"), F.max(value).alias("gmax"))
    out = ends.join(order_statistics(df, [*keys, dim], value, (0.25, 0.75)), [*keys, dim], "left")
    span = F.col("gmax") - F.col("gmin")
    out = out.withColumn("gbins", grid_bins(F.col("n"), span, F.col("q1") - F.col("q0"), factor))
    return out.select(*keys, dim, "gmin", "gmax", "gbins", (span / F.col("gbins")).alias("gwidth"))


def cell_of(v: Column, gmin: Column, gmax: Column, gbins: Column, gwidth: Column) -> Column:
    """Half-open cells: the maximum itself has none, except in a dimension without width, where close values share cell 0."""
    inside = F.least(F.greatest(F.floor(F.try_divide(v - gmin, gwidth)), F.lit(0)), gbins - 1).cast("long")
    return F.when(gwidth > 0, F.when((v >= gmin) & (v < gmax), inside)).otherwise(F.when(isclose(v, gmin), F.lit(0).cast("long")))


def assign_cells(df: DataFrame, grid: DataFrame, keys: list[str], dim: str, value: str, point: list[str]) -> DataFrame:
    """keys, point and cells (by dimension); points with any dimension outside are dropped."""
    placed = df.join(grid, [*keys, dim]).withColumn("cell", cell_of(*[F.col(c) for c in (value, "gmin", "gmax", "gbins", "gwidth")]))
    of_point = placed.groupBy(*keys, *point).agg(F.array_sort(F.collect_list(F.struct(dim, "cell"))).alias("x"), F.every(F.col("cell").isNotNull()).alias("valid"))
    return of_point.where("valid").select(*keys, *point, F.transform("x", lambda r: r["cell"]).alias("cells"))


def grid_coverage(query: DataFrame, reference: DataFrame, grid: DataFrame, keys: list[str], dim: str, value: str, point: list[str]) -> DataFrame:
    """keys, n_query, n_covered and coverage: the share of all query points whose cell a reference point is in."""
    total = query.groupBy(*keys).agg(F.countDistinct(*point).alias("n_query"))
    occupied = assign_cells(reference, grid, keys, dim, value, point).select(*keys, "cells").distinct()
    covered = assign_cells(query, grid, keys, dim, value, point).join(occupied, [*keys, "cells"], "left_semi").groupBy(*keys).agg(F.count("*").alias("n_covered"))
    return total.join(covered, keys, "left").fillna({"n_covered": 0}).withColumn("coverage", F.col("n_covered") / F.col("n_query"))


def grid_coverage_1d(query: DataFrame, reference: DataFrame, grid: DataFrame, keys: list[str], dim: str, value: str) -> DataFrame:
    """keys, dim, n_query, n_covered, coverage with one grid for each dimension by itself."""
    columns = [F.col(c) for c in (value, "gmin", "gmax", "gbins", "gwidth")]
    cells = lambda df: df.join(grid, [*keys, dim]).withColumn("cell", cell_of(*columns))
    occupied = cells(reference).where("cell is not null").select(*keys, dim, "cell").distinct().withColumn("hit", F.lit(1))
    out = cells(query).join(occupied, [*keys, dim, "cell"], "left").groupBy(*keys, dim).agg(F.count("*").alias("n_query"), F.count("hit").alias("n_covered"))
    return out.withColumn("coverage", F.col("n_covered") / F.col("n_query"))


def mean_1d_coverage(by_dim: DataFrame, keys: list[str]) -> DataFrame:
    return by_dim.groupBy(*keys).agg(F.avg("coverage").alias("coverage"), F.avg("n_covered").alias("mean_covered"))


def monotonic_topk(points: DataFrame, group: str = "elem", label_pos: str = "label_pos") -> DataFrame:
    """points(group, label_pos, idx, score, coverage) with `shown`: for each label in order, round-half-even(coverage * n)
    points are shown, never fewer than before, those shown before first, then by score, then by index. A label with
    another number of points starts anew. A round for each label, whose points not yet shown are ranked over ranges; places
    shown so far are a stored table, so that no task holds a group."""
    of = [F.col(group), F.col(label_pos)]
    rows = lineage.ranked(points.drop("rank"), [*of, F.col("idx")])
    sizes = stored(rows.groupBy(group, label_pos).agg(F.count("*").alias("_n"), F.min("rank").alias("_first"), F.first("coverage").alias("_c")))
    rows = stored(rows.join(sizes, [group, label_pos]).withColumn("_place", F.col("rank") - F.col("_first")).drop("rank", "_first"))
    shown, out = None, []
    for (label,) in sorted(sizes.select(label_pos).distinct().collect()):  # a row a label
        now = rows.where(F.col(label_pos) == F.lit(label))
        if shown is None:
            now = now.withColumn("_before", F.lit(False))
        else:
            now = now.join(shown, [group, "_n", "_place"], "left").withColumn("_before", F.col("_shown").isNotNull()).drop("_shown")
        now = stored(now)
        had = now.groupBy(group).agg(F.count_if("_before").alias("_had"), F.first("_n").alias("_m"), F.first("_c").alias("_share"))
        goal = F.greatest(F.col("_had"), F.least(F.bround(F.col("_share") * F.col("_m")), F.col("_m")))
        rest = lineage.ranked(now.where("not _before").select(group, "score", "_place"), [F.col(group), -F.col("score"), F.col("_place")])
        first = rest.groupBy(group).agg(F.min("rank").alias("_first"))
        more = rest.join(first, group).join(had.select(group, (goal - F.col("_had")).alias("_more")), group).where(F.col("rank") - F.col("_first") < F.col("_more"))
        part = stored(now.join(more.select(group, "_place", F.lit(True).alias("_now")), [group, "_place"], "left").withColumn("shown", F.col("_before") | F.col("_now").isNotNull()))
        out.append(part.select(*points.columns, "shown"))
        # groups that this label lacks keep what they had
        kept = part.where("shown").select(group, "_n", "_place", F.lit(True).alias("_shown"))
        shown = kept if shown is None else stored(kept.union(shown.join(part.select(group).distinct(), group, "left_anti")))
    result = points.withColumn("shown", F.lit(False)).limit(0)
    for part in out:
        result = result.union(part)
    return result
