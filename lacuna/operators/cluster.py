"""Clusters from mergeable summaries.

A clustering feature is the count, the sums and the sum of squares of the points of a cell. Cells are cubes whose half
diagonal is the threshold, so that no cluster's radius is above it; features of a cell add up, whatever task its points are
in, and cells of twice the side are made of whole cells, whose features add up too. That makes the summary a single partial
aggregation whose coarser levels need no second reading. The threshold is halved until there are as many cells as clusters
are wanted, and doubled until there are few enough to be merged further on the driver, by least growth of the squared
distances of their centres.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Features that may be merged on the driver, and halvings or doublings before an error.
MOST, ROUNDS = 512, 60


def side(threshold: float, dims: int) -> float:
    return 2.0 * threshold / math.sqrt(dims)


def cell_of(coords: list[str], threshold: float) -> Column:
    """The cell of a point: the place of its coordinates, in order."""
    s = side(threshold, len(coords))
    return F.array(*[F.floor(F.col(c) / F.lit(s)) for c in coords])


def summarise(points: DataFrame, coords: list[str], threshold: float, keys: list[str] | None = None) -> DataFrame:
    """keys, cell, n, sums and squares of points: their clustering features. Points with a null coordinate are left out."""
    there = points.dropna(subset=coords)
    squares = sum((F.col(c) * F.col(c) for c in coords[1:]), F.col(coords[0]) * F.col(coords[0]))
    out = there.groupBy(*(keys or []), cell_of(coords, threshold).alias("cell"))
    return out.agg(F.count("*").alias("n"), F.array(*[F.sum(c) for c in coords]).alias("sums"), F.sum(squares).alias("squares"))


def coarser(features: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Features of cells of twice the side, from those of the cells that they are made of."""
    dims = F.transform("cell", lambda x: F.floor(x / 2))
    each = features.select(*(keys or []), dims.alias("cell"), "n", "squares", F.posexplode("sums").alias("dim", "s"))
    rows = each.groupBy(*(keys or []), "cell", "dim").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"), F.sum("s").alias("s"))
    sums = F.transform(F.array_sort(F.collect_list(F.struct("dim", "s"))), lambda x: x["s"])  # as many as coordinates
    return rows.groupBy(*(keys or []), "cell").agg(F.first("n").alias("n"), sums.alias("sums"), F.first("squares").alias("squares"))


def centre(sums: Column, n: Column) -> Column:
    return F.transform(sums, lambda x: x / n)


def radius(n: Column, sums: Column, squares: Column) -> Column:
    """Root of the mean squared distance from the centre."""
    middle = F.aggregate(centre(sums, n), F.lit(0.0), lambda s, x: s + x * x)
    return F.sqrt(F.greatest(squares / n - middle, F.lit(0.0)))


def adapted(points: DataFrame, coords: list[str], threshold: float, n: int) -> float:
    """The threshold halved until the points have at least n cells: fewer different points than that are an error."""
    if not threshold > 0:
        raise ValueError("a threshold is above 0")
    for _ in range(ROUNDS):
        cells = points.dropna(subset=coords).select(cell_of(coords, threshold).alias("cell")).distinct()
        if cells.limit(n).count() >= n:
            return threshold
        threshold /= 2
    raise ValueError(f"there are fewer than {n} different points")


def merged(features: list[tuple[list[int], list[float]]], n: int) -> list[int]:
    """The cluster, from 0, of each (cell, centre): the two clusters whose joining adds least to the squared distances from
    their centres join until n are left. Cells weigh the same. Clusters are numbered in order of their first cell."""
    order = sorted(range(len(features)), key=lambda i: features[i][0])
    x = np.array([features[i][1] for i in order], float)
    size, owner = np.ones(len(x)), list(range(len(x)))
    gap = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) / 2
    np.fill_diagonal(gap, np.inf)
    for _ in range(len(x) - n):
        a, b = sorted(np.unravel_index(gap.argmin(), gap.shape))
        x[a] = (x[a] * size[a] + x[b] * size[b]) / (size[a] + size[b])
        size[a] += size[b]
        gap[b, :] = gap[:, b] = np.inf
        left = np.isfinite(gap[a]) & (np.arange(len(x)) != a)
        gap[a, left] = gap[left, a] = ((x[left] - x[a]) ** 2).sum(axis=1) * size[left] * size[a] / (size[left] + size[a])
        owner = [a if o == b else o for o in owner]
    number = {o: i for i, o in enumerate(dict.fromkeys(owner))}
    out = [0] * len(features)
    for i, o in zip(order, owner, strict=True):
        out[i] = number[o]
    return out


def cluster(points: DataFrame, coords: list[str], n: int, threshold: float, most: int = MOST) -> tuple[DataFrame, float]:
    """points with `cluster`, 0 to n - 1, and the threshold that was used. The rerun rule: a threshold that gives too few cells
    is adapted first, and the result is that of a run with the adapted one. Points with a null coordinate are left out."""
    if not 0 < n <= most:
        raise ValueError(f"1 to {most} clusters")
    threshold = adapted(points, coords, threshold, n)
    features, level = summarise(points, coords, threshold), 0
    while features.limit(most + 1).count() > most:
        features, level = coarser(features), level + 1
        if level > ROUNDS:
            raise ValueError("the points are too far apart")
    rows = features.select("cell", centre(F.col("sums"), F.col("n")).alias("centre")).collect()  # `most` at most
    if len(rows) < n:
        raise ValueError(f"{n} clusters need more than {most} features")
    found = merged([(r.cell, r.centre) for r in rows], n)
    table = points.sparkSession.createDataFrame([(r.cell, c) for r, c in zip(rows, found, strict=True)], "cell array<long>, cluster int")
    cell = F.transform(cell_of(coords, threshold), lambda x: F.floor(x / F.lit(float(2**level))))
    placed = points.dropna(subset=coords).withColumn("cell", cell).join(F.broadcast(table), "cell").drop("cell")
    return placed, threshold * 2**level
