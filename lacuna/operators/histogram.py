"""Equal-width histograms, zero and occupied intervals, densities, and histograms over given edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.numeric import bin_index, edge, linspace
from lacuna.operators import lineage


def with_bin(df: DataFrame, stats: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """df with its bin, by the stats of its keys. stats has one row per key: dimensions times elements, not rows."""
    joined = df.join(stats.select(*keys, "vmin", "vmax", "nbins"), keys)
    return joined.withColumn("bin", bin_index(F.col(value), F.col("vmin"), F.col("vmax"), F.col("nbins")))


def counts(df: DataFrame, stats: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, bin, lo, hi and freq for every bin, empty ones too."""
    found = with_bin(df, stats, keys, value).groupBy(*keys, "bin").agg(F.count("*").alias("freq"))
    every = stats.select(*keys, "vmin", "vmax", "nbins", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nbins") - 1)).alias("bin"))
    k, args = F.col("bin"), (F.col("vmin"), F.col("vmax"), F.col("nbins"))
    return every.join(found, [*keys, "bin"], "left").select(*keys, "bin", edge(k, *args).alias("lo"), edge(k + 1, *args).alias("hi"), F.coalesce("freq", F.lit(0).cast("long")).alias("freq"))


def low_intervals(histogram: DataFrame, state_population: int = 0) -> DataFrame:
    """Bins with at most state_population values."""
    return histogram.where(F.col("freq") <= state_population)


def occupied_intervals(histogram: DataFrame) -> DataFrame:
    return histogram.where("freq > 0")


def density_2d(df: DataFrame, x: str, y: str, bins: int = 100) -> DataFrame:
    """df with `density`: how many points share the point's cell of a bins by bins grid over the ranges of x and y."""
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in (x, y) for f in (F.min, F.max)])
    n = F.lit(bins)
    placed = df.crossJoin(F.broadcast(ends))  # one row
    cells = {f"_{c}": bin_index(F.col(c), F.col(f"min_{c}"), F.col(f"max_{c}"), n) for c in (x, y)}
    placed = placed.withColumns(cells).drop(*ends.columns)
    of = placed.groupBy(*cells).agg(F.count("*").alias("density"))
    return placed.join(of, list(cells)).drop(*cells)


def edges_with_threshold(end: float, count: int, threshold: float) -> list[float]:
    """linspace(0, end, count) with the threshold put in, rounded to 3 decimals; at the end where it lies beyond."""
    rounded = round(threshold, 3)
    return sorted({*linspace(0.0, end, count), rounded})


def histogram_over(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """bin, lo, hi and freq over given edges; the last bin is closed, values outside are dropped, empty bins stay."""
    last = len(edges) - 2
    pairs = F.array(*[F.lit(float(e)) for e in edges])
    k = F.size(F.filter(pairs, lambda e: e <= F.col(value))) - 1
    k = F.when(F.col(value) == edges[-1], F.lit(last)).otherwise(k)
    found = df.where(F.col(value).between(edges[0], edges[-1])).groupBy(k.cast("long").alias("bin")).agg(F.count("*").alias("freq"))
    every = df.sparkSession.createDataFrame([(i, float(edges[i]), float(edges[i + 1])) for i in range(last + 1)], "bin long, lo double, hi double")
    return every.join(found, "bin", "left").fillna({"freq": 0})


def coverage_score(df: DataFrame, keys: list[str], value: str, nbins: int) -> DataFrame:
    """Share of nbins - 1 cells between min and max that hold a value."""
    ends = df.groupBy(*keys).agg(F.min(value).alias("vmin"), F.max(value).alias("vmax")).withColumn("nbins", F.lit(nbins - 1).cast("long"))
    return with_bin(df, ends, keys, value).groupBy(*keys).agg((F.countDistinct("bin") / F.lit(float(nbins - 1))).alias("score"))


def by_density(df: DataFrame, ties: list[str], density: str = "density") -> DataFrame:
    """df with place, from 0 for the thinnest; equal densities are in order of `ties`."""
    return lineage.ranked(df, [F.col(density), *[F.col(c) for c in ties]]).withColumnRenamed("rank", "place")


def cumulative(histogram: DataFrame, keys: list[str]) -> DataFrame:
    return histogram.withColumn("upto", F.sum("freq").over(Window.partitionBy(*keys).orderBy("bin")))
