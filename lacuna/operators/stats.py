"""Per-dimension statistics and bin counts of a long table, one row per value.

Keys are any grouping columns, usually (body, elem, dim). Counts, ends and deviations are one partial aggregation on the keys.
Quantiles are exact without a task that holds a key's values: see `order_statistics`.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lacuna.functions import numeric

METHODS = ("fd", "scott", "std", "self_input")
#: Rows of a window of values that are ranked at once, and parts by rank of a larger one.
SMALL, CELLS = 1_000_000, 1000


def explode_features(df: DataFrame, features: str = "features", keep: list[str] | None = None) -> DataFrame:
    """One row per dimension: keep columns, dim and value."""
    keep = keep if keep is not None else [c for c in df.columns if c != features]
    return df.select(*keep, F.posexplode(features).alias("dim", "value"))


def dim_stats(df: DataFrame, keys: list[str], value: str = "value", method: str = "fd", factor: float = 1.0, width: float | None = None) -> DataFrame:
    """keys, n, vmin, vmax, q25, q75, sigma, nbins and step. Bin rules: Freedman-Diaconis, Scott, a tenth of the standard
    deviation, or a given width, which must be positive."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; one of {', '.join(METHODS)}")
    if method == "self_input" and not (width and width > 0):
        raise ValueError("self_input needs a positive width")
    v = F.col(value)
    # min and max of doubles order NaN last; a NaN would poison the bins, so it is refused as the reference's histogram does
    checked = F.when(F.isnan(v), F.raise_error(F.lit("NaN in a histogram dimension"))).otherwise(v)
    rows = df.where(v.isNotNull()).withColumn(value, checked.cast("double"))
    ends = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(value).alias("vmin"), F.max(value).alias("vmax"), F.stddev_pop(value).alias("sigma"))
    q = order_statistics(rows, keys, value, (0.25, 0.75)).withColumnsRenamed({"q0": "q25", "q1": "q75"})
    return with_bins(ends.join(q, keys).select(*keys, "n", "vmin", "vmax", "q25", "q75", "sigma"), method, factor, width)


def with_bins(stats: DataFrame, method: str, factor: float = 1.0, width: float | None = None) -> DataFrame:
    n, span, iqr, sigma = F.col("n"), F.col("vmax") - F.col("vmin"), F.col("q75") - F.col("q25"), F.col("sigma")
    bins = {
        "fd": lambda: numeric.fd_bins(n, span, iqr, sigma, factor),
        "scott": lambda: numeric.scott_bins(n, span, sigma, factor),
        "std": lambda: numeric.std_bins(span, sigma),
        "self_input": lambda: numeric.width_bins(span, float(width)),
    }[method]()
    return stats.withColumn("nbins", bins).withColumn("step", span / F.col("nbins"))


def widths(stats: DataFrame, keys: list[str]) -> DataFrame:
    """keys and width: span over bins, 0 without either."""
    return stats.select(*keys, F.when((F.col("vmax") > F.col("vmin")) & (F.col("nbins") > 0), (F.col("vmax") - F.col("vmin")) / F.col("nbins")).otherwise(F.lit(0.0)).alias("width"))


def fixed_width_stats(df: DataFrame, width_table: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, n, vmin, vmax, nbins and step with bins of the widths given per key; 1 bin where the width is not positive."""
    out = df.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("vmin"), F.max(value).alias("vmax")).join(width_table, keys, "left")
    span = F.col("vmax") - F.col("vmin")
    return out.withColumn("nbins", numeric.width_bins(span, F.coalesce("width", F.lit(0.0)))).withColumn("step", span / F.col("nbins")).drop("width")


def order_statistics(df: DataFrame, keys: list[str], value: str, quantiles: tuple[float, ...], small: int = SMALL) -> DataFrame:
    """Exact linear-interpolated quantiles: keys and one column q0, q1, ... for each quantile. Nulls do not count.

    Each place that a quantile needs lies in a window of values, at first all of the key's. While windows hold more than
    `small` rows, an approximate summary of them tells narrower ones by rank, so that outliers do not matter, and the rows
    before and within these are counted. The different values of the last windows are ranked, `small` of them at most, unless
    the values next to a place cannot be told apart.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    ends = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    places = sorted({f for q in quantiles for f in ((q, "floor"), (q, "ceil"))})
    place = lambda q, side: getattr(F, side)((F.col("_n") - 1) * F.lit(float(q)))
    every = F.array_distinct(F.array(*[place(q, side).cast("long") for q, side in places]))
    windows = stored(ends.withColumn("_place", F.explode(every)).withColumns({"_before": F.lit(0).cast("long"), "_inside": F.col("_n")}))
    while (most := windows.where("_low < _high").agg(F.max("_inside")).first()[0] or 0) > small:
        narrower = stored(narrowed(rows, windows, keys, small))
        windows, last = narrower, most
        if (narrower.where("_low < _high").agg(F.max("_inside")).first()[0] or 0) >= last:
            break
    # a window of one value needs no ranking
    known = windows.where("_low = _high").select(*keys, "_n", "_place", F.col("_low").alias("_v"))
    open_ = windows.where("not _low = _high")
    window = [*keys, "_low", "_high", "_before"]  # places of one window share its ranks
    values = within(rows, open_.select(*window).distinct(), keys).groupBy(*window, "_v").agg(F.count("*").alias("_c"))
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*window).orderBy("_v"))
    held = (F.col("_upto") - F.col("_c") <= F.col("_place")) & (F.col("_place") < F.col("_upto"))
    found = values.withColumn("_upto", upto).join(open_, window).where(held).select(*keys, "_n", "_place", "_v")
    at = lambda q, side: F.min(F.when(F.col("_place") == place(q, side), F.col("_v")))
    exact = lambda q: (F.max("_n") - 1) * F.lit(float(q))
    between = lambda q: F.when(at(q, "floor") == at(q, "ceil"), at(q, "floor")).otherwise(at(q, "floor") + (at(q, "ceil") - at(q, "floor")) * (exact(q) - F.floor(exact(q))))
    return known.union(found).groupBy(*keys).agg(*[between(q).alias(f"q{i}") for i, q in enumerate(quantiles)])


def within(rows: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """rows once for each window of their key that holds them: a few windows a key."""
    held = (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))
    joined = rows.join(windows, keys) if keys else rows.crossJoin(F.broadcast(windows))  # a window a place
    return joined.where(held)


def narrowed(rows: DataFrame, windows: DataFrame, keys: list[str], small: int) -> DataFrame:
    """The windows of more than `small` rows cut to about a five hundredth of their rows around their place."""
    inside = within(rows, windows.where(F.col("_inside") > small).where("_low < _high"), keys)
    of = [*keys, "_n", "_place", "_before", "_inside", "_low", "_high"]
    edges = inside.groupBy(*of).agg(F.percentile_approx("_v", [i / CELLS for i in range(CELLS + 1)], 10 * CELLS).alias("_edges"))
    share = (F.col("_place") - F.col("_before")) / F.col("_inside") * CELLS
    low, high = F.greatest(F.floor(share) - 1, F.lit(0)).cast("int"), F.least(F.ceil(share) + 1, F.lit(CELLS)).cast("int")
    ends = edges.select(*of, F.when(low == 0, F.col("_low")).otherwise(F.get("_edges", low)).alias("_a"), F.when(high == CELLS, F.col("_high")).otherwise(F.get("_edges", high)).alias("_z"))
    counted = within(rows, ends, keys).groupBy(*of, "_a", "_z").agg(F.count_if(F.col("_v") < F.col("_a")).alias("_less"), F.count_if(F.col("_v").between(F.col("_a"), F.col("_z"))).alias("_held"))
    before = F.col("_before") + F.col("_less")
    right = (before <= F.col("_place")) & (F.col("_place") < before + F.col("_held"))
    pick = lambda yes, no: F.when(right, yes).otherwise(F.col(no))
    cut = counted.select(*keys, "_n", pick(F.col("_a"), "_low").alias("_low"), pick(F.col("_z"), "_high").alias("_high"), "_place", pick(before, "_before").alias("_before"), pick(F.col("_held"), "_inside").alias("_inside"))
    return windows.where((F.col("_inside") <= small) | (F.col("_low") >= F.col("_high"))).select(*cut.columns).union(cut)


def mean_descriptor(df: DataFrame, keys: list[str], features: str = "features") -> DataFrame:
    """One vector per key: the mean of every dimension."""
    means = df.select(*keys, F.posexplode(features).alias("dim", "value")).groupBy(*keys, "dim").agg(F.avg("value").alias("m"))
    return means.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda x: x["m"]).alias("features"))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only within one process (tests) a local one is made where that is unset."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="lacuna-")


def stored(df: DataFrame) -> DataFrame:
    """df without its lineage, in the shared checkpoint folder: a lost executor reads it again and does not make it anew."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
