"""Points in sorted disjoint intervals, novelty and self classes, covered labels.

Intervals of a key are few (bins of one dimension), so they travel as one sorted array per key and points are located by
a search in that array: an equi-join on the keys, never a non-equi join over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.numeric import bin_index
from lacuna.operators.stats import stored


def last_start(v: Column, starts: Column) -> Column:
    """Place of the last of the sorted starts that is not above v, -1 for none. Found by halving, so that the work for a row is
    the logarithm of the number of starts."""
    n = F.size(starts)
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(n, F.lit(1)) + 1)).cast("int")))

    def halve(at: Column, _: Column) -> Column:
        middle = ((at["lo"] + at["hi"]) / 2).cast("int")
        left = (at["lo"] < at["hi"]) & ~(F.get(starts, middle) <= v)
        right = (at["lo"] < at["hi"]) & (F.get(starts, middle) <= v)
        return F.struct(F.when(right, middle + 1).otherwise(at["lo"]).alias("lo"), F.when(left, middle).otherwise(at["hi"]).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), halve, lambda at: at["lo"] - 1)


def locate(v: Column, starts: Column, ends: Column) -> Column:
    """Index of the half-open interval that holds v, the last one closed; -1 for none, and for NaN and null."""
    n = F.size(starts)
    inside = lambda k: (k >= 0) & ((v < F.get(ends, k)) | ((k == n - 1) & (v == F.get(ends, k))))
    hit = F.transform(F.array(last_start(v, starts)), lambda k: F.when(inside(k), k).otherwise(F.lit(-1)))[0]
    return F.when(v.isNotNull() & ~F.isnan(v) & (n > 0), hit).otherwise(F.lit(-1))


def packed(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """keys, starts and ends: the intervals of a key in order of lo, then hi."""
    rows = intervals.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("x"))
    return rows.select(*keys, F.transform("x", lambda r: r["lo"]).alias("starts"), F.transform("x", lambda r: r["hi"]).alias("ends"))


def locate_points(points: DataFrame, intervals: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """points with interval_id within their key; -1 where no interval holds them."""
    joined = points.join(packed(intervals, keys), keys, "left")
    found = F.when(F.col("starts").isNull(), F.lit(-1)).otherwise(locate(F.col(value), F.col("starts"), F.col("ends")))
    return joined.withColumn("interval_id", found).drop("starts", "ends")


def group_by_interval(points: DataFrame, intervals: DataFrame, keys: list[str], value: str = "value", order: str = "atom_idx", member: str = "structure_id") -> DataFrame:
    """keys, interval_id, lo, hi and members (in order) for every interval, empty ones too."""
    placed = locate_points(points, intervals, keys, value).where("interval_id >= 0")
    members = placed.groupBy(*keys, "interval_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, member))), lambda r: r[member]).alias("members"))
    rows = packed(intervals, keys).select(*keys, F.posexplode(F.arrays_zip("starts", "ends")).alias("interval_id", "x"))
    rows = rows.select(*keys, "interval_id", F.col("x.starts").alias("lo"), F.col("x.ends").alias("hi"))
    return rows.join(members, [*keys, "interval_id"], "left").withColumn("members", F.coalesce("members", F.array().cast(points.select(F.array(member)).schema[0].dataType)))


def novelty_intervals(reference: DataFrame, candidate: DataFrame, zero: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals that candidates could newly fill: the reference's zero intervals, and what lies outside the reference of
    the candidate's own range, cut at the reference's bin width. reference, candidate: dim_stats; zero: lo, hi by key.

    A candidate bin that is partly outside is cut at the reference's edge; one that spans the whole reference range gives
    nothing; a constant reference dimension gives no intervals at all.
    """
    ref = reference.select(*keys, F.col("vmin").alias("rmin"), F.col("vmax").alias("rmax"), F.col("nbins").alias("rbins")).where("rmax > rmin and rbins > 0")
    both = candidate.select(*keys, F.col("vmin").alias("cmin"), F.col("vmax").alias("cmax")).join(ref, keys)
    width = (F.col("rmax") - F.col("rmin")) / F.col("rbins")
    n = F.greatest(F.lit(1), F.ceil(F.try_divide(F.col("cmax") - F.col("cmin"), width))).cast("long")
    n = F.when(F.col("cmax") > F.col("cmin"), n).otherwise(F.lit(1))
    bins = both.withColumn("cbins", n).where("cmin <= rmin or cmax >= rmax").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cbins") - 1)))
    step = (F.col("cmax") - F.col("cmin")) / F.col("cbins")
    upper = F.col("cmin") + (F.col("k") + 1) * step
    bins = bins.withColumns({"lo": F.col("cmin") + F.col("k") * step, "hi": F.when(F.col("k") == F.col("cbins") - 1, F.least(upper, F.col("cmax"))).otherwise(upper)})
    whole = (F.col("lo") >= F.col("rmax")) | (F.col("hi") <= F.col("rmin"))
    below = (F.col("lo") < F.col("rmin")) & F.col("hi").between(F.col("rmin"), F.col("rmax"))
    above = (F.col("hi") > F.col("rmax")) & F.col("lo").between(F.col("rmin"), F.col("rmax"))
    lo, hi = F.when(~whole & above, F.col("rmax")).otherwise(F.col("lo")), F.when(~whole & below, F.col("rmin")).otherwise(F.col("hi"))
    outside = bins.where(whole | below | above).select(*keys, lo.alias("lo"), hi.alias("hi"))
    inside = zero.join(ref.select(*keys), keys, "left_semi").select(*keys, "lo", "hi")
    return inside.union(outside)


def classes(points: DataFrame, intervals: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Memberships keys, interval_id, structure_id, atom_idx: one row per point in an interval; empty classes are no rows."""
    placed = locate_points(points, intervals, keys, value).where("interval_id >= 0")
    return placed.select(*keys, "interval_id", "structure_id", "atom_idx")


def with_class_id(memberships: DataFrame, order: list[str]) -> DataFrame:
    """class_id: dense rank of the class in `order`. The distinct classes (dimensions times bins) are numbered, not rows. Stored
    first, as both reads would search every point's interval anew."""
    memberships = stored(memberships)
    distinct = memberships.select(*order).distinct().withColumn("class_id", F.row_number().over(Window.orderBy(*order)) - 1)
    return memberships.join(distinct, order)


def uncovered(v: Column, vmin: Column, vmax: Column, in_zero: Column) -> Column:
    """In (-inf, min), a zero interval or [max, inf); the minimum and the maximum themselves are covered, and so is NaN."""
    outside = (v < vmin) | (v >= vmax) | in_zero
    return F.when(v.isNull() | F.isnan(v) | (v == vmin) | (v == vmax), F.lit(False)).otherwise(outside)


def flags(stats: DataFrame, zero: DataFrame, keys: list[str]) -> DataFrame:
    """keys, vmin, vmax, nbins and low, whether each bin is a zero interval."""
    bins = zero.groupBy(*keys).agg(F.collect_list("bin").alias("_bins"))  # a dimension's bins
    low = F.transform(F.sequence(F.lit(0).cast("long"), F.col("nbins") - 1), lambda b: F.coalesce(F.array_contains("_bins", b), F.lit(False)))
    return stats.select(*keys, "vmin", "vmax", "nbins").join(bins, keys, "left").select(*keys, "vmin", "vmax", "nbins", low.alias("low"))


def label_covered(points: DataFrame, stats: DataFrame, zero: DataFrame, keys: list[str], value: str = "value", on_missing: str = "raise") -> DataFrame:
    """points with `covered`. A key that the reference lacks is an error, or uncovered if on_missing says so. Where the zero
    intervals are bins of the reference's histogram (a column `bin`), a value's bin is computed and its flag looked up; other
    intervals are searched."""
    if on_missing not in ("raise", "uncovered"):
        raise ValueError("on_missing is raise or uncovered")
    v = F.col(value)
    if "bin" in zero.columns and "nbins" in stats.columns:
        joined = points.join(flags(stats, zero, keys), keys, "left")
        at = F.when(v.between(F.col("vmin"), F.col("vmax")), bin_index(v, F.col("vmin"), F.col("vmax"), F.col("nbins")))
        in_zero = F.coalesce(F.get("low", at.cast("int")), F.lit(False))
    else:
        nothing = F.array().cast("array<double>")
        joined = points.join(stats.select(*keys, "vmin", "vmax").join(packed(zero, keys), keys, "left"), keys, "left")
        in_zero = locate(v, F.coalesce("starts", nothing), F.coalesce("ends", nothing)) >= 0
    missing = F.raise_error(F.lit("a key of the query is not in the reference")).cast("boolean") if on_missing == "raise" else F.lit(False)
    covered = F.when(F.col("vmin").isNull(), missing).otherwise(~uncovered(v, F.col("vmin"), F.col("vmax"), in_zero))
    return joined.withColumn("covered", covered).select(*points.columns, "covered")
