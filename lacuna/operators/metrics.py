"""Label statistics, error metrics, ensemble disagreement, core hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.tensors import EV_PER_A3_TO_GPA, to_voigt, volume


def value_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, mean, std (population), mad (around the mean), vmin, vmax and n. The mean is joined back: two passes."""
    means = df.groupBy(*keys).agg(F.avg(value).alias("mean"))
    joined = df.join(means, keys) if keys else df.crossJoin(F.broadcast(means))
    return joined.groupBy(*keys).agg(F.max("mean").alias("mean"), F.stddev_pop(value).alias("std"), F.avg(F.abs(F.col(value) - F.col("mean"))).alias("mad"), F.min(value).alias("vmin"), F.max(value).alias("vmax"), F.count(value).alias("n"))


def efs_values(frames: DataFrame) -> DataFrame:
    """kind and value of frames(n_atoms, energy, forces, stress): energy per atom, force components, stress components."""
    parts = [
        frames.where("energy is not null").select(F.lit("energy").alias("kind"), F.try_divide(F.col("energy"), F.col("n_atoms")).alias("value")),
        frames.where("forces is not null").select(F.lit("force").alias("kind"), F.explode(F.flatten("forces")).alias("value")),
        frames.where("stress is not null").select(F.lit("stress").alias("kind"), F.explode("stress").alias("value")),
    ]
    return parts[0].union(parts[1]).union(parts[2])


def error_metrics(df: DataFrame, keys: list[str], truth: str, pred: str, factor: float = 1000.0) -> DataFrame:
    """keys, mae, rmse (both times factor), r2 and n; r2 is null where the truth is constant."""
    d = F.col(pred) - F.col(truth)
    sse, sst = F.sum(d * d), F.var_pop(truth) * F.count(truth)
    return df.groupBy(*keys).agg((F.avg(F.abs(d)) * factor).alias("mae"), (F.sqrt(F.avg(d * d)) * factor).alias("rmse"), (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"), F.count(d).alias("n"))


def components_long(df: DataFrame, keep: list[str], pairs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """component, truth and pred rows of named pairs of columns."""
    rows = F.array(*[F.struct(F.lit(name).alias("component"), t.alias("truth"), p.alias("pred")) for name, (t, p) in pairs.items()])
    return df.select(*keep, F.explode(rows).alias("r")).select(*keep, "r.*")


def positional_join(truth: DataFrame, pred: DataFrame, on: list[str]) -> DataFrame:
    """Frames and atoms that stand at the same place. Unequal row counts are an error, and so are places of one side alone,
    found when the rows are read."""
    n = truth.count(), pred.count()
    if n[0] != n[1]:
        raise ValueError(f"truth has {n[0]} rows and prediction {n[1]}")
    both = truth.withColumn("_t", F.lit(1)).join(pred.withColumn("_p", F.lit(1)), on, "full_outer")
    alone = F.raise_error(F.lit("a place is in truth or prediction alone")).cast("boolean")
    return both.where(F.when(F.col("_t").isNull() | F.col("_p").isNull(), alone).otherwise(F.lit(True))).drop("_t", "_p")


def stress_metrics(frames: DataFrame, truth: Column, pred: Column, cell: Column, keys: list[str] | None = None) -> DataFrame:
    """keys, unit (eV, GPa), component (xx to xy, and all) and mae, rmse, r2, n of virials by truth and prediction, each 6 or 9
    numbers in eV. GPa is the virial over the volume; components by themselves, and `all` over all six."""
    keys = keys or []
    pair = frames.select(*keys, to_voigt(truth).alias("_t"), to_voigt(pred).alias("_p"), volume(cell).alias("_v")).where("_t is not null and _p is not null")
    names = F.array(*[F.lit(c) for c in ("xx", "yy", "zz", "yz", "xz", "xy")])
    long = pair.select(*keys, "_v", F.explode(F.arrays_zip(names.alias("component"), F.col("_t").alias("truth"), F.col("_p").alias("pred"))).alias("x")).select(*keys, "_v", "x.*")
    gpa = F.try_divide(F.lit(EV_PER_A3_TO_GPA), F.col("_v"))
    units = F.explode(F.array(F.struct(F.lit("eV").alias("unit"), F.lit(1.0).alias("f")), F.struct(F.lit("GPa").alias("unit"), gpa.alias("f"))))
    each = long.withColumn("u", units).select(*keys, "u.unit", F.explode(F.array("component", F.lit("all"))).alias("component"), (F.col("truth") * F.col("u.f")).alias("truth"), (F.col("pred") * F.col("u.f")).alias("pred"))
    return error_metrics(each, [*keys, "unit", "component"], "truth", "pred", 1.0)


def skip_frames(df: DataFrame, skip: list[int], index: str = "frame_idx") -> DataFrame:
    """df without frames of these 1-based places; a place that is not there is an error."""
    last = (df.agg(F.max(index)).first()[0] or 0) if df.head(1) else 0
    if wrong := [i for i in skip if i < 1 or i > last + 1]:
        raise ValueError(f"no such frames: {wrong}")
    return df.where(~F.col(index).isin([i - 1 for i in skip])) if skip else df


def ensemble_ambiguity(forces: DataFrame, frame: list[str]) -> DataFrame:
    """frame columns and ambiguity: root of the summed population variances of the force components over models. The components
    are added up in order of value, so that the last digits, which tell at a bound, do not depend on how rows are dealt."""
    each = [f"f{c}" for c in "xyz"]
    sorted_ = forces.groupBy(*frame).agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in each])  # a number a model
    return sorted_.select(*frame, F.sqrt(sum((spread(F.col(c)) for c in each[1:]), spread(F.col(each[0])))).alias("ambiguity"))


def spread(values: Column) -> Column:
    """The population variance of an array, made by updates in its order; null if it is empty."""
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "m2")])

    def step(s: Column, x: Column) -> Column:
        n, off = s["n"] + 1, x - s["mean"]
        return F.struct(n.alias("n"), (s["mean"] + off / n).alias("mean"), (s["m2"] + off * (off - off / n)).alias("m2"))

    return F.aggregate(values, zero, step, lambda s: F.try_divide(s["m2"], s["n"]))


def ambiguity_summary(per_atom: DataFrame, frame: str = "structure_id", elem: str = "elem") -> DataFrame:
    """Maximum, minimum and mean by frame and element, and by frame (elem null, is_total 1)."""
    return per_atom.groupingSets([[F.col(frame), F.col(elem)], [F.col(frame)]], frame, elem).agg(
        F.grouping(elem).cast("int").alias("is_total"), F.max("ambiguity").alias("amb_max"), F.min("ambiguity").alias("amb_min"), F.avg("ambiguity").alias("amb_mean")
    )


def ambiguity_matrix(per_atom: DataFrame, elements: list, frame: str = "structure_id", elem: str = "elem") -> DataFrame:
    """Maximum of every frame and element, 0 where the frame lacks the element."""
    kind = per_atom.schema[elem].dataType
    every = per_atom.select(frame).distinct().withColumn(elem, F.explode(F.array(*[F.lit(e).cast(kind) for e in elements])))
    found = per_atom.groupBy(frame, elem).agg(F.max("ambiguity").alias("amb_max"))
    return every.join(found, [frame, elem], "left").fillna({"amb_max": 0.0})


def adaptive_threshold(matrix: DataFrame | None, low_factor: float, limit: float | dict, factor: float, by_element: bool = False, elem: str = "elem", default: float | None = None, generation: int = 1):
    """Threshold and new limit; the default in generation 0 and where nothing was selected before (matrix None). The largest disagreement times low_factor; a threshold above the limit raises the limit by
    `factor` once and is clamped to it. By element, each has its own. Returns (threshold, limit, clamped)."""
    if matrix is None or generation == 0:
        if default is None:
            raise ValueError("generation 0 and a missing selection need a default")
        return default, limit, False
    found = {r[elem]: r["t"] * low_factor for r in matrix.groupBy(elem).agg(F.max("amb_max").alias("t")).collect()}  # one number per element
    if by_element:
        limits = {e: limit[e] * factor if t > limit[e] else limit[e] for e, t in found.items()}
        return {e: min(t, limits[e]) for e, t in found.items()}, limits, False
    top = max(found.values(), default=0.0)
    new = limit * factor if top > limit else limit
    return min(top, new), new, top > new


def limit_memory(flags: list[bool], limit: float, factor: float) -> float:
    """The limit after a run of generations, raised once for each that was clamped."""
    for raised in flags:
        limit = limit * factor if raised else limit
    return limit


def ambiguity_window(df: DataFrame, low: float, high: float, column: str = "ambiguity") -> DataFrame:
    """Strictly between both."""
    return df.where((F.col(column) > low) & (F.col(column) < high))


def complete_prefix(df: DataFrame, frame: str = "frame_idx", keys: list[str] | None = None) -> DataFrame:
    """The first k frames, k being how many frames have as many atoms as the first one (not those frames themselves)."""
    keys = keys or []
    sizes = df.groupBy(*keys, frame).agg(F.count("*").alias("_n"))
    first = sizes.groupBy(*keys).agg(F.min_by("_n", frame).alias("_first"), F.min(frame).alias("_start"))
    joined = sizes.join(first, keys) if keys else sizes.crossJoin(F.broadcast(first))
    k = joined.groupBy(*keys).agg(F.count_if(F.col("_n") == F.col("_first")).alias("_k"), F.max("_start").alias("_start"))
    out = df.join(k, keys) if keys else df.crossJoin(F.broadcast(k))
    return out.where(F.col(frame) < F.col("_start") + F.col("_k")).drop("_k", "_start")


def core_hours(logs: DataFrame) -> DataFrame:
    """category, n_files, core_hours and missing (paths without seconds or cores), with a total row (category null).
    logs(category, path, seconds array<double>, cores)."""
    total = F.aggregate("seconds", F.lit(0.0), lambda s, x: s + x)
    known = F.col("cores").isNotNull() & (F.size("seconds") > 0)
    rows = logs.withColumn("hours", F.when(known, total * F.col("cores") / 3600.0))
    missing = F.array_sort(F.collect_list(F.when(~F.coalesce(known, F.lit(False)), F.col("path"))))
    return rows.rollup("category").agg(F.count("*").alias("n_files"), F.coalesce(F.sum("hours"), F.lit(0.0)).alias("core_hours"), missing.alias("missing"))


def mean_metrics(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def last_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
