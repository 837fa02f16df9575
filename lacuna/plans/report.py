"""Coverage report over cumulative dataset versions on principal components and single dimensions.

Versions are nested, so a dataset point is placed once, at its own version, and counts for all later ones. Where the grid is
the same for all versions (that of the query, or of the last version), one reading does for all: a cell is occupied from the
version of its first point on. Grids that grow with the version (current-loop, combined) take a reading a version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.operators import coverage, lineage, pca
from lacuna.operators.stats import stored

GRID_SOURCES = ("query", "current-loop", "last-loop", "combined")
POINT = ["structure_id", "atom_idx"]
GRID = ["value", "gmin", "gmax", "gbins", "gwidth"]


def selected_labels(dataset: DataFrame, loops: str) -> DataFrame:
    """main, label and label_pos of the versions that a loop selector picks."""
    found = lineage.discover_labels(dataset)
    wanted = lineage.select_loops([r.main for r in found.collect()], loops)  # a row a version
    return found.where(F.col("main").isin(wanted))


def versioned(dataset: DataFrame, labels: DataFrame) -> DataFrame:
    """dataset with label_pos, the first selected version that holds a row; rows of none are left out."""
    at = F.lit(None).cast("int")
    for r in sorted(labels.select("main", "label_pos").collect(), key=lambda r: r.main, reverse=True):
        at = F.when(F.col("main") <= r.main, F.lit(r.label_pos)).otherwise(at)
    return dataset.withColumn("label_pos", at).where("label_pos is not null")


def check_widths(dataset: DataFrame, query: DataFrame) -> None:
    """Elements with fewer than two features, or unequal numbers of them, are an error."""
    widths = query.select("elem", F.size("features").alias("w")).union(dataset.select("elem", F.size("features").alias("w"))).groupBy("elem").agg(F.min("w").alias("low"), F.max("w").alias("high"))
    if wrong := [r["elem"] for r in widths.where("low <> high or low < 2").limit(20).collect()]:
        raise ValueError(f"elements with unequal or fewer than two features: {wrong}")


def long(df: DataFrame, values: str, *keep: str) -> DataFrame:
    return df.select("elem", *keep, *POINT, F.posexplode(values).alias("dim", "value"))


def by_version(cells: DataFrame, occupied: DataFrame, on: list[str], keys: list[str], labels: list[tuple[int, str]]) -> DataFrame:
    """label_pos, label, keys and n_covered: cells(on, ...) that occupied(on, label_pos) holds by each version."""
    first = occupied.groupBy(*on).agg(F.min("label_pos").alias("first"))
    hits = cells.join(first, on).groupBy(*keys, "first").agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("label_pos"), F.lit(name).alias("label")) for p, name in labels]))
    upto = hits.withColumn("x", each).where(F.col("first") <= F.col("x.label_pos"))
    return upto.groupBy("x.label_pos", *keys).agg(F.sum("n").alias("n_covered"))


def each_version(keyed: DataFrame, labels: list[tuple[int, str]]) -> DataFrame:
    """Rows of `keyed` for each version, with label_pos and label: a row a version and key."""
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("label_pos"), F.lit(name).alias("label")) for p, name in labels]))
    return keyed.withColumn("_x", each).select("_x.label_pos", "_x.label", *keyed.columns)


def single_dimensions(query: DataFrame, data: DataFrame, grid_of: DataFrame, labels: list[tuple[int, str]], factor: float) -> DataFrame:
    """label_pos, label, elem, dim, n_query, n_covered and coverage of long query values by long values with label_pos."""
    grid = coverage.grid_stats(grid_of, ["elem"], "dim", "value", factor)
    cells = lambda df: df.join(grid, ["elem", "dim"]).withColumn("cell", coverage.cell_of(*[F.col(c) for c in GRID])).where("cell is not null")
    covered = by_version(cells(query).select("elem", "dim", "cell"), cells(data), ["elem", "dim", "cell"], ["elem", "dim"], labels)
    total = each_version(query.groupBy("elem", "dim").agg(F.count("*").alias("n_query")), labels)
    out = total.join(covered, ["label_pos", "elem", "dim"], "left").fillna({"n_covered": 0})
    return out.withColumn("coverage", F.col("n_covered") / F.col("n_query"))


def planes(query: DataFrame, data: DataFrame, grid_of: DataFrame, labels: list[tuple[int, str]], factor: float) -> DataFrame:
    """label_pos, label, elem, n_query, n_covered and coverage of query points by points with label_pos, on all dimensions at once."""
    grid = coverage.grid_stats(grid_of, ["elem"], "dim", "value", factor)
    cells = lambda df, *keep: coverage.assign_cells(df, grid, ["elem"], "dim", "value", [*keep, *POINT])
    covered = by_version(cells(query).select("elem", "cells"), cells(data, "label_pos"), ["elem", "cells"], ["elem"], labels)
    total = each_version(query.groupBy("elem").agg(F.countDistinct(*POINT).alias("n_query")), labels)
    out = total.join(covered, ["label_pos", "elem"], "left").fillna({"n_covered": 0})
    return out.withColumn("coverage", F.col("n_covered") / F.col("n_query"))


def over_grids(measure, query: DataFrame, data: DataFrame, labels: list[tuple[int, str]], grid_source: str, factor: float) -> DataFrame:
    """A measure with the grid of the named source: at once where the grid is one, else version by version."""
    columns = ["elem", *POINT, "dim", "value"]
    if grid_source in ("query", "last-loop"):
        return measure(query, data, query if grid_source == "query" else data, labels, factor)
    out = None
    for label in labels:
        upto = data.where(F.col("label_pos") <= label[0])
        grid_of = upto if grid_source == "current-loop" else query.select(columns).union(upto.select(columns))
        part = measure(query, upto, grid_of, [label], factor)
        out = part if out is None else out.unionByName(part)
    return out


def with_bodies(by_dim: DataFrame, bodies: dict[str, list[int]]) -> DataFrame:
    """label_pos, elem and for each body the mean over its dimensions: coverage_1d_<body> and mean_covered_1d_<body>."""
    of = lambda dims: F.col("dim").isin(dims)
    columns = [x for name, dims in bodies.items() for x in (F.avg(F.when(of(dims), F.col("coverage"))).alias(f"coverage_1d_{name}"), F.avg(F.when(of(dims), F.col("n_covered"))).alias(f"mean_covered_1d_{name}"))]
    return by_dim.groupBy("label_pos", "label", "elem").agg(F.max("n_query").alias("n_query"), F.avg("coverage").alias("coverage_1d"), F.avg("n_covered").alias("mean_covered_1d"), *columns)


def input_counts(data: DataFrame, labels: list[tuple[int, str]]) -> DataFrame:
    """label_pos, elem and n_input, the dataset's points in each version."""
    own = data.groupBy("elem", "label_pos").agg(F.count("*").alias("n"))
    each = each_version(own.withColumnRenamed("label_pos", "first"), labels).where("first <= label_pos")
    return each.groupBy("label_pos", "elem").agg(F.sum("n").alias("n_input"))


def coverage_by_body(dataset: DataFrame, query: DataFrame, bodies: dict[str, list[int]] | None = None, loops: str = "all", grid_source: str = "query", factor: float = 1.0) -> DataFrame:
    """label_pos, label, elem, n_query, n_input, coverage_1d, mean_covered_1d and these two for each body, which names places of
    features: the mean over dimensions of the share, and of the number, of query points in cells that a version occupies."""
    if grid_source not in GRID_SOURCES:
        raise ValueError("unknown grid_source")
    labels = selected_labels(dataset, loops)
    names = [(r.label_pos, r.label) for r in labels.orderBy("label_pos").collect()]
    data = versioned(dataset, labels)
    singles = over_grids(single_dimensions, long(query, "features"), long(data, "features", "label_pos"), names, grid_source, factor)
    return with_bodies(singles, bodies or {}).join(input_counts(data, names), ["label_pos", "elem"], "left").fillna({"n_input": 0})


def coverage_report(dataset: DataFrame, query: DataFrame, loops: str = "all", fit_source: str = "combined", grid_source: str = "query", factor: float = 1.0, bodies: dict[str, list[int]] | None = None, plane_grid_source: str | None = None, plane_factor: float | None = None) -> DataFrame:
    """label_pos, label, elem, n_query, n_input, n_covered_2d, coverage_2d, coverage_1d, mean_covered_1d, the last two for each
    body, and explained, for each selected version and element. Data of fewer than two features, or of unequal numbers of them,
    are an error.

    dataset(structure_id, atom_idx, elem, features, main), query(structure_id, atom_idx, elem, features). One model of two
    components for each element, fitted on the query, the dataset or both; the grids come from the named sources, where
    `last-loop` is the last selected version; those of the plane from the same ones unless they are named.
    """
    plane_grid_source, plane_factor = plane_grid_source or grid_source, plane_factor or factor
    if fit_source not in ("query", "input", "combined") or plane_grid_source not in GRID_SOURCES:
        raise ValueError("unknown fit_source or grid_source")
    check_widths(dataset, query)
    singles = coverage_by_body(dataset, query, bodies, loops, grid_source, factor)
    labels = selected_labels(dataset, loops)
    names = [(r.label_pos, r.label) for r in labels.orderBy("label_pos").collect()]
    base = [*POINT, "elem", "features"]
    fit_on = {"query": query.select(base), "input": dataset.select(base), "combined": query.select(base).union(dataset.select(base))}[fit_source]
    models = pca.fit(fit_on, "features", "elem")
    planar = lambda df: pca.project_by(df, models, "elem").withColumn("pc", F.array("pc1", "pc2"))
    q, data = stored(long(planar(query), "pc")), stored(long(planar(versioned(dataset, labels)), "pc", "label_pos"))
    both = over_grids(planes, q, data, names, plane_grid_source, plane_factor)
    out = both.select("label_pos", "elem", F.col("n_covered").alias("n_covered_2d"), F.col("coverage").alias("coverage_2d")).join(singles, ["label_pos", "elem"])
    explained = dataset.sparkSession.createDataFrame([(e, m.explained) for e, m in models.items()], f"elem {dataset.schema['elem'].dataType.simpleString()}, explained double")
    more = [f"{c}_{name}" for name in bodies or {} for c in ("coverage_1d", "mean_covered_1d")]
    out = out.select("label_pos", "label", "elem", "n_query", "n_input", "n_covered_2d", "coverage_2d", "coverage_1d", "mean_covered_1d", *more)
    return out.join(F.broadcast(explained), "elem", "left").orderBy("label_pos", "elem")
