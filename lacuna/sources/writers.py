"""Writers: structures as extended XYZ and CFG text, reports and tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.tensors import to_voigt


def joined(numbers: Column, form: str = "%.8f", by: str = " ") -> Column:
    return F.array_join(F.transform(numbers, lambda x: F.format_string(form, x)), by)


def extxyz_text(structures: DataFrame) -> DataFrame:
    """structure_id and value, a frame's text without its last line break. Forces, energy, virial, main and label appear
    where they are not null; columns that are missing count as null."""
    have = set(structures.columns)
    col = lambda name, kind: F.col(name) if name in have else F.lit(None).cast(kind)
    forces = col("forces", "array<array<double>>")
    some = lambda name, kind, text: F.when(col(name, kind).isNotNull(), text(col(name, kind))).otherwise(F.lit(""))
    header = F.concat(
        F.lit('Lattice="'), joined(F.col("cell")), F.lit('" Properties=species:S:1:pos:R:3'), F.when(forces.isNotNull(), F.lit(":forces:R:3")).otherwise(F.lit("")),
        some("energy", "double", lambda x: F.format_string(" energy=%.8f", x)), some("virial", "array<double>", lambda x: F.concat(F.lit(' virial="'), joined(x), F.lit('"'))),
        some("main", "int", lambda x: F.concat(F.lit(" main="), x.cast("string"))), some("label", "string", lambda x: F.concat(F.lit(" label="), x)), F.lit(' pbc="T T T" '),
    )
    number = lambda v: joined(v, "% 16.8f", "")
    rows = F.zip_with(F.col("symbols"), F.arrays_zip(F.col("positions").alias("p"), F.coalesce(forces, F.array().cast("array<array<double>>")).alias("f")), lambda s, x: F.concat(F.rpad(s, 4, " "), number(x["p"]), F.coalesce(number(x["f"]), F.lit(""))))
    return structures.select("structure_id", F.concat_ws("\n", F.size("symbols").cast("string"), header, F.array_join(rows, "\n")).alias("value"))


def elements_in(structures: DataFrame) -> list[str]:
    """The elements of all structures, in order of atomic number: a hundred or so."""
    from lacuna.operators.structures import by_atomic_number, distinct_elements

    return by_atomic_number([r.symbol for r in distinct_elements(structures).collect()])


def cfg_text(structures: DataFrame, elements: list[str] | None = None, allow_missing: bool = False) -> DataFrame:
    """structure_id and value, a labelled block. Types are places in `elements`, or in the elements that there are in order
    of atomic number. A missing label is an error unless allowed,
    and then 0; blocks of tables without forces have positions alone."""
    names = F.array(*[F.lit(e) for e in (elements if elements is not None else elements_in(structures))])
    have = set(structures.columns)

    def label(name: str, zero: Column) -> Column:
        if name not in have:
            return zero
        return F.coalesce(F.col(name), zero if allow_missing else F.raise_error(F.lit(f"no {name}")).cast(structures.schema[name].dataType))

    labelled = "forces" in have
    none = F.transform("symbols", lambda s: F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)))
    forces = label("forces", none) if labelled else none
    rows = F.zip_with(F.sequence(F.lit(1), F.size("symbols")), F.arrays_zip(F.col("symbols").alias("s"), F.col("positions").alias("p"), forces.alias("f")), lambda i, x: F.concat(F.format_string("%10d %4d ", i, (F.array_position(names, x["s"]) - 1).cast("int")), joined(F.concat(x["p"], x["f"]) if labelled else x["p"], "%14.8f")))
    columns = "cartes_x cartes_y cartes_z" + " fx fy fz" * labelled
    parts = [F.lit("BEGIN_CFG"), F.lit(" Size"), F.format_string("%6d", F.size("symbols")), F.lit(" Supercell"), *[joined(F.slice("cell", 3 * i + 1, 3), "%14.8f") for i in range(3)], F.lit(f" AtomData:  id type {columns}"), F.array_join(rows, "\n")]
    if labelled:
        zeros = F.array(*[F.lit(0.0)] * 9)
        parts += [F.lit(" Energy"), F.format_string("%20.8f", label("energy", F.lit(0.0))), F.lit(" PlusStress:  xx yy zz yz xz xy"), joined(to_voigt(label("virial", zeros)), "%14.8f")]
    return structures.select("structure_id", F.concat_ws("\n", *parts, F.lit("END_CFG\n")).alias("value"))


def write_text(texts: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None, form: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Blocks in order of structure_id, in `files` files of consecutive blocks (None: as many as the range sort makes). With
    `form`, they are structures that it makes texts of once they are sorted: what is dealt by ranges is made twice, as a
    sample of it tells the ranges."""
    ordered = texts.repartitionByRange(files, "structure_id") if files else texts.repartitionByRange("structure_id")
    ordered = ordered.sortWithinPartitions("structure_id")
    (form(ordered) if form else ordered).select("value").write.mode(mode).text(path)


def write_selected(flagged: DataFrame, path: str, mode: str = "errorifexists", current: DataFrame | None = None) -> None:
    """Two outputs of one flagged table: selected structures, after those of `current` where it is given, and the rest."""
    chosen = flagged.where("selected").drop("selected")
    if current is not None:
        before = current.select(*[F.col(c) if c in current.columns else F.lit(None).cast(chosen.schema[c].dataType).alias(c) for c in chosen.columns])
        ends = before.agg(F.coalesce(F.max("structure_id") + 1, F.lit(0)).alias("_end"))
        first = chosen.agg(F.coalesce(F.min("structure_id"), F.lit(0)).alias("_start"))
        moved = chosen.crossJoin(F.broadcast(ends)).crossJoin(F.broadcast(first))  # one row each
        chosen = before.unionByName(moved.withColumn("structure_id", F.col("structure_id") - F.col("_start") + F.col("_end")).drop("_start", "_end"))
    for name, part in (("selected", chosen), ("remain", flagged.where("not selected").drop("selected"))):
        write_text(part, f"{path}/{name}", mode, form=extxyz_text)


def hours_text(hours: DataFrame) -> str:
    """Text of a core hour report: a block for each category of metrics.core_hours, their sum, and the logs left out."""
    rows = sorted((r for r in hours.collect() if r.category is not None), key=lambda r: r.category)  # one row a category
    lines = []
    for r in rows:
        lines += [f"{r.category}: {r.core_hours:.6f}", f"  task_count: {r.n_files}", f"  counted_count: {r.n_files - len(r.missing)}"]
    lines += [f"total_core_hours: {sum(r.core_hours for r in rows):.6f}", "missing_runtime_records:"]
    lines += [f"  - {r.category}: {path}" for r in rows for path in r.missing] or ["  - none"]
    return "\n".join(lines) + "\n"


def summary_csv(results: DataFrame, body: str = "body", value: str = "coverage") -> DataFrame:
    """One row a dataset and element with a column for each body, fixed decimals."""
    wide = results.groupBy("dataset", "elem").pivot(body).agg(F.first(value))
    return wide.select("dataset", "elem", *[F.format_number(F.col(f"`{c}`"), "0.000000").alias(f"coverage_{c}") for c in wide.columns[2:]])


def coverage_csv(results: DataFrame, bodies: list[str], settings: dict[str, str]) -> DataFrame:
    """The rows of a coverage report as text columns: dataset, element, the settings, coverages as shares with ten decimals and
    as percent with six, counts, and these for each body; what a row lacks is empty."""
    share = lambda c: F.coalesce(F.format_string("%.10f", F.col(c)), F.lit(""))
    six = lambda c: F.coalesce(F.format_string("%.6f", c), F.lit(""))
    percent = lambda c: six(F.col(c) * 100)
    columns = [F.col("label").alias("dataset"), F.col("elem").cast("string").alias("element"), *[F.lit(v).alias(k) for k, v in settings.items()]]
    if "coverage_2d" in results.columns:
        columns += [share("coverage_2d").alias("coverage_2d"), percent("coverage_2d").alias("coverage_2d_percent")]
    columns += [share("coverage_1d").alias("coverage_1d_mean"), percent("coverage_1d").alias("coverage_1d_mean_percent")]
    if "n_covered_2d" in results.columns:
        columns.append(F.col("n_covered_2d").cast("string").alias("covered_2d_count"))
    columns.append(six(F.col("mean_covered_1d")).alias("covered_1d_mean_count"))
    for b in bodies:
        columns += [share(f"coverage_1d_{b}").alias(f"coverage_1d_{b}"), percent(f"coverage_1d_{b}").alias(f"coverage_1d_{b}_percent"), six(F.col(f"mean_covered_1d_{b}")).alias(f"covered_1d_{b}_mean_count")]
    columns += [F.col("n_query").cast("string").alias("query_count"), F.col("n_input").cast("string").alias("input_count")]
    return results.select(*columns, *([share("explained").alias("explained_variance_2d")] if "explained" in results.columns else []))


def error_points(pairs: DataFrame, kind: str = "kind", truth: str = "truth", pred: str = "pred") -> DataFrame:
    """kind and value, a line a point: truth, prediction and their difference with eight decimals."""
    row = F.concat_ws(",", *[F.format_string("%.8f", x) for x in (F.col(truth), F.col(pred), F.col(pred) - F.col(truth))])
    return pairs.select(kind, row.alias("value"))


def points_text(points: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """PC1 PC2 Is_Covered, separated by blanks, one folder for each dataset and element."""
    rows = points.select("dataset", "elem", F.col("pc1").alias("PC1"), F.col("pc2").alias("PC2"), F.col("covered").cast("int").alias("Is_Covered"))
    rows.write.mode(mode).partitionBy("dataset", "elem").option("sep", " ").option("header", True).csv(path)


def report(df: DataFrame) -> DataFrame:
    """value: each row as a JSON object."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def reduce_report(flagged: DataFrame, mode: str, settings: dict[str, str | int | float | None], current: DataFrame | None = None, append_current: bool = False) -> DataFrame:
    """One row: the mode, settings and counts of a reduction flagged(structure_id, selected), current(structure_id)."""
    n_current = current.select("structure_id").distinct().count() if current is not None else 0
    counts = flagged.agg(F.count("*").alias("input_count"), F.lit(n_current).cast("long").alias("current_count"), F.count_if("selected").alias("selected_from_input"), F.count_if(~F.col("selected")).alias("remain_from_input"))
    counts = counts.withColumn("output_count", F.col("selected_from_input") + (F.col("current_count") if append_current else F.lit(0)))
    return counts.select(F.lit(mode).alias("mode"), *[F.lit(v).alias(k) for k, v in settings.items()], *counts.columns)


def build_report(spark: SparkSession, counts: dict[str, int], made: list[str], found: list[str]) -> DataFrame:
    """One row: what a build's stages hold, how many it made, and whether it went on with or reused another's."""
    row = (counts, len(made), bool(made and found), not made)
    return spark.createDataFrame([row], "counts map<string,long>, stages_made int, resumed_from_existing_build boolean, reused_existing boolean")
