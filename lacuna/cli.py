"""Command line: python -m lacuna.cli COMMAND config.jsonc, with commands reduce, coverage-report, efs-stats, plot-errors,
core-hours, benchmark-selection and calibrate-selection. Inputs and outputs are Parquet tables named in the configuration."""

from __future__ import annotations

import json
import sys
from pathlib import Path

from lacuna import benchmark
from lacuna.functions.text import load_config

#: Keys that configurations may no longer have.
REMOVED = ("bw", "bw_method", "coverage_threshold", "stru_num_list")


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.getOrCreate()


def reduce_command(config: dict) -> None:
    from pyspark.sql import functions as F

    from lacuna.plans import reduce

    spark = _session()
    read = lambda key: spark.read.parquet(config[key]) if config.get(key) else None
    binning = reduce.Binning(config.get("method", "fd"), float(config.get("factor", 1.0)), config.get("width"), int(config.get("state_population", 0)))
    if config.get("mode", "candidate_only") == "candidate_only":
        out = reduce.candidate_only(read("input"), binning, read("current"), read("interval_ref"))
    else:
        out = reduce.reference_guided(read("input"), int(config["chunk_size"]), binning, read("current"), read("interval_ref"), bool(config.get("dynamic_width", True)))
    out.write.mode(config.get("write_mode", "errorifexists")).parquet(config["output"])
    done = spark.read.parquet(config["output"]).agg(F.count("*").alias("n"), F.count_if("selected").alias("n_selected")).first()
    print(json.dumps({"structures": done.n, "selected": done.n_selected, "remain": done.n - done.n_selected}))


def coverage_command(config: dict) -> None:
    from lacuna.plans.report import coverage_report

    spark = _session()
    out = coverage_report(spark.read.parquet(config["dataset"]), spark.read.parquet(config["query"]), config.get("loops", "all"), config.get("fit_source", "combined"), config.get("grid_source", "query"), float(config.get("factor", 1.0)))
    out.write.mode(config.get("write_mode", "errorifexists")).option("header", True).csv(config["output"])


def efs_command(config: dict) -> None:
    from lacuna.operators import metrics

    frames = _session().read.parquet(config["input"])
    metrics.value_stats(metrics.efs_values(frames), ["kind"], "value").write.mode(config.get("write_mode", "errorifexists")).json(config["output"])


def errors_command(config: dict) -> None:
    from pyspark.sql import functions as F

    from lacuna.operators import metrics

    spark = _session()
    on = config.get("on", ["frame_idx", "atom_idx"])
    pairs = metrics.positional_join(spark.read.parquet(config["truth"]), spark.read.parquet(config["prediction"]).withColumnRenamed("value", "pred_value"), on)
    metrics.error_metrics(pairs.withColumn("all", F.lit("all")), ["all"], "value", "pred_value").write.mode(config.get("write_mode", "errorifexists")).json(config["output"])


def hours_command(config: dict) -> None:
    from pyspark.sql import functions as F

    from lacuna.functions import text
    from lacuna.operators import metrics
    from lacuna.sources.writers import hours_text

    spark = _session()
    logs = None
    for category, path in sorted(config["categories"].items()):
        part = spark.read.text(path, wholetext=True).select(F.lit(category).alias("category"), F.col("_metadata.file_path").alias("path"), F.concat(text.runtimes(F.col("value")), text.wall_times(F.col("value"))).alias("seconds"), F.coalesce(text.cores(F.col("value")), F.lit(config.get("cores"))).cast("int").alias("cores"))
        logs = part if logs is None else logs.union(part)
    hours = metrics.core_hours(logs)
    if config.get("format", "json") == "text":
        Path(config["output"]).write_text(hours_text(hours), encoding="utf-8")
    else:
        hours.write.mode(config.get("write_mode", "errorifexists")).json(config["output"])


COMMANDS = {"reduce": reduce_command, "coverage-report": coverage_command, "efs-stats": efs_command, "plot-errors": errors_command, "core-hours": hours_command}


def main(args: list[str]) -> int:
    if args == ["benchmark-selection"]:
        print(json.dumps(benchmark.run()))
    elif args and args[0] == "calibrate-selection" and len(args) <= 2:
        print(json.dumps({"cases": benchmark.calibrate(int(args[1]) if len(args) == 2 else 120)}))
    elif len(args) == 2 and args[0] in COMMANDS:
        COMMANDS[args[0]](load_config(Path(args[1]).read_text(encoding="utf-8"), REMOVED))
    else:
        print(__doc__, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
