"""The star-schema tables as curation data: descriptors, frames, forces, histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-dimensional descriptors: element = event type, structure = user, atom = event; the past is the reference."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("elem"), F.lit(0).alias("dim"), F.col("user_id").alias("structure_id"), F.col("event_id").alias("atom_idx"), "value", "ts", (F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")).alias("is_ref"))


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-dimensional descriptors: element = label; even ids are the reference."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("structure_id"), F.lit(0).alias("atom_idx"), F.col("label").alias("elem"), F.transform("embedding", lambda x: x.cast("double")).alias("features"), (F.col("vec_id") % 2 == 0).alias("is_ref"))


def embedding_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_rows(spark, sf_dir).select("structure_id", "elem", "is_ref", F.posexplode("features").alias("dim", "value"))


def line_forces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forces of three models: frame = order, atom = part modulo 5, model = line number modulo 3."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("structure_id"), (F.col("l_partkey") % 5).alias("elem"), (F.col("l_linenumber") % 3).alias("model"), F.col("l_quantity").alias("fx"), (F.col("l_discount") * 100).alias("fy"), (F.col("l_tax") * 100).alias("fz"))
