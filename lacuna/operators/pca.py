"""Principal components by one aggregation: moments in the cluster, the small eigenproblem on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PcaModel:
    mean: np.ndarray
    scale: np.ndarray
    components: np.ndarray
    explained: float


def moments(df: DataFrame, features: str, key: list[str]) -> DataFrame:
    """key, i, j, n, si, sj and sij for i <= j: D(D+1)/2 sums per key, aggregated before the shuffle."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(features) - 1), lambda i: F.struct(i.alias("i"), F.get(features, i).alias("x")))
    a = df.select(*key, features, F.explode(pairs).alias("a")).select(*key, features, "a.*").where("x is not null")
    b = a.select(*key, "i", F.col("x").alias("xi"), F.posexplode(features).alias("j", "xj")).where("j >= i")
    return b.groupBy(*key, "i", "j").agg(F.count("*").alias("n"), F.sum("xi").alias("si"), F.sum("xj").alias("sj"), F.sum(F.col("xi") * F.col("xj")).alias("sij"))


def solve(rows: list, k: int) -> PcaModel:
    """Standardise by the population deviation (0 counts as 1), eigenvectors of the correlation matrix; signs are set so
    that the largest entry of a component is positive, and missing components are zero."""
    d = max(r["j"] for r in rows) + 1
    n, mean, second = rows[0]["n"], np.zeros(d), np.zeros((d, d))
    for r in rows:
        mean[r["i"]], mean[r["j"]] = r["si"] / n, r["sj"] / n
        second[r["i"], r["j"]] = second[r["j"], r["i"]] = r["sij"] / n
    cov = second - np.outer(mean, mean)
    var = np.maximum(np.diag(cov), 0.0)
    var = np.where(var <= 1e-12 * np.maximum(1.0, mean * mean), 0.0, var)
    scale = np.where(var > 0, np.sqrt(var), 1.0)
    values, vectors = np.linalg.eigh(cov / np.outer(scale, scale))
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1].T
    components = np.zeros((k, d))
    top = vectors[: min(k, d, n)]
    components[: len(top)] = top * np.sign(top[np.arange(len(top)), np.abs(top).argmax(axis=1)])[:, None]
    total = values.sum()
    return PcaModel(mean, scale, components, float(values[:k].sum() / total) if total > 0 else 0.0)


def fit(df: DataFrame, features: str = "features", key: str | None = None, k: int = 2) -> dict:
    """A model for each value of key (None: one model under None). The driver gets D * D numbers for each key."""
    found: dict = {}
    for r in moments(df, features, [key] if key else []).collect():
        found.setdefault(r[key] if key else None, []).append(r)
    return {name: solve(rows, k) for name, rows in found.items()}


def project(df: DataFrame, model: PcaModel, features: str = "features", prefix: str = "pc") -> DataFrame:
    """df with pc1, pc2, ...: one dot product each, in the JVM."""
    columns = {}
    for c in range(len(model.components)):
        weight = model.components[c] / model.scale
        w = F.array(*[F.lit(float(x)) for x in weight])
        dot = F.aggregate(F.zip_with(F.col(features), w, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        columns[f"{prefix}{c + 1}"] = dot - float(weight @ model.mean)
    return df.withColumns(columns)


def project_by(df: DataFrame, models: dict, key: str, features: str = "features", prefix: str = "pc") -> DataFrame:
    """df with pc1, pc2, ... by the model of its key, in one scan; keys without a model are left out. A row a key is sent."""
    k = max(len(m.components) for m in models.values())
    rows = [(name, [(m.components[c] / m.scale).tolist() for c in range(k)], [float(m.components[c] / m.scale @ m.mean) for c in range(k)]) for name, m in models.items()]
    table = df.sparkSession.createDataFrame(rows, f"_key {df.schema[key].dataType.simpleString()}, _w array<array<double>>, _o array<double>")
    joined = df.join(F.broadcast(table), F.col(key) == F.col("_key"))  # the models came from the driver
    dot = lambda w: F.aggregate(F.zip_with(F.col(features), w, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return joined.withColumns({f"{prefix}{c + 1}": dot(F.get("_w", F.lit(c))) - F.get("_o", F.lit(c)) for c in range(k)}).drop("_key", "_w", "_o")


def explained(models: dict, spark, key: str) -> DataFrame:
    return spark.createDataFrame([(name, m.explained) for name, m in models.items()], f"{key} long, explained double")


def cluster_sample(df: DataFrame, features: str, n_clusters: int, per_cluster: int, id_column: str, k: int = 2, seed: int = 1, threshold: float = 0.1) -> DataFrame:
    """Standardise, project, cluster by clustering features of the threshold, and keep per_cluster points of each cluster. Which
    points stand for a cluster goes by a hash."""
    from pyspark.sql import Window

    from lacuna.operators.cluster import cluster

    model = fit(df, features, None, k)[None]
    clusters, _ = cluster(project(df, model, features), [f"pc{i + 1}" for i in range(k)], n_clusters, threshold)
    order = Window.partitionBy("cluster").orderBy(F.xxhash64(F.col(id_column), F.lit(seed)), id_column)
    return clusters.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_cluster).drop("_r")
