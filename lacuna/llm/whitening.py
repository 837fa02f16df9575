"""Embedding whitening by a tall-skinny QR decomposition.

Entries become integers, so that sums over all rows are exact: each task adds its rows as integers, and Spark adds the
tasks' sums as decimals. Rows are centred by them, n * x - S being an integer before it is divided by n. Each partition of
rows then leaves one triangular factor R of its centred rows, FAN factors at a time are stacked and decomposed again in a
tree until one is left, and the singular value decomposition of that one, dim by dim numbers, gives everything: its right
singular vectors are the covariance's eigenvectors, its squared singular values over n the eigenvalues. The covariance
itself is never formed, so that small eigenvalues keep their digits. Rows are projected on the first components and divided
by the root of the eigenvalue. What reaches the driver is the error of the result's covariance, one number.

Defined results: rows whose vector is null or holds null or non-finite entries are left out; so are empty vectors, which
have no components. Vectors of each length are a fit of their own. Components whose singular value is zero to double
precision have no whitened values and are left out (all of them, where all rows are equal or there is one row); equal
eigenvalues have any basis of their space. Each component's largest entry is positive. Entries beyond a long's range count
as the nearest long; a deviation of more than 38 digits is null, and the query's is null beyond a long. Repeated rows and
null ids count and are returned as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import cut, small_side

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Factors that are stacked in one task of the tree, and rows that a task decomposes at once.
FAN, STRIP = 16, 4096
HALF = 1 << 31


def usable(v: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad), F.lit(False))


def integers(table: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, dim and x, the entries as longs, of the usable rows of table(vec_id, embedding)."""
    v = F.col("embedding").cast("array<double>")
    number = F.transform("v", lambda c: F.least(F.greatest(F.floor(c * scale), F.lit(-(1 << 62))), F.lit(1 << 62)) + shift)
    rows = table.select(F.col("vec_id").cast("long"), v.alias("v")).where(usable(F.col("v")))
    return rows.select("vec_id", F.size("v").alias("dim"), number.alias("x"))


def blocks(batch: pa.RecordBatch, dim: int = 0, x: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, row numbers, matrix of longs) of the vectors of each length in a batch."""
    dims, column = batch.column(dim).to_numpy(), batch.column(x)
    starts = np.concatenate([[0], np.cumsum(dims)[:-1]])
    flat = column.flatten().to_numpy(zero_copy_only=False)
    for d in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == d)
        for at in range(0, len(rows), STRIP):
            some = rows[at : at + STRIP]
            yield d, some, flat[starts[some][:, None] + np.arange(d)]


def adder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """dim, x -> dim, rows and sums of the task's rows, exact: the halves of a long are added apart."""
    sums: dict[int, list] = {}
    for batch in batches:
        for d, _, x in blocks(batch):
            high, low = x >> 31, x & (HALF - 1)
            own = sums.setdefault(d, [0, [0] * d])
            own[0] += len(x)
            own[1] = [s + int(h) * HALF + int(k) for s, h, k in zip(own[1], high.sum(axis=0), low.sum(axis=0), strict=True)]
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()), pa.array([[str(s) for s in x] for _, x in sums.values()], pa.list_(pa.string()))], names=["dim", "n", "sums"])


def exact_sums(rows: DataFrame) -> DataFrame:
    """dim, n and sums (text of integers, in place order) of rows(dim, x): a row for each length of vectors."""
    parts = cut(rows.select("dim", "x").mapInArrow(adder, "dim int, n long, sums array<string>"))
    n = parts.groupBy("dim").agg(F.sum("n").alias("n"))
    each = parts.select("dim", F.posexplode("sums").alias("place", "s")).groupBy("dim", "place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = each.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("place", "s"))).alias("x"))  # as many as a vector's entries
    return n.join(sums, "dim").select("dim", "n", F.transform("x", lambda x: x["s"].cast("string")).alias("sums"))


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as longs where they fit, else as Python's integers."""
    if n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in sums) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def triangle(r: np.ndarray) -> np.ndarray:
    """The R factor of a matrix, at most as many rows as columns."""
    return np.linalg.qr(r, mode="r")


FACTOR = "dim int, part long, n long, r binary"


def factors(dim: list[int], part: list[int], n: list[int], r: list[np.ndarray]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((dim, part, n, [x.tobytes() for x in r]), kinds, strict=True)], names=["dim", "part", "n", "r"])


def decomposer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """dim, x, n, sums, part -> the R factor of the task's centred rows of each length."""
    found: dict[int, list] = {}
    for batch in batches:
        for d, rows, x in blocks(batch):
            n, sums = batch.column(2)[int(rows[0])].as_py(), [int(s) for s in batch.column(3)[int(rows[0])].as_py()]
            centred = (differences(x, n, sums) / n).astype(np.float64)
            own = found.setdefault(d, [batch.column(4)[0].as_py(), n, np.zeros((0, d))])
            own[2] = triangle(np.vstack([own[2], centred]))
    if found:
        yield factors(list(found), [p for p, _, _ in found.values()], [n for _, n, _ in found.values()], [r for _, _, r in found.values()])


def merger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """dim, part, n, factors -> the R factor of the stacked factors."""
    for batch in batches:
        dims, parts, ns, groups = (c.to_pylist() for c in batch.columns)
        out = [triangle(np.vstack([np.frombuffer(r).reshape(-1, d) for r in group])) for d, group in zip(dims, groups, strict=True)]
        yield factors(dims, parts, ns, out)


FIT = "dim int, values array<double>, vectors array<double>"


def solver(components: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The last R factor -> eigenvalues, each with its share of the trace after it, and eigenvectors, one after another."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, values, vectors = batch.column(0).to_pylist(), [], []
            for d, n, r in zip(dims, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                _, s, v = np.linalg.svd(np.frombuffer(r).reshape(-1, d), full_matrices=False)
                k = min(components, int((s > s[0] * max(d, n) * np.finfo(float).eps).sum())) if s[0] > 0 else 0
                v = v[:k] * np.where(v[np.arange(k), np.abs(v[:k]).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
                e = s * s / n
                values.append(np.stack([e[:k], e[:k] / e.sum()], axis=1).ravel() if k else np.zeros(0))
                vectors.append(v.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(values, pa.list_(pa.float64())), pa.array(vectors, pa.list_(pa.float64()))], names=["dim", "values", "vectors"])

    return solve


def fit(rows: DataFrame, sums: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """dim, n, sums, values and vectors: the components of rows(dim, x), a row for each length of vectors."""
    placed = rows.select("dim", "x").join(small_side(sums), "dim").select("dim", "x", "n", "sums", F.spark_partition_id().cast("long").alias("part"))
    r = cut(placed.mapInArrow(decomposer, FACTOR))  # one factor a task and length
    last = r.agg(F.max("part")).first()[0] or 0
    while True:
        group = r.groupBy("dim", F.floor(F.col("part") / FAN).alias("to")).agg(F.max("n").alias("n"), F.collect_list("r").alias("rs"))  # FAN factors
        r = group.select("dim", F.col("to").alias("part"), "n", "rs").mapInArrow(merger, FACTOR)
        if last < FAN:
            break
        last //= FAN
    return sums.join(r.mapInArrow(solver(components), FIT), "dim")


PROJECTED = "vec_id long, dim int, n long, deviation string, values array<double>, whitened array<double>"


def projector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dim, x, n, sums, values, vectors -> the deviation, exactly, and the values on each component."""
    for batch in batches:
        for d, rows, x in blocks(batch, 1, 2):
            n, sums, values, vectors = (batch.column(k)[int(rows[0])].as_py() for k in range(3, 7))
            far = differences(x, n, [int(s) for s in sums])
            square = far if far.dtype == object or d * max(int(far.max()), -int(far.min())) ** 2 < 1 << 63 else far.astype(object)
            deviation = [str(s) for s in (square * square).sum(axis=1).tolist()]
            e, v = np.array(values).reshape(-1, 2)[:, 0], np.array(vectors).reshape(-1, d)
            white = (far / n).astype(np.float64) @ v.T / np.sqrt(e)
            columns = [batch.column(0).take(pa.array(rows)), pa.array([d] * len(rows), pa.int32()), pa.array([n] * len(rows), pa.int64()), pa.array(deviation, pa.string()), pa.array([values] * len(rows), pa.list_(pa.float64())), pa.array(list(white), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "dim", "n", "deviation", "values", "whitened"])


def identity_error(white: DataFrame, components: int = COMPONENTS) -> float:
    """The largest absolute entry of the covariance of `whitened` less the identity, over each fit list; 0 without rows."""
    w = lambda i: F.get("whitened", F.lit(i))
    means = white.groupBy("dim").agg(*[F.avg(w(i)).alias(f"m{i}") for i in range(components)])
    centred = white.join(small_side(means), "dim").select("dim", *[(w(i) - F.col(f"m{i}")).alias(f"c{i}") for i in range(components)])
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    worst = F.greatest(*[F.abs(F.avg(F.col(f"c{i}") * F.col(f"c{j}")) - F.lit(float(i == j))) for i, j in pairs])  # nulls are passed over
    return centred.groupBy("dim").agg(worst.alias("error")).agg(F.max("error")).first()[0] or 0.0


def whiten(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained and identity_error of table(vec_id, embedding)."""
    rows = integers(table, scale, shift)
    sums = cut(exact_sums(rows))
    found = cut(fit(rows, sums, components))
    joined = rows.join(small_side(found), "dim").select("vec_id", "dim", "x", "n", "sums", "values", "vectors")
    white = cut(joined.mapInArrow(projector, PROJECTED))
    error = identity_error(white, components)
    each = white.select("vec_id", "n", F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"), "values", F.posexplode("whitened").alias("place", "whitened"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", F.get("values", 2 * F.col("place") + 1).alias("explained"), F.lit(error).alias("identity_error"))
