"""Exact top-k search by inner product over norm-bucketed vectors.

Vectors become integers, floor(SCALE * x), carried as doubles, which hold them exactly. They are grouped by length into
buckets of like length (ratio RATIO), and these into chunks of about CHUNK vectors, sorted by length. Queries go in blocks.
A first pass over the longest chunk gives every query a score that its k-th best reaches at least. A block goes only to
chunks whose greatest length can reach the score of one of its queries; that is told from a few numbers for each block and
chunk, before vectors move. Within a chunk, the score is a local threshold of the cosine. Above 1 the chunk is passed over;
high thresholds prune by coordinates (on the FOCUS largest coordinates of the query, a candidate must lie within the range
that the threshold leaves), low ones by length (shorter vectors cannot reach the score). The products of the rest are
verified as integers: in doubles where no sum can pass 2**52, else in 64-bit or unbounded integers; bounds keep equal scores.

Defined results: vectors that are null, or hold null or non-finite components, or overflow a double when scaled, take no
part; scores beyond a long count as the nearest long; vectors of different sizes do not meet, empty ones do and score 0;
rows of the query's own id are left out, and a repeated query id is one query; fewer than k candidates give fewer rows; an
empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.llm.common import cut, small_side

SCALE, K = 256, 5
RATIO = 0.9
CHUNK, QUERY_BLOCK = 4096, 1024
FOCUS, COORDINATES_FROM = 3, 0.35
NONE, MOST = -(1 << 63), (1 << 63) - 1
#: From here on doubles are whole numbers; floor() returns longs, so larger ones must not go through it.
WHOLE = 2.0**52


def integers(vector: str, scale: int) -> Column:
    """floor(scale * x) as doubles."""

    def whole(x: Column) -> Column:
        y = x.cast("double") * float(scale)
        return F.when(F.abs(y) < WHOLE, F.floor(y).cast("double")).otherwise(y)

    return F.transform(F.col(vector).cast("array<double>"), whole)


def products(c: np.ndarray, q: np.ndarray, largest: float) -> np.ndarray:
    """Inner products of the rows of c with q, whole numbers in doubles of at most `largest`, as longs."""
    bound = largest * float(np.abs(q).max(initial=0)) * max(1, len(q))
    if bound < WHOLE:
        return (c @ q).astype(np.int64)
    if bound < 2.0**62:
        return c.astype(np.int64) @ q.astype(np.int64)
    numbers = [int(x) for x in q]
    exact = [sum(int(x) * y for x, y in zip(row, numbers, strict=True)) for row in c.tolist()]
    return np.array([min(max(x, NONE), MOST) for x in exact], dtype=np.int64)


def lengths_of(v: np.ndarray) -> np.ndarray:
    """Euclidean lengths, without overflow."""
    top = np.abs(v).max(axis=1, initial=0)
    return top * np.linalg.norm(v / np.maximum(top, 1e-300)[:, None], axis=1)


PACKED = ("ids", "vs", "thetas", "longest", "reach")
PACKED_TYPES = "ids binary, vs binary, thetas binary, longest double, reach double"


def packer() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Groups of (vec_id, v, theta) rows -> one row with ids, vectors and thresholds packed, longest vectors first."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            rows = batch.column(names.index("rows"))
            out = []
            for k in range(len(batch)):
                flat = rows[k].values
                ids, theta = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "theta"))
                v = flat.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                lengths = lengths_of(v)
                order = np.lexsort((ids, -lengths))
                # the least length of a partner with which one of these vectors can reach its theta
                reach = np.where(theta > 0, theta / np.maximum(lengths, 1.0) * (1 - 1e-9), 0.0).min(initial=np.inf)
                out.append((ids[order].tobytes(), v[order].tobytes(), theta[order].tobytes(), float(lengths.max(initial=0)), float(reach)))
            kinds = [pa.binary()] * 3 + [pa.float64()] * 2
            packed = [pa.array(x, k) for x, k in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)]
            keep = [n for n in names if n != "rows"]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(n)) for n in keep), *packed], names=[*keep, *PACKED])

    return pack


def survivors(q: np.ndarray, q_length: float, unit_q: np.ndarray, lengths: np.ndarray, units: np.ndarray, theta: int) -> np.ndarray | slice:
    """Which of a chunk's vectors may reach theta."""
    if theta <= 0 or q_length == 0:
        return slice(None)  # no bound on the cosine
    local = theta / (q_length * lengths[0]) * (1 - 1e-9) if lengths[0] > 0 else 2.0
    if local > 1:
        return slice(0, 0)
    if local < COORDINATES_FROM:
        return slice(0, int(np.searchsorted(-lengths, -theta / q_length * (1 - 1e-9), side="right")))
    keep = np.ones(len(lengths), bool)
    for f in np.argsort(-np.abs(unit_q))[:FOCUS]:
        spread = math.sqrt(max(0.0, (1 - local * local) * (1 - unit_q[f] ** 2))) + 1e-9
        low = -1.0 if unit_q[f] <= -local else local * unit_q[f] - spread
        high = 1.0 if unit_q[f] >= local else local * unit_q[f] + spread
        keep &= (units[:, f] >= low) & (units[:, f] <= high)
    return np.flatnonzero(keep)


def searcher(k: int, dim_column: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Meetings of a query block and a chunk -> at most k rows (query_id, vec_id, score) for each query."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                dim, *raw = (c[row].as_py() for c in batch.columns)
                q_ids, q, theta, ids, c = (np.frombuffer(x, dtype=kind) for x, kind in zip(raw, (np.int64, np.float64, np.int64, np.int64, np.float64), strict=True))
                q, c = q.reshape(len(q_ids), dim), c.reshape(len(ids), dim)
                largest = float(np.abs(c).max(initial=0))
                lengths, q_lengths = lengths_of(c), lengths_of(q)
                units = c / np.maximum(lengths, 1e-300)[:, None]
                out: list[tuple[int, int, int]] = []
                for i in range(len(q)):
                    left = survivors(q[i], q_lengths[i], q[i] / max(q_lengths[i], 1e-300), lengths, units, int(theta[i]))
                    if not isinstance(left, slice) and len(left) > len(c) // 2:
                        left = slice(None)  # one product with all costs less than gathering most
                    near = ids[left]
                    score = products(c[left], q[i], largest)
                    fine = (near != q_ids[i]) & (score >= theta[i])
                    near, score = near[fine], score[fine]
                    if len(score) > k:
                        least = np.partition(score, len(score) - k)[len(score) - k]
                        near, score = near[score >= least], score[score >= least]
                    best = np.lexsort((near, -score))[:k]
                    out += [(int(q_ids[i]), int(x), int(y)) for x, y in zip(near[best], score[best], strict=True)]
                a = np.array(out, dtype=np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1]), pa.array(a[:, 2])], names=["query_id", "vec_id", "score"])

    return search


FOUND = "query_id long, vec_id long, score long"


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(table: DataFrame, queries: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score: the k rows of table(vec_id, embedding) with the highest products with each row that
    `queries` selects, ties to the smaller vec_id."""
    x = F.col("embedding")
    bad = lambda y: y.isNull() | F.isnan(y) | (F.abs(y.cast("double") * float(scale)) == float("inf"))
    rows = table.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~F.exists(x, bad))
    v = integers("embedding", scale)
    squares = F.aggregate(F.col("v"), F.lit(0.0), lambda a, y: a + y * y)
    bucket = F.floor(F.log(F.least(F.greatest(squares, F.lit(0.25)), F.lit(1e308))) / (-2 * math.log(RATIO))).cast("int")
    rows = rows.select(F.col("vec_id").cast("long"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query")).withColumns({"dim": F.size("v"), "bucket": bucket})
    rows = cut(rows)
    # at most a few hundred buckets of like length for each vector size
    sizes = rows.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).withColumns({"parts": F.ceil(F.col("n") / CHUNK).cast("int"), "q_parts": F.ceil(F.col("q") / QUERY_BLOCK).cast("int")})
    sizes = sizes.withColumn("longest", F.col("bucket") == F.max("bucket").over(Window.partitionBy("dim"))).drop("n", "q")
    dealt = rows.join(small_side(cut(sizes)), ["dim", "bucket"])
    own = F.struct("vec_id", "v", F.lit(NONE).cast("long").alias("theta"))
    chunks = dealt.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).groupBy("dim", "bucket", "part", "longest").agg(F.collect_list(own).alias("rows"))  # about CHUNK vectors
    chunks = cut(chunks.withColumnRenamed("longest", "top").mapInArrow(packer(), "dim int, bucket int, part int, top boolean, " + PACKED_TYPES))
    asked = dealt.where("is_query").dropDuplicates(["vec_id"]).withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.greatest("q_parts", F.lit(1))).cast("int"))
    chunk_rows = chunks.select("dim", "bucket", "part", F.col("ids").alias("c_ids"), F.col("vs").alias("c_vs"))

    def meet(query_rows: DataFrame, some: DataFrame) -> DataFrame:
        """Each query block meets each chunk of some(dim, bucket, part, longest) that it can reach: the pairs are chosen from
        their numbers, and the blocks copied to the chunks' keys."""
        blocks = query_rows.groupBy("dim", F.col("bucket").alias("q_bucket"), "block").agg(F.collect_list(F.struct("vec_id", "v", "theta")).alias("rows"))
        blocks = cut(blocks.mapInArrow(packer(), "dim int, q_bucket int, block int, " + PACKED_TYPES)).drop("longest")
        pairs = blocks.select("dim", "q_bucket", "block", "reach").join(some, "dim").where("longest >= reach").drop("longest", "reach")
        sent = blocks.join(pairs, ["dim", "q_bucket", "block"])
        both = sent.join(chunk_rows, ["dim", "bucket", "part"])
        return both.select("dim", "ids", "vs", "thetas", "c_ids", "c_vs").mapInArrow(searcher(k), FOUND)

    numbers = chunks.select("dim", "bucket", "part", "top", "longest")
    first = meet(asked.withColumn("theta", F.lit(NONE).cast("long")), numbers.where("top and part = 0").drop("top"))
    theta = best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("theta"))
    second = meet(asked.join(cut(theta), "vec_id", "left").fillna({"theta": NONE}), numbers.drop("top"))
    return best(second, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
