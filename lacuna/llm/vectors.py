"""Embedding near-duplicates by spherical-cap filters with a structured random product code.

The space is rotated at random and cut into BLOCKS blocks; each block has `words` random unit codewords, and a filter
direction is one codeword of every block, scaled to length 1, so a code of words**BLOCKS directions is never written down.
List decoding: with each block's inner products sorted, a walk over the blocks that keeps only beginnings which can still
exceed the threshold finds all directions whose cap holds the vector. Vectors of one label that share a direction are
candidates and are verified exactly, in double precision. The code grows with the table, so that the expected number of
chance pairs for a vector stays the same. The number of caps varies much between vectors, so every vector is also
registered in its nearest directions, BEST of them at 50,000 vectors and as the fourth root of their number beyond.

Copies (equal label and vector) are one vector with a count. A vector goes to each of its directions that others have too,
as it came (floats stay floats), with the directions before that one. Directions of more than CHUNK vectors are dealt to
blocks of about so many, and each two blocks meet on their own, so no task holds a whole hot direction. A meeting is matrix
products of STRIP rows at a time; a pair of vectors counts only at the first direction that both share. Meetings report no pairs: for each vector the number of its links there, and
links enough to connect what the meeting's links connect, so that their rows grow with the vectors in them.

Defined results: null labels, and vectors that are null, empty, zero or hold null or non-finite components, link with
nothing; rows of a null id link like any other and their component is null where no row of it has an id; repeated rows of one
id count as different vectors; vectors of different lengths do not link; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm.common import components, cut

COSINE = 0.93
BLOCKS = 4
#: Caps that a random vector is expected to be in, and the number of nearest directions that it is always in.
EXPECTED, BEST = 32, 16
CHUNK, STRIP = 4096, 256
SEED = 29


class ProductCode:
    def __init__(self, dim: int, words: int, expected: float = EXPECTED, best: int = BEST, blocks: int = BLOCKS, seed: int = SEED):
        rng = np.random.default_rng((seed, dim, words))
        self.blocks, self.words, self.best = min(blocks, dim), words, best
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cuts = np.linspace(0, dim, self.blocks + 1).astype(int)
        self.code = []
        for a, z in zip(self.cuts[:-1], self.cuts[1:], strict=True):
            c = rng.normal(size=(words, z - a))
            self.code.append(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(self.blocks))
        # the threshold at which random directions hold the expected number, measured on random unit vectors
        v = rng.normal(size=(256, dim))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        products = self.products(v)
        picks = rng.integers(0, words, (self.blocks, 256, 8192))
        sums = sum(np.take_along_axis(p, i, axis=1) for p, i in zip(products, picks, strict=True))
        share = min(0.5, expected / float(words) ** self.blocks)
        mean, spread = sums.mean(), sums.std()
        self.threshold = float(mean + spread * self.normal_tail(share))

    @staticmethod
    def normal_tail(share: float) -> float:
        low, high = -10.0, 10.0
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (middle, high) if 0.5 * math.erfc(middle / math.sqrt(2)) > share else (low, middle)
        return high

    def products(self, v: np.ndarray) -> list[np.ndarray]:
        r = v @ self.rotation
        return [r[:, a:z] @ c.T for a, z, c in zip(self.cuts[:-1], self.cuts[1:], self.code, strict=True)]

    def decode(self, v: np.ndarray) -> list[np.ndarray]:
        """The numbers of all directions within the threshold of each unit vector, and of its nearest ones."""
        out, products = [], self.products(v)
        for i in range(len(v)):
            own = [p[i] for p in products]
            best_left = np.cumsum([x.max() for x in own][::-1])[::-1]
            out.append(self.walk(own, best_left, min(self.threshold, self.nearest(own))))
        return out

    def nearest(self, own: list[np.ndarray]) -> float:
        """A threshold that at least `best` directions reach: the best-th largest sum, by merging the blocks' largest."""
        sums = np.zeros(1)
        for x in own:
            top = np.sort(x)[::-1][: self.best]
            sums = np.sort((sums[:, None] + top[None, :]).ravel())[::-1][: self.best]
        return float(sums[-1]) - 1e-9

    def walk(self, own: list[np.ndarray], best_left: np.ndarray, threshold: float) -> np.ndarray:
        sums, numbers = np.zeros(1), np.zeros(1, np.int64)
        for k, x in enumerate(own):
            rest = best_left[k + 1] if k + 1 < len(own) else 0.0
            total = sums[:, None] + x[None, :]
            a, b = np.nonzero(total + rest >= threshold)
            sums, numbers = total[a, b], numbers[a] * self.words + b
        return np.sort(numbers)


def decoder(words: int, expected: float, best: int, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """rep, n, label, embedding -> these with the vector packed in the type `kind`, its size, and its directions in order."""
    kinds = {"rep": pa.int64(), "n": pa.int64(), "label": pa.int64(), "dim": pa.int32(), "filters": pa.list_(pa.int64()), "v": pa.binary()}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, ProductCode] = {}
        for batch in batches:
            for at in range(0, len(batch), 512):
                reps, ns, labels, vectors = (c.to_pylist() for c in batch.slice(at, 512).columns)
                for dim in sorted({len(x) for x in vectors}):
                    if dim not in codes:
                        codes[dim] = ProductCode(dim, words, expected, best)
                    pick = [i for i, x in enumerate(vectors) if len(x) == dim]
                    raw = np.array([vectors[i] for i in pick], dtype=np.float64)
                    found = codes[dim].decode(unit(raw))
                    rows = [(reps[i], ns[i], labels[i], dim, f.tolist(), x.tobytes()) for i, f, x in zip(pick, found, raw.astype(kind), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))

    return decode


CODED = "rep long, n long, label long, dim int, filters array<long>, v binary"


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def usable(vector: str = "embedding") -> F.Column:
    v = F.col(vector)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


def shares(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Whether the directions of a and b, those before the meeting's own, have one in common."""
    used = np.unique(np.concatenate([*a, *b]))
    grids = []
    for side in (a, b):
        grid = np.zeros((len(side), len(used)), np.float32)
        for i, x in enumerate(side):
            grid[i, np.searchsorted(used, x)] = 1
        grids.append(grid)
    return grids[0] @ grids[1].T > 0


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links enough to connect what the links (a, b) connect."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def verifier(cosine: float, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Meetings of two blocks (of one with itself where `right` is null) -> rows (a, b null, number of links of a) and
    (a, b, null) for links that connect."""

    def read(block: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        flat = block.values.flatten()  # rep, n, v and f of its vectors
        rep, n = (x.to_numpy(zero_copy_only=False) for x in flat[:2])
        v = np.frombuffer(b"".join(flat[2].to_pylist()), dtype=kind).astype(np.float64).reshape(len(rep), -1)
        ends = np.cumsum(flat[3].value_lengths().to_numpy(zero_copy_only=False))
        return rep, n, unit(v), np.split(flat[3].flatten().to_numpy(zero_copy_only=False), ends[:-1])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                left = read(batch.column(0)[k])
                same = not batch.column(1)[k].is_valid
                right = left if same else read(batch.column(1)[k])
                own, others = np.zeros(len(left[0]), np.int64), np.zeros(len(right[0]), np.int64)
                tied: list[tuple[int, int]] = []
                for at in range(0, len(left[0]), STRIP):
                    some = slice(at, at + STRIP)
                    near = left[2][some] @ right[2].T >= cosine
                    near &= left[0][some, None] != right[0][None, :]
                    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                    if not len(rows):
                        continue
                    near = near[np.ix_(rows, columns)] & ~shares([left[3][at + i] for i in rows], [right[3][j] for j in columns])
                    own[at + rows] += near @ right[1][columns]
                    others[columns] += left[1][at + rows] @ near
                    i, j = np.nonzero(near)
                    tied = forest(np.concatenate([[x for x, _ in tied], left[0][at + rows[i]]]).astype(np.int64), np.concatenate([[y for _, y in tied], right[0][columns[j]]]).astype(np.int64))
                counts = [(left[0], own)] + ([] if same else [(right[0], others)])
                a, n = (np.concatenate([x[side][x[1] > 0] for x in counts]) for side in (0, 1))
                if len(a):
                    ties = np.array(tied, np.int64).reshape(-1, 2)
                    to = pa.array([None] * len(a) + ties[:, 1].tolist(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, ties[:, 0]])), to, pa.array(n.tolist() + [None] * len(ties), pa.int64())], names=["a", "b", "n"])

    return verify


def links(reps: DataFrame, cosine: float = COSINE, expected: float = EXPECTED, best: int = BEST) -> DataFrame:
    """What the meetings find in reps(rep, n, label, embedding), different vectors: rows (a, null, links of a, copies counted)
    and (a, b, null), links that connect; links are of one label with at least this cosine, and each is counted once."""
    count = reps.count()
    # chance pairs of a vector, expected**2 * count / words**BLOCKS, stay below 8 * expected
    words = max(8, math.ceil((expected * max(1, count) / 8) ** (1 / BLOCKS)))
    best = max(best, math.ceil(best * (count / 50_000) ** 0.25))
    kind = "<f4" if reps.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "<f8"
    coded = cut(reps.select("rep", "n", "label", "embedding").mapInArrow(decoder(words, expected, best, kind), CODED))
    group = ["label", "dim", "filter"]
    counts = coded.select("label", "dim", F.explode("filters").alias("filter")).groupBy(*group).agg(F.count("*").alias("m")).where("m > 1")
    counts = counts.select(*group, F.ceil(F.col("m") / CHUNK).cast("int").alias("parts"))
    # narrow rows first tell which directions are shared; vectors move once, to these
    shared = coded.select("rep", "label", "dim", F.posexplode("filters").alias("place", "filter")).join(counts, group)
    wanted = shared.groupBy("rep").agg(F.collect_list(F.struct("place", "filter", "parts")).alias("wanted"))  # directions of one vector
    full = coded.join(wanted, "rep").withColumn("to", F.explode("wanted")).select("rep", "n", "v", "label", "dim", "to.*", F.slice("filters", F.lit(1), F.col("to.place")).alias("f"))
    full = full.withColumn("part", F.pmod(F.xxhash64("rep", "filter"), F.col("parts")).cast("int"))
    blocks = full.groupBy(*group, "part", "parts").agg(F.collect_list(F.struct("rep", "n", "v", "f")).alias("block"))  # about CHUNK vectors
    alone = blocks.where("parts = 1").select(F.col("block").alias("left"), F.lit(None).cast(blocks.schema["block"].dataType).alias("right"))
    return alone.union(meet(cut(blocks.where("parts > 1")), group)).mapInArrow(verifier(cosine, kind), "a long, b long, n long")


def meet(blocks: DataFrame, group: list[str]) -> DataFrame:
    """left and right of every block with itself (right null) and of every two blocks of one group: a block of a group of many
    goes to each meeting with another by key."""
    each = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*group, F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), F.struct("part", "block").alias("x"))
    pairs = each.groupBy(*group, "p", "q").agg(F.sort_array(F.collect_list("x")).alias("xs"))  # two blocks at most
    own = F.col("p") == F.col("q")
    pairs = pairs.select(F.col("xs")[0]["block"].alias("left"), F.when(~own & (F.size("xs") > 1), F.get("xs", F.lit(1))["block"]).alias("right"), own.alias("own"), F.size("xs").alias("k"))
    return pairs.where("(own and size(left) > 1) or (not own and k > 1)").select("left", "right")


def near_duplicates(table: DataFrame, cosine: float = COSINE, expected: float = EXPECTED) -> DataFrame:
    """vec_id, n_links, component_id and kept of table(vec_id, embedding, label)."""
    kind = "array<float>" if table.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "array<double>"
    rows = table.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast(kind))
    fit = F.coalesce(usable() & F.col("label").isNotNull(), F.lit(False))
    good = rows.where(fit).withColumn("key", F.xxhash64("embedding"))
    classes = good.groupBy("label", "key", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    classes = cut(classes.withColumn("rep", F.monotonically_increasing_id()))  # ids only name rows: they may be null or repeat
    found = cut(links(classes, cosine, expected))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    others = found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    known = classes.join(others, "rep", "left").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    known = cut(known.select("rep", "root", "least", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    named = known.join(known.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("rep", "n_links", "component_id")
    of = classes.select("label", "key", "embedding", "rep").join(named, "rep").drop("rep")
    ids = good.join(of, ["label", "key", "embedding"]).select("vec_id", "n_links", "component_id")
    out = ids.union(rows.where(~fit).select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
