"""Point symmetry of sites and the fewest displacement directions that it leaves.

Rotations are integer matrices on cell coordinates, nine numbers by rows. They are found from a structure as those that keep
the cell's metric tensor and, with the shift that keeps the site, carry every atom to an atom of its kind. The search for
directions is a join of directions and rotations with determinant tests; it runs once for each different set of rotations,
of which there are few, and not for each site.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.stats import stored

#: Directions in the order in which they are tried, along the axes alone or with diagonals.
AXIS = ((1, 0, 0), (0, 1, 0), (0, 0, 1))
DIAGONAL = (*AXIS, (1, 1, 0), (1, 0, 1), (0, 1, 1), (1, -1, 0), (1, 0, -1), (0, 1, -1), (1, 1, 1), (1, 1, -1), (1, -1, 1), (-1, 1, 1))
IDENTITY = (1, 0, 0, 0, 1, 0, 0, 0, 1)
MINUS = ("auto", "always", "never")
#: Directions that may be broadcast, with their rotations: 15 MB or so.
SMALL_ROWS = 10_000


def rotated(rotation: Column, d: Column) -> Column:
    """The image of a direction."""
    return F.array(*[sum((F.get(rotation, F.lit(3 * i + j)) * F.get(d, F.lit(j)) for j in range(1, 3)), F.get(rotation, F.lit(3 * i)) * F.get(d, F.lit(0))) for i in range(3)])


def volume_of(a: Column, b: Column, c: Column) -> Column:
    """The determinant of three directions."""
    x = lambda v, i: F.get(v, F.lit(i % 3))
    terms = [x(a, i) * (x(b, i + 1) * x(c, i + 2) - x(b, i + 2) * x(c, i + 1)) for i in range(3)]
    return terms[0] + terms[1] + terms[2]


def threefold(rotation: Column) -> Column:
    """Whether a rotation made three times is none."""
    units = [F.array(*[F.lit(int(i == j)) for i in range(3)]) for j in range(3)]
    thrice = [rotated(rotation, rotated(rotation, rotated(rotation, u))) == u for u in units]
    return thrice[0] & thrice[1] & thrice[2]


def literal(d: tuple[int, ...]) -> Column:
    return F.array(*[F.lit(x) for x in d])


def generators(groups: DataFrame, candidates: tuple = DIAGONAL, trigonal: bool = False) -> DataFrame:
    """groups(rotations) with place and direction of the directions whose images under the rotations span space: the first that
    does so with two of its own images; else the first two that do so with one image of the first (where that image's
    rotation is threefold and `trigonal`, the first's further images come between); else the first three candidates."""
    table = F.posexplode(F.array(*[literal(d) for d in candidates]))
    turned = groups.select("rotations", table.alias("at", "d")).select("rotations", "at", "d", F.posexplode("rotations").alias("r", "rotation"))
    images = turned.withColumn("image", rotated(F.col("rotation"), F.col("d")))
    other = images.select("rotations", "at", F.col("r").alias("r2"), F.col("image").alias("image2"))
    pairs = images.join(other, ["rotations", "at"]).where((F.col("r") < F.col("r2")) & (volume_of(F.col("d"), F.col("image"), F.col("image2")) != 0))
    one = pairs.groupBy("rotations").agg(F.min(F.struct("at", "d")).alias("x")).select("rotations", F.array("x.d").alias("found"))
    rest = images.join(one.select("rotations"), "rotations", "left_anti")
    seconds = rest.withColumn("s", F.explode(F.array(*[F.struct(F.lit(i).alias("at"), literal(d).alias("d")) for i, d in enumerate(candidates)])))
    spanning = seconds.where(volume_of(F.col("d"), F.col("image"), F.col("s.d")) != 0)
    best = spanning.groupBy("rotations").agg(F.min(F.struct("at", "r", F.col("s.at").alias("second"), "d", "image", "rotation", F.col("s.d").alias("d2"))).alias("x"))
    three = F.array(F.col("x.d"), F.col("x.image"), rotated(F.col("x.rotation"), F.col("x.image")), F.col("x.d2"))
    two = best.select("rotations", (F.when(threefold(F.col("x.rotation")), three).otherwise(F.array("x.d", "x.d2")) if trigonal else F.array("x.d", "x.d2")).alias("found"))
    found = one.union(two)
    none = groups.join(found.select("rotations"), "rotations", "left_anti").select("rotations", F.array(*[literal(d) for d in candidates[:3]]).alias("found"))
    return found.union(none).select("rotations", F.posexplode("found").alias("place", "direction"))


def directions(sites: DataFrame, candidates: tuple = DIAGONAL, minus: str = "auto", trigonal: bool = False) -> DataFrame:
    """sites(..., rotations) with k and direction: a row for each direction that the site needs, each followed by its negative,
    always, never, or where no rotation gives it (auto)."""
    if minus not in MINUS:
        raise ValueError(f"minus is one of {', '.join(MINUS)}")
    groups = stored(sites.select("rotations").distinct())  # read several times below, and far smaller than the sites
    found = generators(groups, candidates, trigonal)
    negative = F.transform("direction", lambda x: -x)
    given = F.exists("rotations", lambda m: rotated(m, F.col("direction")) == negative)
    also = {"auto": ~given, "always": F.lit(True), "never": F.lit(False)}[minus]
    both = found.select("rotations", "place", F.posexplode(F.when(also, F.array("direction", negative)).otherwise(F.array("direction"))).alias("sign", "direction"))
    order = Window.partitionBy("rotations").orderBy("place", "sign")  # eight rows at most
    named = both.withColumn("k", F.row_number().over(order) - 1).select("rotations", "k", "direction")
    named = stored(named)
    # Spark guesses the sites' size by the file that they come from, without the rotations, and would send them to all
    few = named.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    return sites.join(F.broadcast(named) if few else named.hint("merge"), "rotations")


# ---- rotations of a structure


def lattice_rotations(cell: np.ndarray, tolerance: float) -> list[np.ndarray]:
    """Integer matrices with entries -1, 0 and 1 that keep the lengths and angles of a reduced cell's vectors."""
    metric = cell @ cell.T
    lengths = np.sqrt(np.diag(metric))
    steps = np.array(list(itertools.product((-1, 0, 1), repeat=3)))
    size = np.sqrt(np.einsum("ni,ij,nj->n", steps, metric, steps))
    columns = [steps[np.abs(size - n) < tolerance] for n in lengths]
    out = []
    for three in itertools.product(*columns):
        w = np.array(three).T
        # an angle's change moves the end of the longer vector by so much
        if np.all(np.abs(w.T @ metric @ w - metric) < tolerance * np.maximum.outer(lengths, lengths) * 2) and abs(round(np.linalg.det(w))) == 1:
            out.append(w)
    return out


def carries(w: np.ndarray, shift: np.ndarray, x: np.ndarray, kinds: np.ndarray, cell: np.ndarray, tolerance: float) -> np.ndarray | None:
    """The atom that each atom goes to under x -> w x + shift; null where one goes to no atom of its kind."""
    moved = x @ w.T + shift
    far = moved[:, None, :] - x[None, :, :]
    far -= np.rint(far)
    near = (np.linalg.norm(far @ cell, axis=2) < tolerance) & (kinds[:, None] == kinds[None, :])
    return near.argmax(axis=1) if near.any(axis=1).all() else None


def site_symmetry(symbols: list[str], positions: np.ndarray, cell: np.ndarray, tolerance: float) -> dict[int, list[np.ndarray]]:
    """The rotations about each independent atom, the first of the atoms that symmetry makes equal."""
    x, kinds = positions @ np.linalg.inv(cell), np.unique(symbols, return_inverse=True)[1]
    rotations = lattice_rotations(cell, tolerance)
    first = list(range(len(x)))
    for w in rotations:
        for b in np.flatnonzero(kinds == kinds[0]):
            to = carries(w, x[b] - w @ x[0], x, kinds, cell, tolerance)
            for i, j in enumerate(to if to is not None else ()):
                low, high = sorted((first[i], first[j]))
                first = [low if f == high else f for f in first]
    return {a: [w for w in rotations if carries(w, x[a] - w @ x[a], x, kinds, cell, tolerance) is not None] for a in sorted(set(first))}


SITES = "structure_id long, atom_idx int, cell array<double>, rotations array<array<int>>"
ARROW = pa.schema([("structure_id", pa.int64()), ("atom_idx", pa.int32()), ("cell", pa.list_(pa.float64())), ("rotations", pa.list_(pa.list_(pa.int32())))])
#: Structures that a task remembers, and those that it turns into rows at once.
SHAPES, ROWS = 10_000, 1000


def sites(structures: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """structure_id, atom_idx, cell and rotations of the independent atoms of structures(structure_id, symbols, positions, cell).
    Cells must be reduced: no vector gets shorter by adding another. Structures that are equal but for their ids are searched
    once: `SHAPES` of them are remembered in a task, the latest ones."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=SHAPES)
        def rotations_of(symbols: tuple[str, ...], at: tuple[float, ...], edges: tuple[float, ...]) -> dict[int, list[list[int]]]:
            if not at:
                return {}
            found = site_symmetry(list(symbols), np.array(at).reshape(-1, 3), np.array(edges, float).reshape(3, 3), tolerance)
            return {a: [w.ravel().tolist() for w in ws] for a, ws in found.items()}

        for batch in batches:
            for at in range(0, len(batch), ROWS):
                columns = [x.to_pylist() for x in batch.slice(at, ROWS).columns]
                ids, atoms, cells, kind = [], [], [], []
                first: dict[tuple, int] = {}  # where a structure's sites begin among the different ones of this batch
                different: list[list[list[int]]] = []
                for i, symbols, positions, cell in zip(*columns, strict=True):
                    shape = tuple(symbols), tuple(x for p in positions for x in p), tuple(cell)
                    found = rotations_of(*shape)
                    if shape not in first:
                        first[shape] = len(different)
                        different += found.values()
                    for k, a in enumerate(found, first[shape]):
                        ids.append(i), atoms.append(a), cells.append(cell), kind.append(k)
                rotations = pa.array(different, ARROW.field("rotations").type).take(pa.array(kind, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, atoms, cells), ARROW, strict=False)] + [rotations], schema=ARROW)

    return structures.select("structure_id", "symbols", "positions", "cell").mapInArrow(find, SITES)
