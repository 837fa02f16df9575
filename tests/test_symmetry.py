"""Rotations of known cells, and directions against a plain search."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.operators import structures, symmetry
from lacuna.plans.flows import GROUPS

SCHEMA = "structure_id long, symbols array<string>, positions array<array<double>>, cell array<double>"
HALF = math.sqrt(3) / 2
#: name: cell, symbols, fractional places, order of the group about the first atom, independent atoms
CELLS = {
    "cubic": ([[4, 0, 0], [0, 4, 0], [0, 0, 4]], ["X"], [[0.1, 0.2, 0.3]], 48, 1),
    "body centred": ([[4, 0, 0], [0, 4, 0], [0, 0, 4]], ["X", "X"], [[0, 0, 0], [0.5, 0.5, 0.5]], 48, 1),
    "two kinds": ([[4, 0, 0], [0, 4, 0], [0, 0, 4]], ["X", "Y"], [[0, 0, 0], [0.5, 0.5, 0.5]], 48, 2),
    "diamond": ([[4, 0, 0], [0, 4, 0], [0, 0, 4]], ["X"] * 8, [[0, 0, 0], [0, 0.5, 0.5], [0.5, 0, 0.5], [0.5, 0.5, 0], [0.25, 0.25, 0.25], [0.25, 0.75, 0.75], [0.75, 0.25, 0.75], [0.75, 0.75, 0.25]], 24, 1),
    "face centred, one atom": ([[0, 2, 2], [2, 0, 2], [2, 2, 0]], ["X"], [[0, 0, 0]], 48, 1),
    "tetragonal": ([[4, 0, 0], [0, 4, 0], [0, 0, 5]], ["X"], [[0, 0, 0]], 16, 1),
    "orthorhombic": ([[4, 0, 0], [0, 5, 0], [0, 0, 6]], ["X"], [[0, 0, 0]], 8, 1),
    "hexagonal": ([[3, 0, 0], [-1.5, 3 * HALF, 0], [0, 0, 5]], ["X"], [[0, 0, 0]], 24, 1),
    "close packed": ([[3, 0, 0], [-1.5, 3 * HALF, 0], [0, 0, 4.9]], ["X", "X"], [[1 / 3, 2 / 3, 0.25], [2 / 3, 1 / 3, 0.75]], 12, 1),
    "triclinic": ([[4, 0, 0], [0.3, 5, 0], [0.7, 0.4, 6]], ["X"], [[0, 0, 0]], 2, 1),
    "no symmetry": ([[4, 0, 0], [0.3, 5, 0], [0.7, 0.4, 6]], ["X", "Y", "Z"], [[0, 0, 0], [0.1, 0.23, 0.4], [0.35, 0.6, 0.77]], 1, 3),
    "displaced": ([[4, 0, 0], [0, 4, 0], [0, 0, 4]], ["X", "Y"], [[0, 0, 0], [0.5, 0.5, 0.6]], 8, 2),
}


def test_group_orders(spark):
    rows = []
    for i, (cell, symbols, places, _, _) in enumerate(CELLS.values()):
        rows.append((i, symbols, (np.array(places) @ np.array(cell, float)).tolist(), np.array(cell, float).ravel().tolist()))
    rows.append((99, [], [], rows[0][3]))
    found = {}
    for r in symmetry.sites(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault(r.structure_id, []).append((r.atom_idx, [np.array(m).reshape(3, 3) for m in r.rotations]))
    assert 99 not in found
    for i, (name, (_, _, _, order, independent)) in enumerate(CELLS.items()):
        sites = sorted(found[i], key=lambda s: s[0])
        assert len(sites) == independent and len(sites[0][1]) == order, name
        group = {tuple(m.ravel()) for m in sites[0][1]}
        assert symmetry.IDENTITY in group and all(tuple((a @ b).ravel()) in group for a in sites[0][1] for b in sites[0][1]), name


def plain(group, candidates, minus, trigonal):
    """The search written out as loops."""
    images = lambda d: [np.array(m).reshape(3, 3) @ np.array(d) for m in group]
    det = lambda *v: round(np.linalg.det(np.array(v, float)))

    def search():
        for d in candidates:
            own = images(d)
            if any(det(d, own[i], own[j]) for i in range(len(own)) for j in range(i + 1, len(own))):
                return [d]
        for d in candidates:
            for m, turned in zip(group, images(d), strict=True):
                for e in candidates:
                    if det(d, turned, e):
                        m = np.array(m).reshape(3, 3)
                        return [d, turned, m @ turned, e] if trigonal and np.array_equal(m @ m @ m, np.eye(3)) else [d, e]
        return list(candidates[:3])

    out = []
    for d in search():
        d = tuple(int(x) for x in d)
        out.append(d)
        back = tuple(-x for x in d)
        if minus == "always" or minus == "auto" and not any(tuple(x) == back for x in images(d)):
            out.append(back)
    return out


@pytest.mark.parametrize("candidates", [symmetry.AXIS, symmetry.DIAGONAL])
@pytest.mark.parametrize("minus", symmetry.MINUS)
@pytest.mark.parametrize("trigonal", [False, True])
def test_directions_against_loops(spark, candidates, minus, trigonal):
    sites = spark.createDataFrame([(i, [list(m) for m in g]) for i, g in enumerate([*GROUPS, *GROUPS])], "id int, rotations array<array<int>>")
    got = {}
    for r in symmetry.directions(sites, candidates, minus, trigonal).orderBy("id", "k").collect():
        assert r.k == len(got.setdefault(r.id, []))
        got[r.id].append(tuple(r.direction))
    assert got == {i: plain(g, candidates, minus, trigonal) for i, g in enumerate([*GROUPS, *GROUPS])}
    with pytest.raises(ValueError):
        symmetry.directions(sites, minus="x")


def test_displacements_of_a_structure(spark):
    cell, symbols, places, _, _ = CELLS["diamond"]
    s = spark.createDataFrame([(0, symbols, (np.array(places) @ np.array(cell, float)).tolist(), np.array(cell, float).ravel().tolist())], SCHEMA)
    moves = structures.displacements(symmetry.sites(s), 0.01).collect()
    assert len(moves) == 1 and abs(math.hypot(moves[0].dx, moves[0].dy, moves[0].dz) - 0.01) < 1e-12  # one atom, one direction


def test_equal_structures_are_searched_once(spark):
    cell, symbols, x, order, _ = CELLS["diamond"]
    flat = [float(v) for row in cell for v in row]
    places = (np.array(x) @ np.array(cell, float)).tolist()
    rows = [(i, symbols, places, flat) if i % 1000 else (i, ["X"], [[0.0, 0.0, 0.0]], flat) for i in range(4000)]
    start = time.monotonic()
    found = symmetry.sites(spark.createDataFrame(rows, SCHEMA)).collect()
    assert time.monotonic() - start < 40  # one by one they take minutes
    assert sorted((r.structure_id, r.atom_idx) for r in found) == [(i, 0) for i in range(4000)]
    assert all(len(r.rotations) == (order if r.structure_id % 1000 else 48) and r.cell == flat for r in found)


def test_directions_do_not_send_the_sites_to_all(spark, tmp_path, capsys):
    spark.range(1000).write.parquet(str(tmp_path / "ids"))
    matrices = F.array(*[F.array(*[symmetry.literal(m) for m in ms]) for ms in GROUPS])
    sites = spark.read.parquet(str(tmp_path / "ids")).select("id", F.get(matrices, (F.col("id") % len(GROUPS)).cast("int")).alias("rotations"))
    out = symmetry.directions(sites)
    out.explain()
    plan = capsys.readouterr().out
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert out.select("id").distinct().count() == 1000
