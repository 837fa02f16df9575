"""Readers and writers: exact round trips and edge cases."""

import pytest

from lacuna.sources import readers, writers
from lacuna.streaming.pool import CandidatePool, generations, windowed_counts

CFG = """BEGIN_CFG
 Size
    2
 Supercell
    4.0 0.0 0.0
    0.0 4.0 0.0
    0.0 0.0 4.0
 AtomData:  id type cartes_x cartes_y cartes_z fx fy fz
    1 0 0.0 0.0 0.0 0.1 0.2 0.3
    2 1 1.0 2.0 3.0 -0.1 -0.2 -0.3
 Energy
    -10.5
 PlusStress:  xx yy zz yz xz xy
    1 2 3 4 5 6
END_CFG

BEGIN_CFG
 Size
    1
 Supercell
    4.0 0.0 0.0
    0.0 4.0 0.0
    0.0 0.0 4.0
 AtomData:  id type cartes_x cartes_y cartes_z
    1 0 0.5 0.5 0.5
END_CFG
"""

XYZ = """2
Properties=species:S:1:pos:R:3:forces:R:3 Lattice="4 0 0 0 4 0 0 0 4" virial="1 2 3 4 5 6 7 8 9" main=-1 energy=-3.5 note="two words" pbc="T T T"
Si 0.0 0.0 0.0 0.1 0.2 0.3
Ge 1.0 2.0 3.0 -0.1 -0.2 -0.3

1
Lattice="5 0 0 0 5 0 0 0 5" Properties=species:S:1:pos:R:3 label=x pbc="T T T"
Si 0.5 0.5 0.5
"""

DUMP = """ITEM: TIMESTEP
0
ITEM: NUMBER OF ATOMS
2
ITEM: BOX BOUNDS pp pp pp
0.0 4.0
0.0 5.0
0.0 6.0
ITEM: ATOMS id type x y z c_pe
2 9 1.0 1.0 1.0 -1.5
1 1 0.0 0.0 0.0 -2.0
ITEM: TIMESTEP
10
ITEM: NUMBER OF ATOMS
1
ITEM: BOX BOUNDS xy xz yz pp pp pp
0.0 4.5 0.5
0.0 5.0 0.0
0.0 6.0 0.0
ITEM: ATOMS id type x y z fx fy fz
1 2 0.0 0.0 0.0 1.0 2.0 3.0
"""


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_cfg(spark, tmp_path):
    path = put(tmp_path, "a.cfg", CFG)
    rows = readers.read_cfg(spark, path, ["Si", "Ge"]).orderBy("structure_id").collect()
    assert [r.n_atoms for r in rows] == [2, 1] and rows[0].energy == -10.5 and rows[0].stress6 == [1, 2, 3, 4, 5, 6]
    assert rows[0].symbols == ["Si", "Ge"] and rows[0].atoms[1].force == [-0.1, -0.2, -0.3]
    assert rows[1].energy is None and rows[1].stress6 is None and rows[1].atoms[0].force is None
    assert readers.count_cfg(spark, path) == 2
    made = readers.cfg_to_structures(readers.read_cfg(spark, path, ["Si", "Ge"]))
    first = made.orderBy("structure_id").first()
    assert first.virial == [1, 6, 5, 6, 2, 4, 5, 4, 3]
    writers.write_text(writers.cfg_text(made.where("energy is not null"), ["Si", "Ge"]), str(tmp_path / "out"))
    back = readers.read_cfg(spark, str(tmp_path / "out"), ["Si", "Ge"]).first()
    assert back.atoms == rows[0].atoms and back.energy == -10.5 and back.stress6 == rows[0].stress6
    with pytest.raises(Exception, match="no "):
        writers.cfg_text(made, ["Si", "Ge"]).collect()
    assert " 0.00000000" in writers.cfg_text(made, ["Si", "Ge"], allow_missing=True).where("structure_id = 1").first().value


def test_extxyz(spark, tmp_path):
    path = put(tmp_path, "a.xyz", XYZ)
    df = readers.read_extxyz(spark, path)
    a, b = df.orderBy("structure_id").collect()
    assert a.main == -1 and a.energy == -3.5 and a.forces[1] == [-0.1, -0.2, -0.3] and a.info == {"note": "two words"} and a.virial == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert b.forces is None and b.energy is None and b.label == "x"
    assert readers.count_extxyz(spark, path) == 2 and readers.count_extxyz(spark, str(tmp_path / "none.xyz")) == 0
    writers.write_text(writers.extxyz_text(df), str(tmp_path / "out"), files=1)
    again = readers.read_extxyz(spark, str(tmp_path / "out")).orderBy("structure_id").collect()
    for x, y in zip((a, b), again, strict=True):
        assert (x.cell, x.symbols, x.positions, x.forces, x.energy, x.virial, x.main, x.label) == (y.cell, y.symbols, y.positions, y.forces, y.energy, y.virial, y.main, y.label)
    with pytest.raises(Exception, match="cut off"):
        readers.read_extxyz(spark, put(tmp_path, "cut.xyz", "3\nx\nSi 0 0 0\n")).collect()


def test_descriptors(spark, tmp_path):
    path = put(tmp_path, "a.out", "#start 2\n0 1.5 2.5\n1 3.0 4.0\n#start 3\n0 5 6\n\n7 8 9\n")
    rows = readers.read_descriptors(spark, path, 2).orderBy("structure_id", "atom_idx").collect()
    assert [(r.structure_id, r.elem, r.features) for r in rows] == [(0, 0, [1.5, 2.5]), (0, 1, [3.0, 4.0]), (1, 0, [5.0, 6.0])]
    assert readers.read_descriptors(spark, path).count() == 4


def test_dump(spark, tmp_path):
    a, b = readers.read_dump(spark, put(tmp_path, "a.dump", DUMP), ["Si", "Ge"]).orderBy("structure_id").collect()
    assert a.symbols == ["Si", "Ge"] and a.energy == -3.5 and a.cell == [4, 0, 0, 0, 5, 0, 0, 0, 6] and a.forces == [[0, 0, 0], [0, 0, 0]]
    assert b.symbols == ["Ge"] and b.cell == [4, 0, 0, 0.5, 5, 0, 0, 0, 6] and b.forces == [[1, 2, 3]] and b.energy == 0.0


def test_pool(spark, tmp_path):
    flushed = []
    pool = CandidatePool(spark, str(tmp_path / "pool"), 5)
    batch = lambda n: spark.range(n).toDF("structure_id")
    use = lambda df: flushed.append(df.count())
    assert pool.step(batch(3), 0, use) == "wait" and pool.step(batch(3), 0, use) == "wait" and pool.count() == 3
    assert pool.step(batch(4), 1, use) == "update" and flushed == [7] and pool.count() == 0
    assert pool.step(batch(4), 1, use) == "wait" and pool.count() == 0  # replay of a flushed generation
    assert generations([batch(9), batch(0), batch(9)], lambda b, g: b, CandidatePool(spark, str(tmp_path / "p2"), "50%", 10), use) == ["update", "end"]


def test_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(20).write.parquet(str(tmp_path / "in"))
    pool, seen = CandidatePool(spark, str(tmp_path / "pool"), 1), []
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = pool.attach(stream, lambda df: seen.append(df.count()), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert sum(seen) == 20
    w = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    w.awaitTermination(60)
    assert spark.sql("select sum(n) from w").first()[0] == 20
