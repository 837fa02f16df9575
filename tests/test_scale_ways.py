"""The ways of large tables against plain ones: cover in rounds, ranks by ranges, interval search, subtraction of hot keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lacuna.functions import logs
from lacuna.operators import cover, histogram, intervals, lineage, metrics
from lacuna.plans import reduce
from lacuna.sources import readers, writers


def test_cover_in_rounds(spark):
    rng = random.Random(1)
    rows = [(c, rng.randrange(60), rng.randrange(50)) for c in range(80) for _ in range(rng.randrange(1, 9))]
    m = spark.createDataFrame(rows, "class_seq long, structure_id long, atom_idx long")
    assert sorted(cover.min_cover(m).collect()) == sorted(cover.min_cover(m, local_pairs=0).collect())
    assert cover.min_cover(m.limit(0), local_pairs=0).count() == 0


def test_cover_of_copies(spark, monkeypatch):
    """Copies of structures add no rounds: with few enough different sets, one task solves them."""
    rng = random.Random(2)
    rows = [(c, 100 * k + x, x) for c in range(40) for x in rng.sample(range(30), 4) for k in range(20)]
    m = spark.createDataFrame(rows, "class_seq long, structure_id long, atom_idx long")
    counts, whole = [], cover.stored
    monkeypatch.setattr(cover, "stored", lambda df: counts.append(1) or whole(df))
    assert sorted(cover.min_cover(m, local_pairs=200).collect()) == sorted(cover.min_cover(m).collect())
    assert len(counts) == 3 + 2  # pairs, and those of different sets; no round


def test_ranked(spark):
    rows = [(i % 3, None if i % 7 == 0 else i % 5, i) for i in range(500)]
    out = lineage.ranked(spark.createDataFrame(rows, "a long, b long, c long").repartition(7), [F.col("a"), F.col("b"), F.col("c")]).collect()
    want = sorted(rows, key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2]))
    assert [tuple(x)[:3] for x in sorted(out, key=lambda x: x["rank"])] == want and sorted(x["rank"] for x in out) == list(range(500))
    with pytest.raises(ValueError):
        lineage.ranked(spark.createDataFrame([(1,)], "rank long"), [F.col("rank")])


def test_locate(spark):
    starts = [0.0, 1.0, 2.5, 2.5, 7.0]
    ends = [0.5, 2.5, 2.5, 3.0, 9.0]
    values = [x / 4 for x in range(-4, 44)] + [float("nan"), None, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    arrays = [F.array(*[F.lit(x) for x in a]) for a in (starts, ends)]
    got = [x.k for x in df.select(intervals.locate(F.col("v"), *arrays).alias("k")).collect()]

    def plain(v):
        if v is None or v != v:
            return -1
        k = sum(s <= v for s in starts) - 1
        return k if k >= 0 and (v < ends[k] or (k == len(starts) - 1 and v == ends[k])) else -1

    assert got == [plain(v) for v in values]
    none = F.array().cast("array<double>")
    assert {x.k for x in df.select(intervals.locate(F.col("v"), none, none).alias("k")).collect()} == {-1}


@pytest.mark.parametrize("hot", [1_000_000, 80])
def test_subtract_hot_and_null_keys(spark, hot):
    full = [(i, "hot" if i % 3 else None, float(i % 2)) for i in range(400)]
    first = [("hot", 0.0)] * 50 + [(None, 1.0)] * 5 + [("absent", 0.0)]
    out = lineage.multiset_subtract(spark.createDataFrame(full, "o long, k string, x double"), spark.createDataFrame(first, "k string, x double"), ["k", "x"], "o", hot)
    assert out.columns == ["o", "k", "x"]
    left, kept = Counter(first), []
    for row in full:
        if left[row[1:]] > 0:
            left[row[1:]] -= 1
        else:
            kept.append(row)
    assert sorted(map(tuple, out.collect())) == kept


def test_logs_without_labels(spark):
    df = spark.createDataFrame([("nothing",), ("",), (None,)], "log string")
    rows = df.select(logs.quickstep(F.col("log")).alias("q"), logs.relaxation(F.col("log")).alias("x")).collect()
    assert all(r.q.energy is None and not r.q.forces and not r.q.stress and not r.x.converged and not r.x.frames for r in rows)


def test_hours_text(spark):
    found = spark.createDataFrame([("dft", "a", [3600.0], 2), ("dft", "b", [], 2), ("md", "c", [1800.0, 1800.0], 4)], "category string, path string, seconds array<double>, cores int")
    assert writers.hours_text(metrics.core_hours(found)) == (
        "dft: 2.000000\n  task_count: 2\n  counted_count: 1\nmd: 4.000000\n  task_count: 1\n  counted_count: 1\n"
        "total_core_hours: 6.000000\nmissing_runtime_records:\n  - dft: b\n"
    )


def test_selected_after_current(spark, tmp_path):
    atom = lambda i, e, s=None: Row(structure_id=i, symbols=[e], positions=[[0.0, 0.0, float(i)]], cell=[9.0, 0.0, 0.0, 0.0, 9.0, 0.0, 0.0, 0.0, 9.0], selected=s)
    new = spark.createDataFrame([atom(5, "Si", True), atom(6, "Ge", False), atom(8, "C", True)])
    now = spark.createDataFrame([atom(0, "O"), atom(3, "N")], new.schema).drop("selected")
    writers.write_selected(new, str(tmp_path / "out"), current=now)
    read = lambda name: [r.symbols[0] for f in sorted((tmp_path / "out" / name).glob("part-*")) for r in readers.read_extxyz(spark, str(f)).orderBy("structure_id").collect()]
    assert read("selected") == ["O", "N", "Si", "C"] and read("remain") == ["Ge"]


def test_parts_of_logs_are_made_once(spark, capsys):
    spark.range(1).select(logs.relaxation(F.concat(F.lit("a"), F.col("id"))).alias("x"), logs.quickstep(F.concat(F.lit("b"), F.col("id"))).alias("q")).explain()
    assert capsys.readouterr().out.count(r"\r?\n") == 2  # each log is split into lines in one place


def test_relaxation_of_many_frames(spark):
    n = 40
    one = "Lattice vectors: (Cartesian coordinate: in unit of a_0)\n 4 0 0\n 0 5 0\n 0 0 6\nDIRECT COORDINATES\n atom\n t 0.5 0.5 0.25\n TOTAL-FORCE (eV/Angstrom)\n -\n Si1 {k} 0 0\n TOTAL-STRESS (KBAR)\n -\n 1 0 0\n 0 1 0\n 0 0 1\n !FINAL\n final etot is {k}.5 eV\n"
    df = spark.createDataFrame([(" TOTAL ATOM NUMBER = 1\n" + "".join(one.replace("{k}", str(k)) for k in range(n)),)], "log string")
    found = df.select(logs.relaxation(F.col("log")).alias("x")).first().x
    assert [f.energy for f in found.frames] == [k + 0.5 for k in range(n)] and [f.forces for f in found.frames] == [[[k, 0.0, 0.0]] for k in range(n)]
    assert all(f.positions == [[2.0, 2.5, 1.5]] and f.symbols == ["Si"] for f in found.frames)


def test_own_classes_are_computed_not_searched(spark, monkeypatch):
    rng = random.Random(3)
    rows = [("all", e, d, i // 4, i, rng.gauss(0, 1 + d) if e != "c" else 2.0) for e in "abc" for d in range(2) for i in range(200)]
    values = spark.createDataFrame([*rows, ("all", "a", 0, 1, 999, None)], "body string, elem string, dim int, structure_id long, atom_idx long, value double")
    of = reduce.stats_of(values, reduce.Binning())
    occupied = histogram.occupied_intervals(histogram.counts(values, of, reduce.KEYS)).select(*reduce.KEYS, "lo", "hi")
    searched = reduce.numbered(intervals.classes(values, occupied, reduce.KEYS)).collect()
    monkeypatch.setattr(intervals, "locate_points", None)
    got = reduce.self_classes(values, reduce.Binning()).collect()
    place = {c: i for i, c in enumerate(sorted({r.class_seq for r in got}))}
    assert sorted((place[r.class_seq], r.structure_id, r.atom_idx) for r in got) == sorted(tuple(r) for r in searched) and len(got) == 1200
