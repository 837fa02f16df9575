"""Lifecycle plans, featurizers, folder scans and the command line."""

import json

import pytest

from lacuna import cli
from lacuna.plans import featurize, lifecycle, reduce, report
from lacuna.sources import readers

CELL = [4.0, 0.0, 0.0, 0.0, 4.0, 0.0, 0.0, 0.0, 4.0]
SCHEMA = "structure_id long, n_atoms int, cell array<double>, symbols array<string>, positions array<array<double>>"


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(0, 2, CELL, ["Si", "Ge"], [[0.0, 0.0, 0.0], [1.0, 2.0, 3.0]])], SCHEMA)


def test_initial_dataset(spark, base):
    snaps = base.crossJoin(spark.createDataFrame([(0,), (5,), (10,)], "step int"))
    out = lifecycle.initial_dataset(base, [1.0, 1.02], 1, 0.01, 42, snaps, 10)
    assert out.count() == 4  # two strains, two rattled; both snapshots equal the unstrained structure
    levels = {(r.level, r.name): r.n for r in lifecycle.summary(out).collect()}
    assert levels["all", "all"] == 4 and levels["formula", "GeSi"] == 4
    again, more = lifecycle.bundle(out.limit(1), out, ["kind", "positions"])
    assert again.first().main == -1 and more.count() == 3
    frames = spark.createDataFrame([(0, [[1.0, 0.0, 0.0]]), (1, [[9.0, 0.0, 0.0]])], "structure_id long, forces array<array<double>>")
    assert [r.structure_id for r in lifecycle.labelled(frames, 5.0).collect()] == [0]
    assert [r.structure_id for r in lifecycle.labelled(frames, 0.5).collect()] == [0]


def test_featurizer(spark, base):
    rows = featurize.descriptors(base, "pair-distances", ["Si", "Ge"], bins=4, cutoff=8.0).orderBy("atom_idx").collect()
    assert [(r.elem, r.features) for r in rows] == [(0, [0.0, 1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0])]

    def broken():
        def f(row):
            raise ValueError("no")

        return f

    assert featurize.apply(base, broken, "array<array<double>>", ["structure_id"]).first().error == "ValueError: no"
    with pytest.raises(Exception, match="featurizer"):
        featurize.descriptors(base, broken, ["Si"]).collect()


def test_folder_and_blocks(spark, tmp_path):
    for name in ("b.cif", "a.vasp", "POSCAR_1", "notes.txt"):
        (tmp_path / name).write_text("x")
    assert [r.name for r in readers.scan_folder(spark, str(tmp_path)).collect()] == ["POSCAR_1", "a.vasp", "b.cif"]
    out = tmp_path / "d.out"
    out.write_text("#start 1\n0 1 2\n#start 1\n0 3 4\n#start 1\n0 5 6\n")
    picked = readers.select_blocks(spark, str(out), spark.createDataFrame([(2,), (0,)], "structure_id long")).orderBy("structure_id").collect()
    assert [r.value for r in picked] == ["#start 1\n0 1 2", "#start 1\n0 5 6"]


def test_cli(spark, tmp_path, capsys):
    rows = [(i, 0, 0, [float(i % 7), float(i % 5)]) for i in range(40)]
    df = spark.createDataFrame(rows, "structure_id long, atom_idx int, elem int, features array<double>")
    df.write.parquet(str(tmp_path / "in"))
    config = tmp_path / "c.jsonc"
    config.write_text(json.dumps({"input": str(tmp_path / "in"), "output": str(tmp_path / "out")}) + "\n// done")
    assert cli.main(["reduce", str(config)]) == 0
    said = json.loads(capsys.readouterr().out)
    assert said["structures"] == 40 and said["selected"] + said["remain"] == 40
    want = {r.structure_id for r in reduce.candidate_only(df).where("selected").collect()}
    assert {r.structure_id for r in spark.read.parquet(str(tmp_path / "out")).where("selected").collect()} == want
    config.write_text('{"bw": 1}')
    with pytest.raises(ValueError):
        cli.main(["reduce", str(config)])
    assert cli.main([]) == 2 and cli.main(["calibrate-selection", "3"]) == 0


def test_report_versions(spark):
    rows = [(i, 0, 0, [float(i % 9), float(i * i % 11), 1.0], i % 3 - 1) for i in range(60)]
    data = spark.createDataFrame(rows, "structure_id long, atom_idx int, elem int, features array<double>, main int")
    out = report.coverage_report(data, data.drop("main"), "all", grid_source="combined").collect()
    assert [r.label for r in out] == ["init", "loop-1", "loop-2"]
    assert out[0].coverage_2d <= out[1].coverage_2d <= out[2].coverage_2d and out[2].coverage_1d > 0.6
    with pytest.raises(ValueError):
        report.coverage_report(data, data, grid_source="x")
