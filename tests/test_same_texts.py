"""Files that are written and read by faster ways have the texts and frames of the plain ones."""

import random

from pyspark.sql import functions as F

from lacuna.functions import tensors
from lacuna.operators import structures
from lacuna.plans import featurize
from lacuna.sources import frames, readers


def test_small_files_have_small_ranges_and_large_ones_few(spark, tmp_path):
    (tmp_path / "a.xyz").write_bytes(b"\n" * 1000)
    assert frames.dealt_bytes(spark, str(tmp_path)) == frames.LEAST_BYTES
    with open(tmp_path / "b.xyz", "wb") as f:
        f.truncate(1 << 36)  # no bytes on disk
    assert frames.dealt_bytes(spark, str(tmp_path)) == frames.RANGE_BYTES


def test_frames_by_columns_are_those_read_one_by_one():
    rng, batch = random.Random(5), []
    for k in range(50):
        n = rng.randint(0, 5)
        head = f'Lattice="4 0 0 0 4 0 0 0 4" Properties=species:S:1:pos:R:3:force:R:3 main={k} energy={k}.5 other="a b"'
        batch.append((k, [str(n), head, *(f"  Si {k} {i}e-3 0.{i}  -{i} nan {i / 7}\r" for i in range(n))]))
    part = frames.Range("a.xyz", 7, 9, None)
    fast, slow = frames.by_columns(part, batch), [readers.one_frame(x) for _, x in batch]
    assert fast.schema == frames.arrow_schema()
    for row, (place, _), one in zip(fast.to_pylist(), batch, slow, strict=True):
        assert (row["file"], row["start"], row["place"], dict(row["info"])) == ("a.xyz", 7, place, one["info"])
        assert all(repr(row[c]) == repr(one[c]) for c in ("n_atoms", "cell", "symbols", "positions", "forces", "energy", "virial", "main", "label"))
    other = [(50, ["1", "main=1", "Ni 1 2 3"])]
    assert frames.parsed(part, batch + other).to_pylist()[-1]["symbols"] == ["Ni"]  # a layout of its own


def test_blocks_are_numbered_over_files_in_tasks_of_their_own(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"part-{k}").write_text("".join(f"#start 1\n{k}{i}\n" for i in range(k + 1)))
    rows = readers.blocks(spark, str(tmp_path), "#start", "\n", across=True)
    found = [(r.structure_id, r.block.split()[1]) for r in rows.orderBy("structure_id").collect()]
    assert found == list(enumerate(f"{k}{i}" for k in range(5) for i in range(k + 1)))
    assert "BroadcastHashJoin" in rows._jdf.queryExecution().executedPlan().toString()
    picked = readers.select_blocks(spark, str(tmp_path), spark.range(0, 15, 3).select(F.col("id").alias("structure_id")), across=True)
    assert sorted(r.value.split()[2] for r in picked.collect()) == ["00", "20", "30", "33", "42"]


def test_shells_of_all_atoms_at_once_are_those_of_histograms():
    import numpy as np

    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 7):
        p = rng.integers(0, 6, (n, 3)).astype(float)  # distances on the bounds of shells
        for bins, cutoff in ((4, 6.05), (8, 6.0), (5, 3.0)):
            d = np.linalg.norm(p[:, None] - p[None, :], axis=2)
            plain = [np.histogram(np.delete(d[i], i), bins=bins, range=(0, cutoff))[0].tolist() for i in range(n)]
            assert featurize.pair_distances(bins, cutoff)({"positions": p}) == plain
    calls, plain_histogram = [], np.histogram
    np.histogram = lambda *a, **k: calls.append(1) or plain_histogram(*a, **k)
    try:
        featurize.pair_distances(4, 6.0)({"positions": p})
    finally:
        np.histogram = plain_histogram
    assert not calls  # one for each atom before


def test_fractions_are_those_of_each_position(spark):
    rows = [([[1.5, -2.0, 3.25], [-0.0, 9.0, 4.0]], [4.0, 0.5, 0.0, 0.0, 5.0, 0.25, 1.0, 0.0, 6.0]), ([[1.0, 2.0, 3.0]], [0.0] * 9), ([[1.0, 2.0, 3.0]], None), ([], [1.0] * 9), (None, [1.0] * 9)]
    df = spark.createDataFrame(rows, "p array<array<double>>, c array<double>")
    out = df.select(tensors.fractions(F.col("p"), F.col("c")).alias("a"), F.transform("p", lambda p: tensors.fractional(p, F.col("c"))).alias("b"))
    assert all(repr(r.a) == repr(r.b) for r in out.collect())
    size = lambda c: len(df.select(c)._jdf.queryExecution().analyzed().toString())
    s = structures.fingerprint(F.array(F.lit("a")), F.col("p"), F.col("c"))
    assert size(s) < size(F.transform("p", lambda p: tensors.fractional(p, F.col("c"))))  # the cell is inverted once


def test_rows_of_a_key_are_sorted_by_a_hash_first(spark):
    df = spark.createDataFrame([(3, [1.0]), (1, [1.0]), (2, None), (5, None), (4, [-0.0]), (6, [0.0])], "id long, x array<double>")
    first = structures.first_of(df, ["x"], "id")
    assert "xxhash64" in first._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.id for r in first.collect()) == [1, 2, 4]
