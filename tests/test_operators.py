"""Operators against numpy and plain Python versions of their semantics, with the edge cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna import benchmark
from lacuna.functions import numeric, tensors, text
from lacuna.operators import cover, coverage, histogram, intervals, lineage, metrics, pca, select, stats, structures
from lacuna.plans import reduce

K = ["elem"]


def values(spark, groups):
    return spark.createDataFrame([(e, i, i, float(v)) for e, vs in groups.items() for i, v in enumerate(vs)], "elem string, structure_id long, atom_idx long, value double")


def fd(v):
    n, span = len(v), np.ptp(v)
    if n <= 1:
        return 1
    iqr = np.percentile(v, 75) - np.percentile(v, 25)
    w = 2 * iqr / n ** (1 / 3) if iqr > 0 else 3.5 * np.std(v) / n ** (1 / 3)
    return max(1, math.ceil(span / w)) if w > 0 and span > 0 else 1


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    groups = {"normal": rng.normal(size=500), "discrete": rng.integers(0, 5, 300) / 10, "one": [3.0], "constant": [2.0] * 9, "spread": [0, 0, 0, 0, 0, 0, 0, 100.0]}
    df = values(spark, groups)
    of = stats.dim_stats(df, K)
    bins = {r.elem: r.nbins for r in of.collect()}
    rows = histogram.counts(df, of, K).orderBy("elem", "bin").collect()
    for e, v in groups.items():
        assert bins[e] == fd(np.array(v)), e
        freq, edges = np.histogram(v, bins=bins[e])
        own = [r for r in rows if r.elem == e]
        assert [r.freq for r in own] == freq.tolist(), e
        assert np.allclose([r.lo for r in own] + [own[-1].hi], edges), e


def test_nan_is_refused(spark):
    with pytest.raises(Exception, match="NaN"):
        stats.dim_stats(values(spark, {"a": [1.0, float("nan")]}), K).collect()
    with pytest.raises(ValueError):
        stats.dim_stats(values(spark, {"a": [1.0]}), K, method="self_input")


def test_order_statistics(spark):
    v = np.random.default_rng(2).integers(0, 40, 101) / 4
    row = stats.order_statistics(values(spark, {"a": v}), K, "value", (0.25, 0.5, 0.9)).first()
    assert np.allclose([row.q0, row.q1, row.q2], np.quantile(v, (0.25, 0.5, 0.9)))


def test_locate_edges(spark):
    iv = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.0, 2.0), ("a", 3.0, 4.0)], "elem string, lo double, hi double")
    pts = values(spark, {"a": [-1, 0, 1, 2, 2.5, 3, 4, 5, float("nan"), float("inf")], "b": [0.5]})
    got = {(r.elem, r.structure_id): r.interval_id for r in intervals.locate_points(pts, iv, K).collect()}
    assert [got["a", i] for i in range(10)] == [-1, 0, 1, -1, -1, 2, 2, -1, -1, -1] and got["b", 0] == -1
    grouped = {r.interval_id: r.members for r in intervals.group_by_interval(pts, iv, K).collect() if r.elem == "a"}
    assert grouped == {0: [1], 1: [2], 2: [5, 6]}


def test_covered_rules(spark):
    ref = values(spark, {"a": [0.0, 10.0]})
    of = stats.with_bins(ref.groupBy("elem").agg(F.count("*").alias("n"), F.min("value").alias("vmin"), F.max("value").alias("vmax"), F.lit(0.0).alias("q25"), F.lit(5.0).alias("q75"), F.lit(5.0).alias("sigma")), "self_input", width=2.5)
    zero = histogram.low_intervals(histogram.counts(ref, of, K))
    pts = values(spark, {"a": [0, 10, -1, 11, 2.5, 5, 9.9, float("nan"), 1]})
    got = {r.structure_id: r.covered for r in intervals.label_covered(pts, of, zero, K).collect()}
    assert [got[i] for i in range(9)] == [True, True, False, False, False, False, True, True, True]
    with pytest.raises(Exception, match="not in the reference"):
        intervals.label_covered(values(spark, {"z": [1]}), of, zero, K).collect()
    assert not intervals.label_covered(values(spark, {"z": [1]}), of, zero, K, on_missing="uncovered").first().covered


def plain_novelty(data, zero, rmin, rmax, nbins):
    if nbins <= 0 or rmax <= rmin:
        return []
    width, lo, hi = (rmax - rmin) / nbins, min(data), max(data)
    n = max(1, math.ceil((hi - lo) / width)) if hi > lo else 1
    step = (hi - lo) / n
    out = list(zero)
    for i in range(n):
        a, b = lo + i * step, lo + (i + 1) * step
        b = min(b, hi) if i == n - 1 else b
        if a >= rmax or b <= rmin:
            out.append((a, b))
        elif a < rmin and rmin <= b <= rmax:
            out.append((a, rmin))
        elif b > rmax and rmin <= a <= rmax:
            out.append((rmax, b))
    return sorted(out)


@pytest.mark.parametrize("cand", [[-5, -1, 2, 7, 12], [20, 21], [-9, -8], [-30, 40], [3, 4], [10], [0], [15], [-3, 0, 10, 10.5]])
def test_novelty(spark, cand):
    ref = spark.createDataFrame([("a", 0.0, 10.0, 4)], "elem string, vmin double, vmax double, nbins long")
    zero = spark.createDataFrame([("a", 2.5, 5.0)], "elem string, lo double, hi double")
    ends = values(spark, {"a": cand}).groupBy("elem").agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    got = sorted((r.lo, r.hi) for r in intervals.novelty_intervals(ref, ends, zero, K).collect())
    assert np.allclose(got, plain_novelty([float(x) for x in cand], [(2.5, 5.0)], 0.0, 10.0, 4))


def test_constant_reference_has_no_classes(spark):
    ref = spark.createDataFrame([("a", 3.0, 3.0, 1)], "elem string, vmin double, vmax double, nbins long")
    zero = spark.createDataFrame([("a", 2.5, 3.5)], "elem string, lo double, hi double")
    ends = spark.createDataFrame([("a", 0.0, 9.0)], "elem string, vmin double, vmax double")
    assert intervals.novelty_intervals(ref, ends, zero, K).count() == 0


def test_calibration():
    assert benchmark.calibrate(60) == 60


def test_cover_both_ways(spark):
    rng = random.Random(11)
    for _ in range(3):
        rows = [(c, rng.randrange(25), i) for c in range(30) for i in range(rng.randint(1, 6))]
        df = spark.createDataFrame(rows, "class_seq long, structure_id long, atom_idx long")
        classes = [[s for c, s, _ in rows if c == k] for k in range(30)]
        want = set(benchmark.plain_greedy(classes))
        assert {r.structure_id for r in cover.min_cover(df).collect()} == want
        picked = cover.min_cover(df, local_pairs=0)
        assert {r.structure_id for r in picked.collect()} == want
        assert cover.uncovered_classes(df, picked).count() == 0


@pytest.mark.parametrize(("length", "num"), [(23, 10), (23, 0), (23, 1), (23, 4), (23, 5), (23, 30), (10, 10), (1, 3), (0, 2)])
def test_fwss(spark, length, num):
    ids = list(range(length))
    df = spark.createDataFrame([(i, 100 - i) for i in ids], "structure_id long, freq long")
    a = num // 5
    c = max(1, (length - a) // max(1, num - a))
    want = ids[:num] if num >= length else ids[:a] + ids[a::c]
    assert sorted(r.structure_id for r in select.fwss(df, num).collect()) == sorted(want)


def test_fwss_with_mean(spark):
    coverd = spark.createDataFrame([(i, 100 - i) for i in range(20)], "structure_id long, freq long")
    mean = spark.createDataFrame([(50, 0), (3, 1)], "structure_id long, pos long")
    order = [50, 3, *[i for i in range(20) if i != 3]]
    high = select.fwss_with_mean(coverd, mean, 10, 95.0)
    a, c = 2, (21 - 2) // 8
    assert sorted(r.structure_id for r in high.collect()) == sorted(order[:a] + order[a::c])
    low = select.fwss_with_mean(coverd, mean, 10, 50.0)
    assert sorted(r.structure_id for r in low.collect()) == sorted(order[math.floor(21 * 0.8):])
    few = select.fwss_with_mean(coverd, mean, 3, 50.0)
    assert sorted(r.structure_id for r in few.collect()) == sorted(order[-3:])
    assert select.intersection_counts(high).first().n_both == 1


def test_schedule_budget_convergence(spark):
    assert select.schedule([90, 95], 2) == ([[90.0, 90.0], [95.0, 95.0]], True)
    assert select.schedule([[90], [95, 99]], 2) == ([[90.0, 90.0], [95.0, 99.0]], False)
    with pytest.raises(ValueError):
        select.schedule([[1, 2, 3]], 2)
    assert select.target([[90, 91], [95]]) == 95.0 and select.target(None) == 100.0
    rates = spark.createDataFrame([(0, 92.0), (1, 97.0)], "elem int, coverage double")
    stages = spark.createDataFrame([(s, e, t, b) for s, (t, b) in enumerate([(95.0, 20), (90.0, 40)]) for e in (0, 1)], "stage int, elem int, threshold double, budget int")
    assert tuple(select.budget(rates, stages).first()) == (20, False)
    done = spark.createDataFrame([(0, 99.0), (1, 99.0)], "elem int, coverage double")
    assert tuple(select.budget(done, stages).first()) == (0, True)
    h = spark.createDataFrame([("m", i, x) for i, x in enumerate([50.0, 60.0, 60.5, 60.9, 99.0])], "metric_key string, gen int, metric double")
    got = [r.converged for r in select.convergence(h, 95.0, 3, 1.0).orderBy("gen").collect()]
    assert got == [False, False, False, True, True]
    assert [r.plateau for r in select.convergence(h, 95.0, 1, 1.0).orderBy("gen").collect()] == [False] * 5
    up = select.upsert(h, spark.createDataFrame([("m", 4, 1.0), ("m", 5, 2.0)], h.schema))
    assert up.count() == 6 and up.where("gen = 4").first().metric == 1.0


def test_coverage_rates(spark):
    rows = [("a", 0, i, i < 3) for i in range(4)] + [("a", 1, i, i < 1) for i in range(4)]
    df = spark.createDataFrame(rows, "elem string, dim int, structure_id long, covered boolean")
    assert coverage.coverage_rate(df, K).first().coverage == 50.0
    assert coverage.coverage_rate(df, K, how="min").first().coverage == 25.0
    both = spark.createDataFrame([("a",), ("b",)], "elem string")
    assert {r.elem: r.coverage for r in coverage.fill_absent(coverage.coverage_rate(df, K), both, K).collect()} == {"a": 50.0, "b": 100.0}
    assert sorted(r.score for r in coverage.point_scores(df, ["structure_id"]).collect()) == [0, 1, 1, 2]


def test_grid_excludes_the_maximum(spark):
    q = values(spark, {"a": [0, 1, 2, 3, 4, 5, 6, 7]}).withColumn("dim", F.lit(0))
    d = values(spark, {"a": [0, 7]}).withColumn("dim", F.lit(0))
    grid = coverage.grid_stats(q, K, "dim", "value")
    assert grid.first().gbins == math.floor(7 / (2 * 3.5 / 2))
    row = coverage.grid_coverage(q, d, grid, K, "dim", "value", ["structure_id"]).first()
    assert (row.n_query, row.n_covered) == (8, 4)
    flat = values(spark, {"a": [1, 1]}).withColumn("dim", F.lit(0))
    assert coverage.grid_coverage(flat, flat, coverage.grid_stats(flat, K, "dim", "value"), K, "dim", "value", ["structure_id"]).first().coverage == 1.0


def test_monotonic(spark):
    rows = [("a", k, i, s, c) for k, c in ((0, 0.5), (1, 0.25), (2, 0.75)) for i, s in enumerate([1.0, 3.0, 3.0, 0.0])]
    df = spark.createDataFrame(rows, "elem string, label_pos int, idx long, score double, coverage double")
    out = coverage.monotonic_topk(df).collect()
    shown = {k: {r.idx for r in out if r.label_pos == k and r.shown} for k in range(3)}
    assert shown == {0: {1, 2}, 1: {1, 2}, 2: {0, 1, 2}}


def test_pca_matches_svd(spark):
    x = np.random.default_rng(3).normal(size=(200, 5)) @ np.diag([3, 1, 1, 0.5, 0])
    x[:, 4] = 2.0
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "structure_id long, features array<double>")
    model = pca.fit(df)[None]
    std = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(std > 1e-12, std, 1)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    assert abs(model.explained - (s[:2] ** 2).sum() / (s**2).sum()) < 1e-9
    got = np.array([[r.pc1, r.pc2] for r in pca.project(df, model).orderBy("structure_id").collect()])
    assert np.allclose(np.abs(got), np.abs(z @ vt[:2].T), atol=1e-8)


def test_cluster_sample(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.1, size=(40, 4)) for c in (0, 5, 10)])
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "structure_id long, features array<double>")
    out = pca.cluster_sample(df, "features", 3, 2, "structure_id").collect()
    assert len(out) == 6 and len({r.structure_id // 40 for r in out}) == 3


def test_ensemble_does_not_depend_on_the_dealing(spark):
    rng = np.random.default_rng(5)
    rows = [(a, m, *(float(x) * 100 for x in rng.integers(0, 9, 3) / 100)) for a in range(400) for m in range(7)]
    found = set()
    for seed in range(4):
        dealt = [rows[i] for i in np.random.default_rng(seed).permutation(len(rows))]
        df = spark.createDataFrame(dealt, "atom_idx int, model int, fx double, fy double, fz double").repartition(3 + seed)
        found.add(tuple(r.ambiguity for r in metrics.ensemble_ambiguity(df, ["atom_idx"]).orderBy("atom_idx").collect()))
    assert len(found) == 1  # to the last bit


def test_ensemble(spark):
    f = np.random.default_rng(0).normal(size=(3, 4, 5, 3))
    rows = [(m, s, a, a % 2, *f[m, s, a].tolist()) for m in range(3) for s in range(4) for a in range(5)]
    df = spark.createDataFrame(rows, "model int, structure_id int, atom_idx int, elem int, fx double, fy double, fz double")
    per_atom = metrics.ensemble_ambiguity(df, ["structure_id", "atom_idx", "elem"])
    want = np.sqrt(((f - f.mean(axis=0)) ** 2).sum(axis=3).mean(axis=0))
    assert all(abs(r.ambiguity - want[r.structure_id, r.atom_idx]) < 1e-9 for r in per_atom.collect())
    m = metrics.ambiguity_matrix(per_atom, [0, 1, 7])
    assert m.where("elem = 7").agg(F.max("amb_max")).first()[0] == 0.0
    top = want.max()
    assert metrics.adaptive_threshold(m, 1.0, top / 2, 1.1)[1:] == (top / 2 * 1.1, True)
    assert metrics.adaptive_threshold(m, 0.5, top * 2, 1.1)[0] == pytest.approx(top * 0.5)
    assert metrics.limit_memory([True, False, True], 1.0, 2.0) == 4.0
    assert histogram.edges_with_threshold(1.0, 3, 0.25) == [0.0, 0.25, 0.5, 1.0]


def test_metrics(spark):
    rng = np.random.default_rng(1)
    t, p = rng.normal(size=50), rng.normal(size=50)
    df = spark.createDataFrame([("a", float(x), float(y)) for x, y in zip(t, p, strict=True)] + [("c", 1.0, 2.0)] * 2, "k string, t double, p double")
    got = {r.k: r for r in metrics.error_metrics(df, ["k"], "t", "p").collect()}
    d = p - t
    assert np.allclose([got["a"].mae, got["a"].rmse, got["a"].r2], [1000 * np.abs(d).mean(), 1000 * np.sqrt((d * d).mean()), 1 - (d * d).sum() / ((t - t.mean()) ** 2).sum()])
    assert got["c"].r2 is None
    s = metrics.value_stats(df, [], "t").first()
    assert s.n == 52
    with pytest.raises(ValueError):
        metrics.positional_join(spark.range(3), spark.range(2), ["id"])
    frames = spark.createDataFrame([(i,) for i in range(4)], "frame_idx long")
    assert metrics.skip_frames(frames, [1, 4]).count() == 2
    with pytest.raises(ValueError):
        metrics.skip_frames(frames, [5])
    dumps = spark.createDataFrame([(f, a) for f, n in enumerate([2, 1, 2, 2]) for a in range(n)], "frame_idx long, atom long")
    assert {r.frame_idx for r in metrics.complete_prefix(dumps).collect()} == {0, 1, 2}


def test_tensors(spark):
    c = np.array([[4.0, 0.5, 0], [0, 3, 0.2], [0.1, 0, 5]])
    p = np.array([5.0, -1.0, 2.0])
    df = spark.createDataFrame([(c.ravel().tolist(), p.tolist(), [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])], "c array<double>, p array<double>, s array<double>")
    row = df.select(tensors.volume(F.col("c")).alias("v"), tensors.fractional(F.col("p"), F.col("c")).alias("f"), tensors.to_nine(F.col("s")).alias("n"), tensors.virial_from_stress(F.col("s"), F.col("c")).alias("w"), tensors.to_voigt(tensors.to_nine(F.col("s"))).alias("g"), tensors.cartesian(tensors.fractional(F.col("p"), F.col("c"), False), F.col("c")).alias("back")).first()
    assert abs(row.v - abs(np.linalg.det(c))) < 1e-9 and np.allclose(row.f, (p @ np.linalg.inv(c)) % 1) and np.allclose(row.back, p)
    nine = [1.0, 6, 5, 6, 2, 4, 5, 4, 3]
    assert row.n == nine and row.g == [1.0, 2, 3, 4, 5, 6] and np.allclose(row.w, -np.array(nine) * row.v)
    units = spark.createDataFrame([("GPa",), ("eV/A^3",), ("kbar",), ("x",)], "u string").select(tensors.unit_factor(F.col("u")).alias("f")).collect()
    assert np.allclose([u.f for u in units[:3]], [1 / 160.21766208, 1, 0.0006241509073]) and units[3].f is None
    b = spark.createDataFrame([([-0.5, 4.5, 0.5, 0.0, 3.0, -0.5, 0.0, 2.0, 0.0],)], "b array<double>").select(tensors.box_to_cell(F.col("b")).alias("c")).first().c
    assert b == [4.0, 0.0, 0.0, 0.5, 3.0, 0.0, -0.5, 0.0, 2.0]
    g = df.select(tensors.stress_gpa(F.lit(None).cast("array<double>"), F.lit(None).cast("array<double>"), F.lit(None).cast("array<double>"), F.col("s"), F.col("c")).alias("g"), tensors.parity_gpa(F.col("s"), F.col("c")).alias("q")).first()
    assert np.allclose(g.g, -np.array(g.q))


def test_text(spark):
    assert text.load_config('{"a": "x//y#z", /* c */ "b": 1 # end\n}') == {"a": "x//y#z", "b": 1}
    with pytest.raises(ValueError):
        text.load_config('{"old": 1}', ("old",))
    assert (text.trigger("25%", 10), text.trigger(None, 5), text.trigger(7, 0), text.trigger("1%", 10)) == (3, 10, 7, 1)
    for wrong in (0, "0%", "x", 1.5):
        with pytest.raises(ValueError):
            text.trigger(wrong, 10)
    assert text.repeats("2x2x1") == (2, 2, 1) and text.repeats("3") == (3, 3, 3)
    assert [text.coerce(x) for x in ("none", "Yes", "3", "2.5", "abc")] == [None, True, 3, 2.5, "abc"]
    df = spark.createDataFrame([("a total_runtime:12.5 s\nb total_runtime：3 s\nTotal wall time: 1-01:02:03\n#SBATCH -n 28\n",)], "log string")
    row = df.select(text.runtimes(F.col("log")).alias("r"), text.wall_times(F.col("log")).alias("w"), text.cores(F.col("log")).alias("c")).first()
    assert (row.r, row.w, row.c) == ([12.5, 3.0], [90123.0], 28)
    info = spark.createDataFrame([({"Main": "3", "x": "y"},)], "i map<string,string>")
    got = info.select(text.info_matches(F.col("i"), "main", F.lit("3.0")).alias("a"), text.info_matches(F.col("i"), "X", F.lit("z")).alias("b"), text.info_matches(F.col("i"), "none", F.lit("z")).alias("c")).first()
    assert tuple(got) == (True, False, False)
    errors = spark.createDataFrame([("ok\nERROR: bad\nERROR: Lost atoms: 1\nERROR: last",), ("fine",)], "l string").select(text.last_error(F.col("l")).alias("e")).collect()
    assert [e.e for e in errors] == ["ERROR: Lost atoms: 1", None]
    head = spark.createDataFrame([("species_count = 2\nalpha_moment_mapping = {0, 3, 7}",)], "h string").select(text.potential_species(F.col("h")).alias("n"), text.potential_moments(F.col("h")).alias("m")).first()
    assert tuple(head) == (2, [0, 3, 7])
    assert numeric.linspace(0, 1, 5) == [0, 0.25, 0.5, 0.75, 1]


def test_structure_filters(spark):
    f = spark.createDataFrame([(0, 5.0), (1, 2.0), (2, 2.0)], "frame_idx long, max_f double")
    assert [r.frame_idx for r in structures.force_filter(f, 3.0).collect()] == [1, 2]
    assert [r.frame_idx for r in structures.force_filter(f, 1.0).collect()] == [1]
    names = spark.createDataFrame([(0, "Si.cif"), (1, "Ge.cif"), (2, "SiGe.vasp")], "idx long, name string")
    assert [r.idx for r in structures.select_structures(names, ["index:2", "*.cif"]).collect()] == [2, 0, 1]
    assert [r.idx for r in structures.select_structures(names, ["first", "all"]).collect()] == [0, 1, 2]
    assert len(structures.power_set([1, 2, 3])) == 7 and structures.power_set([1, 2])[-1] == (1, 2)
    with pytest.raises(ValueError):
        structures.require_elements(spark.createDataFrame([(1,)], "elem int"), spark.createDataFrame([(2,)], "elem int"))
    syms = spark.createDataFrame([(["H", "C", "H", "O"],), (["Si", "Ge", "Si"],)], "s array<string>").select(structures.formula(F.col("s")).alias("f")).collect()
    assert [s.f for s in syms] == ["CH2O", "GeSi2"]


SI = ("a", 0, 2, [4.0, 0.0, 0.0, 0.0, 4.0, 0.0, 0.0, 0.0, 4.0], ["Si", "Ge"], [[0.0, 0.0, 0.0], [1.0, 2.0, 3.0]])
SCHEMA = "file string, structure_id long, n_atoms int, cell array<double>, symbols array<string>, positions array<array<double>>"


def test_generators(spark):
    df = spark.createDataFrame([SI], SCHEMA)
    out = structures.strain_and_rattle(df, [1.0, 1.02], 2, 0.01, 42).orderBy("candidate_idx").collect()
    assert len(out) == 6 and np.allclose(out[3].cell, np.array(SI[3]) * 1.02)
    seed = 42 + 0 * 100000 + 1020 * 100 + 1
    want = np.array(SI[5]) * 1.02 + np.random.RandomState(seed).normal(scale=0.02, size=(2, 3))
    assert np.allclose([list(p) for p in out[5].positions], want)
    big = structures.supercell(df, (2, 1, 1)).first()
    assert big.n_atoms == 4 and big.cell[0] == 8.0 and [list(p) for p in big.positions][2] == [4.0, 0.0, 0.0]
    shifted = ("b", 1, 2, SI[3], SI[4], [[4.0, 0.0, 0.0], [1.0, -2.0, 3.0]])
    assert structures.dedup(spark.createDataFrame([SI, shifted], SCHEMA)).collect()[0].structure_id == 0
    assert structures.dedup(spark.createDataFrame([SI, shifted], SCHEMA)).count() == 1
    twice = ("c", 2, 3, SI[3], ["Si", "Ge", "Si"], [[0.0, 0.0, 0.0], [1.0, 2.0, 3.0], [4.0, 4.0, 0.0]])
    assert structures.trim_overlaps(spark.createDataFrame([twice], SCHEMA)).first().n_atoms == 2
    assert structures.sort_atoms(df).first().symbols == ["Ge", "Si"]
    assert structures.parameter_grid(df, t=[300, 600], m=[0, 1, 2]).count() == 6
    sites = spark.createDataFrame([(0, 1, SI[3], [[1, 0, 0, 0, 1, 0, 0, 0, 1]])], "structure_id long, atom_idx int, cell array<double>, rotations array<array<int>>")
    d = structures.displacements(sites, 0.01).collect()
    assert len(d) == 6 and all(abs(math.hypot(r.dx, r.dy, r.dz) - 0.01) < 1e-12 for r in d)


def test_lineage(spark):
    n, k = 23, 5
    df = spark.range(n)
    got = [r.chunk for r in lineage.chunk_of(df, k, "id").orderBy("id").collect()]
    assert got == [i for i, part in enumerate(np.array_split(range(n), k)) for _ in part]
    assert lineage.reduce_chunks(df, n, 12, "id").agg(F.max("chunk")).first()[0] == 0
    assert max(r.chunk for r in lineage.chunk_of(df.limit(2), 5, "id").collect()) == 1
    assert lineage.select_loops([-1, *range(9)], "middle-half") == [-1, 2, 3, 4, 5, 6, 8]
    assert lineage.select_loops([-1, *range(9)], "uniform-half") == [-1, 0, 2, 4, 6, 8]
    assert lineage.select_loops([0, 1, 2], "uniform-half") == [0, 1, 2] and lineage.select_loops([0], "all") == [0]
    assert lineage.select_loops([-1, 0, 1, 2], "[init, loop-2, 2, 2]") == [-1, 1, 2]
    with pytest.raises(ValueError):
        lineage.select_loops([0, 1], "[5]")
    with pytest.raises(Exception, match="whole number"):
        lineage.discover_labels(spark.createDataFrame([("1.5",)], "main string")).collect()
    full = spark.createDataFrame([(i, x) for i, x in enumerate([1.0, 1.0, 1.0, 2.0, 3.0])], "i long, x double")
    init = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (2.0,)], "x double")
    assert [r.i for r in lineage.multiset_subtract(full, init, ["x"], "i").orderBy("i").collect()] == [2, 4]
    spans = spark.createDataFrame([("a", 0, 2), ("b", 2, 4), ("a", 4, 6)], "config string, start long, stop long")
    sel = spark.createDataFrame([(3,)], "structure_id long")
    assert {r.config for r in lineage.configurations_with(spans, sel).collect()} == {"b"}
    assert {r.config for r in lineage.configurations_with(spans, sel, by_span=True).collect()} == {"a", "b"}


def test_reduce_properties(spark):
    rng = np.random.default_rng(5)
    rows = [(i, 0, i % 2, rng.normal(size=3).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "structure_id long, atom_idx int, elem int, features array<double>")
    out = reduce.candidate_only(df).collect()
    assert len(out) == 120 and 0 < sum(r.selected for r in out) < 120
    shuffled = reduce.candidate_only(df.orderBy(F.rand(3))).collect()
    assert {r.structure_id for r in out if r.selected} == {r.structure_id for r in shuffled if r.selected}
    guided = reduce.reference_guided(df, 50, current=df.limit(0)).collect()
    assert len(guided) == 120
    assert all(r.selected for r in reduce.candidate_only(df, current=df.limit(0)).collect())
    assert reduce.candidate_only(df.limit(0), current=df).count() == 0


def test_log_forms(spark):
    rows = [("total_runtime: 1.5 s\ntotal_runtime：2 s\ntotal_runtime 3e1 s\ntotal_runtime: 1.2.3 s",), ("Total wall time: 2-01:00:01.5",), ("nothing",)]
    got = spark.createDataFrame(rows, "log string").select(text.runtimes(F.col("log")).alias("r"), text.wall_times(F.col("log")).alias("w")).collect()
    assert [r.r for r in got] == [[1.5, 2.0, 30.0], [], []] and [r.w for r in got] == [[], [2 * 86400 + 3600 + 1.5], []]
    scripts = ["#SBATCH -n 4\n#BSUB -n 8\n", "#SBATCH -n 4\n", "#SBATCH -n 4 # all\n", "#SBATCH --ntasks=4\n", " #BSUB -n 2"]
    assert [r.c for r in spark.createDataFrame([(x,) for x in scripts], "s string").select(text.cores(F.col("s")).alias("c")).collect()] == [8, 4, None, None, None]
    logs = [("Energy MAE (meV/atom): 1.5\nForce MAE   (meV/A)  : 2e1\nStress MAE (eV): 3",), ("energy MAE: 4\nForce MAE (eV/A): 5",)]
    assert [tuple(r.e) for r in spark.createDataFrame(logs, "log string").select(text.training_errors(F.col("log")).alias("e")).collect()] == [(1.5, 20.0, 3.0), (None, None, None)]


def test_lookup_and_names(spark):
    df = spark.createDataFrame([({"KEY": "1", "key": "2"}, "  "), ({"KEY": "1"}, "/a b/ "), ({"x": "1"}, "ok-1.x")], "info map<string,string>, label string")
    got = df.select(text.info_value(F.col("info"), "key").alias("v"), text.safe_name(F.col("label")).alias("n")).collect()
    assert [(r.v, r.n) for r in got] == [("2", "dataset"), ("1", "_a_b_"), (None, "ok-1.x")]


def test_selectors(spark):
    df = spark.createDataFrame([(0, "dir/a.cif", 1), (1, "dir/b.cif", 1), (2, "dir/b.cif", 2), (3, "c1.xyz", 1)], "idx int, name string, frame int")
    pick = lambda s: [r.idx for r in structures.select_structures(df, s, frame="frame").collect()]
    assert pick("b.cif:2, FIRST") == [2, 0] and pick(["b"]) == [1, 2] and pick("c[0-9].xyz,a.cif") == [3, 0] and pick(None) == pick("first,ALL") == [0, 1, 2, 3]
    assert pick("[!c]*") == [0, 1, 2]
    for wrong in ("nothing", "index:9", "index:x", "B.cif"):
        with pytest.raises(ValueError):
            pick(wrong)


def test_positional_join_needs_equal_places(spark):
    with pytest.raises(Exception, match="truth or prediction alone"):
        metrics.positional_join(spark.range(3), spark.range(1, 4), ["id"]).collect()


def test_threshold_default(spark):
    assert metrics.adaptive_threshold(None, 0.8, 2.0, 1.1, default=0.3) == (0.3, 2.0, False)
    with pytest.raises(ValueError):
        metrics.adaptive_threshold(None, 0.8, 2.0, 1.1)
