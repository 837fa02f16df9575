"""Quantiles, marks, clusters and report versions by the ways that large tables take, against plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.operators import cluster, coverage, lineage, stats
from lacuna.plans import report


@pytest.mark.parametrize("small", [20, 1_000_000])
def test_quantiles_in_windows(spark, small):
    rng = random.Random(1)
    groups = {
        "even": [rng.random() for _ in range(3000)], "outlier": [rng.random() for _ in range(3000)] + [1e12, -1e300], "ties": [float(rng.randrange(3)) for _ in range(2000)],
        "one": [7.0] * 1500, "single": [3.0], "two": [1.0, 2.0], "tiny": [10.0 ** -rng.uniform(0, 300) for _ in range(2000)], "infinite": [float("inf"), 1.0, 2.0, 3.0] * 50,
    }
    df = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs] + [("even", None)], "k string, v double")
    qs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r.k: [r[f"q{i}"] for i in range(len(qs))] for r in stats.order_statistics(df, ["k"], "v", qs, small).collect()}
    assert got.pop("infinite") == [1.0, 1.75, 2.5, float("inf"), float("inf")]  # between equal infinities there is no other value
    for k, want in got.items():
        assert want == pytest.approx([float(np.quantile(groups[k], q)) for q in qs], rel=1e-12), k


def test_no_task_ranks_a_key_with_an_outlier(spark):
    """All but one value in a sliver of the range: the window that is ranked is small all the same."""
    df = spark.range(200_000).select(F.lit("k").alias("k"), F.when(F.col("id") == 7, 1e12).otherwise(F.col("id") / 200_000).alias("v"))
    rows = df.select("k", F.col("v").alias("_v"))
    whole = rows.groupBy("k").agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    windows = whole.withColumns({"_place": F.lit(100_000).cast("long"), "_before": F.lit(0).cast("long"), "_inside": F.col("_n")})
    cut = stats.narrowed(rows, windows, ["k"], 1000).first()
    assert cut["_inside"] < 2000 and cut["_before"] <= 100_000 < cut["_before"] + cut["_inside"]
    assert stats.order_statistics(df, ["k"], "v", (0.5,), 1000).first().q0 == pytest.approx(0.5, abs=1e-5)


@pytest.mark.parametrize("few", [0, 10_000])
def test_marks(spark, few):
    rng = random.Random(2)
    starts = sorted(rng.sample(range(1000), 60))
    marks = spark.createDataFrame([(s, f"m{s}") for s in starts], "start long, mark string").repartition(3)
    rows = [(i, rng.randrange(-50, 1100) if i % 4 else 500) for i in range(900)]
    got = {r.id: r.mark for r in lineage.located(spark.createDataFrame(rows, "id int, at long"), marks, "at", few).collect()}
    assert got == {i: next((f"m{s}" for s in reversed(starts) if s <= at), None) for i, at in rows}
    assert lineage.located(spark.createDataFrame(rows, "id int, at long"), marks.limit(0), "at", few).where("mark is null").count() == 900


@pytest.mark.parametrize("few", [0, 10_000])
def test_spans(spark, monkeypatch, few):
    monkeypatch.setattr(lineage.located, "__defaults__", (few,))
    spans = [("a", 0, 10), ("b", 10, 30), ("a", 40, 50), ("c", 10**12, 10**12 + 10**11), ("d", 60, 60 + 10**9)]
    ids = [3, 29, 30, 45, 59, 10**12 + 5, 61 + 10**9]
    s = spark.createDataFrame(spans, "config string, start long, stop long")
    df = spark.createDataFrame([(i,) for i in ids], "structure_id long")
    assert {r.structure_id: r.config for r in lineage.configuration_of(df, s).collect()} == {3: "a", 29: "b", 45: "a", 10**12 + 5: "c"}
    assert {r.config for r in lineage.configurations_with(s, df).collect()} == {"a", "b", "c"}
    assert {r.config for r in lineage.configurations_with(s, spark.createDataFrame([(35,)], "structure_id long")).collect()} == set()
    assert {r.config for r in lineage.configurations_with(s, spark.createDataFrame([(35,)], "structure_id long"), by_span=True).collect()} == {"a"}


def test_monotonic_labels(spark):
    """Against the fold written out: labels of other sizes start anew, a group may lack a label."""
    rng = random.Random(3)
    rows = []
    for g, sizes in (("x", [40, 40, 40, 30]), ("y", [25, 25, 25, 25]), ("z", [10, None, 10, 10])):
        for label, n in enumerate(sizes):
            share = rng.random()
            rows += [(g, label, i * 3, float(rng.randrange(5)), share) for i in range(n or 0)]
    df = spark.createDataFrame(rows, "elem string, label_pos int, idx int, score double, coverage double")
    got = {(r.elem, r.label_pos, r.idx): r.shown for r in coverage.monotonic_topk(df).collect()}
    want = {}
    for g in "xyz":
        shown = None
        for label in range(4):
            part = sorted((idx, s, c) for e, p, idx, s, c in rows if (e, p) == (g, label))
            if not part:
                continue
            if shown is None or len(shown) != len(part):
                shown = [False] * len(part)
            goal = max(sum(shown), min(round(part[0][2] * len(part)), len(part)))
            rest = sorted((k for k, s in enumerate(shown) if not s), key=lambda k: (-part[k][1], k))
            for k in rest[: goal - sum(shown)]:
                shown[k] = True
            want |= {(g, label, part[k][0]): s for k, s in enumerate(shown)}
    assert got == want


def test_features_add_up(spark):
    """Summaries of parts, merged, are the summary of all; radii stay below the threshold; coarser cells are made of cells."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3)) * 3
    df = spark.createDataFrame([(i % 3, *map(float, v)) for i, v in enumerate(x)] + [(0, None, 1.0, 1.0)], "part int, a double, b double, c double")
    coords = ["a", "b", "c"]
    whole = {tuple(r.cell): (r.n, r.sums, r.squares) for r in cluster.summarise(df, coords, 1.5).collect()}
    sums = {}
    for r in cluster.summarise(df, coords, 1.5, ["part"]).collect():
        n, s, q = sums.get(tuple(r.cell), (0, [0.0] * 3, 0.0))
        sums[tuple(r.cell)] = (n + r.n, [u + v for u, v in zip(s, r.sums, strict=True)], q + r.squares)
    assert whole.keys() == sums.keys() and all(whole[k][0] == sums[k][0] and whole[k][1] == pytest.approx(sums[k][1]) and whole[k][2] == pytest.approx(sums[k][2]) for k in whole)
    assert sum(n for n, _, _ in whole.values()) == 500
    wide = {tuple(r.cell): (r.n, r.sums, r.squares) for r in cluster.coarser(cluster.summarise(df, coords, 0.75)).collect()}
    assert wide.keys() == whole.keys() and all(wide[k][0] == whole[k][0] and wide[k][1] == pytest.approx(whole[k][1]) for k in wide)
    radii = cluster.summarise(df, coords, 1.5).select(cluster.radius(F.col("n"), F.col("sums"), F.col("squares")).alias("r")).collect()
    assert max(r.r for r in radii) <= 1.5


def test_clusters(spark):
    rng = np.random.default_rng(5)
    middles = np.array([[0, 0], [10, 0], [0, 10], [10, 10]])
    x = np.concatenate([m + rng.normal(size=(60, 2)) * 0.5 for m in middles])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id int, a double, b double")
    for threshold, most in ((0.5, 512), (0.05, 30)):  # as it is, and with cells joined until there are thirty
        out, used = cluster.cluster(df, ["a", "b"], 4, threshold, most)
        found = {r.id: r.cluster for r in out.collect()}
        assert len(found) == 240 and len({found[60 * k] for k in range(4)}) == 4
        assert all(found[i] == found[i // 60 * 60] for i in found)
        assert (used == threshold) == (threshold == 0.5)
    moved = df.select("id", (F.col("a") + 20).alias("a"), (F.col("b") + 20).alias("b"))  # all in one cell at first
    out, used = cluster.cluster(moved, ["a", "b"], 4, 50.0)  # halved until there are four cells, which are then the clusters
    assert used < 50 and out.count() == 240 and {r.cluster for r in out.collect()} == {0, 1, 2, 3}
    with pytest.raises(ValueError):
        cluster.cluster(df.limit(3), ["a", "b"], 4, 0.5)


@pytest.mark.parametrize("grid_source", ["last-loop", "combined"])
def test_report_by_body(spark, grid_source):
    """Versions at once, and version by version, against each version's coverage alone."""
    rng = random.Random(6)
    rows = [(i, 0, i % 2, [rng.gauss(0, 1 + i % 3) for _ in range(4)], i % 3 - 1) for i in range(240)]
    data = spark.createDataFrame(rows, "structure_id long, atom_idx int, elem int, features array<double>, main int")
    query = spark.createDataFrame([(i, 0, i % 2, [rng.gauss(0, 2) for _ in range(4)]) for i in range(150)], "structure_id long, atom_idx int, elem int, features array<double>")
    bodies = {"two": [0, 1], "three": [2]}
    got = {(r.label, r.elem): r for r in report.coverage_report(data, query, grid_source=grid_source, bodies=bodies).collect()}
    for k, label in enumerate(("init", "loop-1", "loop-2")):
        upto = data.where(F.col("main") <= k - 1)
        grid_of = {"query": query, "current-loop": upto, "last-loop": data, "combined": query.union(upto.drop("main"))}[grid_source]
        long = lambda df: report.long(df, "features")
        grid = coverage.grid_stats(long(grid_of), ["elem"], "dim", "value")
        rates = {(r.elem, r.dim): r for r in coverage.grid_coverage_1d(long(query), long(upto), grid, ["elem"], "dim", "value").collect()}
        for elem in (0, 1):
            r, of = got[label, elem], lambda dims, what: float(np.mean([rates[elem, d][what] for d in dims]))  # noqa: B023
            assert r.coverage_1d == pytest.approx(of(range(4), "coverage")) and r.mean_covered_1d == pytest.approx(of(range(4), "n_covered"))
            assert r.coverage_1d_two == pytest.approx(of([0, 1], "coverage")) and r.mean_covered_1d_three == pytest.approx(of([2], "n_covered"))
            assert r.n_query == 75 and r.n_input == upto.where(F.col("elem") == elem).count() and 0 <= r.coverage_2d <= 1
