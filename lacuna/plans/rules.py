"""More registered queries: joins by place, stress metrics, thresholds, selections, text rules and frame filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lacuna.functions import logs, tensors, text
from lacuna.operators import coverage, histogram, intervals, lineage, metrics, select, stats, structures
from lacuna.plans.adapters import event_values, line_forces, table
from lacuna.plans.catalogue import AMB, ED, EV, query, r

LI = "li AS (SELECT *, l_orderkey * 10 + l_linenumber AS id FROM lineitem)"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


# ---- joins and groups


@query(f"""WITH {EV}, iv AS (SELECT i::INTEGER AS interval_id, i * 20.0::DOUBLE AS lo, (i + 1) * 20.0::DOUBLE AS hi, i = 4 AS is_last FROM range(5) t(i)), k AS (SELECT DISTINCT elem FROM e),
m AS (SELECT e.elem, interval_id, structure_id, atom_idx FROM e JOIN iv ON value >= lo AND (value < hi OR (is_last AND value = hi)))
SELECT k.elem, iv.interval_id, lo, hi, count(m.structure_id) AS n, arg_min(m.structure_id, m.atom_idx) AS first_member, arg_max(m.structure_id, m.atom_idx) AS last_member
FROM k CROSS JOIN iv LEFT JOIN m ON m.elem = k.elem AND m.interval_id = iv.interval_id GROUP BY k.elem, iv.interval_id, lo, hi""")
def interval_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_values(spark, sf_dir)
    spans = F.explode(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.struct((i * 20.0).alias("lo"), ((i + 1) * 20.0).alias("hi"))))
    of = e.select("elem").distinct().withColumn("x", spans).select("elem", "x.lo", "x.hi")
    out = intervals.group_by_interval(e, of, ["elem"])
    return out.select("elem", F.col("interval_id").cast("int").alias("interval_id"), "lo", "hi", F.size("members").cast("long").alias("n"), F.get("members", F.lit(0)).alias("first_member"), F.try_element_at("members", F.lit(-1)).alias("last_member"))


@query("""WITH v AS (SELECT o_orderstatus AS flag, o_totalprice / 1000 AS t, o_custkey * 0.75::DOUBLE AS p FROM orders)
SELECT flag, round(avg(abs(p - t)) * 1000, 3) AS mae, round(sqrt(avg((p - t) * (p - t))) * 1000, 3) AS rmse, round(1 - sum((p - t) * (p - t)) / nullif(var_pop(t) * count(*), 0), 6) AS r2, count(*) AS n FROM v GROUP BY flag""")
def positional_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "frame_idx")
    both = metrics.positional_join(o.select("frame_idx", F.col("o_orderstatus").alias("flag"), (F.col("o_totalprice") / 1000).alias("truth")), o.select("frame_idx", (F.col("o_custkey") * 0.75).alias("pred")), ["frame_idx"])
    out = metrics.error_metrics(both, ["flag"], "truth", "pred")
    return out.select("flag", r("mae", 3).alias("mae"), r("rmse", 3).alias("rmse"), r("r2").alias("r2"), "n")


@query("""WITH v AS (SELECT 160.21766208::DOUBLE / abs((l_quantity + 2) * 5 * 4) AS f, [l_quantity, l_discount * 100, l_tax * 100, l_extendedprice / 1000, l_linenumber::DOUBLE, 1.5::DOUBLE] AS t,
  [l_quantity + l_tax, l_discount * 91.37, l_tax * 100, l_extendedprice / 1001, l_linenumber + 0.25::DOUBLE, l_quantity / 10] AS p FROM lineitem),
l AS (SELECT f, unnest(['xx', 'yy', 'zz', 'yz', 'xz', 'xy']) AS component, unnest(t) AS t, unnest(p) AS p FROM v),
u AS (SELECT 'eV' AS unit, component, t, p FROM l UNION ALL SELECT 'GPa', component, t * f, p * f FROM l), a AS (SELECT * FROM u UNION ALL SELECT unit, 'all', t, p FROM u)
SELECT unit, component, round(avg(abs(p - t)), 5) AS mae, round(sqrt(avg((p - t) * (p - t))), 5) AS rmse, count(*) AS n FROM a GROUP BY unit, component""")
def stress_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, d, t, p, n = (F.col(c) for c in ("l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_linenumber"))
    zero = F.lit(0.0)
    cell = F.array(q + 2, zero, zero, zero, F.lit(5.0), zero, zero, zero, F.lit(4.0))
    truth = F.array(q, d * 100, t * 100, p / 1000, n.cast("double"), F.lit(1.5))
    pred = F.array(q + t, d * 91.37, t * 100, p / 1001, n + F.lit(0.25), q / 10)
    out = metrics.stress_metrics(table(spark, sf_dir, "lineitem"), truth, pred, cell)
    return out.select("unit", "component", r("mae", 5).alias("mae"), r("rmse", 5).alias("rmse"), "n")


@query("""WITH c AS (SELECT o_orderkey AS structure_id, o_orderpriority AS config, o_totalprice > 200000 AS picked FROM orders)
SELECT config, count(*) FILTER (WHERE picked) AS n_selected FROM c GROUP BY config""")
def selected_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("structure_id"), F.col("o_orderpriority").alias("config"), "o_totalprice")
    return coverage.selected_by_config(o.select("structure_id", "config"), o.where("o_totalprice > 200000"))


SPANS = """s AS (SELECT (k % 61)::BIGINT AS config, k * 100 AS start, (k + 1) * 100 AS stop FROM range((SELECT max(l_orderkey) // 100 + 1 FROM lineitem)) t(k)), sel AS (SELECT l_orderkey AS id FROM lineitem WHERE l_quantity * l_discount > 4.9)"""


@query(f"WITH {SPANS} SELECT DISTINCT config FROM s JOIN sel ON id >= start AND id < stop")
def configurations_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.configurations_with(*_spans(spark, sf_dir))


@query(f"WITH {SPANS}, w AS (SELECT config, min(start) AS start, max(stop) AS stop FROM s GROUP BY config) SELECT DISTINCT config FROM w JOIN sel ON id >= start AND id < stop")
def configurations_with_by_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.configurations_with(*_spans(spark, sf_dir), by_span=True)


def _spans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Spans of 100 ids over all orders, whose names come again after 61; orders with a large discount."""
    li = table(spark, sf_dir, "lineitem")
    last = li.agg(F.max("l_orderkey")).first()[0]
    spans = spark.range(last // 100 + 1).select((F.col("id") % 61).alias("config"), (F.col("id") * 100).alias("start"), ((F.col("id") + 1) * 100).alias("stop"))
    return spans, li.where("l_quantity * l_discount > 4.9").select(F.col("l_orderkey").alias("structure_id")).distinct()


# ---- thresholds, scores, selections


@query(f"""WITH {AMB}, t AS (SELECT max(ambiguity) * 0.8::DOUBLE AS t FROM a), l AS (SELECT t, CASE WHEN t > 10 THEN 10 * 1.1::DOUBLE ELSE 10 END AS n FROM t)
SELECT round(least(t, n), 6) AS threshold, round(n, 6) AS new_limit, t > n AS clamped FROM l""")
def adaptive_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = metrics.ambiguity_matrix(metrics.ensemble_ambiguity(line_forces(spark, sf_dir), ["structure_id", "elem"]), [0, 1, 2, 3, 4])
    row = metrics.adaptive_threshold(matrix, 0.8, 10.0, 1.1)
    return spark.createDataFrame([row], "threshold double, new_limit double, clamped boolean").select(r("threshold").alias("threshold"), r("new_limit").alias("new_limit"), "clamped")


@query(f"""WITH {AMB}, t AS (SELECT elem, max(ambiguity) * 0.8::DOUBLE AS t FROM a GROUP BY elem), l AS (SELECT elem, t, CASE WHEN t > 18 + elem THEN (18 + elem) * 1.01::DOUBLE ELSE 18 + elem END AS n FROM t)
SELECT elem, round(least(t, n), 6) AS threshold, round(n, 6) AS new_limit FROM l""")
def adaptive_threshold_by_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = metrics.ambiguity_matrix(metrics.ensemble_ambiguity(line_forces(spark, sf_dir), ["structure_id", "elem"]), [0, 1, 2, 3, 4])
    found, limits, _ = metrics.adaptive_threshold(matrix, 0.8, {e: 18.0 + e for e in range(5)}, 1.01, by_element=True)
    return spark.createDataFrame([(e, found[e], float(limits[e])) for e in sorted(found)], "elem long, threshold double, new_limit double").select("elem", r("threshold").alias("threshold"), r("new_limit").alias("new_limit"))


@query(f"""WITH {EV}, s AS (SELECT elem, min(value) AS a, max(value) AS z FROM e GROUP BY elem), b AS (SELECT elem, least(floor((value - a) / (z - a) * 40), 39) AS bin FROM e JOIN s USING (elem))
SELECT elem, round(count(DISTINCT bin) / 40.0::DOUBLE, 6) AS score FROM b GROUP BY elem""")
def feature_coverage_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram.coverage_score(event_values(spark, sf_dir), ["elem"], "value", 41).select("elem", r("score").alias("score"))


@query("""WITH d AS (SELECT event_type AS elem, 100.0::DOUBLE * avg((value > 20)::INT::DOUBLE) AS coverage FROM events GROUP BY elem), m AS (SELECT event_type AS elem, user_id, event_id FROM events WHERE value > 90)
SELECT elem, count(*) AS n FROM m WHERE elem IN (SELECT elem FROM d WHERE coverage < 80) GROUP BY elem""")
def element_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_values(spark, sf_dir)
    rates = coverage.coverage_rate(e.withColumn("covered", F.col("value") > 20), ["elem"])
    limits = rates.select("elem", F.lit(80.0).alias("threshold"))
    return select.element_gate(e.where("value > 90"), rates, limits).groupBy("elem").agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT event_type AS elem, 100.0::DOUBLE * avg((value > 20)::INT::DOUBLE) AS coverage FROM events GROUP BY elem) SELECT elem, round(coverage, 4) AS coverage FROM d""")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.summary(coverage.coverage_rate(event_values(spark, sf_dir).withColumn("covered", F.col("value") > 20), ["elem"]), ["elem"])


FWSS = """f AS (SELECT user_id AS structure_id, count(*) AS freq FROM events WHERE value > 50 GROUP BY user_id),
m0 AS (SELECT user_id AS structure_id, round(avg(value), 6) AS a FROM events GROUP BY user_id HAVING avg(value) > 60), m AS (SELECT structure_id, row_number() OVER (ORDER BY a DESC, structure_id) - 1 AS pos FROM m0),
b AS (SELECT coalesce(m.structure_id, f.structure_id) AS structure_id, pos, freq, m.structure_id IS NOT NULL AS in_mean, f.structure_id IS NOT NULL AS in_cover FROM m FULL JOIN f ON m.structure_id = f.structure_id),
p AS (SELECT *, row_number() OVER (ORDER BY in_mean DESC, pos NULLS FIRST, freq DESC NULLS LAST, structure_id) - 1 AS place, count(*) OVER () AS len FROM b)"""
STRIDED = "CASE WHEN len <= 25 THEN place < 25 ELSE place < 5 OR (place - 5) % greatest(1, (len - 5) // 20) = 0 END"
TAIL = "CASE WHEN len * 0.2 < 25 THEN place >= floor(len * 0.8) ELSE place >= len - 25 END"


def _with_mean(spark: SparkSession, sf_dir: str, rate: float) -> DataFrame:
    e = event_values(spark, sf_dir)
    freq = e.where("value > 50").groupBy("structure_id").agg(F.count("*").alias("freq"))
    means = e.groupBy("structure_id").agg(r(F.avg("value")).alias("a"), F.avg("value").alias("m")).where("m > 60")
    at = means.withColumn("pos", F.row_number().over(Window.orderBy(F.col("a").desc(), "structure_id")) - 1)
    return select.fwss_with_mean(freq, at, 25, rate)


@query(f"WITH {FWSS} SELECT structure_id, place::INTEGER AS place, in_mean, in_cover FROM p WHERE {STRIDED}")
def fwss_with_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_mean(spark, sf_dir, 95.0).select("structure_id", F.col("place").cast("int").alias("place"), "in_mean", "in_cover")


@query(f"WITH {FWSS} SELECT structure_id, place::INTEGER AS place, in_mean, in_cover FROM p WHERE {TAIL}")
def fwss_with_mean_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_mean(spark, sf_dir, 80.0).select("structure_id", F.col("place").cast("int").alias("place"), "in_mean", "in_cover")


@query(f"WITH {FWSS} SELECT count(*) FILTER (WHERE in_mean) AS n_mean, count(*) FILTER (WHERE in_cover) AS n_cover, count(*) FILTER (WHERE in_mean AND in_cover) AS n_both FROM p WHERE {STRIDED}")
def selection_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.intersection_counts(_with_mean(spark, sf_dir, 95.0))


@query("""WITH h AS (SELECT event_type AS metric_key, (ts::DATE - DATE '2024-01-01')::INTEGER AS gen, count(*) AS metric FROM events GROUP BY ALL)
SELECT metric_key, gen, CASE WHEN gen % 7 = 0 THEN -metric ELSE metric END AS metric FROM h""")
def history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    gen = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    history = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric_key"), gen.alias("gen")).agg(F.count("*").alias("metric"))
    return select.upsert(history, history.where("gen % 7 = 0").withColumn("metric", -F.col("metric")))


# ---- structures and frames


@query(f"WITH {LI} SELECT min(id) AS id FROM li GROUP BY l_returnflag, l_linestatus, l_quantity, l_linenumber % 2")
def dedup_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal up to lattice translations: quantities are whole numbers, moved by whole cells of 64."""
    edge, zero = F.lit(64.0), F.lit(0.0)
    at = F.array(F.col("l_quantity") + 64 * F.col("l_linenumber"), (F.col("l_linenumber") % 2).cast("double"), zero)
    s = lines(spark, sf_dir).select("id", F.array("l_returnflag", "l_linestatus").alias("symbols"), F.array(at, F.array(zero, edge, -edge)).alias("positions"), F.array(edge, zero, zero, zero, edge, zero, zero, zero, edge).alias("cell"))
    return structures.dedup(s, "id").select("id")


@query(f"WITH {LI}, n AS (SELECT l_orderkey, count(*) AS nelm FROM lineitem GROUP BY l_orderkey) SELECT id FROM li JOIN n USING (l_orderkey) WHERE l_linenumber <> nelm")
def converged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = lines(spark, sf_dir)
    n = li.groupBy("l_orderkey").agg(F.count("*").alias("nelm"))
    return structures.converged_runs(li.join(n, "l_orderkey").withColumn("last_step", F.col("l_linenumber"))).select("id")


@query("""WITH s AS (SELECT l_orderkey AS f, count(*) AS n FROM lineitem GROUP BY f), o AS (SELECT min(f) AS start, arg_min(n, f) AS first FROM s), k AS (SELECT start, (SELECT count(*) FROM s WHERE n = first) AS k FROM o)
SELECT l_orderkey AS frame_idx, l_linenumber FROM lineitem, k WHERE l_orderkey < start + k""")
def complete_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("frame_idx"), "l_linenumber")
    return metrics.complete_prefix(frames)


@query("""WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) SELECT o_orderkey FROM o WHERE i NOT IN (0, 4, 99)""")
def skip_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lineage._placed(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").withColumn("frame_idx", F.col("_at"))
    return metrics.skip_frames(at, [1, 5, 100]).select("o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, (CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 END)::INTEGER AS elem FROM lineitem WHERE l_returnflag IN ('R', 'A')""")
def element_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("symbol"))
    return structures.in_elements(structures.element_index(li, ["R", "A"]), 2).drop("symbol")


@query("SELECT DISTINCT unnest([l_returnflag, l_linestatus]) AS symbol FROM lineitem")
def distinct_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structures.distinct_elements(table(spark, sf_dir, "lineitem").select(F.array("l_returnflag", "l_linestatus").alias("symbols")))


@query("""WITH v AS (SELECT l_quantity AS a, ln(l_discount) AS b FROM lineitem WHERE l_discount > 0)
SELECT round(min(a) - (max(a) - min(a)) * 0.05, 6) AS a_lo, round(max(a) + (max(a) - min(a)) * 0.05, 6) AS a_hi, round(min(b) - (max(b) - min(b)) * 0.05, 6) AS b_lo, round(max(b) + (max(b) - min(b)) * 0.05, 6) AS b_hi FROM v""")
def axis_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounts of 0 have an infinite logarithm, and their rows do not count."""
    v = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("a"), F.when(F.col("l_discount") > 0, F.ln("l_discount")).otherwise(F.lit(float("-inf"))).alias("b"))
    out = structures.axis_limits(v, ["a", "b"])
    return out.select(*[r(c).alias(c) for c in out.columns])


@query("""WITH p AS (SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part)
SELECT p_partkey, CASE WHEN idx = 3 THEN 0 WHEN regexp_matches(p_brand, '^Brand#[1-3]') THEN 1 WHEN idx = 0 THEN 2 END::INTEGER AS selector_pos FROM p WHERE idx IN (0, 3) OR regexp_matches(p_brand, '^Brand#[1-3]')""")
def structure_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = lineage._placed(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey").withColumn("idx", F.col("_at"))
    return structures.select_structures(p, "index:3, Brand#[123]*, FIRST", name="p_brand").select("p_partkey", "selector_pos")


@query("""SELECT l_orderkey, count(*) AS n, round(sum(l_quantity * s + a), 4) AS total FROM lineitem, (SELECT unnest([0.97, 1.0, 1.03])::DOUBLE AS s), (SELECT unnest([0.0, 2.5])::DOUBLE AS a) GROUP BY l_orderkey""")
def parameter_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = structures.parameter_grid(table(spark, sf_dir, "lineitem"), s=[0.97, 1.0, 1.03], a=[0.0, 2.5])
    return every.groupBy("l_orderkey").agg(F.count("*").alias("n"), r(F.sum(F.col("l_quantity") * F.col("s") + F.col("a")), 4).alias("total"))


@query("""WITH i AS (SELECT p_partkey, p_size AS x, p_retailprice AS y, unnest(range(2)) AS a FROM part), j AS (SELECT *, unnest(range(3)) AS b FROM i)
SELECT p_partkey, count(*) AS n_atoms, round(sum(x + a * 60), 4)::DOUBLE AS sum_x, round(sum(y + b * 9), 4)::DOUBLE AS sum_y FROM j GROUP BY p_partkey""")
def supercell(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0.0)
    at = F.array(F.col("p_size").cast("double"), F.col("p_retailprice"), zero)
    s = table(spark, sf_dir, "part").select("p_partkey", F.array("p_brand").alias("symbols"), F.array(at).alias("positions"), F.array(F.lit(60.0), zero, zero, zero, F.lit(9.0), zero, zero, zero, F.lit(5.0)).alias("cell"), F.lit(1).alias("n_atoms"))
    out = structures.supercell(s, (2, 3, 1))
    total = lambda k: F.aggregate("positions", F.lit(0.0), lambda acc, p: acc + F.get(p, F.lit(k)))
    return out.select("p_partkey", F.size("symbols").cast("long").alias("n_atoms"), r(total(0), 4).alias("sum_x"), r(total(1), 4).alias("sum_y"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber % 3 = 0")
def step_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third step of a run: the operator's feature, as a run's steps are its lines."""
    return structures.step_snapshots(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), 3, "l_linenumber")


# ---- tensors


@query("""WITH v AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 1.0 / 160.21766208 WHEN 1 THEN 0.0006241509073 ELSE 1.0 END::DOUBLE AS f, l_quantity AS a, l_discount AS b, l_tax AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, round(f * (a + 2 * b + 3 * c + 4 * 2 * 1 + 5 * 2 * 2 + 6 * 2 * 3), 8) AS weighted FROM v""")
def stress_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """6-vectors in three spellings of units to 9 numbers in eV/A^3, summed with a weight for each place."""
    n = F.col("l_linenumber")
    unit = F.when(n % 3 == 0, F.lit("GPa")).when(n % 3 == 1, F.lit(" kBar ")).otherwise(F.lit("eV/Angstrom^3"))
    six = F.array("l_quantity", "l_discount", "l_tax", F.lit(1.0), F.lit(2.0), F.lit(3.0))
    nine = tensors.scaled(tensors.to_nine(six), tensors.unit_factor(unit))
    weights = F.array(*[F.lit(float(w)) for w in (1, 6, 5, 6, 2, 4, 5, 4, 3)])
    total = F.aggregate(F.zip_with(nine, weights, lambda x, w: x * w), F.lit(0.0), lambda s, x: s + x)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r(total, 8).alias("weighted"))


@query("""WITH v AS (SELECT l_orderkey, l_linenumber, abs((l_quantity + 1) * 8) AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, round(CASE l_linenumber % 4 WHEN 0 THEN 7 WHEN 1 THEN 2 * 160.21766208 WHEN 2 THEN 3 * 160.21766208 ELSE -5 * 160.21766208 / v END::DOUBLE, 6) AS xx FROM v""")
def stress_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stress in GPa from whichever of four sources a frame has."""
    n, zero = F.col("l_linenumber") % 4, F.lit(0.0)
    flat = lambda x: F.array(*[F.lit(float(x))] * 6)
    cell = F.array(F.col("l_quantity") + 1, zero, zero, zero, F.lit(2.0), zero, zero, zero, F.lit(4.0))
    found = tensors.stress_gpa(F.when(n == 0, flat(7)), F.when(n <= 1, flat(2)), F.when(n <= 2, flat(3)), flat(5), cell)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r(F.get(found, F.lit(0))).alias("xx"))


@query("""SELECT l_orderkey, l_linenumber, round((l_quantity / 8.0) - floor(l_quantity / 8.0), 8) AS fx, round(l_quantity, 6) AS back FROM lineitem""")
def fractional_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0.0)
    cell, at = F.array(F.lit(8.0), zero, zero, zero, F.lit(4.0), zero, zero, zero, F.lit(2.0)), F.array(F.col("l_quantity"), F.lit(1.0), zero)
    back = tensors.cartesian(tensors.fractional(at, cell, wrap=False), cell)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r(F.get(tensors.fractional(at, cell), F.lit(0)), 8).alias("fx"), r(F.get(back, F.lit(0))).alias("back"))


# ---- text rules


@query("SELECT event_id, round((event_id % 4) * 86400 + (event_id % 24) * 3600 + (event_id % 60) * 60 + (event_id % 50) + 0.25, 4)::DOUBLE AS seconds FROM events")
def wall_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, part = F.col("event_id"), lambda n: (F.col("event_id") % n).cast("int")
    days = F.when(e % 4 > 0, F.concat(part(4).cast("string"), F.lit("-"))).otherwise(F.lit(""))
    log = F.concat(F.lit("Loop done\nTotal wall time: "), days, F.format_string("%d:%02d:%02d.25", part(24), part(60), part(50)))
    return table(spark, sf_dir, "events").select("event_id", r(F.get(text.wall_times(log), F.lit(0)), 4).alias("seconds"))


@query("SELECT round(avg(CASE WHEN user_id % 3 > 0 THEN (event_id % 100) / 8.0 END)::DOUBLE, 6) AS energy, round(avg((event_id % 7) * 1.5)::DOUBLE, 6) AS force, round(avg(CASE WHEN user_id % 2 = 0 THEN 0.125 END)::DOUBLE, 6) AS stress FROM events")
def training_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of each error over the logs that tell it; other lines with the same words do not count."""
    e, u = F.col("event_id"), F.col("user_id")
    log = F.concat(
        F.lit("Energy MAE without a unit: 9\n"), F.when(u % 3 > 0, F.format_string("Energy MAE (meV/atom): %.3f\n", (e % 100) / 8.0)).otherwise(F.lit("")),
        F.format_string("Force MAE  (meV/A) : %.1f\n", (e % 7) * 1.5), F.when(u % 2 == 0, F.lit("Stress MAE (eV): 1.25e-1")).otherwise(F.lit("stress MAE: 3")),
    )
    rows = table(spark, sf_dir, "events").select(text.training_errors(log).alias("x")).select("x.*")
    out = metrics.mean_metrics(rows, ["energy", "force", "stress"])
    return out.select(*[r(c).alias(c) for c in out.columns])


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'ERROR: Lost atoms: original ' || user_id WHEN 2 THEN 'ERROR on proc ' || user_id ELSE NULL END AS error FROM events""")
def last_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, user = F.col("event_id") % 4, F.col("user_id").cast("string")
    proc = F.concat(F.lit("ERROR on proc "), user)
    lost = F.concat(F.lit("ERROR: Lost atoms: original "), user)
    log = F.when(e == 0, F.lit("fine")).when(e == 1, F.concat_ws("\n", F.lit("x"), lost, proc)).when(e == 2, F.concat_ws("\n", F.lit("ERROR early"), proc, F.lit("end"))).otherwise(F.concat(proc, F.repeat(F.lit("\nstep"), 50)))
    return table(spark, sf_dir, "events").select("event_id", text.last_error(log).alias("error"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'dataset' WHEN 1 THEN '_a_b_' || user_id ELSE event_type || '-1.x' END AS name FROM events")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 3
    label = F.when(e == 0, F.lit("  ")).when(e == 1, F.concat(F.lit(" /a $%b "), F.col("user_id").cast("string"), F.lit(" "))).otherwise(F.concat("event_type", F.lit("-1.x")))
    return table(spark, sf_dir, "events").select("event_id", text.safe_name(label).alias("name"))


@query(f"WITH {EV} SELECT elem, count(value) AS n, round(avg(value), 6) AS mean FROM e GROUP BY elem")
def mean_by_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_values(spark, sf_dir)
    out = stats.mean_descriptor(e.select("elem", F.array("value").alias("features")), ["elem"])
    return out.join(e.groupBy(*ED[:1]).agg(F.count("value").alias("n")), "elem").select("elem", "n", r(F.get("features", F.lit(0))).alias("mean"))


# ---- logs of simulation programs


@query("""SELECT event_id, round(-(event_id % 97) * 0.5 * 27.211386245988, 6)::DOUBLE AS energy, 2::BIGINT AS n_forces, round((user_id % 13) * 0.25 * 51.422067476326, 6)::DOUBLE AS fz, round((event_id % 7) * 3 * 0.006241509073, 9)::DOUBLE AS szz FROM events""")
def single_point_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later energy and a later stress do not count, nor do lines of the force table without a number."""
    e, u = F.col("event_id"), F.col("user_id")
    log = F.concat(
        F.lit(" ENERGY| Total FORCE_EVAL ( QS ) energy [a.u.]:   "), F.format_string("%.4f\n", -(e % 97) * 0.5), F.lit(" ENERGY| Total FORCE_EVAL ( QS ) energy [a.u.]: 1.0\n ATOMIC FORCES in [a.u.]\n\n # Atom Kind Element X Y Z\n 1 1 Si 0.1 0.2 "),
        F.format_string("%.4f\n", (u % 13) * 0.25), F.lit(" 2 1 Si 0.0 0.0 0.5\n\n SUM OF ATOMIC FORCES 0 0 0\n STRESS| Analytical stress tensor [GPa]\n STRESS| x y z\n STRESS| x 1 0 0\n STRESS| y 0 2 0\n STRESS| z 0 0 "),
        F.format_string("%d\n STRESS| Analytical stress tensor [GPa]\n\n a b 9 9 9\n", (e % 7) * 3),
    )
    x = F.col("x")
    at = table(spark, sf_dir, "events").select("event_id", logs.quickstep(log).alias("x"))
    return at.select("event_id", r(x["energy"]).alias("energy"), F.size(x["forces"]).cast("long").alias("n_forces"), r(F.get(F.get(x["forces"], F.lit(0)), F.lit(2))).alias("fz"), r(F.get(x["stress"], F.lit(8)), 9).alias("szz"))


@query("""WITH f AS (SELECT *, unnest(range(1 + event_id % 2)) AS frame FROM events)
SELECT event_id, frame::INTEGER AS frame, event_id % 3 = 0 AS converged, round(-100.5 - (event_id % 89) - frame, 6)::DOUBLE AS energy, round(0.5 * (4 + user_id % 5), 6)::DOUBLE AS x, round(0.125 * (event_id % 11) + frame, 6)::DOUBLE AS fy,
  round((1 + frame) * (4 + user_id % 5) * 20 * 0.0006241509073, 9)::DOUBLE AS vxx, 'SiO' AS symbols FROM f""")
def relaxation_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One or two frames a log: direct coordinates in an orthogonal cell, a force table, stress and energy."""
    e, edge = F.col("event_id"), (4 + F.col("user_id") % 5).cast("string")

    def frame(k: int):
        return F.concat(
            F.lit(" Lattice vectors: (Cartesian coordinate: in unit of a_0)\n +"), edge, F.lit(" 0 0\n 0 5 0\n 0 0 4\nDIRECT COORDINATES\n atom x y z\n tau_1 0.5 0.25 0.5 1 0\n tau_2 0 0 0 1 0\n"),
            F.lit(" TOTAL-FORCE (eV/Angstrom)\n ----\n Si1 0 "), F.format_string("%.3f", 0.125 * (e % 11) + k), F.lit(f" 0\n O12 0 0 1\n TOTAL-STRESS (KBAR)\n ----\n {k + 1} 0 0\n 0 1 0\n 0 0 1\n !FINAL x\n final etot is "), F.format_string("%.2f eV\n", -100.5 - e % 89 - k),
        )

    log = F.concat(F.lit(" TOTAL ATOM NUMBER = 2\n"), frame(0), F.when(e % 2 == 1, frame(1)).otherwise(F.lit("")), F.when(e % 3 == 0, F.lit(" Relaxation is converged!\n")).otherwise(F.lit("")))
    x, f = F.col("x"), F.col("f")
    every = table(spark, sf_dir, "events").select("event_id", logs.relaxation(log).alias("x")).select("event_id", x["converged"].alias("converged"), F.posexplode(x["frames"]).alias("frame", "f"))
    number = lambda c, *at: r(F.get(F.get(c, F.lit(at[0])), F.lit(at[1])))
    return every.select("event_id", "frame", "converged", r(f["energy"]).alias("energy"), number(f["positions"], 0, 0).alias("x"), number(f["forces"], 0, 1).alias("fy"), r(F.get(f["virial"], F.lit(0)), 9).alias("vxx"), F.array_join(f["symbols"], "").alias("symbols"))


LOOPS = "l AS (SELECT DISTINCT year(o_orderdate)::INTEGER - 1993 AS main FROM orders), g AS (SELECT main, row_number() OVER (ORDER BY main) - 1 AS p, count(*) OVER () AS n FROM l WHERE main >= 0)"


def _loops(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    labels = lineage.discover_labels(table(spark, sf_dir, "orders").select((F.year("o_orderdate") - 1993).alias("main")))
    wanted = lineage.select_loops([x.main for x in labels.select("main").collect()], how)  # one row a version
    return labels.where(F.col("main").isin(wanted)).select(F.col("main").cast("int").alias("main"))


@query(f"WITH {LOOPS}, k AS (SELECT ceil(max(n) / 2.0) AS keep FROM g) SELECT main FROM l WHERE main = -1 UNION SELECT main FROM g, k, range(100) t(i) WHERE n <= 3 OR p = n - 1 OR (i < keep AND p = round_even(i * (n - 1) / greatest(1, keep - 1)::DOUBLE, 0))")
def loop_select_uniform_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loops(spark, sf_dir, "uniform-half")


@query(f"WITH {LOOPS} SELECT main FROM l")
def loop_select_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loops(spark, sf_dir, "all")


@query(f"WITH {LOOPS} SELECT main FROM l WHERE main IN (4, 6, 8)")
def loop_select_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loops(spark, sf_dir, "[4, loop-7, 8]")
