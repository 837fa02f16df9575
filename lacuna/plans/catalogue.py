"""All registered queries of the curation engine and the SQL that each must equal.

Queries run over whole tables through the operators; the SQL is written from the semantics, not from the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lacuna.functions import numeric, tensors, text
from lacuna.operators import cover, coverage, histogram, intervals, lineage, metrics, pca, select, stats, structures
from lacuna.operators.stats import stored
from lacuna.plans import adapters, reduce, report, sampling
from lacuna.plans.adapters import embedding_rows, embedding_values, event_values, line_forces, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
ED = ["elem", "dim"]


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def r(c, digits: int = 6):
    return F.round(c, digits)


# ---- common pieces of SQL

EV = "e AS (SELECT event_type AS elem, user_id AS structure_id, event_id AS atom_idx, value, ts, ts < TIMESTAMP '2024-01-16' AS is_ref FROM events)"


def stats_sql(source: str, keys: str = "elem", width: str = "CASE WHEN q75 - q25 > 0 THEN 2.0::DOUBLE * (q75 - q25) / pow(n, 1.0::DOUBLE / 3) ELSE 3.5::DOUBLE * sigma / pow(n, 1.0::DOUBLE / 3) END", name: str = "s") -> str:
    return f"""{name}0 AS (SELECT {keys}, count(*) AS n, min(value) AS vmin, max(value) AS vmax, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75, stddev_pop(value) AS sigma FROM {source} GROUP BY {keys}),
{name}1 AS (SELECT *, {width} AS w FROM {name}0),
{name} AS (SELECT *, CASE WHEN n <= 1 OR NOT w > 0 OR NOT vmax > vmin THEN 1 ELSE greatest(1, ceil((vmax - vmin) / w)) END::BIGINT AS nbins FROM {name}1)"""


def hist_sql(source: str, keys: tuple[str, ...] = ("elem",), name: str = "h", s: str = "s") -> str:
    on = " AND ".join(f"v.{k} = s.{k}" for k in keys)
    again = " AND ".join(f"a.{k} = c.{k}" for k in keys)
    k_v, k_a = ", ".join(f"v.{k}" for k in keys), ", ".join(f"a.{k}" for k in keys)
    bare = ", ".join(keys)
    return f"""{name}g AS (SELECT {k_v}, s.vmin, s.vmax, s.nbins, v.value, (s.vmax - s.vmin) / s.nbins AS st, least(floor((v.value - s.vmin) * (s.nbins / nullif(s.vmax - s.vmin, 0))), s.nbins - 1) AS g FROM {source} v JOIN {s} s ON {on}),
{name}b AS (SELECT {bare}, CASE WHEN NOT vmax > vmin THEN 0 WHEN value < vmin + g * st THEN g - 1 WHEN value >= vmin + (g + 1) * st AND g < nbins - 1 THEN g + 1 ELSE g END::BIGINT AS bin FROM {name}g),
{name}c AS (SELECT {bare}, bin, count(*) AS freq FROM {name}b GROUP BY {bare}, bin),
{name}a AS (SELECT {bare}, vmin, vmax, nbins, unnest(range(nbins))::BIGINT AS bin FROM {s}),
{name} AS (SELECT {k_a}, a.bin, CASE WHEN a.vmax > a.vmin THEN a.vmin + a.bin * ((a.vmax - a.vmin) / a.nbins) ELSE a.vmin - 0.5 END AS lo,
  CASE WHEN NOT a.vmax > a.vmin THEN a.vmax + 0.5 WHEN a.bin + 1 >= a.nbins THEN a.vmax ELSE a.vmin + (a.bin + 1) * ((a.vmax - a.vmin) / a.nbins) END AS hi, coalesce(c.freq, 0)::BIGINT AS freq
  FROM {name}a a LEFT JOIN {name}c c ON {again} AND a.bin = c.bin)"""


def covered_sql(cand: str, keys: tuple[str, ...], h: str = "h", s: str = "s", population: int = 0, name: str = "l") -> str:
    on = " AND ".join(f"v.{k} = s.{k}" for k in keys)
    inner = " AND ".join(f"z.{k} = v.{k}" for k in keys)
    return f"""{name}z AS (SELECT *, bin = max(bin) OVER (PARTITION BY {", ".join(keys)}) AS is_last FROM {h} WHERE freq <= {population}),
{name}i AS (SELECT v.*, s.vmin, s.vmax, EXISTS (SELECT 1 FROM {name}z z WHERE {inner} AND z.lo <= v.value AND (v.value < z.hi OR (z.is_last AND v.value = z.hi))) AS in_zero FROM {cand} v JOIN {s} s ON {on}),
{name} AS (SELECT *, CASE WHEN value = vmin OR value = vmax THEN TRUE ELSE NOT (value < vmin OR value >= vmax OR in_zero) END AS covered FROM {name}i)"""


BASE = f"WITH {EV}, ref AS (SELECT * FROM e WHERE is_ref), cand AS (SELECT * FROM e WHERE NOT is_ref), {stats_sql('ref')}, {hist_sql('ref')}"


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("is_ref"), df.where("not is_ref")


def binned(ref: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stats of the reference, a row a key, and its histogram, a row a bin, each made once."""
    of = stored(stats.dim_stats(ref, ED))
    return of, stored(histogram.counts(ref, of, ED))


# ---- histograms and coverage of events


@query(f"""{BASE}, {covered_sql('cand', ('elem',))}
SELECT s.elem AS event_type, s.n AS n_ref, c.n_query, s.nbins, z.n_zero_bins, c.n_uncovered, round(c.coverage, 6) AS coverage FROM s
JOIN (SELECT elem, count(*) FILTER (WHERE freq <= 0) AS n_zero_bins FROM h GROUP BY elem) z USING (elem)
JOIN (SELECT elem, count(*) AS n_query, count(*) FILTER (WHERE NOT covered) AS n_uncovered, 100.0::DOUBLE * avg(covered::INT::DOUBLE) AS coverage FROM l GROUP BY elem) c USING (elem)""")
def event_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(event_values(spark, sf_dir))
    of, bins = binned(ref)
    labelled = intervals.label_covered(cand, of, histogram.low_intervals(bins), ED)
    n_zero = bins.groupBy("elem").agg(F.count_if(F.col("freq") <= 0).alias("n_zero_bins"))
    by = labelled.groupBy("elem").agg(F.count("*").alias("n_query"), F.count_if(~F.col("covered")).alias("n_uncovered"))
    rate = coverage.coverage_rate(labelled, ["elem"])
    out = of.join(n_zero, "elem").join(by, "elem").join(rate, "elem")
    return out.select(F.col("elem").alias("event_type"), F.col("n").alias("n_ref"), "n_query", "nbins", "n_zero_bins", "n_uncovered", r("coverage").alias("coverage"))


def _dim_stats(method: str, width_sql: str, **options):
    sql = f"WITH {EV}, {stats_sql('e', width=width_sql)} SELECT elem, n, round(vmin, 6) AS vmin, round(vmax, 6) AS vmax, round(q25, 6) AS q25, round(q75, 6) AS q75, round(sigma, 6) AS sigma, nbins FROM s"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = stats.dim_stats(event_values(spark, sf_dir), ED, method=method, **options)
        return out.select("elem", "n", *[r(c).alias(c) for c in ("vmin", "vmax", "q25", "q75", "sigma")], "nbins")

    run.__name__ = f"dim_stats_{method}"
    query(sql)(run)


_dim_stats("fd", "CASE WHEN q75 - q25 > 0 THEN 2.0::DOUBLE * (q75 - q25) / pow(n, 1.0::DOUBLE / 3) ELSE 3.5::DOUBLE * sigma / pow(n, 1.0::DOUBLE / 3) END")
_dim_stats("scott", "3.5::DOUBLE * sigma / pow(n, 1.0::DOUBLE / 3)")
_dim_stats("std", "sigma / 10.0::DOUBLE")
_dim_stats("self_input", "7.5::DOUBLE", width=7.5)


def _hist(name: str, where: str, keep):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ref, _ = split(event_values(spark, sf_dir))
        out = keep(binned(ref)[1])
        return out.select("elem", "bin", r("lo").alias("lo"), r("hi").alias("hi"), "freq")

    run.__name__ = name
    query(f"{BASE} SELECT elem, bin, round(lo, 6) AS lo, round(hi, 6) AS hi, freq FROM h WHERE {where}")(run)


_hist("histogram_counts", "TRUE", lambda h: h)
_hist("zero_intervals", "freq <= 0", histogram.low_intervals)
_hist("low_intervals", "freq <= 2", lambda h: histogram.low_intervals(h, 2))
_hist("occupied_intervals", "freq > 0", histogram.occupied_intervals)


@query(f"""WITH {EV}, ref AS (SELECT * FROM e WHERE is_ref), cand AS (SELECT * FROM e WHERE NOT is_ref), {stats_sql('ref', name='f')},
w AS (SELECT elem, CASE WHEN vmax > vmin THEN (vmax - vmin) / nbins ELSE 0 END AS w FROM f),
s AS (SELECT elem, count(value) AS n, min(value) AS vmin, max(value) AS vmax, CASE WHEN max(w) > 0 AND max(value) > min(value) THEN greatest(1, ceil((max(value) - min(value)) / max(w))) ELSE 1 END::BIGINT AS nbins FROM cand JOIN w USING (elem) GROUP BY elem),
{hist_sql('cand')} SELECT elem, bin, round(lo, 6) AS lo, round(hi, 6) AS hi, freq FROM h""")
def fixed_width_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(event_values(spark, sf_dir))
    of = stats.fixed_width_stats(cand, stats.widths(stats.dim_stats(ref, ED), ED), ED)
    return histogram.counts(cand, of, ED).select("elem", "bin", r("lo").alias("lo"), r("hi").alias("hi"), "freq")


@query(f"""{BASE}, {covered_sql('cand', ('elem',))}, {covered_sql('cand', ('elem',), population=2, name='m')}
SELECT elem, a.rate AS coverage_0, b.rate AS coverage_2 FROM (SELECT elem, round(100.0::DOUBLE * avg(covered::INT::DOUBLE), 6) AS rate FROM l GROUP BY elem) a
JOIN (SELECT elem, round(100.0::DOUBLE * avg(covered::INT::DOUBLE), 6) AS rate FROM m GROUP BY elem) b USING (elem)""")
def state_population_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(event_values(spark, sf_dir))
    of, bins = binned(ref)
    rates = [coverage.coverage_rate(intervals.label_covered(cand, of, histogram.low_intervals(bins, p), ED), ["elem"]).select("elem", r("coverage").alias(f"coverage_{p}")) for p in (0, 2)]
    return rates[0].join(rates[1], "elem")


NOVEL = f"""{BASE},
c0 AS (SELECT c.elem, min(c.value) AS cmin, max(c.value) AS cmax, any_value(s.vmin) AS rmin, any_value(s.vmax) AS rmax, any_value(s.nbins) AS rb FROM cand c JOIN s USING (elem) WHERE s.vmax > s.vmin GROUP BY c.elem),
c1 AS (SELECT *, CASE WHEN cmax > cmin THEN greatest(1, ceil((cmax - cmin) / ((rmax - rmin) / rb))) ELSE 1 END::BIGINT AS nb FROM c0),
c2 AS (SELECT *, unnest(range(nb))::BIGINT AS k FROM c1),
c3 AS (SELECT elem, rmin, rmax, cmin + k * ((cmax - cmin) / nb) AS lo, CASE WHEN k = nb - 1 THEN least(cmin + (k + 1) * ((cmax - cmin) / nb), cmax) ELSE cmin + (k + 1) * ((cmax - cmin) / nb) END AS hi FROM c2),
c4 AS (SELECT elem, CASE WHEN lo >= rmax OR hi <= rmin THEN lo WHEN hi > rmax AND lo BETWEEN rmin AND rmax THEN rmax ELSE lo END AS lo,
  CASE WHEN lo >= rmax OR hi <= rmin THEN hi WHEN lo < rmin AND hi BETWEEN rmin AND rmax THEN rmin ELSE hi END AS hi FROM c3
  WHERE lo >= rmax OR hi <= rmin OR (lo < rmin AND hi BETWEEN rmin AND rmax) OR (hi > rmax AND lo BETWEEN rmin AND rmax)),
iv AS (SELECT elem, lo, hi FROM h WHERE freq <= 0 UNION ALL SELECT elem, lo, hi FROM c4),
ivn AS (SELECT *, row_number() OVER (PARTITION BY elem ORDER BY lo, hi) - 1 AS interval_id, count(*) OVER (PARTITION BY elem) AS ni FROM iv),
mem AS (SELECT i.elem, i.interval_id, c.structure_id, c.atom_idx FROM cand c JOIN ivn i ON c.elem = i.elem AND i.lo <= c.value AND (c.value < i.hi OR (i.interval_id = i.ni - 1 AND c.value = i.hi)))"""


def _novel(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(event_values(spark, sf_dir))
    of, bins = binned(ref)
    zero = histogram.low_intervals(bins).select(*ED, "lo", "hi")
    ends = cand.groupBy(*ED).agg(F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    return intervals.classes(cand, intervals.novelty_intervals(of, ends, zero, ED), ED)


@query(f"{NOVEL} SELECT elem, interval_id::INTEGER AS interval_id, structure_id, atom_idx FROM mem")
def novelty_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _novel(spark, sf_dir).select("elem", "interval_id", "structure_id", "atom_idx")


@query(f"{NOVEL} SELECT structure_id, count(*) AS freq FROM mem GROUP BY structure_id")
def class_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover.frequencies(_novel(spark, sf_dir))


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.with_class_id(_novel(spark, sf_dir), [*ED, "interval_id"]).select(F.col("class_id").alias("class_seq"), "structure_id", "atom_idx")


@query(f"""{NOVEL}, num AS (SELECT dense_rank() OVER (ORDER BY elem, interval_id) - 1 AS class_seq, structure_id, atom_idx FROM mem),
f AS (SELECT structure_id, count(*) AS freq, min(struct_pack(c := class_seq, a := atom_idx)) AS seen FROM num GROUP BY structure_id)
SELECT structure_id, freq, (row_number() OVER (ORDER BY freq DESC, seen, structure_id) - 1)::INTEGER AS rank FROM f""")
def cover_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover.cover_rank(_numbered(spark, sf_dir)).select("structure_id", "freq", "rank")


@query(f"""{NOVEL} SELECT count(DISTINCT (elem, interval_id)) AS n_classes, count(DISTINCT structure_id) AS n_structures, count(*) AS n_memberships FROM mem""")
def class_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover.summary(_numbered(spark, sf_dir))


def greedy_sql(members: str) -> str:
    """CTEs after `members`(class_seq, structure_id, atom_idx): rk (structure_id, freq, rank) and g, one row a greedy pick. Each
    step counts a structure's classes that no earlier pick has closed."""
    return f"""fr AS (SELECT structure_id, count(*) AS freq, min(struct_pack(c := class_seq, a := atom_idx)) AS seen FROM {members} GROUP BY structure_id),
rk AS MATERIALIZED (SELECT structure_id, freq, (row_number() OVER (ORDER BY freq DESC, seen, structure_id) - 1)::INTEGER AS rank FROM fr),
pr AS MATERIALIZED (SELECT DISTINCT class_seq, rank FROM {members} JOIN rk USING (structure_id)),
g(rank, closed) AS (SELECT -1, []::BIGINT[] UNION ALL
  SELECT b.rank, list_concat(closed, (SELECT list(class_seq) FROM pr WHERE pr.rank = b.rank)) FROM
  (SELECT g.closed, (SELECT arg_min(rank, (-n, rank)) FROM (SELECT p.rank, count(*) AS n FROM pr p WHERE NOT list_contains(g.closed, p.class_seq) GROUP BY p.rank)) AS rank FROM g) b WHERE b.rank IS NOT NULL)"""


RECURSIVE = NOVEL.replace("WITH", "WITH RECURSIVE", 1)
NUMBERED = "num AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY elem, interval_id) - 1 AS class_seq, structure_id, atom_idx FROM mem)"


@query(f"{RECURSIVE}, {NUMBERED}, {greedy_sql('num')} SELECT structure_id, freq, rank FROM g JOIN rk USING (rank)")
def greedy_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover.min_cover(_numbered(spark, sf_dir))


@query(f"{RECURSIVE}, {NUMBERED}, {greedy_sql('num')} SELECT structure_id, freq, rank FROM g JOIN rk USING (rank)")
def greedy_cover_in_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way of very large tables, here for all sizes."""
    return cover.min_cover(_numbered(spark, sf_dir), local_pairs=0)


@query("SELECT 0::BIGINT AS uncovered_classes")
def greedy_cover_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = _numbered(spark, sf_dir)
    return cover.uncovered_classes(members, cover.min_cover(members)).agg(F.count("*").alias("uncovered_classes"))


@query(f"""{NOVEL}, f AS (SELECT structure_id, count(*) AS freq FROM mem GROUP BY structure_id),
p AS (SELECT *, row_number() OVER (ORDER BY freq DESC, structure_id) - 1 AS place, count(*) OVER () AS len FROM f)
SELECT structure_id, freq, place::INTEGER AS place FROM p WHERE CASE WHEN len <= 10 THEN place < 10 ELSE place < 2 OR (place >= 2 AND (place - 2) % greatest(1, (len - 2) // 8) = 0) END""")
def fwss_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.fwss(cover.frequencies(_novel(spark, sf_dir)), 10).select("structure_id", "freq", F.col("place").cast("int").alias("place"))


def _event_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_values(spark, sf_dir).select("structure_id", "atom_idx", "elem", F.array("value").alias("features"), "is_ref", "ts")


@query(f"""WITH RECURSIVE {EV}, {stats_sql('e')}, {hist_sql('e')}, o AS (SELECT *, row_number() OVER (PARTITION BY elem ORDER BY lo, hi) - 1 AS i, count(*) OVER (PARTITION BY elem) AS ni FROM h WHERE freq > 0),
mem AS (SELECT e.elem, o.i AS interval_id, structure_id, atom_idx FROM e JOIN o ON e.elem = o.elem AND o.lo <= value AND (value < o.hi OR (o.i = o.ni - 1 AND value = o.hi))), {NUMBERED}, {greedy_sql('num')}
SELECT DISTINCT e.structure_id, e.structure_id IN (SELECT structure_id FROM g JOIN rk USING (rank)) AS selected FROM e""")
def reduce_candidate_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce.candidate_only(_event_descriptors(spark, sf_dir))


@query()
def reduce_reference_guided(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(_event_descriptors(spark, sf_dir))
    n = cand.select("structure_id").distinct().count()
    return reduce.reference_guided(cand, max(1, n // 2), current=ref)


@query()
def generation_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(_event_descriptors(spark, sf_dir))
    return sampling.sample(ref, cand, [90.0, 99.0, 100.0], [40, 20, 10])[0].select("structure_id", "freq", F.col("place").cast("int").alias("place"))


@query()
def mean_descriptor_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(embedding_rows(spark, sf_dir))
    return sampling.mean_sample(ref, cand, [90.0, 100.0], [20, 10])[0].select("structure_id", "freq", F.col("place").cast("int").alias("place"))


@query(f"""{BASE}, {covered_sql('cand', ('elem',))}, c AS (SELECT elem, structure_id % 4 AS config, 100.0::DOUBLE * avg(covered::INT::DOUBLE) AS rate FROM l GROUP BY elem, config)
SELECT elem, round(least(100.0::DOUBLE, min(rate)), 6) AS coverage FROM c GROUP BY elem""")
def per_configuration_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(event_values(spark, sf_dir))
    of, bins = binned(ref)
    labelled = intervals.label_covered(cand.withColumn("config", F.col("structure_id") % 4), of, histogram.low_intervals(bins), ED)
    rates = coverage.coverage_rate(labelled, ["config", "elem"])
    return coverage.across_batches(rates, ["elem"]).select("elem", r("coverage").alias("coverage"))


@query(f"""{BASE}, {covered_sql('cand', ('elem',))}, c AS (SELECT elem, 100.0::DOUBLE * avg(covered::INT::DOUBLE) AS rate FROM l GROUP BY elem),
g AS (SELECT * FROM (VALUES (0, 90.0::DOUBLE, 40), (1, 99.9::DOUBLE, 20), (2, 100.0::DOUBLE, 10)) t(stage, threshold, budget)), x AS (SELECT * FROM g, c)
SELECT coalesce((SELECT budget FROM x WHERE rate < threshold ORDER BY threshold, stage LIMIT 1), 0)::INTEGER AS budget, (SELECT bool_and(rate > 100.0) FROM c) AS converged""")
def budget_by_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(event_values(spark, sf_dir))
    of, bins = binned(ref)
    rates = coverage.coverage_rate(intervals.label_covered(cand, of, histogram.low_intervals(bins), ED), ["elem"])
    stages = rates.select("elem").crossJoin(spark.createDataFrame([(0, 90.0, 40), (1, 99.9, 20), (2, 100.0, 10)], "stage int, threshold double, budget int"))
    return select.budget(rates, stages)


@query("""WITH d AS (SELECT event_type AS metric_key, (ts::DATE - DATE '2024-01-01')::INTEGER AS gen, round(avg(value), 6) AS metric FROM events GROUP BY ALL),
x AS (SELECT *, metric - lag(metric) OVER w AS delta FROM d WINDOW w AS (PARTITION BY metric_key ORDER BY gen)),
y AS (SELECT *, count(delta) OVER w = 2 AND max(delta) OVER w < 1.5 AS plateau FROM x WINDOW w AS (PARTITION BY metric_key ORDER BY gen ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))
SELECT metric_key, gen, metric, round(delta, 6) AS delta, plateau, metric >= 60 OR plateau AS converged FROM y""")
def convergence_plateau(spark: SparkSession, sf_dir: str) -> DataFrame:
    gen = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    daily = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric_key"), gen.alias("gen")).agg(r(F.avg("value")).alias("metric"))
    return select.convergence(daily, 60.0, 3, 1.5).withColumn("delta", r("delta"))


# ---- embeddings

EMB = "e AS (SELECT vec_id AS structure_id, label AS elem, vec_id % 2 = 0 AS is_ref, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1)::INTEGER - 1 AS dim FROM embeddings)"
EMB_BASE = f"WITH {EMB}, ref AS (SELECT * FROM e WHERE is_ref), cand AS (SELECT * FROM e WHERE NOT is_ref), {stats_sql('ref', keys='elem, dim')}, {hist_sql('ref', ('elem', 'dim'))}, {covered_sql('cand', ('elem', 'dim'))}"


def _embedding_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(embedding_values(spark, sf_dir))
    of, bins = binned(ref)
    return intervals.label_covered(cand, of, histogram.low_intervals(bins), ED)


def _embedding_coverage(how: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return coverage.coverage_rate(_embedding_labels(spark, sf_dir), ["elem"], how=how).select("elem", r("coverage").alias("coverage"))

    run.__name__ = f"embedding_coverage_{how}"
    agg = "avg" if how == "mean" else "min"
    query(f"{EMB_BASE}, d AS (SELECT elem, dim, 100.0::DOUBLE * avg(covered::INT::DOUBLE) AS rate FROM l GROUP BY elem, dim) SELECT elem, round({agg}(rate), 6) AS coverage FROM d GROUP BY elem")(run)


_embedding_coverage("mean")
_embedding_coverage("min")


@query(f"{EMB_BASE} SELECT elem, structure_id, count(*) FILTER (WHERE covered)::BIGINT AS score FROM l GROUP BY elem, structure_id")
def point_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.point_scores(_embedding_labels(spark, sf_dir), ["elem", "structure_id"])


@query("""WITH d AS (SELECT label AS elem, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings), m AS (SELECT elem, dim, round(avg(v), 6) AS m FROM d GROUP BY elem, dim)
SELECT elem, (dim - 1)::INTEGER AS dim, m AS mean FROM m""")
def mean_descriptor(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.mean_descriptor(embedding_rows(spark, sf_dir), ["elem"])
    return out.select("elem", F.posexplode("features").alias("dim", "mean")).withColumn("mean", r("mean"))


@query("SELECT vec_id AS structure_id, round(embedding[1]::DOUBLE, 6) AS f0, round(embedding[11]::DOUBLE, 6) AS f1, round(embedding[4]::DOUBLE, 6) AS f2, 3 AS width FROM embeddings")
def body_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = embedding_rows(spark, sf_dir).select("structure_id", "features")
    both = structures.stack_bodies([structures.body_slice(e, [0, 10]), structures.body_slice(e, [3])], ["structure_id"])
    return both.select("structure_id", *[r(F.get("features", F.lit(i))).alias(f"f{i}") for i in range(3)], F.size("features").alias("width"))


@query()
def pca_explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pca.explained(pca.fit(embedding_rows(spark, sf_dir), "features", "elem"), spark, "elem").select(F.col("elem").cast("int").alias("elem"), r("explained").alias("explained"))


@query()
def pca_grid_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(embedding_rows(spark, sf_dir))
    models = pca.fit(ref, "features", "elem")
    flat = lambda df: pca.project_by(df, models, "elem").select("elem", "structure_id", F.posexplode(F.array("pc1", "pc2")).alias("dim", "value"))
    q, d = flat(cand), flat(ref)
    out = coverage.grid_coverage(q, d, coverage.grid_stats(q, ["elem"], "dim", "value"), ["elem"], "dim", "value", ["structure_id"])
    return out.withColumn("coverage", r("coverage", 10))


@query()
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = embedding_rows(spark, sf_dir)
    ref, cand = split(e)
    out = report.coverage_report(ref.withColumn("main", (F.col("structure_id") % 8 / 2 - 1).cast("int")).drop("is_ref"), cand.drop("is_ref"), "all")
    return out.withColumns({c: r(c, 10) for c in ("coverage_2d", "coverage_1d", "mean_covered_1d")} | {"explained": r("explained")})


@query(f"""WITH {EV}, ref AS (SELECT * FROM e WHERE is_ref), cand AS (SELECT * FROM e WHERE NOT is_ref),
g0 AS (SELECT elem, count(*) AS n, min(value) AS a, max(value) AS z, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM cand GROUP BY elem),
g1 AS (SELECT *, CASE WHEN 2.0::DOUBLE * iqr / pow(n, 1.0::DOUBLE / 3) > 0 THEN 2.0::DOUBLE * iqr / pow(n, 1.0::DOUBLE / 3) ELSE z - a END AS w FROM g0),
g AS (SELECT *, CASE WHEN z > a THEN greatest(1, floor((z - a) / w)) ELSE 1 END AS nb FROM g1),
q AS (SELECT c.elem, CASE WHEN value >= a AND value < z THEN least(floor((value - a) / ((z - a) / nb)), nb - 1) END AS cell FROM cand c JOIN g USING (elem)),
o AS (SELECT DISTINCT c.elem, least(floor((value - a) / ((z - a) / nb)), nb - 1) AS cell FROM ref c JOIN g USING (elem) WHERE value >= a AND value < z)
SELECT elem, count(*) AS n_query, count(o.cell) AS n_covered, round(count(o.cell) / count(*)::DOUBLE, 6) AS coverage FROM q LEFT JOIN o USING (elem, cell) GROUP BY elem""")
def grid_coverage_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cand = split(event_values(spark, sf_dir))
    grid = coverage.grid_stats(cand, ["elem"], "dim", "value")
    out = coverage.grid_coverage_1d(cand, ref, grid, ["elem"], "dim", "value")
    return out.select("elem", "n_query", "n_covered", r("coverage").alias("coverage"))


@query("""WITH x AS (SELECT label, vec_id, embedding[1]::DOUBLE AS v FROM embeddings), k AS (SELECT label, count(*) // 10 AS k FROM x GROUP BY label),
y AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY v DESC, vec_id) AS r FROM x) SELECT label, vec_id, round(v, 6) AS v FROM y JOIN k USING (label) WHERE r <= k""")
def topk_in_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.get("embedding", F.lit(0)).cast("double").alias("v"))
    k = x.groupBy("label").agg(F.floor(F.count("*") / 10).alias("k"))
    return select.topk_in_cluster(x, "label", "v", "vec_id", k).withColumn("v", r("v"))


@query("""WITH b AS (SELECT event_type AS elem, user_id AS idx, round(sum(value), 6) AS score FROM events GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY elem ORDER BY score DESC, idx) AS place, count(*) OVER (PARTITION BY elem) AS n FROM b)
SELECT elem, k::INTEGER AS label_pos, idx, place <= round_even((k + 1) / 5.0::DOUBLE * n, 0) AS shown FROM p, range(4) t(k)""")
def monotonic_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = event_values(spark, sf_dir)
    week = F.floor(F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7).cast("int")
    base = e.groupBy("elem", "structure_id").agg(F.round(F.sum("value"), 6).alias("score"), F.min(week).alias("first"))
    labels = spark.createDataFrame([(i,) for i in range(4)], "label_pos int")
    points = base.crossJoin(F.broadcast(labels)).select("elem", "label_pos", F.col("structure_id").alias("idx"), "score", ((F.col("label_pos") + 1) / F.lit(5.0)).alias("coverage"))
    return coverage.monotonic_topk(points).select("elem", "label_pos", "idx", "shown")


# ---- ensemble disagreement, metrics

AMB = """f AS (SELECT l_orderkey AS structure_id, l_partkey % 5 AS elem, l_quantity AS fx, l_discount * 100 AS fy, l_tax * 100 AS fz FROM lineitem),
a AS (SELECT structure_id, elem, sqrt(var_pop(fx) + var_pop(fy) + var_pop(fz)) AS ambiguity FROM f GROUP BY structure_id, elem)"""


def _ambiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.ensemble_ambiguity(line_forces(spark, sf_dir), ["structure_id", "elem"])


@query(f"""WITH {AMB} SELECT structure_id, coalesce(elem, -1) AS elem, grouping(elem)::INTEGER AS is_total, round(max(ambiguity), 6) AS amb_max, round(min(ambiguity), 6) AS amb_min, round(avg(ambiguity), 6) AS amb_mean
FROM a GROUP BY GROUPING SETS ((structure_id, elem), (structure_id))""")
def ensemble_ambiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.ambiguity_summary(_ambiguity(spark, sf_dir))
    return out.select("structure_id", F.coalesce("elem", F.lit(-1)).alias("elem"), "is_total", *[r(c).alias(c) for c in ("amb_max", "amb_min", "amb_mean")])


@query(f"""WITH {AMB}, s AS (SELECT DISTINCT structure_id FROM a), g AS (SELECT structure_id, unnest([0, 1, 2, 3, 4])::BIGINT AS elem FROM s)
SELECT structure_id, elem, round(coalesce(max(ambiguity), 0), 6) AS amb_max FROM g LEFT JOIN a USING (structure_id, elem) GROUP BY structure_id, elem""")
def ambiguity_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.ambiguity_matrix(_ambiguity(spark, sf_dir), [0, 1, 2, 3, 4]).withColumn("amb_max", r("amb_max"))


@query(f"WITH {AMB} SELECT structure_id, elem, round(ambiguity, 6) AS ambiguity FROM a WHERE ambiguity > 2.5 AND ambiguity < 10.5")
def ambiguity_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.ambiguity_window(_ambiguity(spark, sf_dir), 2.5, 10.5).withColumn("ambiguity", r("ambiguity"))


@query(f"""WITH {AMB}, ed AS (SELECT unnest([0.0, 5.0, 7.123, 10.0, 15.0, 20.0, 25.0])::DOUBLE AS lo, unnest([5.0, 7.123, 10.0, 15.0, 20.0, 25.0, NULL])::DOUBLE AS hi),
b AS (SELECT row_number() OVER (ORDER BY lo) - 1 AS bin, lo, hi FROM ed WHERE hi IS NOT NULL)
SELECT bin, lo, hi, (SELECT count(*) FROM a WHERE ambiguity >= lo AND (ambiguity < hi OR (bin = 5 AND ambiguity = hi))) AS freq FROM b""")
def ambiguity_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram.histogram_over(_ambiguity(spark, sf_dir), "ambiguity", histogram.edges_with_threshold(25.0, 6, 7.1234))


STATS_SQL = """WITH v AS (SELECT l_returnflag AS kind, {value} AS value FROM lineitem), m AS (SELECT kind, avg(value) AS mean FROM v GROUP BY kind)
SELECT kind, round(any_value(mean), 6) AS mean, round(stddev_pop(value), 6) AS std, round(avg(abs(value - mean)), 6) AS mad, min(value) AS vmin, max(value) AS vmax, count(value) AS n FROM v JOIN m USING (kind) GROUP BY kind"""


@query(STATS_SQL.format(value="l_quantity"))
def efs_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("kind"), F.col("l_quantity").alias("value"))
    return metrics.value_stats(v, ["kind"], "value").select("kind", r("mean").alias("mean"), r("std").alias("std"), r("mad").alias("mad"), "vmin", "vmax", "n")


@query("""WITH p AS (SELECT l_returnflag AS flag, unnest(['price', 'tax']) AS component, unnest([l_extendedprice, l_tax]) AS t, unnest([l_quantity * p_retailprice, l_discount]) AS p FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT flag, component, round(avg(abs(p - t)) * 1000, 4) AS mae, round(sqrt(avg((p - t) * (p - t))) * 1000, 4) AS rmse, round(1 - sum((p - t) * (p - t)) / nullif(var_pop(t) * count(t), 0), 6) AS r2, count(*) AS n FROM p GROUP BY flag, component""")
def error_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    pairs = {"price": (F.col("l_extendedprice"), F.col("l_quantity") * F.col("p_retailprice")), "tax": (F.col("l_tax"), F.col("l_discount"))}
    rows = metrics.components_long(joined.withColumn("flag", F.col("l_returnflag")), ["flag"], pairs)
    out = metrics.error_metrics(rows, ["flag", "component"], "truth", "pred")
    return out.select("flag", "component", r("mae", 4).alias("mae"), r("rmse", 4).alias("rmse"), r("r2").alias("r2"), "n")


@query("""WITH m AS (SELECT l_orderkey, l_linenumber, sqrt(l_quantity * l_quantity + l_tax * l_tax) AS f FROM lineitem),
w AS (SELECT *, count(*) FILTER (WHERE f < 10) OVER (PARTITION BY l_orderkey) AS ok, row_number() OVER (PARTITION BY l_orderkey ORDER BY f, l_linenumber) AS r FROM m)
SELECT l_orderkey, l_linenumber, round(f, 6) AS max_f FROM w WHERE f < 10 OR (ok = 0 AND r = 1)""")
def force_filter_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numeric.norm(F.array("l_quantity", "l_tax")).alias("max_f"))
    return structures.force_filter(frames, 10.0, ["l_orderkey"], order="l_linenumber").withColumn("max_f", r("max_f"))


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE sqrt(l_quantity * l_quantity + l_tax * l_tax) <= 25""")
def force_at_most(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array(F.array("l_quantity", "l_tax")).alias("forces"))
    return structures.force_at_most(frames, 25.0).drop("forces")


@query("""WITH x AS (SELECT l_orderkey, l_quantity AS a, l_extendedprice / 1000 AS b FROM lineitem),
m AS (SELECT min(a) AS a0, max(a) AS a1, min(b) AS b0, max(b) AS b1 FROM x),
c AS (SELECT least(floor((a - a0) * (10 / (a1 - a0))), 9) AS i, least(floor((b - b0) * (10 / (b1 - b0))), 9) AS j, * FROM x, m),
d AS (SELECT CASE WHEN a < a0 + i * ((a1 - a0) / 10) THEN i - 1 WHEN a >= a0 + (i + 1) * ((a1 - a0) / 10) AND i < 9 THEN i + 1 ELSE i END AS i, CASE WHEN b < b0 + j * ((b1 - b0) / 10) THEN j - 1 WHEN b >= b0 + (j + 1) * ((b1 - b0) / 10) AND j < 9 THEN j + 1 ELSE j END AS j FROM c),
n AS (SELECT i, j, count(*) AS density FROM d GROUP BY i, j) SELECT density, sum(density)::BIGINT AS n_points FROM n GROUP BY density""")
def density_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("a"), (F.col("l_extendedprice") / 1000).alias("b"))
    return histogram.density_2d(x, "a", "b", 10).groupBy("density").agg(F.count("*").alias("n_points"))


# ---- lineage, sets, summaries


@query("""WITH y AS (SELECT o_orderkey, year(o_orderdate)::INTEGER - 1993 AS main FROM orders), l AS (SELECT main, row_number() OVER (ORDER BY main) - 1 AS pos FROM (SELECT DISTINCT main FROM y))
SELECT CASE WHEN b.main = -1 THEN 'init' ELSE 'loop-' || (b.main + 1) END AS label, count(*) AS n FROM y JOIN l a USING (main) JOIN l b ON b.pos >= a.pos GROUP BY b.main""")
def cumulative_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = table(spark, sf_dir, "orders").select("o_orderkey", (F.year("o_orderdate") - 1993).alias("main"))
    return lineage.cumulative(frames, lineage.discover_labels(frames)).groupBy("label").agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT DISTINCT year(o_orderdate)::INTEGER - 1993 AS main FROM orders), g AS (SELECT main, row_number() OVER (ORDER BY main) - 1 AS p, count(*) OVER () AS n FROM l WHERE main >= 0)
SELECT main FROM l WHERE main = -1 UNION ALL SELECT main FROM g WHERE n <= 3 OR p BETWEEN ceil(0.25 * (n - 1)) AND floor(0.75 * (n - 1)) OR p = n - 1""")
def loop_select_middle_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = lineage.discover_labels(table(spark, sf_dir, "orders").select((F.year("o_orderdate") - 1993).alias("main")))
    wanted = lineage.select_loops([x.main for x in labels.select("main").collect()], "middle-half")
    return labels.where(F.col("main").isin(wanted)).select(F.col("main").cast("int").alias("main"))


@query("""WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders), c AS (SELECT year(o_orderdate)::INTEGER - 1993 AS main, count(*) AS cnt FROM orders GROUP BY main),
s AS (SELECT main, sum(cnt) OVER (ORDER BY main) AS hi, sum(cnt) OVER (ORDER BY main) - cnt AS lo FROM c)
SELECT o_orderkey, main FROM o JOIN s ON i >= lo AND i < hi""")
def segment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments as long as the orders of each year, one after another over all orders."""
    o = table(spark, sf_dir, "orders")
    at = lineage._placed(o.select("o_orderkey"), "o_orderkey").select("o_orderkey", F.col("_at").alias("frame_idx"))
    counts = o.groupBy((F.year("o_orderdate") - 1993).alias("main")).agg(F.count("*").alias("cnt"))
    return lineage.segment_labels(at, counts).select("o_orderkey", "main")


@query("SELECT doc_id, (ntile(7) OVER (ORDER BY doc_id) - 1)::INTEGER AS chunk FROM documents")
def ntile_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.chunk_of(table(spark, sf_dir, "documents").select("doc_id"), 7, "doc_id")


@query("WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) SELECT doc_id, floor(i / ceil(n / 6.0))::INTEGER AS chunk FROM o")
def ceil_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.ceil_split(table(spark, sf_dir, "documents").select("doc_id"), 6, "doc_id")


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY md5(text)")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("h"))
    first = structures.first_of(docs, ["h"], "doc_id")
    return first.join(docs.groupBy("h").agg(F.count("*").alias("copies")), "h").select("doc_id", "copies")


KEY = "l_quantity, l_discount, l_tax"


@query(f"""WITH f AS (SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS o, {KEY}, row_number() OVER (PARTITION BY {KEY} ORDER BY l_orderkey * 10 + l_linenumber) AS r FROM lineitem),
i AS (SELECT {KEY}, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY {KEY})
SELECT l_orderkey, l_linenumber FROM f LEFT JOIN i USING ({KEY}) WHERE r > coalesce(n, 0)""")
def multiset_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("o", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    keys = ["l_quantity", "l_discount", "l_tax"]
    return lineage.multiset_subtract(li.select("l_orderkey", "l_linenumber", "o", *keys), li.where("l_returnflag = 'A'"), keys, "o").select("l_orderkey", "l_linenumber")


@query("""WITH p AS (SELECT coalesce(p_brand, 'unknown') AS kind, coalesce(p_type, 'unknown') AS parent, p_size AS a FROM part)
SELECT 'kind' AS level, kind AS name, count(*) AS n, min(a) AS n_min, max(a) AS n_max, round(avg(a), 6) AS n_mean FROM p GROUP BY kind
UNION ALL SELECT 'parent', parent, count(*), min(a), max(a), round(avg(a), 6) FROM p GROUP BY parent UNION ALL SELECT 'all', 'all', count(*), min(a), max(a), round(avg(a), 6) FROM p""")
def collection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("kind"), F.col("p_type").alias("parent"), "p_size")
    return structures.collection_summary(p, ["kind", "parent"], "p_size").withColumn("n_mean", r("n_mean"))


@query("""WITH j AS (SELECT event_type AS category, CAST(json_extract(props, '$.k') AS INTEGER) AS k, user_id % 10 AS c FROM events)
SELECT coalesce(category, 'total') AS category, count(*) AS n_files, round(coalesce(sum(CASE WHEN c > 0 THEN (k + 1.5) * c / 3600.0 END), 0), 6) AS core_hours, count(*) FILTER (WHERE NOT c > 0) AS n_missing FROM j GROUP BY ROLLUP (j.category)""")
def core_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = F.format_string("x total_runtime:%.1f s", F.get_json_object("props", "$.k").cast("double") + 1.5)
    script = F.when(F.col("user_id") % 10 > 0, F.concat(F.lit("#SBATCH -n "), (F.col("user_id") % 10).cast("string"))).otherwise(F.lit("#!/bin/sh"))
    logs = table(spark, sf_dir, "events").select(F.col("event_type").alias("category"), F.col("event_id").cast("string").alias("path"), text.runtimes(log).alias("seconds"), text.cores(script).alias("cores"))
    return metrics.core_hours(logs).select(F.coalesce("category", F.lit("total")).alias("category"), "n_files", r("core_hours").alias("core_hours"), F.size("missing").cast("long").alias("n_missing"))


@query("SELECT DISTINCT n_nationkey AS elem FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def elements_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    there = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("elem"))
    return structures.missing_elements(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("elem")), there)


@query("SELECT p_brand, p_type, p_size % 3 AS third, count(*) AS n FROM part GROUP BY CUBE (p_brand, p_type, p_size % 3) HAVING grouping(p_brand) + grouping(p_type) + grouping(p_size % 3) < 3")
def powerset_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("third", F.col("p_size") % 3)
    sets = [[F.col(c) for c in some] for some in structures.power_set(["p_brand", "p_type", "third"])]
    return p.groupingSets(sets, "p_brand", "p_type", "third").agg(F.count("*").alias("n"))


@query("""SELECT event_type, count(*) AS n FROM events WHERE CAST(json_extract(props, '$.k') AS DOUBLE) = 7 GROUP BY event_type""")
def info_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").where(text.info_matches(info, "K", F.lit("7.0"))).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey AS k FROM nation WHERE n_regionkey = 1 INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0")
def set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("k"))
    return a.intersect(table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_nationkey"))


@query("SELECT s_nationkey AS k, count(*) AS n FROM (SELECT s_nationkey FROM supplier UNION ALL SELECT c_nationkey FROM customer) GROUP BY k")
def union_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")), table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    return a.unionByName(b).groupBy("k").agg(F.count("*").alias("n"))


@query("SELECT (o_orderkey // (m // 10 + 1))::BIGINT AS config, count(*) AS n FROM orders, (SELECT max(o_orderkey) AS m FROM orders) GROUP BY config")
def configuration_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten spans of ids over all orders."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("structure_id"))
    width = F.floor(F.max("structure_id") / 10) + 1
    spans = o.agg(width.alias("w")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("config"), "w").select("config", (F.col("config") * F.col("w")).alias("start"), ((F.col("config") + 1) * F.col("w")).alias("stop"))
    return lineage.configuration_of(o, spans).groupBy("config").agg(F.count("*").alias("n"))


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, l_discount * 100 AS b, l_tax * 100 AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, round(abs((a + 10) * ((b + 20) * (c + 30) - a * b) - b * (c * (c + 30) - a * a) + c * (c * b - (b + 20) * a)), 4) AS volume FROM t""")
def cell_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b, c = F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100
    cell = F.array(a + 10, b, c, c, b + 20, a, a, b, c + 30)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r(tensors.volume(cell), 4).alias("volume"))


@query("""WITH w AS (SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS r, l_returnflag FROM lineitem)
SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity FROM w WHERE r <= 10""")
def top_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_returnflag").orderBy(F.col("l_quantity").desc(), "l_orderkey", "l_linenumber")
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return li.withColumn("r", F.row_number().over(order)).where("r <= 10").drop("r")


@query(f"WITH {EV}, q AS (SELECT elem, quantile_cont(value, 0.1) AS q0, quantile_cont(value, 0.5) AS q1 FROM e GROUP BY elem) SELECT elem, round(q0, 6) AS q0, round(q1, 6) AS q1 FROM q")
def order_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.order_statistics(event_values(spark, sf_dir), ["elem"], "value", (0.1, 0.5))
    return out.select("elem", r("q0").alias("q0"), r("q1").alias("q1"))


assert adapters.SPLIT == "2024-01-16"  # the SQL above has it as a literal
