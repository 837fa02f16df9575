"""Registered queries of reports, selections and the dataset's way from build to export."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import text
from lacuna.operators import histogram, lineage, metrics, structures
from lacuna.operators.stats import stored
from lacuna.plans import featurize, flows, lifecycle, report, sampling
from lacuna.plans.adapters import line_forces, table
from lacuna.plans.catalogue import AMB, query, r
from lacuna.sources import frames, readers, writers
from lacuna.streaming import pool


@query(f"WITH {AMB}, m AS (SELECT structure_id, max(ambiguity) AS amb FROM a GROUP BY structure_id) SELECT structure_id, round(amb, 6) AS ambiguity FROM m WHERE amb > 6.05 AND amb < 9.15")
def ambiguity_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames whose largest disagreement lies in the window: all of them, as the clusters' picks would pass the budget."""
    forces = line_forces(spark, sf_dir).withColumn("atom_idx", F.col("elem"))
    vectors = forces.select("structure_id", F.array("fx", "fy").alias("features"))
    return sampling.ambiguity_sample(forces, vectors, 6.05, 9.15, 15, 2, 20).select("structure_id", r("ambiguity").alias("ambiguity"))


@query("""WITH x AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity AS a, l_extendedprice / 1037 AS b FROM lineitem), m AS (SELECT min(a) AS a0, max(a) AS a1, min(b) AS b0, max(b) AS b1 FROM x),
c AS (SELECT least(floor((a - a0) * (10 / (a1 - a0))), 9) AS i, least(floor((b - b0) * (10 / (b1 - b0))), 9) AS j, * FROM x, m),
d AS (SELECT id, CASE WHEN a < a0 + i * ((a1 - a0) / 10) THEN i - 1 WHEN a >= a0 + (i + 1) * ((a1 - a0) / 10) AND i < 9 THEN i + 1 ELSE i END AS i, CASE WHEN b < b0 + j * ((b1 - b0) / 10) THEN j - 1 WHEN b >= b0 + (j + 1) * ((b1 - b0) / 10) AND j < 9 THEN j + 1 ELSE j END AS j FROM c),
n AS (SELECT id, count(*) OVER (PARTITION BY i, j) AS density FROM d) SELECT id, density, row_number() OVER (ORDER BY density, id) - 1 AS place FROM n""")
def density_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in order of density, the thinnest first; ids tell ties apart, and lines that share one take either's place."""
    points = flows.line_points(spark, sf_dir).select("id", F.col("x").alias("a"), F.col("y").alias("b"))
    return histogram.by_density(histogram.density_2d(points, "a", "b", 10), ["id"]).select("id", "density", "place")


@query("""SELECT l_returnflag AS dataset, l_linenumber AS elem, count(*) AS n, round(sum(l_quantity), 3) AS pc1, count(*) FILTER (WHERE l_discount > 0.05) AS covered FROM lineitem GROUP BY dataset, elem""")
def component_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a plane written as text, a folder for each dataset and element, and read back."""
    li = table(spark, sf_dir, "lineitem")
    points = li.select(F.col("l_returnflag").alias("dataset"), F.col("l_linenumber").alias("elem"), F.col("l_quantity").alias("pc1"), F.col("l_tax").alias("pc2"), (F.col("l_discount") > 0.05).alias("covered"))
    with flows.folder(spark) as path:
        writers.points_text(points, path)
        back = spark.read.option("sep", " ").option("header", True).schema("PC1 double, PC2 double, Is_Covered int, dataset string, elem int").csv(path)
        return stored(back.groupBy("dataset", "elem").agg(F.count("*").alias("n"), r(F.sum("PC1"), 3).alias("pc1"), F.sum("Is_Covered").alias("covered")))


@query("""SELECT event_type AS category, printf('%.6f', count(*) FILTER (WHERE event_id % 3 > 0) * 90.0 * 8 / 3600) AS hours, count(*)::VARCHAR AS tasks, count(*) FILTER (WHERE event_id % 3 > 0)::VARCHAR AS counted FROM events GROUP BY event_type""")
def hours_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text report of core hours, taken apart again: every third log tells no runtime."""
    none = F.array().cast("array<double>")
    seconds = F.when(F.col("event_id") % 3 > 0, F.array(F.lit(60.0), F.lit(30.0))).otherwise(none)
    logs = table(spark, sf_dir, "events").select(F.col("event_type").alias("category"), F.col("event_id").cast("string").alias("path"), seconds.alias("seconds"), F.lit(8).alias("cores"))
    whole = spark.createDataFrame([(writers.hours_text(metrics.core_hours(logs)),)], "value string")
    found = F.regexp_extract_all("value", F.lit(r"(?m)^(\w+: [0-9.]+)\n  task_count: \d+\n  counted_count: \d+$"), F.lit(0))
    part = lambda form: F.regexp_extract("block", form, 1)
    return whole.select(F.explode(found).alias("block")).select(part(r"^(\w+):").alias("category"), part(r"^\w+: ([0-9.]+)").alias("hours"), part(r"task_count: (\d+)").alias("tasks"), part(r"counted_count: (\d+)").alias("counted"))


@query("""SELECT 'selected' AS part, count(*) + (SELECT count(*) FROM part) AS n, TRUE AS current_first FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey % 3 = 0 UNION ALL SELECT 'remain', count(*), TRUE FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey % 3 <> 0""")
def selected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two structure files of one selection, the current set before the selected."""
    s = flows.order_structures(spark, sf_dir).select("structure_id", "symbols", "positions", "cell", (F.col("structure_id") % 3 == 0).alias("selected")).withColumn("label", F.lit("new"))
    current = flows.part_blocks(spark, sf_dir).withColumn("label", F.lit("current"))
    out = []
    with flows.folder(spark) as path:
        writers.write_selected(s, path, current=current)
        for part in ("selected", "remain"):
            rows = stored(readers.read_extxyz(spark, f"{path}/{part}", frames.dealt_bytes(spark, f"{path}/{part}")).select("file", "structure_id", "label"))
            at = F.struct("file", "structure_id")
            ends = rows.agg(F.count("*").alias("n"), F.max(F.when(F.col("label") == "current", at)).alias("last"), F.min(F.when(F.col("label") == "new", at)).alias("first")).first()
            out.append((part, ends.n, ends.last is None or tuple(ends.last) < tuple(ends.first)))
    return spark.createDataFrame(out, "part string, n long, current_first boolean")


@query("""SELECT event_id, (1 + user_id % 5)::INTEGER AS species, '0 ' || (event_id % 11) || ' 20' AS moments FROM events""")
def potential_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.concat(F.lit("MTP\nversion = 1.1.0\nspecies_count = "), (1 + F.col("user_id") % 5).cast("string"), F.lit("\nalpha_moments_count = 9\nalpha_moment_mapping = {0, "), (F.col("event_id") % 11).cast("string"), F.lit(",20}\n"))
    return table(spark, sf_dir, "events").select("event_id", text.potential_species(header).alias("species"), F.array_join(text.potential_moments(header).cast("array<string>"), " ").alias("moments"))


@query("""WITH x AS (SELECT l_orderkey AS o, row_number() OVER () AS i, l_quantity AS x, l_discount * 100 AS y, l_tax * 100 AS z FROM lineitem),
p AS (SELECT a.o, count(*) AS n FROM x a JOIN x b ON a.o = b.o AND a.i <> b.i AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) <= 6.05 GROUP BY a.o)
SELECT o AS structure_id, CASE WHEN o % 7 = 0 THEN NULL ELSE coalesce(max(n), 0) END::BIGINT AS pairs, CASE WHEN o % 7 = 0 THEN 'ValueError: seventh' END AS error FROM x LEFT JOIN p USING (o) GROUP BY o""")
def featurized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours within 6.05 by a featurizer of shells; one that fails keeps its error in its row."""

    def shells(**options):
        count = featurize.pair_distances(**options)

        def features(row: dict) -> list[list[float]]:
            if row["structure_id"] % 7 == 0:
                raise ValueError("seventh")
            return count(row)

        return features

    found = featurize.apply(flows.order_structures(spark, sf_dir).select("structure_id", "positions"), shells, "array<array<double>>", ["structure_id"], bins=4, cutoff=6.05)
    total = F.aggregate(F.flatten("result"), F.lit(0.0), lambda s, x: s + x).cast("long")
    return found.select("structure_id", total.alias("pairs"), "error")


@query("""WITH f AS (SELECT l_returnflag, l_quantity, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'F' AND l_linenumber = 1) AS k FROM lineitem GROUP BY l_returnflag, l_quantity)
SELECT l_returnflag, sum(n - k)::BIGINT AS beyond, sum(k)::BIGINT AS initial, -1 AS main FROM f GROUP BY l_returnflag""")
def dataset_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The initial set with its mark, and what the final set has beyond it, by exact fingerprint and multiplicity."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("structure_id"), "l_returnflag", "l_quantity", "l_linestatus", "l_linenumber")
    initial, beyond = lifecycle.bundle(li.where("l_linestatus = 'F' and l_linenumber = 1"), li, ["l_returnflag", "l_quantity"])
    first = initial.groupBy("l_returnflag").agg(F.count("*").alias("initial"), F.max("main").alias("main"))
    return beyond.groupBy("l_returnflag").agg(F.count("*").alias("beyond")).join(first, "l_returnflag", "left").fillna({"initial": 0, "main": -1})


@query("""WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders), c AS (SELECT year(o_orderdate)::INTEGER - 1993 AS main, count(*) - 5 AS cnt FROM orders GROUP BY main), s AS (SELECT main, sum(cnt) OVER (ORDER BY main) AS hi, sum(cnt) OVER (ORDER BY main) - cnt AS lo FROM c)
SELECT CASE WHEN main IS NULL THEN 'none' WHEN main = -1 THEN 'init' ELSE 'loop-' || (main + 1) END AS label, count(*) AS n FROM o LEFT JOIN s ON i >= lo AND i < hi GROUP BY main""")
def final_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last training set with the loop that each frame came from; the counts fall short, so that the last have none."""
    o = table(spark, sf_dir, "orders")
    numbered = lineage.ranked(o.select("o_orderkey"), [F.col("o_orderkey")]).withColumnRenamed("rank", "frame_idx")
    counts = o.groupBy((F.year("o_orderdate") - 1993).alias("main")).agg((F.count("*") - 5).alias("cnt"))
    out = lifecycle.export(numbered, counts)
    return out.select(F.coalesce(text.loop_label(F.col("main")), F.lit("none")).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT least(count(*), 321) AS n, least(count(*), 321) AS different, 0::BIGINT AS unknown, TRUE AS again FROM orders")
def downsampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample without replacement: its size, that its rows are different and of the table, and that it comes again."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    one, two = (stored(structures.downsample(o, 321, "o_orderkey", 5)) for _ in range(2))
    same = one.exceptAll(two).limit(1).count() + two.exceptAll(one).limit(1).count() == 0
    unknown = one.join(o, "o_orderkey", "left_anti").count()
    return one.agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("different")).select("n", "different", F.lit(unknown).cast("long").alias("unknown"), F.lit(same).alias("again"))


@query("""SELECT event_id, (user_id % 9 + 1)::INTEGER AS x, CASE event_id % 3 WHEN 0 THEN (user_id % 9 + 1) WHEN 1 THEN 2 ELSE 3 END::INTEGER AS y, CASE event_id % 3 WHEN 0 THEN (user_id % 9 + 1) ELSE 1 END::INTEGER AS z,
  CASE event_id % 5 WHEN 0 THEN 'None' WHEN 1 THEN 'True' WHEN 2 THEN event_id::VARCHAR WHEN 3 THEN (event_id + 0.5)::VARCHAR ELSE 'text // #' END AS value FROM events""")
def commented_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeat sizes and stored defaults out of commented JSON texts."""
    e, n = F.col("event_id"), (F.col("user_id") % 9 + 1).cast("string")
    size = F.when(e % 3 == 0, n).when(e % 3 == 1, F.concat(n, F.lit("x2x1"))).otherwise(F.concat(n, F.lit(" 3, 1")))
    value = F.when(e % 5 == 0, F.lit("none")).when(e % 5 == 1, F.lit("yes")).when(e % 5 == 2, e.cast("string")).when(e % 5 == 3, F.concat(e.cast("string"), F.lit(".5"))).otherwise(F.lit("text // #"))
    config = F.concat(F.lit('{ // sizes\n"repeat": "'), size, F.lit('", /* a\ndefault */ "value": "'), value, F.lit('" # end\n}'))

    def parsed(texts: pd.Series) -> pd.DataFrame:
        found = [text.load_config(t) for t in texts]
        sizes = [text.repeats(c["repeat"]) for c in found]
        return pd.DataFrame({"x": [s[0] for s in sizes], "y": [s[1] for s in sizes], "z": [s[2] for s in sizes], "value": [str(text.coerce(c["value"])) for c in found]})

    out = table(spark, sf_dir, "events").select("event_id", F.pandas_udf(parsed, "x int, y int, z int, value string")(config).alias("p"))
    return out.select("event_id", "p.*")


@query("""WITH RECURSIVE w AS (SELECT (day(ts) - 1) // 6 AS gen, count(*) AS n FROM events WHERE value > 97 GROUP BY gen), t AS (SELECT greatest(1, ceil(count(*) * 0.006))::BIGINT AS most FROM events),
s(gen, n, action, pool) AS (SELECT -1::BIGINT, 0::BIGINT, 'wait', 0::BIGINT UNION ALL
  SELECT s.gen + 1, coalesce(w.n, 0), CASE WHEN coalesce(w.n, 0) = 0 THEN 'end' WHEN s.pool + w.n < most THEN 'wait' ELSE 'update' END, CASE WHEN s.pool + coalesce(w.n, 0) < most THEN s.pool + coalesce(w.n, 0) ELSE 0 END FROM s JOIN t ON TRUE LEFT JOIN w ON w.gen = s.gen + 1 WHERE s.action <> 'end' AND s.gen < 4)
SELECT gen::INTEGER AS gen, n, action FROM s WHERE gen >= 0""")
def candidate_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five generations into a pool whose trigger is a share of all events: what each did, every step taken twice."""
    e = stored(table(spark, sf_dir, "events").select("event_id", "value", F.floor((F.dayofmonth("ts") - 1) / 6).alias("part")))
    batches = [e.where(F.col("part") == k).drop("part") for k in range(5)]
    with flows.folder(spark) as path:
        held = pool.CandidatePool(spark, path, "0.6%", e.count())
        done = pool.generations(batches, lambda batch, _: batch.where("value > 97"), held, lambda rows: rows.count())
        rows = [(k, batches[k].where("value > 97").count(), action) for k, action in enumerate(done)]
        for k, action in enumerate(done):  # a generation that runs again adds nothing
            if action == "update":
                held.add(batches[k].where("value > 97"), k)
        assert held.count() < held.threshold
    return spark.createDataFrame(rows, "gen int, n long, action string")


@query("""WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM part) SELECT p_partkey::INTEGER AS main, place FROM p""")
def merged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structures split into files of consecutive ranges: read one after another, they are in the order that they had."""
    s = flows.part_blocks(spark, sf_dir).withColumn("main", F.col("structure_id").cast("int"))
    with flows.folder(spark) as path:
        writers.write_text(s, path, files=3, form=writers.extxyz_text)
        rows = stored(readers.read_extxyz(spark, path, frames.dealt_bytes(spark, path)).select("main", "file", "structure_id"))
    return lineage.ranked(rows, [F.col("file"), F.col("structure_id")]).select("main", F.col("rank").alias("place"))


@query(f"""WITH s AS ({flows.BODY_SQL}) SELECT label AS dataset, elem::VARCHAR AS element, 'fd' AS coverage_grid, printf('%.10f', coverage_1d) AS coverage_1d_mean, printf('%.6f', mean_covered) AS covered_1d_mean_count, {", ".join(f"printf('%.10f', {b}) AS coverage_1d_{b}" for b in flows.BODIES)}, n_query::VARCHAR AS query_count, n_input::VARCHAR AS input_count FROM s""")
def coverage_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's rows as the text columns of its CSV file, written and read back."""
    out = report.coverage_by_body(*flows.halves(spark, sf_dir), flows.BODIES)
    with flows.folder(spark) as path:
        writers.coverage_csv(out, list(flows.BODIES), {"coverage_grid": "fd"}).write.option("header", True).csv(path)
        back = stored(spark.read.option("header", True).option("inferSchema", False).csv(path))
    return back.select("dataset", "element", "coverage_grid", "coverage_1d_mean", "covered_1d_mean_count", *[f"coverage_1d_{b}" for b in flows.BODIES], "query_count", "input_count")
