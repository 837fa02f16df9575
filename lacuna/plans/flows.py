"""Registered queries of whole flows: files written from the tables and read back, stores, builds and loops that are stopped
and gone on with, clusters, symmetry and coverage by body."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lacuna.functions import tensors, text
from lacuna.operators import cluster, lineage, metrics, select, structures, symmetry
from lacuna.operators.stats import shared_folder, stored
from lacuna.plans import build, report
from lacuna.plans.adapters import event_values, table
from lacuna.plans.catalogue import EV, query, r
from lacuna.sources import frames, readers, store, writers
from lacuna.streaming import generations


@contextmanager
def folder(spark: SparkSession) -> Iterator[str]:
    """A new folder beside the checkpoints, removed afterwards: what is read from it must be stored before."""
    path = f"{shared_folder(spark)}/flow-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def order_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A structure an order, an atom a line: kinds by return flag, places and forces by quantity, discount and tax."""
    li = table(spark, sf_dir, "lineitem")
    atom = F.struct("l_linenumber", F.element_at(F.create_map(F.lit("A"), F.lit("Al"), F.lit("N"), F.lit("Ni"), F.lit("R"), F.lit("Ru")), F.col("l_returnflag")).alias("s"), "l_quantity", "l_discount", "l_tax")
    rows = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(atom)).alias("a"), F.sum("l_extendedprice").alias("price"))  # seven lines at most
    zero, edge = F.lit(0.0), lambda x: F.lit(float(x))
    return rows.select(
        F.col("l_orderkey").alias("structure_id"), F.size("a").alias("n_atoms"), F.array(edge(64), zero, zero, zero, edge(32), zero, zero, zero, edge(16)).alias("cell"), F.transform("a", lambda x: x["s"]).alias("symbols"),
        F.transform("a", lambda x: F.array(x["l_quantity"], x["l_discount"] * 100, x["l_tax"] * 100)).alias("positions"), F.transform("a", lambda x: F.array(x["l_tax"], x["l_discount"], x["l_quantity"] / 128)).alias("forces"),
        (-F.col("price")).alias("energy"), F.array(*[F.size("a") * edge(w) for w in (1, 6, 5, 6, 2, 4, 5, 4, 3)]).alias("virial"), F.col("l_orderkey").cast("int").alias("main"),
    )


def total(vectors: Column, k: int) -> Column:
    return F.aggregate(vectors, F.lit(0.0), lambda s, v: s + F.get(v, F.lit(k)))


# ---- structure files


@query("""SELECT l_orderkey::INTEGER AS main, count(*)::INTEGER AS n_atoms, round(sum(l_quantity), 3) AS x, round(sum(l_discount), 3) AS fy, round(-sum(l_extendedprice), 2) AS energy, row_number() OVER (ORDER BY l_orderkey) - 1 AS place,
  string_agg(CASE l_returnflag WHEN 'A' THEN 'Al' WHEN 'N' THEN 'Ni' ELSE 'Ru' END, '' ORDER BY l_returnflag) AS symbols FROM lineitem GROUP BY l_orderkey""")
def extended_xyz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames written in files of consecutive ranges and read back by ranges of bytes; `place` numbers them over the files."""
    with folder(spark) as path:
        writers.write_text(order_structures(spark, sf_dir), path, form=writers.extxyz_text)
        read = readers.read_extxyz(spark, path, frames.dealt_bytes(spark, path))
        symbols = F.array_join(F.array_sort("symbols"), "").alias("symbols")
        found = stored(read.select("file", "structure_id", "main", "n_atoms", total(F.col("positions"), 0).alias("x"), total(F.col("forces"), 1).alias("fy"), "energy", symbols))
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a file
    before = found.groupBy("file").agg(F.count("*").alias("n")).select("file", earlier.alias("before"))
    return found.join(F.broadcast(before), "file").select("main", "n_atoms", r("x", 3).alias("x"), r("fy", 3).alias("fy"), r("energy", 2).alias("energy"), (F.col("structure_id") + F.col("before")).alias("place"), "symbols")


@query("SELECT count(DISTINCT l_orderkey) AS frames, count(*) AS atoms, TRUE AS ranges_agree FROM lineitem")
def frame_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames by the ranges' index alone, atoms by the frames; whether the index has as many frames as were read."""
    with folder(spark) as path:
        writers.write_text(order_structures(spark, sf_dir), path, form=writers.extxyz_text)
        size = frames.dealt_bytes(spark, path)
        index = stored(frames.frame_index(spark, path, size))
        counted = index.agg(F.sum("frames").alias("frames")).first()["frames"]
        read = frames.read_frames(spark, path, size, index).agg(F.count("*").alias("n"), F.sum("n_atoms").alias("atoms")).first()
    return spark.createDataFrame([(counted, read.atoms, counted == read.n)], "frames long, atoms long, ranges_agree boolean")


ATOMS = "CASE l_returnflag WHEN 'A' THEN 'Al' WHEN 'N' THEN 'Ni' ELSE 'Ru' END"


@query(f"""SELECT {ATOMS} AS symbol, count(*) AS n, round(sum(l_quantity), 3) AS x, round(sum(l_quantity / 128), 4) AS fz, round(sum(n * 4)::DOUBLE, 3) AS vyz FROM lineitem JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) USING (l_orderkey) GROUP BY symbol""")
def cfg_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written by type number and read back; the stress 6-vector becomes 9 numbers, whose sixth is yz."""
    kinds = ["Al", "Ni", "Ru"]
    with folder(spark) as path:
        writers.write_text(order_structures(spark, sf_dir), path, form=lambda s: writers.cfg_text(s, kinds))
        found = readers.cfg_to_structures(readers.read_cfg(spark, path, kinds))
        atoms = found.select(F.explode(F.arrays_zip(F.col("symbols").alias("s"), F.col("positions").alias("p"), F.col("forces").alias("f"))).alias("a"), F.get("virial", F.lit(5)).alias("v"))
        out = atoms.groupBy(F.col("a.s").alias("symbol")).agg(F.count("*").alias("n"), r(F.sum(F.get("a.p", F.lit(0))), 3).alias("x"), r(F.sum(F.get("a.f", F.lit(2))), 4).alias("fz"), r(F.sum("v"), 3).alias("vyz"))
        return stored(out)


@query("SELECT count(DISTINCT l_orderkey) AS blocks, (SELECT count(*) FROM lineitem WHERE l_returnflag IN ('A', 'N')) AS atoms FROM lineitem")
def cfg_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks by their first line, and the atoms of two elements of three."""
    with folder(spark) as path:
        writers.write_text(order_structures(spark, sf_dir), path, form=lambda s: writers.cfg_text(s, ["Al", "Ni", "Ru"]))
        cfg = readers.read_cfg(spark, path)
        atoms = cfg.select(F.explode("atoms").alias("a")).select(F.col("a.type").alias("elem"))
        row = (readers.count_cfg(spark, path), structures.in_elements(atoms, 2).count())
    return spark.createDataFrame([row], "blocks long, atoms long")


def descriptor_text(df: DataFrame, of: list[str]) -> DataFrame:
    """`of` and value: descriptor blocks of df(of, atom_idx, elem, features), a block for each value of `of`."""
    line = F.concat_ws(" ", F.col("elem").cast("string"), writers.joined(F.col("features"), "%.6f"))
    rows = df.groupBy(*of).agg(F.array_sort(F.collect_list(F.struct("atom_idx", line.alias("l")))).alias("x"))  # atoms of one structure
    return rows.select(*of, F.concat(F.lit("#start "), F.size("x").cast("string"), F.lit("\n"), F.array_join(F.transform("x", lambda x: x["l"]), "\n")).alias("value"))


def line_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An atom a line, a structure an order: the type by ship status and line, two features."""
    li = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_linestatus") == "O", F.lit(0)).otherwise(1) + F.when(F.col("l_linenumber") > 5, F.lit(2)).otherwise(0)
    return li.select("l_orderkey", F.col("l_linenumber").alias("atom_idx"), kind.alias("elem"), F.array("l_quantity", "l_discount").alias("features"))


LINES = "d AS (SELECT l_orderkey, CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END + CASE WHEN l_linenumber > 5 THEN 2 ELSE 0 END AS elem, l_quantity AS a, l_discount AS b FROM lineitem)"


@query(f"WITH {LINES} SELECT elem::INTEGER AS elem, count(*) AS n, round(sum(a), 3) AS a, round(sum(b), 3) AS b, (SELECT count(DISTINCT l_orderkey) FROM d WHERE elem < 3) AS structures FROM d WHERE elem < 3 GROUP BY elem")
def descriptor_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptor blocks written and read back; a type beyond the elements drops out, and an order that has no other with it."""
    with folder(spark) as path:
        descriptor_text(line_descriptors(spark, sf_dir), ["l_orderkey"]).select("value").write.text(path)
        rows = stored(readers.read_descriptors(spark, path, elements=3))
    n = lineage.ranked(rows.select("file", "structure_id").distinct(), [F.col("file"), F.col("structure_id")]).agg((F.max("rank") + 1).alias("structures"))
    out = rows.groupBy("elem").agg(F.count("*").alias("n"), r(F.sum(F.get("features", F.lit(0))), 3).alias("a"), r(F.sum(F.get("features", F.lit(1))), 3).alias("b"))
    return out.crossJoin(F.broadcast(n))  # one row


@query("""WITH d AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS blocks, sum(n)::BIGINT AS atoms FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey) - 1 AS place FROM d) WHERE place % 3 = 0""")
def selected_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third block of a sequence of files, with its lines, copied by its number."""
    with folder(spark) as path:
        writers.write_text(descriptor_text(line_descriptors(spark, sf_dir), ["l_orderkey"]).withColumnRenamed("l_orderkey", "structure_id"), path)
        n = readers.blocks(spark, path, "#start", "\n").count()
        found = readers.select_blocks(spark, path, spark.range(0, n, 3).select(F.col("id").alias("structure_id")), across=True)
        return stored(found.agg(F.count("*").alias("blocks"), F.sum(F.size(F.split("value", "\n")) - 1).cast("long").alias("atoms")))


def dump_text(df: DataFrame, order: str) -> DataFrame:
    """structure_id and value: trajectory frames of df(structure_id, n_atoms, atoms), atoms being lines in any order."""
    box = "ITEM: BOX BOUNDS xy xz yz pp pp pp\n0.0 66.0 2.0\n0.0 32.0 0.0\n0.0 16.0 0.0\n"
    head = F.concat(F.lit("ITEM: TIMESTEP\n"), F.col(order).cast("string"), F.lit("\nITEM: NUMBER OF ATOMS\n"), F.col("n_atoms").cast("string"), F.lit(f"\n{box}ITEM: ATOMS id type x y z fx fy fz c_pe\n"))
    return df.select("structure_id", F.concat(head, F.array_join("atoms", "\n")).alias("value"))


@query(f"""SELECT {ATOMS.replace("'Ru'", "'Ni'")} AS symbol, count(*) AS n, round(sum(l_quantity), 3) AS x, round(sum(l_discount), 4) AS fy, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS frames, (SELECT round(-sum(l_extendedprice), 2) FROM lineitem) AS energy, round(64.0 * 32 * 16, 3)::DOUBLE AS volume FROM lineitem GROUP BY symbol""")
def trajectory_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with atoms out of order and a tilted box; a type beyond the elements counts as the last, the energy sums up."""
    li = table(spark, sf_dir, "lineitem")
    kind = F.element_at(F.create_map(F.lit("A"), F.lit(1), F.lit("N"), F.lit(2), F.lit("R"), F.lit(3)), F.col("l_returnflag"))
    line = F.concat_ws(" ", F.col("l_linenumber").cast("string"), kind.cast("string"), F.col("l_quantity").cast("string"), F.lit("1.0 2.0 0.0"), F.col("l_discount").cast("string"), F.lit("0.0"), F.format_string("%.2f", -F.col("l_extendedprice")))
    atoms = li.groupBy(F.col("l_orderkey").alias("structure_id")).agg(F.count("*").alias("n_atoms"), F.sort_array(F.collect_list(line), asc=False).alias("atoms"))  # seven at most
    with folder(spark) as path:
        writers.write_text(atoms, path, form=lambda s: dump_text(s, "structure_id"))
        found = stored(readers.read_dump(spark, path, ["Al", "Ni"]))
    whole = found.agg(F.count("*").alias("frames"), r(F.sum("energy"), 2).alias("energy"), r(F.max(tensors.volume(F.col("cell"))), 3).alias("volume"))
    each = found.select(F.explode(F.arrays_zip(F.col("symbols").alias("s"), F.col("positions").alias("p"), F.col("forces").alias("f"))).alias("a"))
    return each.groupBy(F.col("a.s").alias("symbol")).agg(F.count("*").alias("n"), r(F.sum(F.get("a.p", F.lit(0))), 3).alias("x"), r(F.sum(F.get("a.f", F.lit(1))), 4).alias("fy")).crossJoin(F.broadcast(whole))  # one row


@query("""WITH e AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 3 AS frame, (row_number() OVER (ORDER BY event_id) - 1) % 3 AS atom FROM events),
m AS (SELECT frame, atom, value, model, f, count(*) OVER (PARTITION BY model, frame) AS n FROM (SELECT e.*, t.model, t.f FROM e, (VALUES ('a', 1.0), ('b', 1.25), ('c', 0.5)) t(model, f)
  WHERE NOT (t.model = 'c' AND atom = 2 AND frame >= (SELECT max(frame) FROM e) // 2 AND frame % 2 = 0))),
k AS (SELECT min(k) AS k FROM (SELECT model, count(DISTINCT frame) FILTER (WHERE n = 3) AS k FROM m GROUP BY model))
SELECT frame AS structure_id, round(max(a), 6) AS amb_max, count(*) AS atoms FROM (SELECT frame, atom, sqrt(var_pop(value * f)) AS a FROM m, k WHERE frame < k GROUP BY frame, atom) GROUP BY frame""")
def ensemble_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps of three models, one of which loses an atom in every other frame of its later half: the prefix that holds for all,
    and the largest disagreement of each of its frames."""
    e = lineage.ranked(table(spark, sf_dir, "events").select("event_id", "value"), [F.col("event_id")])
    e = stored(e.select(F.floor(F.col("rank") / 3).alias("structure_id"), (F.col("rank") % 3).alias("atom"), "value"))
    half = F.lit(e.agg(F.max("structure_id")).first()[0] // 2)
    with folder(spark) as path:
        for model, factor in (("a", 1.0), ("b", 1.25), ("c", 0.5)):
            lost = (F.lit(model) == "c") & (F.col("atom") == 2) & (F.col("structure_id") >= half) & (F.col("structure_id") % 2 == 0)
            line = F.concat_ws(" ", (F.col("atom") + 1).cast("string"), F.lit("1 0.0 0.0 0.0"), (F.col("value") * factor).cast("string"), F.lit("0.0 0.0 0.0"))
            atoms = e.where(~lost).groupBy("structure_id").agg(F.count("*").alias("n_atoms"), F.sort_array(F.collect_list(line)).alias("atoms"))
            writers.write_text(atoms, f"{path}/{model}", form=lambda s: dump_text(s, "structure_id"))  # a trajectory is a sequence of files
        forces = stored(readers.read_ensemble(spark, {m: f"{path}/{m}" for m in "abc"}, ["Si"]))
    per_atom = metrics.ensemble_ambiguity(forces, ["structure_id", "atom_idx"])
    return per_atom.groupBy("structure_id").agg(r(F.max("ambiguity")).alias("amb_max"), F.count("*").alias("atoms"))


# ---- stores, builds, loops


@query("""SELECT event_type, count(*) AS n, round(sum(CASE WHEN event_type = 'view' THEN value * 2 ELSE value END), 2) AS total, event_type = 'view' AS parsed_again, event_type <> 'error' AS still_there FROM events WHERE event_type <> 'error' GROUP BY event_type""")
def descriptor_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptor files by event type in a store; then one type's files change and another's go, and the store is brought up to
    date. What it holds, and which types were parsed a second time."""
    e = table(spark, sf_dir, "events").select("event_type", "user_id", F.col("event_id").alias("atom_idx"), F.lit(0).alias("elem"), "value")
    of = ["event_type", "user_id"]

    def write(rows: DataFrame, path: str) -> None:
        texts = descriptor_text(rows.withColumn("features", F.array("value")), of)
        texts.select("event_type", "value").repartition("event_type").write.partitionBy("event_type").mode("overwrite").option("partitionOverwriteMode", "dynamic").text(path)

    kind = lambda c: F.regexp_extract(c, "event_type=([^/]+)", 1)
    with folder(spark) as path:
        files = store.FileStore(spark, f"{path}/store")
        write(e, f"{path}/out")
        files.update(f"{path}/out")
        write(e.where("event_type = 'view'").withColumn("value", F.col("value") * 2), f"{path}/out")
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/out/event_type=error")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
        again = files.update(f"{path}/out").parsed
        rows = stored(files.read().select(kind(F.col("file")).alias("event_type"), F.get("features", F.lit(0)).alias("value")))
    parsed = spark.createDataFrame([(f,) for f in again], "file string").select(kind(F.col("file")).alias("event_type"), F.lit(True).alias("parsed_again")).distinct()
    out = rows.groupBy("event_type").agg(F.count("*").alias("n"), r(F.sum("value"), 2).alias("total"))
    return out.join(parsed, "event_type", "left").fillna({"parsed_again": False}).withColumn("still_there", F.lit(True))


class Stopped(Exception):
    """A run that is stopped on purpose."""


def stop_at(steps: set[str]):
    """Raises at each of the steps once."""
    left = set(steps)

    def before(step: str) -> None:
        if step in left:
            left.remove(step)
            raise Stopped(step)

    return before


@query("""WITH p AS (SELECT p_partkey, p_size, p_retailprice FROM part), n AS (SELECT count(*) AS n FROM p)
SELECT 'source' AS kind, n AS n, n * 2 AS n_atoms, 5 AS runs FROM n UNION ALL SELECT 'random_displacement', 2 * n, 4 * n, 5 FROM n UNION ALL SELECT 'trajectory', (SELECT count(*) FROM p WHERE p_size % 2 = 0), 2 * (SELECT count(*) FROM p WHERE p_size % 2 = 0), 5 FROM n""")
def staged_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An initial dataset whose build is stopped in four places and gone on with each time: source structures, two strains of
    each, and the trajectory frames of even steps, of which those that are at rest are copies of the source and count once."""
    zero = F.lit(0.0)
    at = F.array(F.array(zero, zero, zero), F.array(F.col("p_size") / 8, F.lit(1.5), F.lit(2.25)))
    cell = F.array(F.col("p_partkey") + 8.0, zero, zero, zero, F.lit(8.0), zero, zero, zero, F.lit(8.0))
    base = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("structure_id"), F.array(F.lit("Si"), F.lit("Ge")).alias("symbols"), at.alias("positions"), cell.alias("cell"), F.lit(2).alias("n_atoms"), F.col("p_size").alias("step"))
    moved = base.withColumn("positions", F.transform("positions", lambda p: F.transform(p, lambda x: x + 0.125)))
    snapshots = base.unionByName(moved)
    settings, runs = build.Settings(strains=(0.97, 1.03), every=2), 0
    before = stop_at({"random_displacement", "mark of random_displacement", "candidates", "mark of candidates"})
    with folder(spark) as path:
        while True:
            runs += 1
            try:
                made = build.ensure_dataset(spark, path, base.drop("step"), settings, snapshots, before=before)
                break
            except Stopped:
                continue
        return stored(made.table.groupBy("kind").agg(F.count("*").alias("n"), F.sum("n_atoms").alias("n_atoms"))).withColumn("runs", F.lit(runs))


WEEKS = 4


@query("""WITH RECURSIVE e AS (SELECT user_id, day(ts) AS d, value FROM events WHERE value > 90), f AS (SELECT user_id, (CASE WHEN d > 16 THEN 1 ELSE 0 END) AS main, least(3, ((d - 1) % 16) // 4) AS gen FROM e),
s(main, gen, stop, n_selected, n_pool, n_flushed, seen) AS (
  SELECT -1, 3, TRUE, 0::BIGINT, 0::BIGINT, 0::BIGINT, []::BIGINT[] UNION ALL
  SELECT p.main, p.gen, p.n = 0 OR p.gen = 3, p.n, CASE WHEN p.n > 0 AND p.n + p.pool >= 100 THEN 0 ELSE p.n + p.pool END, CASE WHEN p.n > 0 AND p.n + p.pool >= 100 THEN p.n + p.pool ELSE 0 END, list_concat(p.seen, p.own) FROM (
    SELECT q.main, q.gen, q.pool, q.seen, coalesce(len(q.own), 0)::BIGINT AS n, coalesce(q.own, []) AS own FROM (
      SELECT w.main, w.gen, w.pool, w.seen, (SELECT list(DISTINCT user_id) FROM f WHERE f.main = w.main AND f.gen = w.gen AND NOT list_contains(w.seen, user_id)) AS own FROM (
        SELECT CASE WHEN s.stop THEN s.main + 1 ELSE s.main END AS main, CASE WHEN s.stop THEN 0 ELSE s.gen + 1 END AS gen, s.n_pool AS pool, s.seen FROM s) w WHERE w.main < 2) q) p)
SELECT main::INTEGER AS main, gen::INTEGER AS gen, CASE WHEN n_selected > 0 THEN 'done' ELSE 'ended' END AS status, n_selected, n_pool, n_flushed FROM s WHERE main >= 0""")
def generation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outer loops of four generations, stopped in five places and gone on with: a generation selects the users with a value
    above 90 whom no earlier one has, a hundred fill the pool, and one that selects nobody ends its loop."""
    e = stored(table(spark, sf_dir, "events").where("value > 90").select("user_id", F.dayofmonth("ts").alias("d")).withColumns({"at_main": (F.col("d") > 16).cast("int"), "at_gen": F.least(F.lit(3), F.floor((F.col("d") - 1) % 16 / 4).cast("int"))}))

    def choose(batch: DataFrame, seen: DataFrame | None, _: generations.Position) -> DataFrame:
        users = batch.select("user_id").distinct()
        return users if seen is None else users.join(seen.select("user_id"), "user_id", "left_anti")

    def draw(at: generations.Position) -> DataFrame:
        return e.where((F.col("at_main") == at.main) & (F.col("at_gen") == at.gen))

    with folder(spark) as path:
        before = stop_at({"start", "select", "flush", "done"})
        loop = generations.Generations(spark, path, 2, WEEKS, 100, choose, before)
        for _ in range(5):
            try:
                loop.run(draw)
            except Stopped:
                continue
        loop.step(generations.Position(0, 0), draw(generations.Position(0, 0)))  # a generation that is done runs no more
        return stored(loop.history())


@query("""WITH g AS (SELECT event_type, day(ts)::INTEGER AS gen, avg(value) > 50.5 AS label FROM events GROUP BY ALL), k AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY gen) = 1 THEN 0 ELSE label::INT END AS kept FROM g)
SELECT event_type, gen, label, coalesce(sum(kept) OVER w, 0)::BIGINT AS raised, round(0.2 * (1 + coalesce(sum(kept) OVER w, 0)), 6)::DOUBLE AS limit_now FROM k WINDOW w AS (PARTITION BY event_type ORDER BY gen ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def limit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit of each generation, a day of a type, from records of which every generation has three: only its last counts."""
    daily = table(spark, sf_dir, "events").groupBy("event_type", F.dayofmonth("ts").alias("gen")).agg((F.avg("value") > 50.5).alias("label"))
    runs = daily.withColumn("at", F.explode(F.sequence(F.lit(1), F.lit(3)))).withColumn("label", F.when(F.col("at") == 3, F.col("label")).otherwise(~F.col("label")))
    return generations.limits(runs, 0.2, key=["event_type"]).select("event_type", "gen", "label", "raised", r("limit").alias("limit_now"))


# ---- symmetry


def group_of(*generators: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The rotations that some make, in order."""
    product = lambda a, b: tuple(sum(a[3 * i + k] * b[3 * k + j] for k in range(3)) for i in range(3) for j in range(3))
    found = {symmetry.IDENTITY}
    while len(more := found | {product(a, g) for a in found for g in generators}) > len(found):
        found = more
    return sorted(found)


FOURFOLD, THREEFOLD, TWOFOLD = (0, -1, 0, 1, 0, 0, 0, 0, 1), (0, 0, 1, 1, 0, 0, 0, 1, 0), (1, 0, 0, 0, -1, 0, 0, 0, -1)
INVERSION, HEXAGONAL = (-1, 0, 0, 0, -1, 0, 0, 0, -1), (0, -1, 0, 1, -1, 0, 0, 0, 1)
GROUPS = [group_of(), group_of(INVERSION), group_of(FOURFOLD), group_of(THREEFOLD), group_of(HEXAGONAL), group_of(TWOFOLD, INVERSION), group_of(FOURFOLD, THREEFOLD), group_of(TWOFOLD, THREEFOLD)]

_det = lambda a, b, c: f"({a}[1] * ({b}[2] * {c}[3] - {b}[3] * {c}[2]) - {a}[2] * ({b}[1] * {c}[3] - {b}[3] * {c}[1]) + {a}[3] * ({b}[1] * {c}[2] - {b}[2] * {c}[1]))"
_turn = lambda m, d: "[" + ", ".join(" + ".join(f"{m}[{3 * i + j + 1}] * {d}[{j + 1}]" for j in range(3)) for i in range(3)) + "]"


@query(f"""WITH g AS (SELECT * FROM (VALUES {", ".join(f"({i}, {[list(m) for m in ms]})" for i, ms in enumerate(GROUPS))}) t(grp, ms)), dirs AS (SELECT * FROM (VALUES {", ".join(f"({i}, {list(d)})" for i, d in enumerate(symmetry.DIAGONAL))}) t(pos, d)),
m AS (SELECT grp, unnest(ms) AS m, generate_subscripts(ms, 1) AS r FROM g), im AS (SELECT grp, pos, d, r, m, {_turn("m", "d")} AS im FROM m, dirs),
one AS (SELECT a.grp, min(a.pos) AS pos FROM im a JOIN im b ON a.grp = b.grp AND a.pos = b.pos AND a.r < b.r WHERE {_det("a.d", "a.im", "b.im")} <> 0 GROUP BY a.grp),
two AS (SELECT grp, min(struct_pack(pos := im.pos, r := r, s := dirs.pos)) AS x FROM im, dirs WHERE grp NOT IN (SELECT grp FROM one) AND {_det("im.d", "im.im", "dirs.d")} <> 0 GROUP BY grp),
trig AS (SELECT two.grp, im.im AS second, {_turn("im.m", "im.im")} AS third, {_turn("im.m", _turn("im.m", "im.im"))} = im.d AS threefold FROM two JOIN im ON im.grp = two.grp AND im.pos = two.x.pos AND im.r = two.x.r),
f AS (SELECT grp, 0 AS place, d FROM one JOIN dirs USING (pos) UNION ALL SELECT grp, 0, d FROM two JOIN dirs ON dirs.pos = two.x.pos UNION ALL SELECT grp, 3, d FROM two JOIN dirs ON dirs.pos = two.x.s
  UNION ALL SELECT grp, 1, second FROM trig WHERE threefold UNION ALL SELECT grp, 2, third FROM trig WHERE threefold
  UNION ALL SELECT grp, pos, d FROM g, dirs WHERE pos < 3 AND grp NOT IN (SELECT grp FROM one) AND grp NOT IN (SELECT grp FROM two)),
b AS (SELECT grp, place, 0 AS sign, d FROM f UNION ALL SELECT grp, place, 1, list_transform(d, lambda x: -x) FROM f WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.grp = f.grp AND {_turn("m.m", "f.d")} = list_transform(f.d, lambda x: -x))),
k AS (SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY place, sign) - 1 AS k, d FROM b)
SELECT p_partkey, k::INTEGER AS k, list_aggregate(d, 'string_agg', ' ') AS direction, round(0.03 * d[1] * 8 / sqrt((d[1] * 8) ** 2 + (d[2] * 8) ** 2 + (d[3] * p_size) ** 2), 9)::DOUBLE AS dx FROM part JOIN k ON k.grp = p_partkey % {len(GROUPS)}""")
def displacement_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directions of sites whose symmetry is one of eight groups, by the part's number, with the trigonal rule; lengths of 0.03."""
    p, zero = table(spark, sf_dir, "part"), F.lit(0.0)
    matrices = F.array(*[F.array(*[symmetry.literal(m) for m in ms]) for ms in GROUPS])
    cell = F.array(F.lit(8.0), zero, zero, zero, F.lit(8.0), zero, zero, zero, F.col("p_size").cast("double"))
    sites = p.select(F.col("p_partkey").alias("structure_id"), F.lit(0).alias("atom_idx"), cell.alias("cell"), F.get(matrices, (F.col("p_partkey") % len(GROUPS)).cast("int")).alias("rotations"))
    out = structures.displacements(sites, 0.03, trigonal=True)
    return out.select(F.col("structure_id").alias("p_partkey"), "k", F.array_join(F.transform("direction", lambda x: x.cast("int").cast("string")), " ").alias("direction"), r("dx", 9).alias("dx"))


@query("""WITH c AS (SELECT p_partkey, 4 + p_size % 3 AS a, 4 + p_partkey % 3 AS b, 4 + p_size % 2 AS c FROM part)
SELECT p_partkey, 0 AS atom_idx, CASE WHEN a = b AND b = c THEN 48 WHEN a = b OR b = c OR a = c THEN 16 ELSE 8 END AS n_rotations FROM c
UNION ALL SELECT p_partkey, 1, CASE WHEN a = b AND b = c THEN 48 WHEN a = b OR b = c OR a = c THEN 16 ELSE 8 END FROM c""")
def site_rotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotations about the two atoms, of two kinds, in the corner and the middle of boxes with edges of 4 to 6."""
    zero, n = F.lit(0.0), lambda c, m: (F.col(c) % m + 4).cast("double")
    a, b, c = n("p_size", 3), n("p_partkey", 3), n("p_size", 2)
    at = F.array(F.array(zero, zero, zero), F.array(a / 2, b / 2, c / 2))
    s = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("structure_id"), F.array(F.lit("Cs"), F.lit("Cl")).alias("symbols"), at.alias("positions"), F.array(a, zero, zero, zero, b, zero, zero, zero, c).alias("cell"))
    return symmetry.sites(s).select(F.col("structure_id").alias("p_partkey"), "atom_idx", F.size("rotations").alias("n_rotations"))


# ---- clusters

POINTS = "p AS (SELECT l_returnflag AS flag, l_orderkey * 10 + l_linenumber AS id, l_quantity AS x, l_extendedprice / 1037 AS y FROM lineitem)"


def line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1037).alias("y"))


def _side(threshold: float) -> str:
    return f"{cluster.side(threshold, 2)!r}::DOUBLE"


@query(f"""WITH {POINTS}, f AS (SELECT flag, floor(x / {_side(8.0)})::BIGINT AS cx, floor(y / {_side(8.0)})::BIGINT AS cy, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS ss FROM p GROUP BY ALL)
SELECT flag, cx, cy, n, round(sx, 3) AS sx, round(sy, 3) AS sy, round(sqrt(greatest(ss / n - (sx / n) ** 2 - (sy / n) ** 2, 0)), 3) AS radius FROM f WHERE n > 1""")
def clustering_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of cells of threshold 8, made of those of threshold 2 by joining twice; lone points have no radius to tell."""
    fine = cluster.summarise(line_points(spark, sf_dir), ["x", "y"], 2.0, ["flag"])
    f = cluster.coarser(cluster.coarser(fine, ["flag"]), ["flag"]).where("n > 1")
    at = lambda c, i: F.get(c, F.lit(i))
    return f.select("flag", at("cell", 0).alias("cx"), at("cell", 1).alias("cy"), "n", r(at("sums", 0), 3).alias("sx"), r(at("sums", 1), 3).alias("sy"), r(cluster.radius(F.col("n"), F.col("sums"), F.col("squares")), 3).alias("radius"))


THRESHOLDS = [64.0 / 2**i for i in range(12)]


@query(f"""WITH {POINTS}, t AS (SELECT * FROM (VALUES {", ".join(f"({i}, {_side(t)})" for i, t in enumerate(THRESHOLDS))}) t(i, side)), c AS (SELECT i, side, count(DISTINCT (floor(x / side), floor(y / side))) AS cells FROM p, t GROUP BY ALL),
u AS (SELECT side FROM c WHERE cells >= 40 ORDER BY i LIMIT 1), q AS (SELECT id, x, y, floor(x / side) AS cx, floor(y / side) AS cy FROM p, u),
k AS (SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY x DESC, id) AS r FROM q)
SELECT id, round(x, 3) AS x, (SELECT count(DISTINCT (cx, cy)) FROM q) AS n_cells FROM k WHERE r <= 2""")
def rerun_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold is halved from 64 until there are 40 cells; two points of each cell are picked by the largest x."""
    points = line_points(spark, sf_dir)
    threshold = cluster.adapted(points, ["x", "y"], 64.0, 40)
    placed = points.withColumn("cluster", cluster.cell_of(["x", "y"], threshold))
    cells = placed.groupBy("cluster").agg(F.least(F.count("*"), F.lit(2)).alias("k"))
    picked = select.topk_in_cluster(placed, "cluster", "x", "id", cells)
    return picked.select("id", r("x", 3).alias("x")).crossJoin(F.broadcast(cells.agg(F.count("*").alias("n_cells"))))  # one row


@query("""WITH p AS (SELECT user_id, max(value) AS a, min(value) AS b FROM events GROUP BY user_id) SELECT 12 AS clusters, count(*) AS n, TRUE AS whole FROM p""")
def merged_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users in twelve clusters merged from features; whether each cell is in one cluster."""
    points = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("value").alias("a"), F.min("value").alias("b"))
    placed, threshold = cluster.cluster(points, ["a", "b"], 12, 4.0)
    placed = stored(placed)
    cells = placed.groupBy(cluster.cell_of(["a", "b"], threshold).alias("cell")).agg(F.countDistinct("cluster").alias("k"))
    return placed.agg(F.countDistinct("cluster").cast("int").alias("clusters"), F.count("*").alias("n")).crossJoin(F.broadcast(cells.agg((F.max("k") == 1).alias("whole"))))  # one row


# ---- coverage by body

BODIES = {"two": [0, 1, 2, 3], "three": [4, 5, 6, 7, 8, 9], "four": [2, 60, 63]}


BODY_SQL = f"""WITH e AS (SELECT vec_id AS id, label AS elem, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings), x AS (SELECT *, (id % 8) // 2 - 1 AS main FROM e WHERE id % 2 = 0), q AS (SELECT * FROM e WHERE id % 2 = 1),
g0 AS (SELECT elem, dim, count(*) AS n, min(v) AS a, max(v) AS z, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM q GROUP BY elem, dim),
g1 AS (SELECT *, CASE WHEN 2.0::DOUBLE * iqr / pow(n, 1.0::DOUBLE / 3) > 0 THEN 2.0::DOUBLE * iqr / pow(n, 1.0::DOUBLE / 3) ELSE z - a END AS w FROM g0),
g AS (SELECT *, CASE WHEN z > a THEN greatest(1, floor((z - a) / w)) ELSE 1 END AS nb FROM g1),
qc AS (SELECT q.elem, q.dim, CASE WHEN v >= a AND v < z THEN least(floor((v - a) / ((z - a) / nb)), nb - 1) END AS cell FROM q JOIN g USING (elem, dim)),
l AS (SELECT main, row_number() OVER (ORDER BY main) - 1 AS pos FROM (SELECT DISTINCT main FROM x)),
xc AS (SELECT x.elem, x.dim, least(floor((v - a) / ((z - a) / nb)), nb - 1) AS cell, min(pos) AS first FROM x JOIN g USING (elem, dim) JOIN l USING (main) WHERE v >= a AND v < z GROUP BY ALL),
c AS (SELECT l.pos, l.main, qc.elem, qc.dim, count(*) AS n_query, count(*) FILTER (WHERE first <= l.pos) AS n_covered FROM qc CROSS JOIN l LEFT JOIN xc ON xc.elem = qc.elem AND xc.dim = qc.dim AND xc.cell = qc.cell GROUP BY ALL),
s AS (SELECT pos, main, elem, max(n_query) AS n_query, avg(n_covered / n_query::DOUBLE) AS all_dims, avg(n_covered) AS mean_covered, {", ".join(f"avg(CASE WHEN dim IN ({', '.join(map(str, d))}) THEN n_covered / n_query::DOUBLE END) AS {b}" for b, d in BODIES.items())} FROM c GROUP BY ALL),
i AS (SELECT l.pos, y.elem, count(*) AS n_input FROM (SELECT DISTINCT id, elem, main FROM x) y JOIN l y0 ON y.main = y0.main JOIN l ON y0.pos <= l.pos GROUP BY ALL)
SELECT s.pos::INTEGER AS label_pos, CASE WHEN main = -1 THEN 'init' ELSE 'loop-' || (main + 1) END AS label, s.elem, n_query, n_input, round(all_dims, 10) AS coverage_1d, round(mean_covered, 10) AS mean_covered, {", ".join(f"round({b}, 10) AS {b}" for b in BODIES)} FROM s JOIN i USING (pos, elem)"""


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vectors of even ids in four versions, and those of odd ids."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("structure_id"), F.lit(0).alias("atom_idx"), F.col("label").alias("elem"), F.transform("embedding", lambda x: x.cast("double")).alias("features"))
    data = e.where("structure_id % 2 = 0").withColumn("main", (F.floor(F.col("structure_id") % 8 / 2) - 1).cast("int"))
    return data, e.where("structure_id % 2 = 1")


@query(BODY_SQL)
def coverage_by_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-dimensional coverage of half of the vectors by four cumulative versions of the other half, by body."""
    out = report.coverage_by_body(*halves(spark, sf_dir), BODIES)
    return out.select("label_pos", "label", "elem", "n_query", "n_input", r("coverage_1d", 10).alias("coverage_1d"), r("mean_covered_1d", 10).alias("mean_covered"), *[r(f"coverage_1d_{b}", 10).alias(b) for b in BODIES])


# ---- small rules


@query("""SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY l_returnflag, l_linenumber) AS symbols, string_agg(l_linenumber::VARCHAR, '' ORDER BY l_returnflag, l_linenumber) AS places FROM lineitem GROUP BY l_orderkey""")
def sorted_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atoms in order of symbol, as they came within one; their places tell the order."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("a"))  # seven lines at most
    s = rows.select("l_orderkey", F.transform("a", lambda x: x["l_returnflag"]).alias("symbols"), F.transform("a", lambda x: F.array(x["l_linenumber"].cast("double"))).alias("positions"))
    return structures.sort_atoms(s).select("l_orderkey", F.array_join("symbols", "").alias("symbols"), F.array_join(F.transform("positions", lambda p: F.get(p, F.lit(0)).cast("int").cast("string")), "").alias("places"))


@query("""SELECT p_partkey, s AS strain, round(p_size / 8.0 * s, 8)::DOUBLE AS x, round((p_size + 1) * 4 * 2 * s * s * s, 6)::DOUBLE AS volume FROM part, (VALUES (0.97::DOUBLE), (1.0), (1.03)) t(s)""")
def strained_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three strains of a structure a part, without noise: places move with the cell."""
    zero = F.lit(0.0)
    s = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("structure_id"), F.array(F.lit("Si")).alias("symbols"), F.array(F.array(F.col("p_size") / 8, zero, zero)).alias("positions"), F.array(F.col("p_size") + 1.0, zero, zero, zero, F.lit(4.0), zero, zero, zero, F.lit(2.0)).alias("cell"), F.lit(1).alias("n_atoms"))
    out = structures.strain_and_rattle(s, [0.97, 1.0, 1.03], 0, 0.01, 7)
    return out.select(F.col("structure_id").alias("p_partkey"), "strain", r(F.get(F.get("positions", F.lit(0)), F.lit(0)), 8).alias("x"), r(tensors.volume(F.col("cell"))).alias("volume"))


@query("""SELECT event_type, count(*) AS base, greatest(1, ceil(count(*) * 2.5 / 100))::BIGINT AS share, 10::BIGINT AS nothing, 37::BIGINT AS fixed FROM events GROUP BY event_type""")
def pool_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a pool of each type is handed on: a share of the rows there are, the default, and a number."""
    base = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("base")).collect()  # a row a type
    rows = [(x.event_type, x.base, text.trigger("2.5%", x.base), text.trigger(None, x.base), text.trigger("37", x.base)) for x in base]
    return spark.createDataFrame(rows, "event_type string, base long, share long, nothing long, fixed long")


STAGES = [60.0, [80.0, 85.0, 90.0, 95.0, 99.0], [99.5]]


@query(f"""WITH {EV}, c AS (SELECT elem, 100.0::DOUBLE * avg((value > 20)::INT::DOUBLE) AS rate, row_number() OVER (ORDER BY elem) AS i FROM e GROUP BY elem), g AS (SELECT * FROM (VALUES (0, [60.0, 60, 60, 60, 60], 40), (1, [80.0, 85, 90, 95, 99], 20), (2, [99.5, 99.5, 99.5, 99.5, 99.5], 10)) t(stage, ts, budget)),
x AS (SELECT stage, elem, rate, ts[i] AS threshold, budget FROM g, c)
SELECT coalesce((SELECT budget FROM x WHERE rate < threshold ORDER BY stage, threshold LIMIT 1), 0)::INTEGER AS budget, (SELECT bool_and(rate > t) FROM (SELECT elem, rate, max(threshold) AS t FROM x GROUP BY elem, rate)) AS converged, 99.5::DOUBLE AS target""")
def budget_by_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The budget of a schedule with a threshold for each element in one stage, one for all in others; and the target."""
    rates = event_values(spark, sf_dir).groupBy("elem").agg((F.lit(100.0) * F.avg((F.col("value") > 20).cast("double"))).alias("coverage"))
    elements = sorted(x.elem for x in rates.select("elem").collect())  # a row a type
    rows, scalar = select.schedule(STAGES, len(elements))
    stages = spark.createDataFrame([(s, e, row[i], (40, 20, 10)[s]) for s, row in enumerate(rows) for i, e in enumerate(elements)], "stage int, elem string, threshold double, budget int")
    return select.budget(rates, stages, scalar).withColumn("target", F.lit(select.target(STAGES)))


@query("""SELECT event_id, printf('% .8f', value) AS signed, printf('%16.8f', -value) AS wide, printf('%.10f', value / 3) AS fine FROM events""")
def formatted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as structure files have them."""
    v = F.col("value")
    one = lambda x, form: writers.joined(F.array(x), form)
    return table(spark, sf_dir, "events").select("event_id", one(v, "% .8f").alias("signed"), one(-v, "%16.8f").alias("wide"), one(v / 3, "%.10f").alias("fine"))


@query("""SELECT DISTINCT unnest([p_brand, 'x' || (p_size % 7)]) AS symbol FROM part UNION SELECT DISTINCT s_name FROM supplier""")
def elements_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The elements of two sources, each once."""
    a = table(spark, sf_dir, "part").select(F.array("p_brand", F.concat(F.lit("x"), (F.col("p_size") % 7).cast("string"))).alias("symbols"))
    b = table(spark, sf_dir, "supplier").select(F.array("s_name").alias("symbols"))
    return structures.distinct_elements(a.union(b))


LOOPS_AGAIN = "[4, loop-7, 8, 4, loop_7, 8]"


@query("""WITH l AS (SELECT DISTINCT year(o_orderdate)::INTEGER - 1993 AS main FROM orders) SELECT main, CASE main WHEN 4 THEN 0 WHEN 6 THEN 1 ELSE 2 END AS place FROM l WHERE main IN (4, 6, 8)""")
def loops_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loops named more than once count once, in the order in which they are first named."""
    labels = lineage.discover_labels(table(spark, sf_dir, "orders").select((F.year("o_orderdate") - 1993).alias("main")))
    named = {m: i for i, m in enumerate(lineage.parse_loops(LOOPS_AGAIN))}
    place = F.array_position(F.array(*[F.lit(m) for m in named]), F.col("main").cast("int")).cast("int") - 1
    return labels.select(F.col("main").cast("int").alias("main"), place.alias("place")).where("place >= 0")


@query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Si' WHEN 1 THEN 'O' WHEN 2 THEN 'Fe' ELSE 'He' END AS symbol, CASE p_size % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 2 END::INTEGER AS elem FROM part""")
def atomic_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type numbers in order of atomic number, whatever the order in which the elements are named."""
    names = F.array(*[F.lit(x) for x in ("Si", "O", "Fe", "He")])
    rows = table(spark, sf_dir, "part").select("p_partkey", F.get(names, F.col("p_size") % 4).alias("symbol"))
    return structures.element_index(rows, ["Fe", "Si", "O"], by_number=True)


def part_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A structure of two atoms a part, of four elements."""
    zero, names = F.lit(0.0), F.array(*[F.lit(x) for x in ("Si", "O", "Fe", "H")])
    size = F.col("p_size")
    at = F.array(F.array(zero, zero, zero), F.array(size / 8, F.lit(1.5), F.lit(2.25)))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("structure_id"), F.array(F.get(names, size % 4), F.lit("O")).alias("symbols"), at.alias("positions"), F.array(F.lit(8.0), zero, zero, zero, F.lit(8.0), zero, zero, zero, F.lit(8.0)).alias("cell"))


@query("""WITH s AS (SELECT unnest([CASE p_size % 4 WHEN 0 THEN 'Si' WHEN 1 THEN 'O' WHEN 2 THEN 'Fe' ELSE 'H' END, 'O']) AS symbol FROM part) SELECT symbol, CASE symbol WHEN 'H' THEN 0 WHEN 'O' THEN 1 WHEN 'Si' THEN 2 ELSE 3 END AS elem, count(*) AS n FROM s GROUP BY symbol""")
def sorted_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks whose types are numbered by the elements that there are, in order of atomic number."""
    with folder(spark) as path:
        s = part_blocks(spark, sf_dir)
        writers.write_text(writers.cfg_text(s), path)
        atoms = readers.read_cfg(spark, path, writers.elements_in(s)).select(F.explode(F.arrays_zip(F.col("symbols").alias("s"), F.col("atoms").alias("a"))).alias("x"))
        return stored(atoms.groupBy(F.col("x.s").alias("symbol"), F.col("x.a.type").alias("elem")).agg(F.count("*").alias("n")))


@query("""WITH s AS (SELECT unnest([CASE p_size % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'Li' WHEN 2 THEN 'Be' ELSE 'B' END, 'Li']) AS symbol FROM part) SELECT symbol, count(*) AS n, (SELECT count(*) FROM part) AS blocks, 0::BIGINT AS strict_blocks FROM s GROUP BY symbol""")
def universal_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type numbers read as those of the universal elements; blocks by first lines that stand apart, which the strict count passes over."""
    with folder(spark) as path:
        order = ["Si", "O", "Fe", "H"]
        texts = writers.cfg_text(part_blocks(spark, sf_dir), order).withColumn("value", F.regexp_replace("value", "BEGIN_CFG", " BEGIN_CFG "))
        writers.write_text(texts, path)
        atoms = readers.read_cfg(spark, path, "universal").select(F.explode("symbols").alias("symbol"))
        counts = [F.lit(readers.count_cfg(spark, path, strict)).cast("long").alias(name) for name, strict in (("blocks", False), ("strict_blocks", True))]
        return stored(atoms.groupBy("symbol").agg(F.count("*").alias("n")).select("symbol", "n", *counts))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'run-' || user_id WHEN 2 THEN 'set.v1' ELSE event_type END AS label, CASE event_id % 4 WHEN 0 THEN '/data/x=' || user_id WHEN 1 THEN '/data/run-' || user_id || '.xyz' WHEN 2 THEN 'set.v1.cfg' ELSE '/data/' || event_type || '/' END AS path FROM events""")
def label_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, user = F.col("event_id") % 4, F.col("user_id").cast("string")
    named = F.concat(F.lit(" "), F.col("event_type"), F.lit(" = /data/x="), user)
    given = F.when(e == 0, named).when(e == 1, F.concat(F.lit("/data/run-"), user, F.lit(".xyz"))).when(e == 2, F.lit("set.v1.cfg")).otherwise(F.concat(F.lit("/data/"), F.col("event_type"), F.lit("/")))
    return table(spark, sf_dir, "events").select("event_id", text.label_path(given).alias("x")).select("event_id", "x.label", "x.path")


@query("""WITH s AS (SELECT DISTINCT user_id, user_id % 3 = 0 AS selected FROM events)
SELECT 'candidate_only' AS mode, 'fd' AS dq_width_method, count(*) AS input_count, (SELECT count(*) FROM customer)::BIGINT AS current_count, count(*) FILTER (WHERE selected) AS selected_from_input, count(*) FILTER (WHERE NOT selected) AS remain_from_input,
  count(*) FILTER (WHERE selected) + (SELECT count(*) FROM customer) AS output_count, TRUE AS parses FROM s""")
def reduce_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a selection as a report, and whether its JSON reads back as the same row."""
    flagged = table(spark, sf_dir, "events").select(F.col("user_id").alias("structure_id"), (F.col("user_id") % 3 == 0).alias("selected")).distinct()
    current = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("structure_id"))
    row = stored(writers.reduce_report(flagged, "candidate_only", {"dq_width_method": "fd"}, current, append_current=True))
    back = writers.report(row).select(F.from_json("value", row.schema).alias("x")).select("x.*").first()
    return row.withColumn("parses", F.lit(back == row.first()))


@query("""SELECT l_returnflag AS kind, count(*) AS n, round(sum(printf('%.8f', l_quantity * 1.0)::DOUBLE), 4) AS truth, round(sum(printf('%.8f', l_discount * 100)::DOUBLE), 4) AS pred FROM lineitem GROUP BY kind""")
def error_point_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of error points, written by kind and summed after reading them back."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("kind"), F.col("l_quantity").alias("truth"), (F.col("l_discount") * 100).alias("pred"))
    with folder(spark) as path:
        writers.error_points(pairs).write.partitionBy("kind").text(path)
        rows = spark.read.text(path).select("kind", F.split("value", ",").alias("x"))
        at = lambda i: F.get("x", F.lit(i)).cast("double")
        return stored(rows.groupBy("kind").agg(F.count("*").alias("n"), r(F.sum(at(0)), 4).alias("truth"), r(F.sum(at(1)), 4).alias("pred")))
