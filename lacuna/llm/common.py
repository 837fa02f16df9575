"""Shared plumbing of the training-data operators: checkpoints, bounded samples, components, ranks."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
#: Rows of a table of narrow rows that may be broadcast.
SMALL_ROWS = 100_000
HAS_LETTER = re.compile(r"[^\W\d_]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and reads it back, which ends its lineage.

    The folder is the one named in spark.checkpoint.dir.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only within one process (tests) a local one is made where that is unset."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="lacuna-")


def small_side(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """df with a broadcast hint if it is counted to hold at most `rows` rows, else df as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def id_crc(column: str) -> Column:
    """crc32 of the id written as text; a null id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8"))


def labelled_sample(docs: DataFrame, per_label: int, label: str | None = None, known: DataFrame | None = None) -> list[tuple[str, object]]:
    """(text, label) of at most `per_label` different texts of each label, chosen by text hash.

    docs(doc_id, text) has the column `label`, or known(doc_id, y) has the labels. Copies of a text count once; rows with
    null label or text are left out. The choice depends on the rows only, not on their order or partitions. Labels meet
    text hashes, never texts: only the chosen texts leave their tasks, per_label for each label value, to the driver. Hashes
    are spread evenly, so that a share of their range holds a few times per_label rows of a label; it is widened where it
    holds fewer than wanted, and only its rows are ranked.
    """
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").alias("t"), F.xxhash64("text").alias("h"), *([F.col(label).alias("y")] if label else []))
    keys = (rows if label else rows.select("doc_id", "h").join(known, "doc_id")).where("y is not null").select("y", "h").distinct()
    keys = cut(keys)
    counts = {r.y: r.n for r in keys.groupBy("y").agg(F.count("*").alias("n")).collect()}  # a row for each label value
    share = {y: min(1.0, 4 * per_label / n) for y, n in counts.items()}
    while True:
        ends = [(y, min((1 << 63) - 1, int(s * (1 << 64)) - (1 << 63))) for y, s in share.items()]
        held = keys.join(small_side(keys.sparkSession.createDataFrame(ends, f"y {keys.schema['y'].dataType.simpleString()}, upto long")), "y").where("h <= upto").select("y", "h")
        found = {r.y: r.n for r in held.groupBy("y").agg(F.count("*").alias("n")).collect()}
        short = [y for y, n in counts.items() if found.get(y, 0) < min(n, per_label)]
        if not short:
            break
        share |= {y: min(1.0, 4 * share[y]) for y in short}
    keys = held.withColumn("r", F.row_number().over(Window.partitionBy("y").orderBy("h"))).where(F.col("r") <= per_label).drop("r")
    keys = cut(keys)  # per_label rows a label value at most
    texts = rows.select("t", "h").join(small_side(keys.select("h").distinct()), "h").groupBy("h").agg(F.min("t").alias("t"))
    picked = texts.join(small_side(keys), "h")
    return [(r.t, r.y) for r in sorted(picked.collect(), key=lambda r: (str(r.y), r.h))]


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, root), root being the smallest node reachable.

    Alternates large-star and small-star steps, each one shuffle on the node, until the edges stop changing. Only a
    count and a checksum reach the driver. Nodes without edges are not returned. Raises if `limit` rounds don't settle.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e)

    def mark(x: DataFrame) -> tuple:
        r = x.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return r.n, r.s

    before = mark(e)
    for _ in range(limit):
        if not before[0]:
            break
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        e = cut(small)
        after = mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {limit} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def ranked(df: DataFrame, key: list[str], order: list[str], rank: str, rows_a_salt: int = 1_000_000) -> DataFrame:
    """Adds a gapless rank from 0 within each key, without bringing a hot key's rows to one task. df must not change when it is
    read again.

    Rows of a key are dealt into salts by a hash of `order` and of their place in the table, so that rows equal in `order` are
    dealt too; they are ranked within (key, salt), and moved up by the number of rows in earlier salts. The number of salts
    grows with the table.
    """
    salts = max(64, df.count() // rows_a_salt)
    df = df.withColumn("_place", F.monotonically_increasing_id())
    df = df.withColumn("_salt", F.pmod(F.xxhash64(*order, "_place"), F.lit(salts)).cast("int"))
    counts = df.groupBy(*key, "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*key, "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    within = df.withColumn("_within", F.row_number().over(Window.partitionBy(*key, "_salt").orderBy(*order, "_place")))
    return within.join(counts, [*key, "_salt"]).withColumn(rank, F.col("_within") - 1 + F.col("_before")).drop("_place", "_salt", "_within", "_before")
