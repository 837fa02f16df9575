"""Outer loops of generations that go on where an earlier run stopped.

A generation draws its batch, selects from it, adds the selection to the pool, and hands the pool to the training set when it
reaches its trigger. Its history is one partition (main, gen) with what it did, written when it starts and again when it is
done. Where to go on follows from the history alone, as the last outer loop with a generation and that loop's last generation:
one that is not done is run again, one that ended its loop or was the last allowed is followed by the next outer loop.

Everything that a generation writes is a partition of its own that a repeated run replaces: the selection is made once and
read back after that, the pool holds it once, and the training set takes a flush once. Hence a run that is killed at any step
and started again leaves the tables that an undisturbed run leaves.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HISTORY = "main int, gen int, status string, n_selected long, n_pool long, n_flushed long"
STARTED, DONE, ENDED = "started", "done", "ended"


class Position(NamedTuple):
    main: int
    gen: int


def last_position(history: DataFrame) -> DataFrame:
    """main, gen and status of the last generation of history(main, gen, status, ...): one row, none without history."""
    last = F.max_by(F.struct("main", "gen", "status"), F.struct("main", "gen"))
    return history.agg(last.alias("x")).where("x is not null").select("x.*")


def next_position(history: DataFrame, loops: int, max_gen: int) -> DataFrame:
    """main and gen of the generation to run: no row where all loops are done."""
    spark = history.sparkSession
    last = last_position(history)
    over = (F.col("status") == ENDED) | (F.col("gen") >= max_gen - 1)
    main = F.when(F.col("status") == STARTED, F.col("main")).when(over, F.col("main") + 1).otherwise(F.col("main"))
    gen = F.when(F.col("status") == STARTED, F.col("gen")).when(over, F.lit(0)).otherwise(F.col("gen") + 1)
    begin = spark.createDataFrame([(0, 0)], "main int, gen int")
    found = begin.join(last.select(F.lit(1).alias("one")), F.lit(True), "left_anti").union(last.select(main, gen))
    return found.where((F.col("main") < loops) & (F.lit(max_gen) > 0))


#: (a generation's batch, what earlier ones selected, its position) -> its selection.
Select = Callable[[DataFrame, "DataFrame | None", Position], DataFrame]


class Generations:
    """`select(batch, seen, position)` selects from a generation's batch, `seen` being what earlier generations selected (null
    before any). `threshold` rows in the pool are flushed. `before` is told each step's name before it is taken."""

    def __init__(self, spark: SparkSession, folder: str, loops: int, max_gen: int, threshold: int, select: Select, before: Callable[[str], None] | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.loops, self.max_gen, self.threshold, self.select = loops, max_gen, threshold, select
        self.before = before or (lambda step: None)

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{name}")
        except AnalysisException:
            return None

    def _put(self, df: DataFrame, name: str, at: Position) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/main={at.main}/gen={at.gen}")

    def history(self) -> DataFrame:
        found = self._read("history")
        return self.spark.createDataFrame([], HISTORY) if found is None else found.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in HISTORY.split(", ")])

    def training(self) -> DataFrame | None:
        """Rows handed over so far, with the main and gen of the flush."""
        return self._read("training")

    def _number(self) -> Column:
        return F.col("main") * self.max_gen + F.col("gen")

    def seen(self, at: Position) -> DataFrame | None:
        """What the generations before `at` selected, with their main and gen."""
        rows = self._read("selected")
        return rows.where(self._number() < at.main * self.max_gen + at.gen) if rows is not None else None

    def pool(self, at: Position) -> DataFrame:
        """Selections since the last flush before `at`, its own among them, with the main and gen that selected them."""
        now = at.main * self.max_gen + at.gen
        flushed = self.history().where((F.col("n_flushed") > 0) & (self._number() < now)).agg(F.coalesce(F.max(self._number()), F.lit(-1)).alias("x")).first()["x"]
        return self._read("selected").where((self._number() > flushed) & (self._number() <= now))

    def _written(self, name: str, at: Position) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/main={at.main}/gen={at.gen}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _mark(self, at: Position, status: str, selected: int = 0, pool: int = 0, flushed: int = 0) -> None:
        row = self.spark.createDataFrame([(status, selected, pool, flushed)], "status string, n_selected long, n_pool long, n_flushed long")
        self._put(row.coalesce(1), "history", at)

    def step(self, at: Position, batch: DataFrame) -> str:
        """One generation, once however often it is called."""
        done = self.history().where((F.col("main") == at.main) & (F.col("gen") == at.gen) & (F.col("status") != STARTED)).head(1)
        if done:
            return done[0]["status"]
        self.before("start")
        self._mark(at, STARTED)
        if not self._written("selected", at):
            self.before("select")
            self._put(self.select(batch, self.seen(at), at), "selected", at)
        n = self.spark.read.parquet(f"{self.folder}/selected/main={at.main}/gen={at.gen}").count()
        pool = self.pool(at)
        size = pool.count()
        flushed = 0
        if n and size >= self.threshold:
            self.before("flush")
            self._put(pool.withColumnsRenamed({"main": "from_main", "gen": "from_gen"}), "training", at)
            flushed = size
        self.before("done")
        self._mark(at, DONE if n else ENDED, n, size - flushed, flushed)
        return DONE if n else ENDED

    def run(self, batch: Callable[[Position], DataFrame]) -> list[Position]:
        """Runs from where the history ends until all loops are done; the generations of this run."""
        out = []
        while row := next_position(self.history(), self.loops, self.max_gen).first():
            out.append(Position(row["main"], row["gen"]))
            self.step(out[-1], batch(out[-1]))
        return out

    def attach(self, stream: DataFrame, checkpoint: str, **trigger):
        """Generations of a stream, a micro-batch each: the batch's number is the generation's. Batches after the last loop's
        end are passed over, and a loop's end goes on with the next loop's first generation."""

        def each(batch: DataFrame, number: int) -> None:
            marks = self._read("batches")
            known = marks.where(F.col("batch") == number).head(1) if marks is not None else []
            if known:  # a replay runs the generation that the batch was given, which step() does once
                at = Position(known[0]["to_main"], known[0]["to_gen"])
            elif row := next_position(self.history(), self.loops, self.max_gen).first():
                at = Position(row["main"], row["gen"])
                given = self.spark.createDataFrame([(at.main, at.gen)], "to_main int, to_gen int")
                given.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batches/batch={number}")
            else:
                return
            self.step(at, batch)

        return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def limits(records: DataFrame, base: float | Column, first_is_lost: bool = True, key: list[str] | None = None, gen: str = "gen", label: str = "label") -> DataFrame:
    """key, gen and the limit that holds in it, from records(key, gen, label), a row for every time a generation was run: the
    base for each generation before that was clamped and once more. A generation counts once, by its last record's place
    `at`, however often it ran. first_is_lost: the first generation's label is not kept, as the first write makes an empty
    list."""
    key = key or []
    base = base if isinstance(base, Column) else F.lit(float(base))
    once = records.groupBy(*key, gen).agg(F.max_by(label, "at").alias(label))
    order = Window.partitionBy(*key).orderBy(gen)  # a row a generation
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    kept = F.when((F.row_number().over(order) > 1) | F.lit(not first_is_lost), F.col(label).cast("int")).otherwise(0)
    out = once.withColumn("_kept", kept).withColumn("raised", F.coalesce(F.sum("_kept").over(before), F.lit(0)))
    return out.select(*key, gen, label, "raised", (base * (F.col("raised") + 1)).alias("limit"))


class LimitMemory:
    """Clamped generations kept in a folder, a partition each, so that a generation that runs again replaces its record."""

    def __init__(self, spark: SparkSession, folder: str, base: float, first_is_lost: bool = True):
        self.spark, self.folder, self.base, self.first_is_lost = spark, folder.rstrip("/"), base, first_is_lost

    def records(self) -> DataFrame:
        try:
            return self.spark.read.parquet(self.folder).select(F.col("gen").cast("int"), "label", F.lit(0).alias("at"))
        except AnalysisException:
            return self.spark.createDataFrame([], "gen int, label boolean, at int")

    def limit(self, gen: int) -> float:
        """The limit that holds in a generation, from the records before it."""
        asked = self.spark.createDataFrame([(gen, False, 0)], "gen int, label boolean, at int")
        rows = limits(self.records().where(F.col("gen") < gen).union(asked), self.base, self.first_is_lost)
        return rows.where(F.col("gen") == gen).first()["limit"]

    def record(self, gen: int, label: bool) -> None:
        self.spark.createDataFrame([(label,)], "label boolean").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/gen={gen}")
