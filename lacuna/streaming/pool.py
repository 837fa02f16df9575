"""The candidate pool as a table that micro-batches fill, idempotent under replay.

A generation is one batch: its rows are appended once (batches seen are recorded by their rows), and when the pool reaches
its trigger it is handed to `flush` and emptied. A batch without rows ends the loop. State is Parquet in one folder, so a
restarted stream goes on where it stopped; a replayed batch replaces its own rows and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.text import trigger


class CandidatePool:
    def __init__(self, spark: SparkSession, path: str, when: int | str | None = None, base_count: int = 0):
        self.spark, self.path = spark, path.rstrip("/")
        self.threshold = trigger(when, base_count)

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException:
            return None

    def flushed(self) -> set[int]:
        marks = self._read("flushed")
        return {r.gen for r in marks.select("gen").distinct().collect()} if marks is not None else set()  # one number a generation

    def rows(self) -> DataFrame | None:
        """What is in the pool: rows of generations not flushed yet."""
        pool, gone = self._read("pool"), self.flushed()
        if pool is None:
            return None
        return pool.where(~F.col("gen").isin(sorted(gone))) if gone else pool

    def count(self) -> int:
        rows = self.rows()
        return rows.count() if rows is not None else 0

    def add(self, batch: DataFrame, gen: int) -> int:
        """Rows in the pool after the generation's rows are in, once however often this is called."""
        if gen not in self.flushed():
            batch.write.mode("overwrite").parquet(f"{self.path}/pool/gen={gen}")
        return self.count()

    def flush(self, use: Callable[[DataFrame], None]) -> int:
        """Hands the pool to `use` and, when that returns, empties it; the number of rows."""
        rows = self.rows()
        n = self.count()
        if n:
            use(rows)
            gens = rows.select("gen").distinct()
            gens.write.mode("append").parquet(f"{self.path}/flushed")
        return n

    def step(self, batch: DataFrame, gen: int, use: Callable[[DataFrame], None]) -> str:
        """`end` where nothing was selected (what is left in the pool is dropped), `wait` below the trigger, else `update`."""
        if not batch.head(1):
            return "end"
        if self.add(batch, gen) < self.threshold:
            return "wait"
        self.flush(use)
        return "update"

    def attach(self, stream: DataFrame, use: Callable[[DataFrame], None], checkpoint: str, **trigger_options):
        """The pool behind a stream: each micro-batch is a generation."""
        write = stream.writeStream.foreachBatch(lambda batch, gen: self.step(batch, gen, use) and None).option("checkpointLocation", checkpoint)
        return write.trigger(**(trigger_options or {"availableNow": True})).start()


def generations(batches: list[DataFrame], select: Callable[[DataFrame, int], DataFrame], pool: CandidatePool, use: Callable[[DataFrame], None]) -> list[str]:
    """The outer loop: select from each batch, pool, update; stops at the first generation that selects nothing."""
    out = []
    for gen, batch in enumerate(batches):
        out.append(pool.step(select(batch, gen), gen, use))
        if out[-1] == "end":
            break
    return out


def windowed_counts(stream: DataFrame, time: str = "ts", key: str = "event_type", late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Counts by event time with a watermark: an addition, the curation loop itself knows no event time."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
