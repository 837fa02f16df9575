"""A store of parsed files that parses a file again only when it has changed.

Each file's rows are a partition named by the file and its time and size; a manifest, written after the rows, lists the
partitions that count. An update lists the folder without reading it, parses the files whose time or size is new, and adds a
manifest; rows of unchanged files are not touched. An update that dies before its manifest changes nothing: the next one
overwrites what it left. Rows of files that are gone or changed are removed after the manifest that no longer names them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.operators.stats import stored
from lacuna.sources.readers import read_descriptors

Parse = Callable[[SparkSession, list[str]], DataFrame]
MANIFEST = "file string, at long, size long, part string"


class Update(NamedTuple):
    """Files that an update parsed, that it kept as they were, and that are gone."""

    parsed: list[str]
    kept: int
    gone: int


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, at (modification time in microseconds), size and part (the partition's name); contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    of = files.select(F.col("_metadata.file_path").alias("file"), F.unix_micros(F.col("_metadata.file_modification_time")).alias("at"), F.col("_metadata.file_size").alias("size"))
    return of.withColumn("part", F.substring(F.sha2(F.concat_ws("\n", "file", "at", "size"), 256), 1, 32))


class FileStore:
    """Rows of parse(spark, paths), which has a column `file`, by default those of descriptor files."""

    def __init__(self, spark: SparkSession, folder: str, parse: Parse = read_descriptors):
        self.spark, self.folder, self.parse = spark, folder.rstrip("/"), parse

    def versions(self) -> list[int]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest")
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in system.listStatus(root)] if system.exists(root) else []
        whole = [n for n in names if system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest/{n}/_SUCCESS"))]
        return sorted(int(n) for n in whole if n.isdigit())

    def manifest(self) -> DataFrame:
        """file, at, size and part of the files in the store."""
        found = self.versions()
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest/{found[-1]}") if found else self.spark.createDataFrame([], MANIFEST)

    def update(self, path: str | list[str]) -> Update:
        """Brings the store to what the path's files hold now."""
        now, before = stored(listing(self.spark, path)), stored(self.manifest())
        fresh = now.join(before.select("part"), "part", "left_anti")
        parsed = sorted(r.file for r in fresh.select("file").collect())  # Spark's own listing holds as many on the driver
        gone = before.join(now.select("part"), "part", "left_anti")
        old = [r.part for r in gone.select("part").collect()]
        if parsed:
            rows = self.parse(self.spark, [unquote(f) for f in parsed])
            placed = rows.join(fresh.select("file", "part"), "file").repartition("part")
            # a partition that an earlier, unfinished update left is replaced
            placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.folder}/rows")
        if parsed or old or not self.versions():
            last = max(self.versions(), default=-1)
            now.select("file", "at", "size", "part").write.mode("overwrite").parquet(f"{self.folder}/manifest/{last + 1}")
            for name in [*(f"rows/part={p}" for p in old), *(f"manifest/{v}" for v in self.versions()[:-2])]:
                self.remove(name)
        return Update(parsed, now.count() - len(parsed), gone.join(now.select("file"), "file", "left_anti").count())

    def remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self) -> DataFrame:
        """The rows of the files that the manifest lists; a store without rows is an error."""
        try:
            rows = self.spark.read.parquet(f"{self.folder}/rows")
        except AnalysisException:
            raise ValueError(f"{self.folder} has no rows") from None
        return rows.join(self.manifest().select("part"), "part", "left_semi").drop("part")
