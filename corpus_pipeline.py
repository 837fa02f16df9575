"""Documents to packed training sequences: quality, near-duplicates, secrets, mix, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and all but the last return the
columns of documents. Between stages, tables are written as Parquet to the shared folder named in spark.checkpoint.dir.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lacuna.llm import mixing, packing, quality, secrets, simhash
from lacuna.llm.common import shared_folder, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays, that of the smallest doc_id, null ids last."""
    return simhash.keep_first(docs, words=5, similar=0.8)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; no document goes."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go as their source's target weight tells."""
    return mixing.repeat(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("packing", pack_sequences),
]

#: SQL expresses neither the classifier nor the hashes; the tests compare stages with brute force instead.
ORACLE_SQL = None


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in the store that its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's table goes once the next one is written; the last one's input stays, as the
    result still reads it."""
    folder, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
