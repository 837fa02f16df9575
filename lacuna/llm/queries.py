"""The registered queries of the training-data operators, with production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm import language, mixing, packing, quality, secrets, sharding, simhash, spelling, tokens, topk, toxicity, vectors, whitening
from lacuna.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", *[F.col(f"{mixing.MIX}.{c}").alias(c) for c in ("size", "source_size", "target", "taken")])


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    number = lambda i: F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")
    kinds = [number(i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *kinds, F.sha2(secrets.digest(F.col("base")), 256).alias("base_sha256"), secrets.digest(F.col("all")).alias("spans"), secrets.digest(F.col("live")).alias("live_spans"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), u AS (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM u UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
), roots AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, r.component_id, r.vec_id = r.component_id AS kept
FROM roots r LEFT JOIN counts c USING (vec_id)
"""

OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

#: crc32 byte by byte, from a table that its polynomial gives; neighbours share what is left without one character.
OP13_SQL = """
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
), d AS (
  SELECT run, count(*) AS k, string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '') AS letters FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
), b AS (
  SELECT run, k, flatten(list_transform(letters, lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + (ord(x) >> 6), 128 + (ord(x) & 63)]::BIGINT[] END)) AS bytes FROM d
), h AS (
  SELECT run, k, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t.t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM b, t
), w AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), dels AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT word, rest AS other FROM dels WHERE rest IN (SELECT word FROM w)
  UNION SELECT rest, word FROM dels WHERE rest IN (SELECT word FROM w)
  UNION SELECT a.word, b.word FROM dels a JOIN dels b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
), best AS (
  SELECT a.word, a.n, count(o.word)::BIGINT AS n_near, arg_min(o.word, (-o.n, o.word)) AS top, max(o.n) AS top_n
  FROM w a LEFT JOIN near ON near.word = a.word LEFT JOIN w o ON o.word = near.other GROUP BY a.word, a.n
), f AS (
  SELECT word, n, n_near, CASE WHEN top_n >= 5 * n THEN top END AS form, CASE WHEN top_n >= 5 * n THEN top_n END AS form_n FROM best
), chain(word, root, step) AS (
  SELECT word, word, 0 FROM f UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL
), roots AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, roots.root, f.n, f.n_near, f.form_n FROM f JOIN roots USING (word)
"""

ALL = (op1_packing, op2_toxicity, op3_language, op4_quality, op5_sharding, op6_simhash, op7_vectors, op8_mixing, op9_secrets, op10_topk, op11_tokens, op12_whitening, op13_spelling)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in ALL}
ORACLE_SQL: dict[str, str] = {"op7_vectors": OP7_SQL, "op10_topk": OP10_SQL, "op13_spelling": OP13_SQL}
