"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lacuna.llm import language, mixing, packing, quality, secrets, sharding, simhash, topk, toxicity, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ["size", "target", "shard", "slot", "rank", "fp", "u", "v", "n", "rep", "part", "score", "key", "copies", "base", "value", "_salt", "bucket"]
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "same text here", "en", "a", 14),
    (4, "same text here", "en", "b", 14),
    (4, "same text here", "en", "b", 14),
    (None, "an id is missing", None, "b", 1),
    (6, "password = hunter22 and 123 456", "de", None, 5),
    (7, "word " * 30_000, "de", "a", 150_000),
    (8, "\x1c  　 Ünïcode ẞ 漢字 🙂 \x00", "fr", "a", 3),
    (9, "12 34 !!", None, "a", 3),
]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (7, 0, 1), (8, 1, None), (None, None, None), (8, 1, 0), (6, None, 1)], LABELS)


def test_packing(docs, empty):
    rows = packing.pack(docs).collect()
    assert len([r for r in rows if r.doc_id == 4]) == 2
    by = {r.doc_id: r for r in rows}
    for i in (1, 2):
        assert (by[i].length, by[i].ids_crc32) == (1, zlib.crc32(b"\1\0\0\0"))
    assert sum(r.length for r in rows if r.doc_id == 7) == 30_001
    assert packing.pack(empty).count() == 0


def test_classifiers(docs, empty, labels):
    for run in (lambda d: toxicity.classify(d, labels), lambda d: quality.classify(d, labels), language.identify):
        rows = run(docs).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        same = {r.score for r in rows if r.doc_id in (3, 4)}
        assert len(same) == 1
        assert run(empty).count() == 0
    pred = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert pred[1] == pred[2] == pred[9] == "und" and pred[3] != "und" and pred[8] != "und"
    nothing = labels.where("false")
    assert {r.score for r in quality.classify(docs, nothing).collect()} == {0.5}
    assert {r.score for r in toxicity.classify(docs, nothing).collect()} == {0.0}


def test_sharding(docs, empty):
    rows = sharding.shard(docs, 3).collect()
    assert len(rows) == len(ROWS) and next(r for r in rows if r.doc_id == 1).size == 1
    assert len({r.shard for r in rows if r.doc_id in (3, 4)}) == 1
    assert len({r.shard for r in rows if r.doc_id in (1, 2)}) == 1
    for k in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    assert sharding.shard(empty).count() == 0


def test_simhash(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[1].fp == by[2].fp == 0 and by[2].component_id == 1 and by[4].component_id == 3
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert not {2, 4} & {r.doc_id for r in kept.collect()}


def test_null_ids_link_like_others(spark, monkeypatch):
    """A row without an id between two others joins them; a component without ids is null."""
    far = 0x0F0F << 20
    rows = [(1, "0"), (None, "3"), (2, "15"), (None, str(far)), (None, str(far + 1)), (7, str(far << 8))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = docs.select("doc_id", F.col("text").cast("long").alias("fp"))
    monkeypatch.setattr(simhash, "fingerprints", lambda d, words, seed: prints)
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 0, 1), (None, 3, 1), (2, 15, 1), (None, far, None), (None, far + 1, None), (7, far << 8, 7)], key=str)
    v = [[1.0, 0.0, 0.0], [1.0, 0.3, 0.0], [1.0, 0.66, 0.0]]
    rows = [(1, v[0], 5), (None, v[1], 5), (2, v[2], 5), (2, [0.0, 0.0, 1.0], 5), (2, [0.0, 0.1, 1.0], 5), (None, [0.0, -1.0, 0.0], 5)]
    got = [tuple(r) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()]
    want = [(1, 1, 1, True), (None, 2, 1, False), (2, 1, 1, False), (2, 1, 2, True), (2, 1, 2, True), (None, 0, None, True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_duplicates_keep_rows_without_own_id(spark):
    texts = ["one two three four five", "six seven eight nine ten", "red green blue white black", "up down left right middle"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (6, texts[3]), (None, texts[3])]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3])], key=str)


def test_near_duplicates_by_similarity(spark):
    """Copies of a text with some edited words go, though they differ in more than two bits; other texts stay."""
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(5000)}"
    base = [[word() for _ in range(300)] for _ in range(3)]

    def edited(words, n):
        at = set(rng.choice(300, n, replace=False).tolist())
        return " ".join(word() if i in at else w for i, w in enumerate(words))

    texts = [" ".join(b) for b in base] + [edited(b, 5) for b in base for _ in range(30)] + [edited(base[0], 100)]
    sets = [simhash.shingle_set(t, 5, 42) for t in texts]
    alike = [len(np.intersect1d(sets[3 + i], sets[i // 30])) / len(np.union1d(sets[3 + i], sets[i // 30])) for i in range(90)]
    assert min(alike) >= 0.8
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "")
    assert {r.doc_id for r in kept.collect()} == {0, 1, 2, 93}


def test_near_duplicates_take_the_grids_links(spark, monkeypatch):
    """Links of the grid count in the stage, by similarity; unlike texts of equal fingerprints stay apart."""
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(10**6, size=20_000)]
    texts = [" ".join(base), " ".join([*base[:-1], "other"]), "one two three four five six", "red green blue white black grey"]
    sets = [simhash.shingle_set(t, 5, 42) for t in texts]
    fps = [simhash.fingerprint(t, 5) for t in texts[:2]]
    assert (fps[0] ^ fps[1]).bit_count() <= 2
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, signed(fps[i]) if i < 2 else 77, sorted({int(h >> np.uint64(32)) - (1 << 31) for h in s})) for i, s in enumerate(sets)]
    assert [tuple(r) for r in simhash.link_grid(spark.createDataFrame(rows, "node long, fp long, shingles array<int>")).collect()] == [(0, 1)]
    calls, whole = [], simhash.link_fingerprints
    monkeypatch.setattr(simhash, "link_fingerprints", lambda prints: calls.append(1) or whole(prints))
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "")
    assert {r.doc_id for r in kept.collect()} == {0, 2, 3} and calls


def test_mixing(docs, empty):
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, mixing.MIX] and mixed.count() == len(ROWS)
    assert all(r.c in (0, 1, 2) for r in mixed.select(F.col(f"{mixing.MIX}.copies").alias("c")).collect())
    assert mixing.repeat(docs).columns == docs.columns
    assert mixing.mix(empty).count() == 0 and mixing.repeat(empty).count() == 0


def test_mixing_passes_over_what_does_not_fit(spark):
    """Long documents anywhere in a source do not keep the short ones from filling its target."""
    for first in (0, 10_000, 20_000):
        rows = [(first + i, "w " * (20_000 if i % 300 == 7 else 10 + i % 90), "a") for i in range(1500)]
        taken, goal = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).select(F.sum(f"{mixing.MIX}.taken"), F.max(f"{mixing.MIX}.target")).first()
        assert abs(taken - goal) <= 5, (first, taken, goal)


def test_secrets(docs, empty):
    rows = secrets.scan(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r.doc_id: len(r.base) for r in rows}[6] == 1
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[6] == "[secret] and 123 456" and texts[1] is None and texts[7] == ROWS[7][1]
    assert secrets.scan(empty).count() == 0 and secrets.redact(empty).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int"
ODD = [
    (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [], 1),
    (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0], 2),
    (11, [1.0, 0.0, 0.0], 1), (50, [1.0, 0.0], 1), (100, [-3.0, 1e30], 2),
]


def test_vectors(spark):
    table = spark.createDataFrame(ODD, VECTORS).withColumns({c: F.lit("clash") for c in CLASHES})
    rows = vectors.near_duplicates(table).collect()
    assert len(rows) == len(ODD)
    by = {r.vec_id: r for r in rows}
    assert by[0].n_links == 4 and by[2].n_links == 4 and by[50].component_id == 0 and by[1].n_links == 4
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    assert vectors.near_duplicates(table.where("false")).count() == 0


def test_topk(spark):
    table = spark.createDataFrame(ODD, VECTORS).withColumns({c: F.lit("clash") for c in CLASHES})
    rows = topk.top_k(table, F.col("vec_id") % 50 == 0, k=3).orderBy("query_id", "rank").collect()
    first = [(r.rank, r.vec_id, r.score) for r in rows if r.query_id == 0]
    assert first == [(1, 2, 131072), (2, 1, 65536), (3, 1, 65536)]
    assert {r.query_id for r in rows} == {0, 50, 100}
    assert topk.top_k(table.where("false"), F.lit(True)).count() == 0


def test_pipeline(spark, docs, empty, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(ROWS, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
    kept = sorted(((r.doc_id, r.text) for r in now.collect()), key=str)
    assert kept and {i for i, _ in kept} <= {r[0] for r in ROWS}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id) for r in packed if r.piece == 0)) == sorted(str(i) for i, _ in kept)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
