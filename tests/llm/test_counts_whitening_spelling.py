"""Token counts, whitening and spelling variants against the library, plain numpy and plain loops; and their edge cases."""

import functools
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.llm import spelling, tokens, whitening
from lacuna.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
CLASHES = ("key", "no", "n", "n_bytes", "word", "dim", "x", "part", "run", "chunk", "head", "count")


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def noise(seed, n):
    rng = random.Random(seed)
    letters = [*"abcdeéß ▁\t\n<>0123xyzAB.,", "the", "ing", "tion", " ", "  ", "ﬁ", "日本", "😀", "​", "\x00", "<s>", "aaaa"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_transducer_counts_as_the_library():
    t = tokens.compiled(tokens.tokenizer_path())
    for text in noise(3, 1500):
        normal, want = t.library.normalize(text), len(t.library.encode(text))
        assert t.count(normal) == t.run(tokens.START, normal)[1] == want, text


def test_chunk_maps_compose_at_every_cut_and_in_any_order():
    t = tokens.compiled(tokens.tokenizer_path())
    for seed, text in enumerate([*noise(4, 150), "x" * 300, "incomprehensibilities" * 9]):
        normal, want = t.library.normalize(text), len(t.library.encode(text))
        for cut in range(1, len(normal)):
            assert t.total(t.compose(t.chunk_map(normal[:cut]), t.chunk_map(normal[cut:]))) == want
        step = 1 + seed % 7
        maps = [t.chunk_map(normal[i : i + step]) for i in range(0, len(normal), step)]
        if maps:
            assert t.total(functools.reduce(t.compose, maps)) == want
            assert t.total(functools.reduce(lambda b, a: t.compose(a, b), reversed(maps))) == want


def test_states_start_anew():
    t = tokens.Transducer(tokens.tokenizer_path(), states=50)
    for text in noise(5, 200):
        assert t.count(t.library.normalize(text)) == len(t.library.encode(text))
    assert len(t.key) < 500


def test_other_models_are_errors(tmp_path):
    (tmp_path / "no.model").write_bytes(b"no model")
    with pytest.raises((OSError, RuntimeError, ValueError)):
        tokens.Transducer(str(tmp_path / "no.model"))


def test_op11(spark):
    t = tokens.compiled(tokens.tokenizer_path())
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_tokens"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(t.library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_long_texts_are_dealt_out(spark):
    t = tokens.compiled(tokens.tokenizer_path())
    texts = [None, "", "word " * 900, "word " * 900, "z" * 1500, "日本😀x" * 300, *noise(6, 30), " ".join(noise(7, 60))]
    rows = [(None if i == 3 else i % 7, x) for i, x in enumerate(texts)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = tokens.count_tokens(docs, limit=100, chunk=37, fan=3).collect()
    want = [(i, len((x or "").encode()), len(t.library.encode(x or ""))) for i, x in rows]
    key = lambda r: (r[0] is None, *(x or 0 for x in r))
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert tokens.count_tokens(docs.where("false")).count() == 0


def plain_whitening(vectors, k=8):
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000
    n, total = len(x), [sum(int(v) for v in c) for c in x.T]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, total, strict=True)) for row in x]
    centred = np.array([[float(n * int(v) - s) / n for v, s in zip(row, total, strict=True)] for row in x])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    return deviation, centred @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def test_op12(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, white, explained = plain_whitening([r.embedding for r in rows])
    at = {r.vec_id: i for i, r in enumerate(rows)}
    got = QUERIES["op12_whitening"](spark, SF)
    assert dict(got.dtypes)["deviation"] == "bigint"
    out, got = np.zeros_like(white), got.collect()
    assert len(got) == 8 * len(rows)
    for r in got:
        assert r.deviation == deviation[at[r.vec_id]] and r.n == len(rows) and r.identity_error < 1e-9
        assert abs(r.explained - explained[r.component - 1]) < 1e-9
        out[at[r.vec_id], r.component - 1] = r.whitened
    signs = np.sign((out * white).sum(axis=0))
    assert np.abs(out - white * signs).max() < 1e-6


def test_whitening_small_eigenvalues_and_many_partitions(spark, monkeypatch):
    """Spreads from 1e6 to 1 keep their digits, and 40 factors merge in a tree of fan 16."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(800, 6)) * np.array([1000.0, 100, 10, 1, 0.1, 0.05]) @ np.linalg.qr(rng.normal(size=(6, 6)))[0]
    monkeypatch.setattr(whitening, "STRIP", 7)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(40)
    deviation, white, _ = plain_whitening(vectors)
    out = np.zeros_like(white)
    for r in whitening.whiten(df).collect():
        out[r.vec_id, r.component - 1] = r.whitened
        assert int(r.deviation) == deviation[r.vec_id] and r.identity_error < 1e-6
    signs = np.sign((out * white).sum(axis=0))
    assert np.abs(out - white * signs).max() < 1e-4


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.5, 0.0]), (2, [1.5, 0.0]), (None, [3.0, 1.0]), (5, None), (6, []), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 2.0, 3.0])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = whitening.whiten(df).collect()
    assert Counter((r.vec_id, r.component) for r in got) == {(1, 1): 1, (1, 2): 1, (2, 1): 2, (2, 2): 2, (None, 1): 1, (None, 2): 1}  # one vector of three entries has no spread
    deviation, _, _ = plain_whitening([[1.0, 2.0], [1.5, 0.0], [1.5, 0.0], [3.0, 1.0]])
    assert {r.vec_id: int(r.deviation) for r in got} == {1: deviation[0], 2: deviation[1], None: deviation[3]}
    assert {r.n for r in got} == {4} and max(r.identity_error for r in got) < 1e-9
    big = spark.createDataFrame([(i, [1e17 * i, float(i % 3)]) for i in range(6)], "vec_id long, embedding array<double>")
    assert {(r.component, r.deviation) for r in whitening.whiten(big).collect()} >= {(1, None)}  # sums beyond a long are exact too
    for none in (df.where("false"), df.where("vec_id = 5"), df.where("vec_id = 1")):
        assert whitening.whiten(none).count() == 0


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_groups(words):
    forms, out = {}, {}
    for w, n in words.items():
        near = [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if near and words[best] >= 5 * n else None
        out[w] = len(near)
    roots = {}
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        roots[w] = root
    return {(w, forms[w], roots[w], n, out[w], words.get(forms[w])) for w, n in words.items()}


def test_slips_and_counts(spark):
    rng = random.Random(9)
    pool = ["letter", "Lettre", "ÉCOLES", "école÷s", "sixsix", "short", "a" * 3000, "naïveté"]
    rows = [(None if i == 7 else i % 300, None if i == 11 else " ".join(rng.choices(pool, k=20)) + ".") for i in range(700)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.word: r.n for r in spelling.count_words(docs).collect()} == plain_words(rows)
    assert spelling.variants(docs.where("false")).count() == 0


@pytest.mark.parametrize("size, most", [(65_536, 32_000_000), (13, 32_000_000), (13, 700)])
def test_groups_against_all_pairs(spark, size, most):
    """Small shards, and rounds of few shards, give what one shard gives."""
    rng = random.Random(10)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(120)]
    words = {w: int(5 * 6 ** rng.uniform(0, 5)) for w in base}
    words |= {"chainaaa": 5, "chainaab": 25, "chainabb": 125, "chainbbb": 625, "tiedone": 100, "tiedono": 100, "tiedon": 20}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    got = spelling.group(df, size=size, task_words=40, most=most).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain_groups(words)
    by = {r.word: r for r in got}
    assert by["chainaaa"].root == "chainbbb" and by["tiedon"].form == "tiedone"


def test_automaton():
    for a, b in itertools.product(["".join(x) for n in range(4) for x in itertools.product("ab", repeat=n)], repeat=2):
        if a and b:
            found = spelling.neighbours(spelling.expanded(iter([(b, 3), ("zzzz", 1)])), a)
            assert (b in found) == one_edit(a, b) == spelling.one_edit(a, b), (a, b)


def test_op13_is_equal_to_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLE_SQL['op13_spelling']})").fetchall()
    got = QUERIES["op13_spelling"](spark, "/root/testdata/sf0.001").select(*names).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got) and want
