"""Whole results of queries that SQL cannot express, rebuilt by plain loops from the texts."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lacuna.llm import common, language, mixing, packing, quality, secrets, simhash, toxicity
from lacuna.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def text_hash(text):
    """Spark's xxhash64 of a text, as a signed number."""
    h = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return h - (1 << 64) if h >> 63 else h


def plain_sample(pairs, per_label):
    """The texts with the least hashes of each label, in order of label and hash."""
    of = defaultdict(dict)
    for text, y in pairs:
        if text is not None and y is not None:
            of[y][text_hash(text)] = text
    return [(of[y][h], y) for y in sorted(of, key=str) for h in sorted(of[y])[:per_label]]


@pytest.mark.parametrize("per_label", [1, 3, 50, 10_000])
def test_labelled_sample(spark, rows, per_label):
    docs = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in rows] * 2, "doc_id long, text string, lang string")
    assert common.labelled_sample(docs, per_label, "lang") == plain_sample([(r.text, r.lang) for r in rows], per_label)
    known = docs.select("doc_id", (F.col("doc_id") % 3).alias("y"))
    assert common.labelled_sample(docs, per_label, known=known) == plain_sample([(r.text, r.doc_id % 3) for r in rows], per_label)
    assert common.labelled_sample(docs.where("false"), per_label, "lang") == []


def test_ranks_of_equal_rows(spark):
    """Rows equal in key and order are dealt to many salts and still get each place once."""
    df = spark.range(5000).select(F.lit(7).alias("k"), F.lit(None).cast("long").alias("id"))
    got = common.ranked(df, ["k"], ["id"], "r").collect()
    assert sorted(r.r for r in got) == list(range(5000))
    salts = df.withColumn("_place", F.monotonically_increasing_id()).select(F.pmod(F.xxhash64("id", "_place"), F.lit(64)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == 64 and max(r["count"] for r in salts) < 200


def test_op2_by_hand(spark, rows, labels):
    """Every document's score from the machine's landmarks and weights alone, sentence by sentence and word by word."""
    toxic = {i: r.toxic for i, r in labels.items() if r.toxic is not None}
    machine = toxicity.train(plain_sample([(r.text, toxic.get(r.doc_id)) for r in rows if fold(r.doc_id, 5)], toxicity.PER_LABEL))
    parts = sorted({p for r in rows for w in toxicity.sentences(r.text or "") if w != "\x00" for p in toxicity.stretches(w)})
    values = dict(zip(parts, machine.kernel(parts).astype(float) @ machine.weights if machine.kernel else [0.0] * len(parts), strict=True))

    def value(word):
        return max(values[p] for p in toxicity.stretches(word))

    want = {}
    for r in rows:
        best, sentence = -np.inf, []
        for w in [*toxicity.sentences(r.text or "")]:
            if w == "\x00":
                chunks = [sentence[i : i + toxicity.SENTENCE] for i in range(0, max(1, len(sentence)), toxicity.SENTENCE)]
                best, sentence = max([best, *(sum(map(value, c)) for c in chunks)]), []
            else:
                sentence.append(w)
        want[r.doc_id] = 1 / (1 + np.exp(-np.clip(machine.slope * (best + machine.bias) + machine.shift, -30, 30))) if machine.kernel else 0.0
    got = QUERIES["op2_toxicity"](spark, SF).collect()
    assert len(got) == len(rows)
    for g in got:
        assert abs(g.score - want[g.doc_id]) < 2e-3 and g.held_out == (fold(g.doc_id, 5) == 0) and g.predicted == int(g.score >= 0.5)


def test_op3_by_hand(spark, rows):
    """Every document's pooled probabilities, run by run without a memo."""
    model = language.train(plain_sample([(r.text, r.lang) for r in rows if fold(r.doc_id, 4) != 2], language.PER_LABEL))
    got = {g.doc_id: g for g in QUERIES["op3_language"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows[::7]:
        g = got[r.doc_id]
        assert g.held_out == (fold(r.doc_id, 4) == 2)
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (g.lang_pred, g.score) == ("und", 0)
            continue
        sums, n = np.zeros(len(model.labels)), 0
        for word, times in Counter(r.text.lower().split()).items():
            for run in language.runs_of(word):
                codes, mask = language.padded([run])
                for code, p in zip(codes[0], model.network.probabilities(codes, mask)[0], strict=True):
                    if code >= 128 or chr(code).isalpha():
                        sums, n = sums + times * p, n + times
        mean = sums / max(1, n)
        assert abs(g.score - min(1, mean.max())) < 1e-3
        assert g.lang_pred == model.labels[int(mean.argmax())] or np.sort(mean)[-1] - np.sort(mean)[-2] < 1e-3


def test_op4_by_hand(spark, rows, labels):
    """Every document's score from the weights, passage by passage."""
    known = {i: r.quality for i, r in labels.items() if r.quality is not None}
    model = quality.train(plain_sample([(r.text, known.get(r.doc_id)) for r in rows if fold(r.doc_id, 5)], quality.PER_LABEL))
    p = model.p
    got = {g.doc_id: g for g in QUERIES["op4_quality"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        hidden, gates = [], []
        for x in quality.encode(r.text or ""):
            h = np.tanh(np.clip((x - model.mean) / model.scale, -8, 8) @ p["w"] + p["c"])
            hidden.append(h)
            gates.append(float((np.tanh(h @ p["v"]) / (1 + np.exp(-(h @ p["u"])))) @ p["a"]))
        weight = np.exp(np.array(gates) - max(gates))
        z = sum(w * h for w, h in zip(weight / weight.sum(), hidden, strict=True))
        want = 1 / (1 + np.exp(-(z @ p["o"] + p["d"][0])))
        g = got[r.doc_id]
        assert abs(g.score - want) < 1e-5 and g.held_out == (fold(r.doc_id, 5) == 0) and g.predicted == int(g.score >= 0.3)


def test_op5_is_the_optimum(spark, rows):
    """The largest shard is the least that any cut into eight runs of whole groups, in order of the text's hash, allows."""
    size = Counter()
    for r in rows:
        size[text_hash(r.text or "")] += len((r.text or "").encode()) + 1
    ordered = [size[h] for h in sorted(size)]

    def shards(capacity):
        n, room = 1, capacity
        for s in ordered:
            if s > room:
                n, room = n + 1, capacity
            room -= s
        return n

    low, high = max(ordered), sum(ordered)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if shards(middle) <= 8 else (middle + 1, high)
    got = QUERIES["op5_sharding"](spark, SF).collect()
    held = Counter()
    for g in got:
        held[g.shard] += g.size
    assert max(held.values()) == low and len(got) == len(rows)


# ---- pipeline


def plain_pipeline_rows(spark, docs):
    """The stages' decisions one by one, each on what the one before kept."""
    good = quality.keep_good(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    return good, simhash.keep_first(good, words=5, similar=0.8)


def test_run_is_its_stages(spark):
    """run() against the stages by hand: who stays, how often the mix takes each text, and whole sequences of their tokens."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good, first = plain_pipeline_rows(spark, docs)
    clean = secrets.redact(first)
    mixed = mixing.mix(clean).select("doc_id", "text", f"{mixing.MIX}.copies").collect()
    want = Counter()
    encode = packing.WordTokenizer(packing.tokenizer_path())
    for r in mixed:
        ids = encode(r.text or "") + b"\1\0\0\0"
        for at in range(0, len(ids), 4 * 4096):
            want[r.doc_id, at // 4, zlib.crc32(ids[at : at + 4 * 4096]), len(ids[at : at + 4 * 4096]) // 4] += r.copies
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((g.doc_id, g.start, g.ids_crc32, g.length) for g in got) == +want
    places = defaultdict(list)
    for g in got:
        places[g.sequence_id].append((g.offset, g.length))
    for of in places.values():
        end = 0
        for offset, length in sorted(of):
            assert offset == end
            end += length
        assert end <= 4096
    # as few sequences as the plan of the same lengths gives, and no fewer than the ids need
    counts = Counter(g.length for g in got)
    plan = packing.plan(dict(counts), 4096)
    assert len(places) == len({s for _, low, high, sequence, each, _ in plan for s in range(sequence, sequence + (high - low) // each)}) >= -(-sum(g.length for g in got) // 4096)


def test_mix_stage_meets_its_targets(spark):
    """The mix of what the stages before kept: words taken of each source against the targets reshared by hand."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix(docs).select("source", "text", f"{mixing.MIX}.*").collect()
    sizes, taken = Counter(), Counter()
    for r in mixed:
        n = len((r.text or "").split())
        assert r.taken in (0, n, 2 * n)
        sizes[r.source] += n
        taken[r.source] += r.taken
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, open_ = {}, set(order)
    left = 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            goal[s] = 2.0 * sizes[s]
        left -= sum(goal[s] for s in over)
        open_ -= over
    goal |= share
    for s in order:
        longest = max(len((r.text or "").split()) for r in mixed if r.source == s)
        assert abs(taken[s] - goal[s]) <= max(longest, 0.01 * goal[s]), s


