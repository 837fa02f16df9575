"""Every operator against a brute-force version, an exact round trip or held-out accuracy."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lacuna.llm import language, mixing, packing, quality, secrets, sharding, simhash, topk, toxicity, vectors
from lacuna.llm.common import components, ranked
from lacuna.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"))
    good = np.array(label) == 1
    return (order[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(50)] + [(2000, 2001 + i) for i in range(200)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_ranked(spark):
    rows = ranked(spark.range(3000).withColumn("k", F.col("id") % 3), ["k"], ["id"], "r").collect()
    for k in range(3):
        assert sorted(r.r for r in rows if r.k == k) == list(range(1000))


def test_op1(spark, docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = QUERIES["op1_packing"](spark, SF).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        pieces = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        got = sorted(by[doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in got] == [(k, 4096 * k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(pieces)]
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_fullest():
    rng = random.Random(3)
    for _ in range(300):
        counts = {rng.randint(1, 50): rng.randint(1, 4) for _ in range(rng.randint(1, 8))}
        chosen = packing.fullest(counts, 50)
        assert all(n <= counts[x] for x, n in chosen.items()) and max(counts) in chosen
        rest = [x for x, n in counts.items() for _ in range(n)]
        rest.remove(max(counts))
        sums = {0}
        for x in rest:
            sums |= {s + x for s in sums if s + x <= 50 - max(counts)}
        assert sum(x * n for x, n in chosen.items()) == max(counts) + max(sums)


def test_kernel():
    def brute(a, b):
        total = 0.0
        for i, j in itertools.product(itertools.combinations(range(len(a)), 3), itertools.combinations(range(len(b)), 3)):
            if all(a[x] == b[y] for x, y in zip(i, j, strict=True)):
                total += toxicity.DECAY ** (i[-1] - i[0] + j[-1] - j[0] + 2)
        return total

    words = ["idiot", "idxiot", "aabab", "ab", "losser", ""]
    got = toxicity.kernel(toxicity.codes(words), toxicity.codes(words[::-1]))
    assert np.allclose(got, [[brute(a, b) for b in words[::-1]] for a in words], atol=1e-5)
    c = toxicity.codes(words)
    assert np.allclose(toxicity.kernel(c, c), [brute(a, a) for a in words], atol=1e-5)


def test_op2(spark, texts, labels):
    rows = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").collect()
    known = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in rows)
    # the smallest languages have a few dozen toxic texts here, whose insults clean texts have too
    assert auc([r.score for r in held], [known[r.doc_id] for r in held]) > 0.92
    assert np.mean([r.predicted == known[r.doc_id] for r in held]) > 0.93


def test_gapped_insults():
    rng, insults = random.Random(2), ["moron", "idiot", "loser"]
    word = lambda: "".join(rng.choice(["ta", "ne", "ro", "li", "su", "ve", "ka"]) for _ in range(rng.randint(1, 3)))
    line = lambda n: " ".join(word() for _ in range(n)) + ". "
    clean = [line(6) + line(8) for _ in range(90)]
    toxic = [line(6) + line(3)[:-2] + f" {insults[i % 3]} " + line(3) for i in range(90)]
    machine = toxicity.train([(t, 0) for t in clean] + [(t, 1) for t in toxic])
    bad = machine.score(["ta neta moron here.", "ta neta morxon here.", "ta neta m o r o n here.", "ta mo-ron neta.", "ta ne idi.ot ve"])
    good = machine.score(["ta neta roli kasu.", "", None, "neta morta kasu"])
    assert bad.min() > good.max() and bad.min() > 0.5 > good.max()


def test_op3(spark, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = QUERIES["op3_language"](spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95


def test_network_gradients():
    net = language.ByteNetwork(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes, mask = language.padded([b"abc", b"de", b"zabx"])
    label = np.array([0, 1, 2])
    grads = net.gradients(codes, mask, label)

    def loss():
        p = net.probabilities(codes, mask)
        return -(np.log(p[np.arange(3), :, label]) * mask).sum() / mask.sum()

    rng = np.random.default_rng(0)
    for key, value in net.p.items():
        for _ in range(4):
            at = tuple(int(rng.integers(n)) if key[0] != "x" or d else int(codes[mask][rng.integers(mask.sum())]) for d, n in enumerate(value.shape))
            keep = value[at]
            value[at] = keep + 1e-3
            up = loss()
            value[at] = keep - 1e-3
            down = loss()
            value[at] = keep
            assert abs((up - down) / 2e-3 - grads[key][at]) < 2e-3, key


def test_attention_gradients():
    model, rng = quality.AttentionModel(5, 4, 3), np.random.default_rng(1)
    x, first, label = rng.normal(size=(7, 5)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])
    grads = model.gradients(x, first, label)

    def loss():
        z = model.forward(x, first)[-1]
        return np.mean(np.log1p(np.exp(z)) - label * z)

    for key, value in model.p.items():
        at = tuple(int(rng.integers(n)) for n in value.shape)
        keep = value[at]
        value[at] = keep + 1e-5
        up = loss()
        value[at] = keep - 1e-5
        down = loss()
        value[at] = keep
        assert abs((up - down) / 2e-5 - grads[key][at]) < 1e-6, key


def test_op4(spark):
    known = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = QUERIES["op4_quality"](spark, "/root/testdata/sf0.1").collect()
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert auc([r.score for r in held], [known[r.doc_id] for r in held]) > 0.98
    assert np.mean([r.predicted == known[r.doc_id] for r in held]) > 0.97


@pytest.mark.parametrize("bits", [(12, 17), (2, 3)])
def test_minimax(bits, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits[0])
    monkeypatch.setattr(sharding, "REFINE_BITS", bits[1])
    rng = random.Random(8)
    for case in range(60):
        groups = {}
        for _ in range(rng.randint(1, 60)):
            key = rng.randint(-(1 << 63), (1 << 63) - 1) if rng.random() < 0.7 else rng.randint(0, 1 << 20)
            groups[key] = 500 if rng.random() < 0.03 else rng.randint(1, 20)
        keys, k = sorted(groups), rng.randint(1, 9)

        def sums(ranges, coarse, b, groups=groups, keys=keys):
            shift = lambda key, n: (key + (1 << 63)) >> (64 - n)
            wanted = None if ranges is None else {shift(a, coarse) for a, _ in ranges}
            out = defaultdict(list)
            for key in keys:
                if wanted is None or shift(key, coarse) in wanted:
                    out[shift(key, b)].append(key)
            return [(min(x), max(x), sum(groups[y] for y in x)) for x in out.values()]

        def feasible(capacity, keys=keys, groups=groups, k=k):
            used, at = 1, 0
            for key in keys:
                if groups[key] > capacity:
                    return False
                if at + groups[key] > capacity:
                    used, at = used + 1, 0
                at += groups[key]
            return used <= k

        cuts = sharding.minimax_cuts(sums, k)
        loads = Counter()
        for key in keys:
            loads[sum(key >= c for c in cuts)] += groups[key]
        best = next(c for c in range(1, sum(groups.values()) + 1) if feasible(c))
        assert len(loads) <= k and max(loads.values()) == best, case


def test_op5(spark, texts):
    rows = QUERIES["op5_sharding"](spark, SF).collect()
    shard_of = defaultdict(set)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None) and 0 <= r.shard < 8
        shard_of[texts[r.doc_id]].add(r.shard)
    assert all(len(x) == 1 for x in shard_of.values())
    loads = Counter()
    for k in range(8):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))
        loads[k] = sum(r.size for r in rows if r.shard == k)
    group = Counter()
    for t in texts.values():
        group[t] += len(t.encode()) + 1
    assert max(loads.values()) <= sum(loads.values()) / 8 + max(group.values())


def test_op6(spark, texts):
    fps = {}
    for doc_id, text in texts.items():
        words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower())
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        fps[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    rows = QUERIES["op6_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {x: (f"{fps[x]:016x}", find(x)) for x in fps}


def test_op7_recall():
    rng = np.random.default_rng(0)
    a = vectors.unit(rng.normal(size=(600, 64)))
    z = rng.normal(size=(600, 64))
    z = vectors.unit(z - (z * a).sum(axis=1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * z
    code = vectors.ProductCode(64, 22)
    shared = [len(np.intersect1d(x, y)) > 0 for x, y in zip(code.decode(a), code.decode(b), strict=True)]
    assert np.mean(shared) >= 0.9  # at the threshold itself, the hardest links


def test_op7_dense_group(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 50)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    v = np.concatenate([centre + 0.02 * rng.normal(size=(300, 16)), rng.normal(size=(100, 16))]).astype(np.float32)
    v = np.concatenate([v, v[:40]])
    rows = vectors.near_duplicates(spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")).collect()
    u = vectors.unit(v.astype(np.float64))
    near = u @ u.T >= 0.93
    assert {r.vec_id: r.n_links for r in rows} == {i: int(near[i].sum()) - 1 for i in range(len(v))}
    assert all(r.component_id == 0 for r in rows if r.vec_id < 300)


def test_op8(spark, docs, texts):
    rows = {r.doc_id: r for r in QUERIES["op8_mixing"](spark, SF).collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    size = {d: len(re.findall(r"[^\x20\x09-\x0d]+", t)) for d, t in texts.items()}
    total = Counter()
    for d in texts:
        total[source[d]] += size[d]
    goal = mixing.targets(dict(total))
    assert abs(sum(goal.values()) - 1.5 * sum(total.values())) < 1e-6 * sum(total.values())
    got = Counter()
    for d, r in rows.items():
        assert r["size"] == size[d] and r.source_size == total[source[d]] and abs(r.target - goal[source[d]]) < 1e-6
        assert r.taken in (0, size[d], 2 * size[d])
        got[source[d]] += r.taken
    for s in total:
        assert abs(got[s] - goal[s]) <= 0.005 * goal[s] + 5, s
    again = {r.doc_id: r for r in QUERIES["op8_mixing"](spark, SF).collect()}
    assert rows == again


def test_targets_reshare():
    got = mixing.targets({"a": 10, "b": 100, None: 100})
    assert got["a"] == 20.0 and abs(sum(got.values()) - 315) < 1e-9 and max(got["b"], got[None]) <= 200
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_op9(spark, texts, tmp_path):
    tricky = [
        "secret=token:abcdef", "password=token=abcdefgh", "🙂é password: \"hunter22\" 🙂 AKIA" + "A" * 16, "AKIAAKIA" + "B" * 15, "AKIA" + "C" * 15,
        "0" * 24, "x" + "ab12" * 6 + "g" + "a" * 23, "API_KEY = 'ab' token='abcdef", "token=abcdef" * 3, "passwd:" + "0123456789abcdef" * 2, "ſecret=abcdefgh", "apikey  =  x.y=z-1+/",
    ]
    rows = [(d, t, "s") for d, t in texts.items()] + [(10_000 + i, t, "s") for i, t in enumerate(tricky)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op9_secrets"](spark, str(tmp_path)).collect():
        text = texts.get(r.doc_id) if r.doc_id < 10_000 else tricky[r.doc_id - 10_000]
        spans = base_spans(text)
        joined = ",".join(f"{k}:{a}:{z}" for a, _, z, k in spans)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == i for s in spans) for i in range(3)], text[:80]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_ownership(spark):
    rows = [(i, f"key Abcd3fGh1jKlmN0pQrst{i % 2} end", f"org{i}/repo" if i % 2 else "org/repo", i % 2) for i in range(12)]
    got = {r.doc_id: r.all for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string, odd int")).collect()}
    assert all(len(got[i]) == (0 if i % 2 else 1) for i in range(12))  # odd: six owners hold one value


def test_op10(spark):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, e = np.array([r.vec_id for r in v]), np.floor(256 * np.array([r.embedding for r in v], dtype=np.float64)).astype(np.int64)
    want = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = e @ e[i]
        order = sorted((-s, x) for s, x in zip(score.tolist(), ids.tolist(), strict=True) if x != ids[i])[:5]
        want |= {(int(ids[i]), k): (x, -s) for k, (s, x) in enumerate(order, 1)}
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in QUERIES["op10_topk"](spark, SF).collect()} == want


def test_op10_pruned(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(4)
    e = (rng.normal(size=(500, 8)) * rng.lognormal(0, 1.5, (500, 1))).round(2)
    e[7] = 0
    got = topk.top_k(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(e)], "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 7).collect()
    z = np.floor(256 * e).astype(np.int64)
    for q in range(7, 500, 10):
        order = sorted((-s, x) for x, s in enumerate((z @ z[q]).tolist()) if x != q)[:5]
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == [(x, -s) for s, x in order]


def similar_firsts(docs):
    """The first document of each group that is connected by a Jaccard similarity of 0.8 of five-word shingles."""
    first = {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        words = re.findall(rb"[^\x20\x09-\x0d]+", r.text.encode().lower())
        first.setdefault(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset(), r.doc_id)
    sets, holders = list(first), defaultdict(list)
    root = {i: i for i in first.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                a, b = find(first[s]), find(first[sets[j]])
                root[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    return {x for x in root if find(x) == x}


def test_pipeline(spark, docs):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and max(r.offset + r.length for r in out) <= 4096
    kept = corpus_pipeline.keep_good(spark, docs, SF)
    good = {r.doc_id for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good
    first = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert {r.doc_id for r in first.collect()} == similar_firsts(docs)
    clean = {r.doc_id: r.text for r in corpus_pipeline.redact_secrets(spark, docs, SF).collect()}
    assert len(clean) == docs.count() and not any(base_spans(t) for t in clean.values())


def test_op1_special_texts():
    from tokenizers import Tokenizer

    encode, whole = packing.WordTokenizer(packing.tokenizer_path()), Tokenizer.from_file(packing.tokenizer_path())
    for text in ("<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "<|EndOfText|> x", "<|endoftext|<|endoftext|>", "plain text", ""):
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text
    assert np.frombuffer(encode("<|endoftext|>"), "<u4").tolist() == [49407]


def test_sentence_value_is_a_sum_of_dense_kernels():
    """A score's inside, against sums over all landmarks and words of the kernel by hand."""
    machine = toxicity.Machine(toxicity.WordKernel(["^idiot", "^loser", "^friend"]), np.array([1.5, 0.5, -1.0], np.float32), -0.25, 1.0, 0.0)

    def subsequences(a, b):
        return sum(toxicity.DECAY ** (i[-1] - i[0] + j[-1] - j[0] + 2) for i in itertools.combinations(range(len(a)), 3) for j in itertools.combinations(range(len(b)), 3) if all(a[x] == b[y] for x, y in zip(i, j, strict=True)))

    def like(a, b):
        return (subsequences(a, b) / max(1e-12, subsequences(a, a) * subsequences(b, b)) ** 0.5) ** toxicity.POWER

    text = "you idxiot went home. a friend of losers"
    by_hand = [sum(w * like(f"^{x}", m) for x in s.split() for m, w in (("^idiot", 1.5), ("^loser", 0.5), ("^friend", -1.0))) for s in text.split(". ")]
    assert abs(machine.values([text])[0] - (max(by_hand) - 0.25)) < 1e-4


def test_network_byte_by_byte():
    net = language.ByteNetwork(3, hidden=4)
    runs = [b"abc", b"de", b"zabx"]
    codes, mask = language.padded(runs)
    got, s = net.probabilities(codes, mask), lambda x: 1 / (1 + np.exp(-x))
    for k, run in enumerate(runs):
        states = {}
        for way, order in (("f", range(len(run))), ("b", range(len(run) - 1, -1, -1))):
            h = np.zeros(4)
            for t in order:
                x, r = net.p["x" + way][run[t]] + net.p["c" + way], h @ net.p["h" + way]
                update, reset = s(x[:4] + r[:4]), s(x[4:8] + r[4:8])
                h = (1 - update) * np.tanh(x[8:] + reset * r[8:]) + update * h
                states[way, t] = h
        for t in range(len(run)):
            z = np.concatenate([states["f", t], states["b", t]]) @ net.p["o"] + net.p["d"]
            assert np.allclose(got[k, t], np.exp(z) / np.exp(z).sum(), atol=1e-5)


def test_attention_bag_by_bag():
    model, rng = quality.AttentionModel(5, 4, 3), np.random.default_rng(1)
    bags = [rng.normal(size=(n, 5)) for n in (1, 3, 2)]
    got = model.forward(np.concatenate(bags), np.array([0, 1, 4]))[-1]
    for logit, bag in zip(got, bags, strict=True):
        h = [np.tanh(x @ model.p["w"] + model.p["c"]) for x in bag]
        pull = np.exp([(np.tanh(x @ model.p["v"]) / (1 + np.exp(-(x @ model.p["u"])))) @ model.p["a"] for x in h])
        assert abs(sum(w * x for w, x in zip(pull / pull.sum(), h, strict=True)) @ model.p["o"] + model.p["d"][0] - logit) < 1e-9


@pytest.mark.parametrize("crowd", [24, 2])
def test_op6_planted_links(spark, monkeypatch, crowd):
    """Fingerprints 1 to 4 bits apart, and a crowd around one word, in cells of few and of many."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for f in sorted(fps)[:50]:
        for k in (1, 2, 3, 4):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), k)))
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << i) for i in range(0, 64, 2)} | {centre ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(60)}
    fps = sorted(fps)

    def roots(links):
        root = list(range(len(fps)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return [find(x) for x in range(len(fps))]

    want = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 2]
    rows = [(r.a, r.b) for r in simhash.link_fingerprints(spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "rep long, fp long")).collect()]
    assert len(want) > 100 and all((fps[a] ^ fps[b]).bit_count() <= 2 for a, b in rows) and roots(rows) == roots(want)


def test_op6_cells_are_not_broadcast(spark, monkeypatch):
    """A few fingerprints have many times their bytes of cells: neither side of the cells' join goes through the driver."""
    stored, whole = [], simhash.cut
    monkeypatch.setattr(simhash, "cut", lambda df: stored.append(df) or whole(df))
    rows = spark.createDataFrame([(1, 5), (2, 7), (3, 1 << 40)], "rep long, fp long")
    assert [tuple(r) for r in simhash.link_fingerprints(rows).collect()] == [(1, 2)]
    plan = stored[0]._jdf.queryExecution().executedPlan().toString()
    assert "cell" in stored[0].columns and "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize(("words", "best"), [(22, 16), (67, 51), (213, 160)])
def test_op7_recall_at_larger_codes(words, best):
    """The codes of 50 thousand, 5 million and 500 million vectors, at the threshold itself."""
    rng = np.random.default_rng(0)
    n = 60
    a = vectors.unit(rng.normal(size=(n, 64)))
    z = rng.normal(size=(n, 64))
    z = vectors.unit(z - (z * a).sum(axis=1, keepdims=True) * a)
    code = vectors.ProductCode(64, words, best=best)
    shared = [len(np.intersect1d(x, y)) > 0 for x, y in zip(code.decode(a), code.decode(0.93 * a + np.sqrt(1 - 0.93**2) * z), strict=True)]
    assert np.mean(shared) >= 0.9


def test_op8_against_plain_pareto_sampling(spark, docs):
    """Copies of each document, against one walk over each source's documents in Pareto order."""
    mixed = {r.doc_id: r for r in mixing.mix(docs).select("doc_id", f"{mixing.MIX}.*").collect()}
    rows = [r.m for r in mixing.measured(docs, mixing.SEED).select(F.col(mixing.MIX).alias("m")).collect()]
    total = Counter()
    for r in rows:
        total[r.source] += r["size"]
    seen = set()
    for source, goal in mixing.targets(dict(total)).items():
        own = [r for r in rows if r.source == source]
        low, high = 0.0, 2.0
        for _ in range(200):  # the rate at which expected words make the target
            rate = (low + high) / 2
            low, high = (rate, high) if sum(min(2.0, rate * r["size"].bit_length()) * r["size"] for r in own) < goal else (low, rate)
        copies = {r.id: round(min(2.0, high * r["size"].bit_length()), 9) for r in own}
        seen |= {round(c % 1, 6) for c in copies.values()}
        missing = goal - sum(int(copies[r.id]) * r["size"] for r in own)
        odds = lambda r: r.u / (1 - r.u) / (copies[r.id] % 1 / (1 - copies[r.id] % 1))  # noqa: B023, E731
        order = sorted((r for r in own if copies[r.id] % 1 > 0), key=lambda r: (odds(r), r.id))
        taken = set()
        for r in order:
            if r["size"] <= missing:
                taken.add(r.id)
                missing -= r["size"]
        extra = [r for r in order if r.id not in taken and r["size"] < 2 * missing]
        taken |= {min(extra, key=lambda r: (abs(r["size"] - missing), odds(r))).id} if extra else set()
        assert {r.id: mixed[r.id].copies for r in own} == {r.id: int(copies[r.id]) + (r.id in taken) for r in own}, source
    assert len(seen) > 20  # documents of one source have unequal probabilities


def test_op9_many_matches(spark):
    text = "é token=abcdef, " * 3000 + "secret: " + "0123456789abcdef" * 2
    df = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    got = [(r.start, r.kind, r.stop) for r in secrets.scan(df).first().base]
    assert got == [s[:3] for s in base_spans(text)]
    assert secrets.redact(df).first().text == "é [secret], " * 3000 + "[secret]"


def test_op10_large_components(spark):
    v = [(0, [600000.0, 1.0]), (1, [700000.0, 0.0]), (2, [1e12, -3.0]), (3, [-1e5, 2.0]), (50, [2.0**40, 2.0**38]), (4, [])]
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(spark.createDataFrame(v, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, k=9).collect()}
    whole = {i: [int(256 * x) for x in e] for i, e in v}
    exact = {(q, c): sum(x * y for x, y in zip(whole[q], whole[c], strict=True)) for q in (0, 50) for c in (0, 1, 2, 3, 50) if q != c}
    assert got == {k: max(-(1 << 63), min((1 << 63) - 1, x)) for k, x in exact.items()} and got[0, 1] == 27525120000000000


def test_network_gradients_weighted():
    net = language.ByteNetwork(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes, mask = language.padded([b"abc", b"de", b"zabx"])
    label, weight = np.array([0, 1, 2]), np.array([0.5, 3.0, 1.0])
    grads = net.gradients(codes, mask, label, weight)

    def loss():
        p = net.probabilities(codes, mask)
        return -(weight[label][:, None] * np.log(p[np.arange(3), :, label]) * mask).sum() / mask.sum()

    for key, at in (("o", (0, 1)), ("d", (2,)), ("hf", (1, 5)), ("hb", (2, 9)), ("xf", (ord("d"), 3)), ("cb", (7,))):
        value, keep = net.p[key], net.p[key][at]
        value[at] = keep + 1e-3
        up = loss()
        value[at] = keep - 1e-3
        down = loss()
        value[at] = keep
        assert abs((up - down) / 2e-3 - grads[key][at]) < 2e-3, key


def test_op3_rare_language(spark, docs):
    """Thirty texts of one language beside hundreds of the others: all runs are learnt from, the rare one is still told."""
    rows = docs.where("lang is not null").select("lang", "text").collect()
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r.text)
    rare = min(by)
    size = {y: 30 if y == rare else len(texts) // 2 for y, texts in by.items()}
    found = language.train([(t, y) for y, texts in sorted(by.items()) for t in texts[: size[y]]])
    for y, texts in by.items():
        left = [t for t in texts[size[y] :] if language.has_letter(t)]
        assert left and np.mean([p == y for p, _ in found.predict(left)]) > 0.9, y
