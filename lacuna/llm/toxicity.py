"""Toxicity by a support vector machine on a subsequence string kernel with Nystrom landmarks.

Kernel: two words compare by their gap-weighted common subsequences of ORDER letters (a gap costs DECAY a letter),
normalised and raised to POWER; two sentences compare by the sum of that over their pairs of words, which is a kernel
again. Runs of single letters are read as one word, and signs within a word are passed over, so that gapped insults and
insults with inserted letters stay near the plain ones. Sentences enter the machine by their kernel with a few dozen
landmark words, whitened by the landmarks' own kernel (Nystrom); the machine is linear there, so a sentence's value is a
sum of values of its words, which workers compute once a word and remember, up to MEMO_WORDS words.

Labels are of documents: training takes all sentences of clean documents, of toxic ones the sentence that the machine
of the round before likes best, for ROUNDS rounds, with copies of these whose telling word got a letter or a gap. A
document scores as its worst sentence, through a logistic curve fitted to training documents. Training is bounded: at
most `per_label` different texts of each label, in numpy on the driver.

Defined results: null and empty texts have no sentence and score as a sentence without words; without both labels every
score is 0. Repeated rows get equal rows; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import id_crc, labelled_sample

ORDER, DECAY, POWER = 3, 0.75, 4
#: Letters of a word that are compared at once; longer words go in overlapping stretches.
STRETCH = 20
LANDMARKS, ROUNDS, TOLD, FORMS = 48, 3, 3, 4
#: Lengths of the beginnings of words that may be landmarks, START included.
STEM = range(6, 10)
#: Words of a sentence; longer ones are several.
SENTENCE = 24
#: Documented bound of the training sample: different texts of each label.
PER_LABEL = 1200
MEMO_WORDS = 700_000
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_][^\w\s]?[ ]){3,}[^\W\d_](?!\w)")
_END = "\x00"
#: Stands before the first letter, so that beginnings of words are told from their middles.
START = "^"


def sentences(text: str) -> list[str]:
    """Words of a text, with an _END after each sentence."""
    text = _SPELLED.sub(lambda m: _NOT_LETTERS.sub("", m[0]), text.lower())
    for sign in (". ", "! ", "? ", "\n"):
        text = text.replace(sign, f" {_END} ")
    return [*text.split(), _END]


def stretches(word: str) -> list[str]:
    """The letters of a word after a START, in overlapping stretches of at most STRETCH."""
    letters = START + _NOT_LETTERS.sub("", word)
    if len(letters) <= STRETCH:
        return [letters]
    return [letters[i : i + STRETCH] for i in range(0, len(letters) - STRETCH // 2, STRETCH // 2)]


def codes(words: list[str]) -> np.ndarray:
    """(words, longest) code points, 0 where a word has ended."""
    width = max(1, *map(len, words)) if words else 1
    raw = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "replace")
    return np.frombuffer(raw, dtype=np.uint32).reshape(len(words), width)


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common subsequences of ORDER letters, weighted by DECAY to the power of the lengths they span: (words a, words b),
    or (words,) of pairs at the same place if b is a itself."""
    pairs = a is b
    shape = (len(a),) if pairs else (len(a), len(b))
    width = b.shape[1]
    # prefix[i][j]: weight of matched subsequences of i + 1 letters up to here in a and up to letter j in b
    prefix = [[np.zeros(shape, np.float32) for _ in range(width + 1)] for _ in range(ORDER - 1)]
    total, run, step = np.zeros(shape, np.float32), np.zeros(shape, np.float32), np.zeros(shape, np.float32)
    decay, square = np.float32(DECAY), np.float32(DECAY * DECAY)
    for s in range(a.shape[1]):
        letter = np.where(a[:, s] == 0, np.uint32(0xFFFFFFFF), a[:, s])  # an ended word has no letter that b could have
        letter = letter if pairs else letter[:, None]
        equal = [np.multiply(letter == (b[:, j] if pairs else b[None, :, j]), square, dtype=np.float32) for j in range(width)]
        for j in range(width):
            np.multiply(equal[j], prefix[-1][j], out=step)
            total += step
        for i in range(ORDER - 2, -1, -1):
            run.fill(0)
            for j in range(width):
                run *= decay
                run += equal[j] if i == 0 else np.multiply(equal[j], prefix[i - 1][j], out=step)
                prefix[i][j + 1] *= decay
                prefix[i][j + 1] += run
    return total


class WordKernel:
    """Normalised kernel values between words and fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        order = sorted(range(len(landmarks)), key=lambda i: len(landmarks[i]))
        # landmarks of like length go together, as a group costs as much as its longest
        self.groups = [g for g in np.array_split(np.array(order, dtype=int), 3) if len(g)]
        self.codes = [codes([landmarks[i] for i in g]) for g in self.groups]
        self.own = [kernel(c, c) for c in self.codes]

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(words), 512):
            pick = np.array(order[at : at + 512])
            c = codes([words[i] for i in pick])
            size = kernel(c, c)[:, None]
            for g, of, own in zip(self.groups, self.codes, self.own, strict=True):
                norm = np.sqrt(np.maximum(size * own[None, :], 1e-12))
                out[np.ix_(pick, g)] = (kernel(c, of) / norm) ** POWER
        return out


class Machine:
    def __init__(self, word_kernel: WordKernel | None, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.kernel, self.weights, self.bias, self.slope, self.shift = word_kernel, weights, bias, slope, shift
        self.memo: dict[str, float] = {_END: np.nan}
        self.parts: dict[str, float] = {}

    def learn(self, words: list[str]) -> None:
        """Puts the words' values into the memo; words that differ in signs and capitals alone share their stretches' values."""
        if len(self.memo) + len(words) > MEMO_WORDS:
            self.memo, self.parts = {_END: np.nan}, {}
        split = [stretches(w) for w in words]
        new = [p for p in dict.fromkeys(p for ps in split for p in ps) if p not in self.parts]
        if new:
            self.parts.update(zip(new, (self.kernel(new) @ self.weights).tolist(), strict=True))
        self.memo.update((w, max(self.parts[p] for p in ps)) for w, ps in zip(words, split, strict=True))

    def values(self, texts: list[str | None]) -> np.ndarray:
        """The value of the worst sentence of each text."""
        tokens = [sentences(x or "") for x in texts]
        if new := [w for w in dict.fromkeys(w for t in tokens for w in t) if w not in self.memo]:
            self.learn(new)
            if any(w not in self.memo for t in tokens for w in t):  # the memo was emptied
                self.learn([w for w in dict.fromkeys(w for t in tokens for w in t) if w not in self.memo])
        out = np.empty(len(texts))
        for i, t in enumerate(tokens):
            v = np.fromiter(map(self.memo.__getitem__, t), np.float64, len(t))
            place, end = np.arange(len(t)), np.isnan(v)
            v[end] = 0
            begin = np.maximum.accumulate(np.concatenate([[0], np.where(end, place + 1, 0)[:-1]]))
            out[i] = np.add.reduceat(v, np.flatnonzero((place - begin) % SENTENCE == 0)).max() + self.bias
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.kernel is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.values(texts) + self.shift, -30, 30)))


def split_sentences(text: str) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = []
    words: list[str] = []
    for w in sentences(text):
        if w == _END:
            out += [tuple(words[i : i + SENTENCE]) for i in range(0, len(words), SENTENCE)]
            words = []
        else:
            words += [x for x in stretches(w) if len(x) >= ORDER]
    return out


def stems(words: set[str]) -> set[str]:
    """The words and their beginnings of STEM letters."""
    return words | {w[:n] for w in words for n in STEM if len(w) > n}


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]]) -> tuple[list[str], list[str]]:
    """Telling words and stems, and clean words that are like them.

    Telling ones are taken greedily: the one that most toxic texts have that are not told by TOLD of them yet, weighed down
    by its share of clean texts; those that only stand in texts told already, as rare words of near copies do, add nothing.
    The others are the words of clean texts with the highest kernel with a telling one.
    """
    where: dict[str, list[int]] = {}
    for i, t in enumerate(toxic):
        for w in stems(t):
            where.setdefault(w, []).append(i)
    where = {w: at for w, at in where.items() if len(at) >= 3}
    in_clean = Counter(w for t in clean for w in stems(t) if w in where)
    where = {w: at for w, at in where.items() if len(at) / len(toxic) > 5 * in_clean[w] / max(1, len(clean))}
    need, told, own = [TOLD] * len(toxic), [], {w for t in toxic for w in t}
    candidates = dict(where)
    while len(told) < LANDMARKS * 2 // 3 and candidates:
        gain = {w: sum(need[i] > 0 for i in at) - 3 * len(toxic) * in_clean[w] / max(1, len(clean)) for w, at in candidates.items()}
        best = min(gain, key=lambda w: (-gain[w], -len(w), w))
        if gain[best] < 3 + 0.005 * len(toxic):
            break
        # a stem stands for its commonest words that hardly any clean text has
        words = sorted((w for w in where if w in own and w.startswith(best) and in_clean[w] <= 1 + 0.001 * len(clean)), key=lambda w: (-len(where[w]), w))
        told += [w for w in words[:FORMS] if w not in told]
        for i in candidates.pop(best):
            need[i] -= 1
        candidates = {w: at for w, at in candidates.items() if gain[w] > 0 and not w.startswith(best) and not best.startswith(w)}
    if not told:
        return [], []
    known = set(told)
    words = sorted({w for t in clean for w in t} - known)
    near = WordKernel(told)(words).max(axis=1)
    return told, [words[i] for i in np.argsort(-near, kind="stable")[: LANDMARKS - len(told)]]


def hinge_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0, steps: int = 400) -> np.ndarray:
    """Weights and bias (last) of a linear machine: squared hinge loss, by accelerated gradient descent."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = last = np.zeros(x.shape[1])
    rate = 1 / (1 + 2 * cost * np.linalg.eigvalsh((x * weight[:, None]).T @ x).max())
    for k in range(steps):
        ahead = w + k / (k + 3) * (w - last)
        short = np.maximum(0, 1 - y * (x @ ahead))
        ridge = np.append(ahead[:-1], 0)
        last, w = w, ahead - rate * (ridge - 2 * cost * ((weight * short * y) @ x))
    return w


def disturbed(word: str, rng: np.random.Generator) -> str:
    """A letter put into a word."""
    at = int(rng.integers(2, len(word)))
    return (word[:at] + "abcdefghijklmnopqrstuvwxyz"[int(rng.integers(26))] + word[at:])[:STRETCH]


def train(sample: list[tuple[str, int]], seed: int = 17) -> Machine:
    """A machine from (text, label) rows; the same rows in the same order give the same one."""
    rng = np.random.default_rng(seed)
    texts = {y: [t for t, k in sample if k == y] for y in (0, 1)}
    if not texts[0] or not texts[1]:
        return Machine(None, np.zeros(0), 0.0, 1.0, 0.0)
    seen: set[tuple[str, ...]] = set()
    bags: dict[int, list[list[tuple[str, ...]]]] = {0: [], 1: []}
    for y in (0, 1):
        for t in texts[y]:
            own = [s for s in dict.fromkeys(split_sentences(t)) if s not in seen]  # near copies share sentences, which count once
            seen.update(own)
            bags[y].append(own)
    told, like = choose_landmarks(*([{w for s in b for w in s} for b in bags[y]] for y in (1, 0)))
    if not told:
        return Machine(None, np.zeros(0), 0.0, 1.0, 0.0)
    landmarks = told + like
    word_kernel = WordKernel(landmarks)
    clean = [s for b in bags[0] for s in b]
    vocabulary = {w: i for i, w in enumerate(sorted({w for s in clean for w in s} | {w for b in bags[1] for s in b for w in s}))}
    table = word_kernel(list(vocabulary))
    whiten = np.linalg.cholesky(np.linalg.inv(word_kernel(landmarks).astype(np.float64) + 1e-3 * np.eye(len(landmarks))))
    summed = lambda s: table[[vocabulary[w] for w in s]].sum(axis=0)
    negative = np.array([summed(x) for x in clean]).reshape(-1, len(landmarks)) @ whiten
    bags[1] = [b for b in bags[1] if b]
    rows = [np.array([summed(s) for s in b]) @ whiten for b in bags[1]]
    start = np.r_[np.ones(len(told)), np.zeros(len(like))]
    w = np.append(np.linalg.solve(whiten, start), 0.0)
    for _ in range(ROUNDS):
        best = [int((r @ w[:-1]).argmax()) for r in rows]
        positive, extra = [r[i] for r, i in zip(rows, best, strict=True)], []
        alpha = whiten @ w[:-1]
        for b, i in zip(bags[1], best, strict=True):
            s = list(b[i])
            k = int(np.argmax([table[vocabulary[x]] @ alpha for x in s]))
            if len(s[k]) > ORDER and len(s[k]) < STRETCH:
                extra.append((summed(s) - table[vocabulary[s[k]]], disturbed(s[k], rng)))
        changed = word_kernel([x for _, x in extra])
        positive += [(base + v) @ whiten for (base, _), v in zip(extra, changed, strict=True)]
        x, y = np.concatenate([np.array(positive), negative]), np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        w = hinge_fit(x, y, np.where(y > 0, 500 / len(positive), 12000 / max(1, len(negative))))
    machine = Machine(word_kernel, (whiten @ w[:-1]).astype(np.float32), float(w[-1]), 1.0, 0.0)
    value, label = machine.values(texts[0] + texts[1]), np.r_[np.zeros(len(texts[0])), np.ones(len(texts[1]))]
    value = np.clip(value, -10, 10)
    slope, shift = 1.0, 0.0
    for _ in range(400):  # logistic curve over the training documents, both labels weighing the same
        p = 0.5 + 0.5 * np.tanh(0.5 * (slope * value + shift))
        g = (p - label) * np.where(label > 0, 0.5 / len(texts[1]), 0.5 / len(texts[0]))
        slope, shift = slope - 2.0 * (g @ value), shift - 2.0 * g.sum()
        slope = min(max(slope, 1e-3), 6.0)
    machine.slope, machine.shift = float(slope), float(shift)
    machine.memo, machine.parts = {_END: np.nan}, {}
    return machine


#: The machine that a worker used last, with the words that it remembers, by its numbers.
_HELD: dict[bytes, Machine] = {}


def held(machine: Machine) -> Machine:
    """An equal machine of an earlier task of this worker, if there is one: its words are not valued again."""
    key = repr((machine.kernel and machine.kernel.landmarks, machine.weights.tobytes(), machine.bias, machine.slope, machine.shift)).encode()
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = machine
    return _HELD[key]


def scorer(machine: Machine) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held(machine)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(of.score(part.column(2).to_pylist()), pa.float64())], names=["doc_id", "held_out", "score"])

    return scores


def classify(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, threshold: float = 0.5, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted of docs(doc_id, text); labels(doc_id, toxic) of the fold `held` are not learnt from."""
    rows = docs.select(F.col("doc_id").cast("long"), (id_crc("doc_id") % folds == held).alias("held_out"), F.col("text").cast("string"))
    known = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("y"))
    machine = train(labelled_sample(rows.where("not held_out"), per_label, known=known))
    scored = rows.mapInArrow(scorer(machine), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
