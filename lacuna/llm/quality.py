"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words. Each passage is encoded as shares of character classes, word shapes,
repetition within the passage and repetition of earlier passages. The network embeds every passage, weighs it by gated
attention, tanh(Vh) * sigmoid(Uh), normalised over the bag, and scores the weighted mean. Embedding, attention and score
are learnt together from document labels by gradient descent in numpy on the driver, over at most `per_label` different
texts of each label. Whole texts are scored, in Arrow batches; a text's score depends on that text alone.

Defined results: null and empty texts are one empty passage and get that passage's score; without labels every score is
0.5. Repeated rows get equal rows; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import id_crc, labelled_sample

PASSAGE = 48
#: Documented bound of the training sample: different texts of each label.
PER_LABEL = 1500
THRESHOLD = 0.3
#: Characters with a class of their own; the others are grouped.
OWN = "!*&$%#|.,?:;-_/=+@<>()[]{}\"'\\"
LOWER, UPPER, DIGIT, BLANK, LINE, HIGH, OTHER = range(7)
CLASSES = 7 + len(OWN)
FEATURES = CLASSES + 6


def byte_classes() -> np.ndarray:
    out = np.full(256, OTHER, np.int64)
    for b in range(128):
        x = chr(b)
        out[b] = 7 + OWN.index(x) if x in OWN else LOWER if x.islower() else UPPER if x.isupper() else DIGIT if x.isdigit() else LINE if x == "\n" else BLANK if x.isspace() else OTHER
    out[128:] = HIGH
    return out


_CLASS = byte_classes()


def encode(text: str) -> np.ndarray:
    """(passages, FEATURES) of a text, whole."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    words = text.encode("utf-8", "replace").split()
    n = max(1, -(-len(words) // PASSAGE))
    out = np.zeros((n, FEATURES), np.float32)
    if not words:
        return out
    kind = _CLASS[raw]
    solid = (kind != BLANK) & (kind != LINE)
    starts = solid & ~np.concatenate([[False], solid[:-1]])
    passage = np.minimum(np.maximum(np.cumsum(starts) - 1, 0) // PASSAGE, n - 1)
    counts = np.bincount(passage * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    size = counts.sum(axis=1, keepdims=True)
    out[:, :CLASSES] = counts / np.maximum(size, 1)
    seen: set = set()
    for k in range(n):
        part = words[k * PASSAGE : (k + 1) * PASSAGE]
        own = set(part)
        lengths = [len(x) for x in part]
        out[k, CLASSES:] = (len(own) / len(part), len(own & seen) / len(own), sum(lengths) / len(part) / 10, min(max(lengths), 100) / 30, len({x[-1] for x in part}) / len(part), len(part) / PASSAGE)
        seen |= own
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class AttentionModel:
    def __init__(self, features: int = FEATURES, hidden: int = 24, attention: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
        self.p = {"w": normal(features, hidden), "c": np.zeros(hidden), "v": normal(hidden, attention), "u": normal(hidden, attention), "a": normal(attention), "o": normal(hidden), "d": np.zeros(1)}
        self.mean, self.scale, self.fitted = np.zeros(features), np.ones(features), False

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        """x: passages of all bags one after another; first: where each bag begins."""
        p = self.p
        h = np.tanh(x @ p["w"] + p["c"])
        t, s = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * s) @ p["a"]
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        weight = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(weight[:, None] * h, first)
        return h, t, s, bag, weight, z, z @ p["o"] + p["d"][0]

    def gradients(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over the bags."""
        p, (h, t, s, bag, weight, z, logit) = self.p, self.forward(x, first)
        g = (sigmoid(logit) - label) / len(label)
        d_z = g[:, None] * p["o"]
        d_h = weight[:, None] * d_z[bag]
        pull = (h * d_z[bag]).sum(axis=1)
        d_e = weight * (pull - np.add.reduceat(weight * pull, first)[bag])
        d_t, d_s = d_e[:, None] * p["a"] * s * (1 - t * t), d_e[:, None] * p["a"] * t * s * (1 - s)
        d_h += d_t @ p["v"].T + d_s @ p["u"].T
        d_in = d_h * (1 - h * h)
        return {"w": x.T @ d_in, "c": d_in.sum(axis=0), "v": h.T @ d_t, "u": h.T @ d_s, "a": (t * s).T @ d_e, "o": z.T @ g, "d": np.array([g.sum()])}

    def fit(self, bags: list[np.ndarray], label: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 9) -> None:
        rng, rows = np.random.default_rng(seed), np.concatenate(bags)
        self.mean, self.scale, self.fitted = rows.mean(axis=0), rows.std(axis=0) + 0.02, True
        bags = [np.clip((x - self.mean) / self.scale, -8, 8) for x in bags]
        m, v, step = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                first = np.cumsum([0, *(len(bags[i]) for i in pick[:-1])])
                grads, step = self.gradients(np.concatenate([bags[i] for i in pick]), first, label[pick]), step + 1
                for k, g in grads.items():
                    g = g + decay * self.p[k]
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.p[k] -= rate * 0.93**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.fitted or not texts:
            return np.full(len(texts), 0.5)
        bags = [encode(x or "") for x in texts]
        first = np.cumsum([0, *(len(x) for x in bags[:-1])])
        return sigmoid(self.forward(np.clip((np.concatenate(bags) - self.mean) / self.scale, -8, 8), first)[-1])


def train(sample: list[tuple[str, int]]) -> AttentionModel:
    """A model from (text, label) rows. Labels are weighed as they come: both get the same number of texts at most, so that
    a score is a posterior under near-equal priors."""
    model = AttentionModel()
    if len({y for _, y in sample}) == 2:
        model.fit([encode(t) for t, _ in sample], np.array([float(y) for _, y in sample]))
    return model


def scorer(model: AttentionModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                part = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(model.score(part.column(part.num_columns - 1).to_pylist()), pa.float64())], names=[*part.schema.names[:-1], "score"])

    return scores


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, folds: int = 5, held: int = 0) -> AttentionModel:
    """Trains on docs(doc_id, text) with labels(doc_id, quality), without the documents of the fold `held`."""
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("y"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(id_crc("doc_id") % folds != held)
    return train(labelled_sample(rows, per_label, known=known))


def classify(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, threshold: float = THRESHOLD, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted of docs(doc_id, text)."""
    model = learn(docs, labels, per_label, folds, held)
    rows = docs.select(F.col("doc_id").cast("long"), (id_crc("doc_id") % folds == held).alias("held_out"), F.col("text").cast("string"))
    scored = rows.mapInArrow(scorer(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least `threshold`, with all their columns."""
    model, columns = learn(docs, labels, per_label), docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                part = batch.slice(at, 128)
                yield part.filter(pa.array(model.score([x.as_py() for x in part.column(columns.index("text"))]) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
