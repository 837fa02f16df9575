"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a lower-cased word in both directions and labels every byte with language
probabilities; a document's probabilities are the mean over the bytes of its letters. Words are the network's sequences
(longer ones go in runs of RUN bytes), so the result of a word does not depend on what stands around it, and each worker
computes a word once and remembers its summed probabilities, up to MEMO_WORDS words. Training is back-propagation
through time in numpy on the driver, over at most `per_label` different texts of each language. Every run of the sample is
learnt from; languages with fewer bytes than the mean weigh more in the loss, up to RARE times.

Defined results: a null text, or one without letters, is `und` with score 0; so is every text if nothing is labelled.
Repeated rows get equal rows; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import HAS_LETTER, id_crc, labelled_sample

UNKNOWN = "und"
RUN = 32
MEMO_WORDS = 500_000
#: Documented bound of the training sample: different texts of each language, and words of each of them.
PER_LABEL, WORDS_A_TEXT = 400, 120
HIDDEN = 20
#: Greatest weight of a language's bytes in the loss.
RARE = 20.0
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(x.isalpha() for x in set(text))


def runs_of(word: str) -> list[bytes]:
    raw = word.encode("utf-8", "replace")
    return [raw[i : i + RUN] for i in range(0, len(raw), RUN)]


def padded(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """bytes (runs, longest) and a mask of the same shape."""
    width = max(map(len, runs))
    codes = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in runs), dtype=np.uint8).reshape(len(runs), width)
    return codes, np.arange(width)[None, :] < np.fromiter(map(len, runs), int, len(runs))[:, None]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class ByteNetwork:
    """Two gated recurrent layers, one from either end, and a softmax over both states at each byte."""

    def __init__(self, labels: int, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for way in "fb":
            self.p["x" + way] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p["h" + way] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
            self.p["c" + way] = np.zeros(3 * hidden, np.float32)
        self.p["o"] = rng.normal(0, 0.3, (2 * hidden, labels)).astype(np.float32)
        self.p["d"] = np.zeros(labels, np.float32)

    def layer(self, codes: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States (width, runs, hidden) of one direction; keep gets what the way back needs."""
        n, width, h = *codes.shape, self.hidden
        state, out = np.zeros((n, h), np.float32), np.zeros((width, n, h), np.float32)
        wx, wh, c = (self.p[k + way] for k in "xhc")
        for t in range(width) if way == "f" else range(width - 1, -1, -1):
            x, r = wx[codes[:, t]] + c, state @ wh
            gates = sigmoid(x[:, : 2 * h] + r[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + reset * r[:, 2 * h :])
            on = mask[:, t, None]
            after = np.where(on, new + update * (state - new), state)
            if keep is not None:
                keep.append((t, state, update, reset, new, r[:, 2 * h :], on))
            state = out[t] = after
        return out

    def back(self, codes: np.ndarray, way: str, kept: list, grad: np.ndarray, into: dict) -> None:
        """Back-propagation through time of one direction; grad: (width, runs, hidden)."""
        h = self.hidden
        wh, carried = self.p["h" + way], np.zeros(grad.shape[1:], np.float32)
        gx, gh, gc = np.zeros_like(self.p["x" + way]), np.zeros_like(wh), np.zeros(3 * h, np.float32)
        for t, state, update, reset, new, rn, on in reversed(kept):
            g = grad[t] + carried
            live = g * on
            d_new = live * (1 - update) * (1 - new * new)
            d_update = live * (state - new) * update * (1 - update)
            d_reset = d_new * rn * reset * (1 - reset)
            d_x = np.concatenate([d_update, d_reset, d_new], axis=1)
            d_r = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            np.add.at(gx, codes[:, t], d_x)
            gc += d_x.sum(axis=0)
            gh += state.T @ d_r
            carried = live * update + g * ~on + d_r @ wh.T
        into["x" + way], into["h" + way], into["c" + way] = gx, gh, gc

    def probabilities(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(runs, width, labels)"""
        both = np.concatenate([self.layer(codes, mask, "f"), self.layer(codes, mask, "b")], axis=2)
        return self.softmax(both).transpose(1, 0, 2)

    def softmax(self, both: np.ndarray) -> np.ndarray:
        z = both @ self.p["o"] + self.p["d"]
        e = np.exp(z - z.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True)

    def gradients(self, codes: np.ndarray, mask: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all bytes, those of a run weighed by its label's weight."""
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self.layer(codes, mask, way, kept[way]) for way in "fb"], axis=2)
        g = self.softmax(both)
        g[:, np.arange(len(label)), label] -= 1
        g *= mask.T[:, :, None] / mask.sum()
        if weight is not None:
            g *= weight[label].astype(np.float32)[None, :, None]
        out = {"o": np.einsum("tnh,tnl->hl", both, g), "d": g.sum(axis=(0, 1))}
        states = g @ self.p["o"].T
        self.back(codes, "f", kept["f"], states[:, :, : self.hidden], out)
        self.back(codes, "b", kept["b"], states[:, :, self.hidden :], out)
        return out

    def fit(self, runs: list[bytes], label: np.ndarray, weight: np.ndarray, epochs: int = 3, batch: int = 256, rate: float = 0.01, seed: int = 3) -> None:
        """Adam with gradients clipped by their norm, over batches of runs of like length."""
        rng = np.random.default_rng(seed)
        m, v, step = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        length = np.array([len(x) for x in runs])
        batches = np.array_split(np.lexsort((rng.random(len(runs)), length)), max(1, len(runs) // batch))
        for epoch in range(epochs):
            for i in rng.permutation(len(batches)):
                pick = batches[i]
                codes, mask = padded([runs[j] for j in pick])
                grads, step = self.gradients(codes, mask, label[pick], weight), step + 1
                norm = sum(float((g * g).sum()) for g in grads.values()) ** 0.5
                for k, g in grads.items():
                    g = g / max(1.0, norm)
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.p[k] -= (rate * 0.5**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)


class Identifier:
    def __init__(self, labels: list[str], network: ByteNetwork):
        self.labels, self.network = labels, network
        self.letter = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
        self.reset()

    def reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.sums = np.zeros((1024, len(self.labels) + 1), np.float32)

    def learn(self, words: list[str]) -> None:
        """Puts the words' probabilities, summed over the bytes of letters, and the number of these bytes into the memo."""
        start = len(self.memo)
        self.memo.update(zip(words, range(start, start + len(words)), strict=True))
        if (need := start + len(words)) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((need, self.sums.shape[1]), np.float32)])
        runs, owner = [], []
        for i, w in enumerate(words, start):
            for x in runs_of(w):
                runs.append(x)
                owner.append(i)
        order = np.argsort([len(x) for x in runs], kind="stable")
        owner = np.array(owner)
        for at in range(0, len(runs), 4096):
            pick = order[at : at + 4096]
            codes, mask = padded([runs[j] for j in pick])
            weight = (mask & self.letter[codes]).astype(np.float32)
            sums = np.einsum("nt,ntl->nl", weight, self.network.probabilities(codes, mask))
            np.add.at(self.sums, owner[pick], np.concatenate([sums, weight.sum(axis=1, keepdims=True)], axis=1))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for text in texts:
            if not self.labels or not text or not has_letter(text):
                out.append((UNKNOWN, 0.0))
                continue
            words, memo = text.lower().split(), self.memo
            if new := [w for w in dict.fromkeys(words) if w not in memo]:
                if len(memo) > MEMO_WORDS:
                    self.reset()
                    memo, new = self.memo, list(dict.fromkeys(words))
                self.learn(new)
            total = self.sums[np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))].sum(axis=0, dtype=np.float64)
            mean = total[:-1] / max(1.0, total[-1])
            best = int(mean.argmax())
            out.append((self.labels[best], min(1.0, float(mean[best]))))
        return out


def train(sample: list[tuple[str, str]], words_a_text: int = WORDS_A_TEXT, seed: int = 11) -> Identifier:
    """An identifier from (text, language) rows; the same rows in the same order give the same one."""
    labels, rng = sorted({y for _, y in sample}), np.random.default_rng(seed)
    runs, label = [], []
    for text, y in sample:
        words = [w for w in text.lower().split() if HAS_LETTER.search(w)]
        for i in rng.permutation(len(words))[:words_a_text]:
            for x in runs_of(words[i]):
                runs.append(x)
                label.append(labels.index(y))
    network = ByteNetwork(max(1, len(labels)))
    if runs:
        size = np.bincount(label, weights=[len(x) for x in runs], minlength=len(labels))  # else common languages win all doubtful bytes
        network.fit(runs, np.array(label), np.minimum(RARE, size.mean() / np.maximum(1, size)))
    return Identifier(labels, network)


def predictor(identifier: Identifier) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = batch_predict(identifier, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return predict


def batch_predict(identifier: Identifier, texts: list[str | None]) -> list[tuple[str, float]]:
    """Looks all new words of the texts up at once, then predicts."""
    words = dict.fromkeys(w for t in texts if t for w in t.lower().split())
    new = [w for w in words if w not in identifier.memo]
    if identifier.labels and new:
        if len(identifier.memo) + len(new) > MEMO_WORDS:
            identifier.reset()
            new = list(words)
        identifier.learn(new)
    return identifier.predict(texts)


def identify(docs: DataFrame, per_label: int = PER_LABEL, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of docs(doc_id, text, lang); documents of the fold `held` are not learnt from."""
    rows = docs.select(F.col("doc_id").cast("long"), (id_crc("doc_id") % folds == held).alias("held_out"), F.col("text").cast("string"), F.col("lang").cast("string"))
    identifier = train(labelled_sample(rows.where("not held_out"), per_label, "lang"))
    return rows.select("doc_id", "held_out", "text").mapInArrow(predictor(identifier), "doc_id long, held_out boolean, lang_pred string, score double")
