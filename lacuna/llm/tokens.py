"""Token counts by a finite-state transducer that is compiled from a byte-pair vocabulary.

A split of a text into pieces is the one that byte-pair merging gives if and only if merging each two neighbouring pieces by
themselves gives these two. So the last piece of every beginning of a text follows from the last pieces of shorter
beginnings, and what the next characters can do depends only on the pieces that are open there: a state is, for each open
place, the node of the vocabulary's trie that the characters since then have reached, the piece that ends at the place, and
how many pieces fewer lie before it. Reading a character leads to one state, and the transition is annotated with the
number of pieces that it adds (below zero where pieces merge). States and transitions are made when a text first needs
them, and are kept in the worker up to STATES.

Where no piece of the vocabulary holds a character and its successor side by side, every state is left for the start
state. A chunk of a text is thereby a map from the state before it to the state and the count after it, kept as the
characters up to the chunk's first such place, the count from there on and the state at its end. Maps compose
associatively. Texts of up to CHUNK characters are read in their task; longer ones are cut there into chunks, at any
character, dealt out to other tasks, and their maps compose in a tree, FAN at a time, the scan's up-sweep. The state before
a text is the start state, so that the composed map gives its count.

Defined results: null and empty texts have no bytes and no tokens; repeated rows are counted as often as they occur; null
ids stay; an empty table gives no rows; other columns are ignored. Only models of merged pieces with byte fallback, and
without unused pieces, are compiled; any other model is an error.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import cut

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Characters of a chunk, chunk maps that compose in one task, states and words that a worker keeps; it starts anew beyond these.
CHUNK, FAN = 65_536, 64
STATES, MEMO_WORDS = 400_000, 800_000

#: (trie node, piece that ends where the node's characters begin, pieces up to there less pieces up to now) of each open place.
State = tuple[tuple[int, str, int], ...]
START: State = ((0, "", 0),)
#: Texts whose counts must equal the library's before a compiled model is used.
PROBES = ("", " ", "a  b ", "the training of models\n\tçà et là", "aaaaaaaaa 2024 <s>x</s>", "\U0001f600\U0001f601 x")


class ChunkMap(NamedTuple):
    """What a chunk does to any state: `head` is read from that state; if `reset`, the rest is known beforehand."""

    head: str
    count: int
    end: State
    reset: bool


class Transducer:
    def __init__(self, path: str, states: int = STATES):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        self.states = states
        ids = range(self.library.get_piece_size())
        special = lambda i: self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)
        self.score = {self.library.id_to_piece(i): self.library.get_score(i) for i in ids if not special(i)}
        #: Pairs of characters that some piece holds side by side.
        self.inside = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.children: list[dict[str, int]] = [{}]
        self.piece: list[str] = [""]
        for p in self.score:
            node = 0
            for c in p:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.piece.append("")
                node = self.children[node][c]
            self.piece[node] = p
        #: Words are a run of the blank's sign and what follows up to the next, where no piece goes on beyond them.
        self.word = re.compile("▁*[^▁]+|▁+" if not any(x[1] == "▁" != x[0] for x in self.inside) else r"[\s\S]+")
        self.clear()
        self.pairs: dict[tuple[str, str], bool] = {}
        fallback = all(self.library.is_byte(self.library.piece_to_id(f"<0x{b:02X}>")) for b in range(256))
        if not fallback or any(self.library.is_unused(i) for i in ids) or any(c not in self.score for p in self.score for c in p):
            raise ValueError(f"{path}: only models of merged pieces with byte fallback and without unused pieces are compiled")
        if any(self.count(self.library.normalize(x)) != len(self.library.encode(x)) for x in PROBES):
            raise ValueError(f"{path}: the compiled model does not count as the library does")

    def clear(self) -> None:
        self.number: dict[State, int] = {START: 0}
        self.key: list[State] = [START]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.memo: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging of a few characters: the best-scored pair merges first, the leftmost of equals."""
        parts = list(text)
        while True:
            best = max(((s, -i) for i in range(len(parts) - 1) if (s := self.score.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return parts
            parts[-best[1] : 2 - best[1]] = [parts[-best[1]] + parts[1 - best[1]]]

    def beside(self, left: str, right: str) -> bool:
        """Whether merging leaves the piece `right` whole after the piece `left`, or alone if that is empty."""
        if (left, right) not in self.pairs:
            if len(self.pairs) > 4 * self.states:
                self.pairs.clear()
            self.pairs[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return self.pairs[left, right]

    def next(self, state: State, c: str) -> tuple[State, int]:
        """The state after reading c, and the number of pieces that this adds."""
        if c not in self.score:
            return START, len(c.encode("utf-8", "surrogatepass"))
        last = state[0][1]
        if last and last[-1] + c not in self.inside:
            state = START
        opened, ends = [], None
        for node, left, behind in state:
            child = self.children[node].get(c)
            if child is None:
                continue
            if ends is None and self.piece[child] and self.beside(left, self.piece[child]):
                ends = self.piece[child], behind + 1
            if self.children[child]:
                opened.append((child, left, behind))
        assert ends, "some piece ends at every character"
        return ((0, ends[0], 0), *sorted((node, left, behind - ends[1]) for node, left, behind in opened)), ends[1]

    def move(self, at: int, c: str) -> tuple[int, int]:
        state, n = self.next(self.key[at], c)
        to = self.number.setdefault(state, len(self.key))
        if to == len(self.key):
            self.key.append(state)
            self.moves.append({})
        self.moves[at][c] = to, n
        return to, n

    def run(self, state: State, text: str) -> tuple[State, int]:
        """The state after a text read from `state`, and the pieces that it adds."""
        if len(self.key) > self.states:
            self.clear()
        at, total = self.number.setdefault(state, len(self.key)), 0
        if at == len(self.key):
            self.key.append(state)
            self.moves.append({})
        moves = self.moves
        for c in text:
            found = moves[at].get(c)
            at, n = found if found else self.move(at, c)
            total += n
        return self.key[at], total

    def count(self, normal: str) -> int:
        """Tokens of a whole normalized text; words begin in the start state, and a word's count is remembered."""
        words = self.word.findall(normal)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        try:
            return sum([self.memo[w] for w in words])
        except KeyError:
            for w in set(words):
                if w not in self.memo:
                    n = self.run(START, w)[1]  # may clear the memo
                    self.memo[w] = n
        return sum(self.memo[w] if w in self.memo else self.run(START, w)[1] for w in words)

    def chunk_map(self, chunk: str) -> ChunkMap:
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in self.inside:
                end, n = self.run(START, chunk[i:])
                return ChunkMap(chunk[:i], n, end, True)
        return ChunkMap(chunk, 0, START, False)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of a's chunk with b's after it."""
        if not a.reset:
            return ChunkMap(a.head + b.head, b.count, b.end, b.reset)
        end, n = self.run(a.end, b.head)
        return ChunkMap(a.head, a.count + n + b.count, b.end if b.reset else end, True)

    def total(self, m: ChunkMap) -> int:
        """Pieces that a map adds to the start state."""
        return self.run(START, m.head)[1] + m.count


@functools.lru_cache(maxsize=2)
def compiled(path: str) -> Transducer:
    """The transducer of a vocabulary file; workers keep it between tasks."""
    return Transducer(path)


def counter(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(path)
        for batch in batches:
            n = [t.count(t.library.normalize(x.as_py() or "")) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return counts


def slicer(path: str, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """key, text -> the text's normalized form in chunks."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(path)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                normal = t.library.normalize(text.as_py())
                for at in range(0, len(normal), 64 * chunk):  # a few chunks are in memory twice
                    parts = [normal[x : x + chunk] for x in range(at, min(at + 64 * chunk, len(normal)), chunk)]
                    yield pa.RecordBatch.from_pydict({"key": [key] * len(parts), "no": pa.array(range(at // chunk, at // chunk + len(parts)), pa.int64()), "chunk": parts})

    return slices


OPEN = "array<struct<node:int,last:string,behind:int>>"
MAPS = f"key string, no long, head string, count long, end {OPEN}, reset boolean"
KINDS = pa.schema([("key", pa.string()), ("no", pa.int64()), ("head", pa.string()), ("count", pa.int64()), ("end", pa.list_(pa.struct([("node", pa.int32()), ("last", pa.string()), ("behind", pa.int32())]))), ("reset", pa.bool_())])


def row(key: str, no: int, m: ChunkMap) -> dict:
    end = [dict(zip(("node", "last", "behind"), x, strict=True)) for x in m.end]
    return {"key": key, "no": no, "head": m.head, "count": m.count, "end": end, "reset": m.reset}


def mapper(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(path)
        for batch in batches:
            found = [row(key, no, t.chunk_map(text.as_py())) for key, no, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_pylist(found, KINDS)

    return maps


def composer(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """key, no, maps in order -> one map."""

    def composes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(path)
        for batch in batches:
            found = []
            for key, no, maps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                states = [ChunkMap(x["head"], x["count"], tuple((y["node"], y["last"], y["behind"]) for y in x["end"]), x["reset"]) for x in maps]
                found.append(row(key, no, functools.reduce(t.compose, states)))
            yield pa.RecordBatch.from_pylist(found, KINDS)

    return composes


def totaller(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(path)
        for batch in batches:
            key, head, count, reset = (c.to_pylist() for c in batch.columns)
            n = [t.total(ChunkMap(h, c, START, r)) for h, c, r in zip(head, count, reset, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(n, pa.int64())], names=["key", "n_tokens"])

    return totals


def long_counts(texts: DataFrame, path: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """key and n_tokens of texts(key, text), equal texts having equal keys."""
    chunks = texts.mapInArrow(slicer(path, chunk), "key string, no long, chunk string").dropDuplicates(["key", "no"])
    maps = cut(chunks.mapInArrow(mapper(path), MAPS))
    last = maps.agg(F.max("no")).first()[0] or 0
    while last:
        groups = maps.groupBy("key", F.floor(F.col("no") / fan).alias("to")).agg(F.array_sort(F.collect_list(F.struct("no", "head", "count", "end", "reset"))).alias("maps"))  # `fan` maps at most
        maps = groups.select("key", "to", "maps").mapInArrow(composer(path), MAPS)
        last //= fan
    return maps.select("key", "head", "count", "reset").mapInArrow(totaller(path), "key string, n_tokens long")


def tokenizer_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens) of docs(doc_id, text)."""
    path = tokenizer_path(path)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    size = F.length("text")
    short = rows.where(size <= chunk).mapInArrow(counter(path), "doc_id long, n_bytes long, n_tokens long")
    long_ = rows.where(size > chunk).withColumn("key", F.sha2("text", 256))
    counts = long_counts(long_.select("key", "text"), path, chunk, fan)
    both = short.union(long_.select("doc_id", "n_bytes", "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens"))
    return both.withColumn("over_limit", F.col("n_tokens") > limit)
