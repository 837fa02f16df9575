"""Spelling variants grouped by intersecting Levenshtein automata with broadcast trie shards.

Words are counted in the JVM, summed in each task before they meet. The different words, sorted, are cut into shards of at
most SHARD words; a shard is a trie in depth-first order, front-coded: for each word how many characters it shares with the
one before, and the others. Shards of together at most BROADCAST bytes are broadcast at a time; larger vocabularies take as
many rounds as that needs, so that neither driver nor workers ever hold more. In a round each task takes its words through
every broadcast shard: the shard's trie is expanded, and the automaton that accepts what is one edit away from a word walks
it depth-first. Its states are the number of the word's characters read and whether the edit was made; without the edit, a
node is left for the edit's outcomes below it, and where neither the word's next character nor an edit goes on the shard
is left at once, which for most shards is at the root, as a shard is a range of the order. A task leaves one row for a word
and round, the number of neighbours and the best of them, and these are reduced by word. Forms are followed by doubling.

Defined results: null texts have no words; a null id counts as an empty text before the colon; repeated rows count as often
as they occur; of equally frequent neighbours the smallest in code-point order is the form; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import cut

#: Runs of these are words; one in SLIPS of them, told by the id and the run, loses a character. LEAST code points, TIMES occurrences.
LETTERS = r"[A-Za-zÀ-ÿ]+"
SLIPS, LEAST, TIMES = 199, 6, 5
#: A form occurs this many times as often as the word.
RATIO = 5
#: Words of a shard and of a task, bytes of shards that are broadcast at a time, tries that a worker keeps expanded.
SHARD, TASK_WORDS, BROADCAST, EXPANDED = 65_536, 65_536, 32_000_000, 8

#: A trie: next character -> trie, or (rest, count) where one word goes on; "" -> the count of the word that ends here.
Trie = dict


def slipped(doc: Column, run: Column, slips: int = SLIPS) -> Column:
    """The run as the document has it: without one character where `slips` divides the checksum of id and run."""
    h = F.crc32(F.encode(F.concat_ws(":", F.coalesce(doc.cast("string"), F.lit("")), run), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % slips == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(docs: DataFrame, slips: int = SLIPS, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """word and n of the words of docs(doc_id, text) with at least `least` code points and `times` occurrences."""
    lower = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.col("doc_id").cast("long").alias("doc"), F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), F.lit(0))).alias("run")).where(F.length("run") >= least)
    words = runs.select(slipped(F.col("doc"), F.col("run"), slips).alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def shared(a: str, b: str) -> int:
    """The number of characters with which both begin."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


SHARDS = "size long, prefix binary, rest binary, letters string, counts binary"


def packer(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """word, n in order -> front-coded shards of at most `size` words."""

    def pack(words: list[str], counts: list[int]) -> pa.RecordBatch:
        prefix = [shared(a, b) for a, b in zip(["", *words], words, strict=False)]
        rest = [w[p:] for w, p in zip(words, prefix, strict=True)]
        row = {"prefix": np.array(prefix, "<u4").tobytes(), "rest": np.array([len(x) for x in rest], "<u4").tobytes(), "letters": "".join(rest), "counts": np.array(counts, "<i8").tobytes()}
        total = sum(len(x.encode() if isinstance(x, str) else x) for x in row.values())
        return pa.RecordBatch.from_pydict({"size": [total]} | {k: [v] for k, v in row.items()})

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[str] = []
        counts: list[int] = []
        for batch in batches:
            words += batch.column(0).to_pylist()
            counts += batch.column(1).to_pylist()
            while len(words) >= size:
                yield pack(words[:size], counts[:size])
                del words[:size], counts[:size]
        if words:
            yield pack(words, counts)

    return packs


def unpacked(prefix: bytes, rest: bytes, letters: str, counts: bytes) -> Iterator[tuple[str, int]]:
    """The words and counts of a shard."""
    word, at = "", 0
    for p, r, n in zip(np.frombuffer(prefix, "<u4").tolist(), np.frombuffer(rest, "<u4").tolist(), np.frombuffer(counts, "<i8").tolist(), strict=True):
        word, at = word[:p] + letters[at : at + r], at + r
        yield word, n


def expanded(words: Iterator[tuple[str, int]]) -> Trie:
    root: Trie = {}
    for word, n in words:
        node, rest, count = root, word, n
        while True:
            if not rest:
                node[""] = count
                break
            c, rest = rest[0], rest[1:]
            child = node.get(c)
            if child is None:
                node[c] = rest, count
                break
            if type(child) is tuple:  # one word so far: its rest moves one node down
                tail, other = child
                child = node[c] = {tail[:1]: (tail[1:], other) if tail else other}
            node = child
    return root


def one_edit(a: str, b: str) -> bool:
    """Whether b is a with exactly one character inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = shared(a, b)
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def accepted(child: Trie | tuple[str, int] | None, word: str, i: int) -> int | None:
    """The count of the word below `child` that goes on exactly as word[i:], the edit being made."""
    while type(child) is dict:
        if i == len(word):
            return child.get("")
        child = child.get(word[i])
        i += 1
    return child[1] if child and child[0] == word[i:] else None


def neighbours(root: Trie, word: str) -> dict[str, int]:
    """The words of a trie one edit away from `word`, with their counts: the automaton's walk, depth-first."""
    found: dict[str, int] = {}
    node, size = root, len(word)
    for i in range(size + 1):  # node spells word[:i], the edit not yet made
        here = word[i : i + 1]
        if here and (n := accepted(node, word, i + 1)):
            found[word[:i] + word[i + 1 :]] = n
        for c, child in node.items():
            if c:
                if n := accepted(child, word, i):
                    found[word[:i] + c + word[i:]] = n
                if c != here and here and (n := accepted(child, word, i + 1)):
                    found[word[:i] + c + word[i + 1 :]] = n
        node = node.get(here) if here else None
        if node is None:
            break
        if type(node) is tuple:  # one word is left here
            if one_edit(word[i + 1 :], node[0]):
                found[word[: i + 1] + node[0]] = node[1]
            break
    return found


NEAR = "word string, n_near long, best_n long, best string"


def walker(shards: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words -> for each the number of its neighbours in the broadcast shards, and the most frequent of them."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [w for batch in batches for w in batch.column(0).to_pylist()]  # about TASK_WORDS
        best: dict[str, tuple[int, int, str]] = {}
        for shard in shards.value:
            trie = trie_of(shard)
            for word in words:
                if found := neighbours(trie, word):
                    top = min((-n, w) for w, n in found.items())
                    n, *old = best.get(word, (0, *top))
                    best[word] = (n + len(found), *min(tuple(old), top))
        if best:
            n, minus, top = zip(*best.values(), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.string()), pa.array(n, pa.int64()), pa.array([-x for x in minus], pa.int64()), pa.array(top, pa.string())], names=["word", "n_near", "best_n", "best"])

    return walk


@functools.lru_cache(maxsize=EXPANDED)
def trie_of(shard: tuple[bytes, bytes, str, bytes]) -> Trie:
    return expanded(unpacked(*shard))


def make_shards(words: DataFrame, size: int = SHARD) -> DataFrame:
    """Front-coded shards of words(word, n), whose number of words is counted."""
    parts = max(1, math.ceil(words.count() / size))
    return words.repartitionByRange(parts, "word").sortWithinPartitions("word").select("word", "n").mapInArrow(packer(size), SHARDS)


def near_words(words: DataFrame, size: int = SHARD, task_words: int = TASK_WORDS, most: int = BROADCAST) -> DataFrame:
    """word, n_near, best_n and best of words(word, n), a row for each word with a neighbour."""
    spark = words.sparkSession
    shards = cut(make_shards(words, size).withColumn("no", F.monotonically_increasing_id()))
    dealt = cut(words.select("word").repartition(max(1, math.ceil(words.count() / task_words)), "word"))
    sizes, rounds = sorted((r.no, r["size"]) for r in shards.select("no", "size").collect()), [[]]  # a number for each `size` words
    total = 0
    for no, bytes_ in sizes:
        if rounds[-1] and total + bytes_ > most:
            rounds.append([])
            total = 0
        rounds[-1].append(no)
        total += bytes_
    parts = None
    for numbers in rounds:
        held = shards.where(F.col("no").between(numbers[0], numbers[-1])).orderBy("no").collect() if numbers else []
        sent = spark.sparkContext.broadcast([(bytes(r.prefix), bytes(r.rest), r.letters, bytes(r.counts)) for r in held])
        found = cut(dealt.mapInArrow(walker(sent), NEAR))
        sent.destroy()
        parts = found if parts is None else parts.union(found)
    least = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("x")).select("word", "n_near", (-F.col("x.minus")).alias("best_n"), F.col("x.best").alias("best"))


def follow(forms: DataFrame, limit: int = 64) -> DataFrame:
    """word and root of forms(word, form), which have no cycles: forms are followed to the last, twice as far in each round."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(limit):
        then = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = cut(now.join(then, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if not moved.where("moved").limit(1).count():
            return now
        now = moved.drop("moved")
    raise RuntimeError(f"forms did not end in {limit} rounds")


def group(words: DataFrame, ratio: int = RATIO, size: int = SHARD, task_words: int = TASK_WORDS, most: int = BROADCAST) -> DataFrame:
    """word, form, root, n, n_near and form_n of words(word, n), different words."""
    words = cut(words)
    found = words.join(near_words(words, size, task_words, most), "word", "left")
    known = F.col("best_n") >= ratio * F.col("n")
    found = cut(found.select("word", F.when(known, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(known, F.col("best_n")).alias("form_n")))
    roots = follow(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """The spelling variants of docs(doc_id, text): word, form, root, n, n_near, form_n."""
    return group(count_words(docs))
