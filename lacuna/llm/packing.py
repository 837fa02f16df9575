"""Best-fit packing of tokenized documents by minimum bin slack.

Stages: (1) every text is tokenized in Arrow batches and cut into pieces of at most `capacity` ids; (2) the counts of
the piece lengths, at most `capacity` numbers however many rows there are, go to the driver; (3) minimum bin slack fills
one sequence after another there: the longest piece left is fixed, a bitset subset-sum over the other lengths finds the
fullest feasible combination, and as many sequences of that combination as the counts allow are closed at once, so that
the work depends on the number of lengths, not of rows; (4) the plan, a bounded table of rank ranges for each length,
is joined to the pieces' ranks within their length. Ranks are salted, so that a length shared by a third of all rows
is dealt to many tasks.

Defined results: null and empty texts are one piece (the end id alone); repeated rows are packed as often as they occur;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import cut, ranked

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Words kept in a worker's memo; it starts anew beyond that.
MEMO_WORDS = 800_000
#: Words of these characters are cut into the vocabulary's pre-tokens here; all others go through the tokenizer whole.
PLAIN = re.compile(r"[!-&(-~¡-¿À-ÖØ-öø-ÿ]+")
PRE_TOKEN = re.compile(r"[A-Za-zªµºÀ-ÖØ-öø-ÿ]+|[0-9²³¹¼-¾]|[^A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼-¾]+")
#: White space to str.split() but not to the tokenizer's pattern.
SPLIT_ONLY = re.compile("[\x1c-\x1f]")

#: Pre-tokens on which the merger must agree with the tokenizer's model before it is used.
PROBES = ("a", "the", "training", "Ünïcode".lower(), "antidisestablishmentarianism", "!!", "...", "zqxj", "7", "été")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next from 256 up."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class WordTokenizer:
    """text -> little-endian uint32 ids, equal to Tokenizer.encode(text, add_special_tokens=False).

    The vocabulary drops white space, so ids of words between white space are independent of each other; they are
    memoised by word, up to MEMO_WORDS.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        specials = sorted((t.content for t in self.whole.get_added_tokens_decoder().values()), key=lambda t: (-len(t), t))
        #: Texts of these, which are one id each wherever they stand, go through the tokenizer whole.
        self.special = re.compile("|".join(map(re.escape, specials)), re.IGNORECASE) if specials else None
        self.part = self.merger(path)
        self.part = self.part if all(self.agrees(x) for x in PROBES) else self.model_part
        self.memo: dict[str, bytes] = {}

    letters = byte_letters()

    def merger(self, path: str) -> Callable[[str], list[int]]:
        """ids of one pre-token. Where ids follow the order of the merges, they serve as ranks of a byte-pair merger, in
        which the byte 255, never part of UTF-8, stands for the end of a word; else the tokenizer's own model is used."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = self.letters
        vocabulary, end = model["vocab"], model["end_of_word_suffix"] or ""
        byte = {letter: b for b, letter in enumerate(letters)}
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        after = sorted(vocabulary[x] for x in letters + [x + end for x in letters])
        if not end or after != list(range(512)) or any(vocabulary[a + b] != 512 + i for i, (a, b) in enumerate(merges)) or len({a + b for a, b in merges}) < len(merges) or min(vocabulary[x + end] for x in letters) != 256:
            return self.model_part
        import tiktoken

        def plain(token: str) -> bytes:
            ended = token.endswith(end)
            return bytes(byte[x] for x in (token[: -len(end)] if ended else token)) + b"\xff" * ended

        ranks = {plain(token): i for token, i in vocabulary.items() if token not in special}
        merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        return lambda part: merge(part.encode() + b"\xff")

    def model_part(self, part: str) -> list[int]:
        return [t.id for t in self.whole.model.tokenize("".join([self.letters[b] for b in part.encode()]))]

    def agrees(self, part: str) -> bool:
        """Whether the merger gives a pre-token the ids that the tokenizer's model gives it."""
        return list(self.part(part)) == self.model_part(part)

    def word(self, word: str) -> bytes:
        if PLAIN.fullmatch(word):
            ids = array("I")
            for part in PRE_TOKEN.findall(word.lower()):
                ids.extend(self.part(part))
            return ids.tobytes()
        return self.full(word)

    def full(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if SPLIT_ONLY.search(text) or (self.special and self.special.search(text)):
            return self.full(text)
        words, memo = text.split(), self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        try:
            return b"".join([memo[w] for w in words])
        except KeyError:
            for w in words:
                if w not in memo:
                    memo[w] = self.word(w)
        return b"".join([memo[w] for w in words])


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cutter(path: str, capacity: int, end_id: int, keep_ids: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = WordTokenizer(path), array("I", [end_id]).tobytes()
        for batch in batches:
            ids: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at : at + 4 * capacity]
                    for to, value in zip(ids, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                        to.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 6 if keep_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(ids[:n], kinds[:n], strict=True)], names=names[:n])

    return pieces


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination of the lengths in counts that fits into capacity and has the longest length.

    Bit s of the bitset says that sum s can be reached. Lengths go in from long to short, a length that is there c times
    as items of 1, 2, 4, ... copies; the bitsets before each item tell, going back, which items make the best sum.
    """
    longest = max(counts)
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, copies = min(counts[length] - (length == longest), room // length), 1
        while left > 0:
            copies = min(copies, left)
            steps.append((reach, length, copies))
            reach |= (reach << (length * copies)) & mask
            left -= copies
            copies *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {longest: 1}
    for before, length, copies in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + copies
            total -= length * copies
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, low, high, sequence, each, offset): the pieces of a length whose ranks are in [low, high) go, `each` of
    them to a sequence, into the sequences from `sequence` on, the first of them at `offset`."""
    counts, used = {k: v for k, v in counts.items() if v}, dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    while counts:
        chosen = fullest(counts, capacity)
        times = min(counts[x] // n for x, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, used[length], used[length] + n * times, sequence, n, offset))
            used[length] += n * times
            counts[length] -= n * times
            offset += n * length
            if not counts[length]:
                del counts[length]
        sequence += times
    return rows


def tokenizer_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def cut_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, binary) of docs(doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cutter(tokenizer_path(path), capacity, end_id, keep_ids), PIECES + ", ids binary" * keep_ids)


def place(pieces: DataFrame, capacity: int = CAPACITY, order: list[str | Column] | None = None) -> DataFrame:
    """Adds sequence_id and offset to pieces(length, doc_id, piece, ...), which must not change when it is read again."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` rows at most
    rows = spark.createDataFrame(plan(counts, capacity), "length long, low long, high long, sequence long, each long, first long")
    # at most a few rows for each of `capacity` lengths, as the plan closes at least one length at each step
    rows = rows.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("high", "low", "sequence", "each", "first"))).alias("ranges"))
    numbered = ranked(pieces, ["length"], order or ["doc_id", "piece"], "rank")
    placed = numbered.join(F.broadcast(rows), "length").withColumn("at", F.expr("filter(ranges, x -> x.high > rank)[0]"))
    return placed.select(*pieces.columns, F.expr("at.sequence + (rank - at.low) div at.each").alias("sequence_id"), F.expr("at.first + (rank - at.low) % at.each * length").alias("offset"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """docs(doc_id, text) packed into as few sequences of at most `capacity` ids as minimum bin slack finds."""
    return place(cut(cut_pieces(docs, path, capacity, end_id)), capacity)
