"""SimHash near-duplicates by a grid range-join over segment bit counts.

A 64-bit fingerprint becomes the vector of the bit counts of its 32 segments of 2 bits. The Manhattan distance of two
such vectors is at most the Hamming distance of the fingerprints, so links (2 differing bits or fewer) lie within
Manhattan distance 2. Grid range-join: each different fingerprint registers in its own cell of the integer grid and in
the cells one step away; vectors within distance 2 share such a cell. The fingerprints that share a cell are the
candidates, and each pair's differing bits are counted. In a cell of more than CROWD fingerprints not all pairs are made:
a pair that this cell must find differs by at most one bit from a word of the cell's own bit counts, so that each of the
cell's fingerprints is compared with the first one beside each such word; all beside one word are within 2 bits of each
other. Every step is linear in the number of different fingerprints. Exact copies are one fingerprint, hence one row,
before the grid.

The near-duplicate stage (`keep_first`) links texts by the Jaccard similarity of their shingle sets, SIMILAR or more of WORDS
words. It takes the grid's links of fingerprints first and checks them by their similarity (`link_grid`). Similar texts may
differ in some ten bits and more, beyond the reach of the grid's cells, so that further candidates are texts that share one
of BANDS bands of HASHES least hashes and that the grid has not connected. Each text of a band is compared with the band's centre, the text
that shares most bands; texts that are connected by then need no more comparing. What is left of a band are pairs of texts
in different components: of bands of up to SMALL texts each such pair is compared; larger ones go in blocks of CHUNK texts,
those outside the band's largest component meeting all others, within a task and without a row for a pair.

Defined results: null and empty texts have fingerprint zero, which links like any other; rows of a null id link like any
other, and a component without any id is null; repeated rows get equal rows; an empty table gives no rows; other columns of
the input are ignored. The near-duplicate stage takes all texts without words as one group, of which one row stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.llm.common import components, cut

SHINGLE = 3
SEED = 42
#: The near-duplicate stage: words of a shingle and least similarity. A pair at it shares no band in 0.07 % of cases.
WORDS, SIMILAR = 5, 0.8
BANDS, HASHES, SMALL, CHUNK = 24, 6, 16, 512
#: Differing bits of linked fingerprints; the grid's cells are made for this number. Fingerprints of a cell that all meet.
DISTANCE, CROWD = 2, 24


def fingerprint(text: str, words: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text: bit k is set if it is set in over half the XXH64 of its shingles, repeats included."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z alone are lowered, and white space is ASCII's
    if not parts:
        return 0
    if len(parts) <= words:
        return xxh64_intdigest(b" ".join(parts), seed)
    hashes = [xxh64_intdigest(b" ".join(x), seed) for x in zip(*(parts[i:] for i in range(words)), strict=False)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        block = np.array(hashes[at : at + 65_536], dtype="<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def printer(words: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py() or "", words, seed) for x in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return prints


def fingerprints(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of docs(doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(printer(words, seed), "doc_id long, fp long")


def bits(value: int) -> Column:
    """A 64-bit pattern as a long."""
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def own_cell(fp: Column) -> Column:
    """The bit counts of fp's 2-bit segments, each in the place of its segment: both bits make 2, one of them 1."""
    low, half = bits(int("01" * 32, 2)), F.shiftrightunsigned(fp, 1)
    return F.shiftleft(fp.bitwiseAND(half).bitwiseAND(low), 1).bitwiseOR(fp.bitwiseXOR(half).bitwiseAND(low))


def cells(own: Column) -> Column:
    """The grid cell `own` and the cells one step away: of 0 that is 1, of 1 it is 0 and 2, of 2 it is 1."""
    out = [own]
    for i in range(0, 64, 2):
        out.append(F.when(own.bitwiseAND(bits(2 << i)) == 0, own.bitwiseXOR(bits(1 << i))))
        out.append(F.when(own.bitwiseAND(bits(3 << i)) != 0, own.bitwiseXOR(bits(3 << i))))
    return F.array_compact(F.array(*out))


def near_words(fp: Column) -> Column:
    """fp and the 64 words one bit away."""
    return F.array(fp, *[fp.bitwiseXOR(bits(1 << i)) for i in range(64)])


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between the reps of fingerprints that differ in 1 or 2 bits, enough of them to connect all that such
    differences connect. prints: rep (long) and fp (long), both different in every row."""
    in_cells = prints.select("rep", "fp", own_cell(F.col("fp")).alias("own")).select("rep", "fp", F.explode(cells(F.col("own"))).alias("cell"))
    shared = in_cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    # Spark takes the cells to be as few bytes as the fingerprints they come from, some 40 times too few, and would broadcast them
    there = cut(in_cells.hint("merge").join(shared, "cell"))
    of = F.struct("fp", "rep")
    few = there.where(F.col("n") <= CROWD).groupBy("cell").agg(F.array_sort(F.collect_list(of)).alias("x"))
    pairs = few.select(F.explode(F.flatten(F.transform("x", lambda b, i: F.transform(F.slice("x", F.lit(1), i), lambda a: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).select("p.a", "p.b")
    words = there.where(F.col("n") > CROWD).select("cell", of.alias("b"), F.explode(F.filter(near_words(F.col("fp")), lambda w: own_cell(w) == F.col("cell"))).alias("word"))
    first = words.groupBy("cell", "word").agg(F.min("b").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = pairs.union(words.join(first, ["cell", "word"]).where("a <> b").select("a", "b"))
    return pairs.where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= DISTANCE).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable by links, of docs(doc_id, text). Fingerprints link, ids only
    name what is reached."""
    prints = cut(fingerprints(docs, words, seed))
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("rep", F.col("fp"))
    roots = components(link_fingerprints(reps.select("rep", "fp"))).select(F.col("node").alias("rep"), "root")
    rooted = reps.join(roots, "rep", "left").select("fp", "least", F.coalesce("root", "rep").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, words: int, seed: int) -> np.ndarray:
    """The different hashes of a text's shingles, in order; fewer words than `words` are one shingle."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.array([xxh64_intdigest(x, seed) for x in parts], dtype=np.uint64)
    size = min(words, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = stirred(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k])
    return np.unique(out)


def bands_of(hashes: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each band of least hashes of a set; an empty set has none."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    rng = np.random.default_rng(seed)
    add, times = rng.integers(0, 1 << 63, (2, BANDS * HASHES), dtype=np.uint64)
    least = np.full(BANDS * HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4096):
        mixed = (hashes[None, at : at + 4096] ^ add[:, None]) * (times[:, None] | np.uint64(1))
        least = np.minimum(least, mixed.min(axis=1))
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(HASHES):
        out = stirred(out * np.uint64(0x9E3779B97F4A7C15) + least[k::HASHES])
    return out.view(np.int64)


def setter(words: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = [shingle_set(x or "", words, seed) for x in part.column(2).to_pylist()]
                fps = np.array([fingerprint(x or "", words, seed) for x in part.column(2).to_pylist()], dtype=np.uint64).view(np.int64)
                nodes = np.array([xxh64_intdigest(x.tobytes(), seed) for x in found], dtype=np.uint64).view(np.int64)
                bands = pa.array([bands_of(x, seed) for x in found], pa.list_(pa.int64()))
                short = pa.array([np.unique((x >> np.uint64(32)).astype(np.uint32)).view(np.int32) for x in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(nodes), pa.array(fps), bands, short], names=["row", "id", "node", "fp", "bands", "shingles"])

    return sets


def verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) of sets(node, shingles) with a Jaccard similarity of `similar` or more."""
    side = lambda n: sets.select(F.col("node").alias(n), F.col("shingles").alias(f"of_{n}"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    found = pairs.join(side("a"), "a").join(side("b"), "b")
    return found.where(both >= similar * (F.size("of_a") + F.size("of_b") - both)).select("a", "b")


def comparer(similar: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Meetings of two blocks of texts, of one with itself where `right` is null -> links (a, b) that connect their components."""

    def read(block: list[dict]) -> tuple[list[int], list[int], list[np.ndarray]]:
        return [x["node"] for x in block], [x["root"] for x in block], [np.array(x["shingles"], np.int32) for x in block]

    def incidence(sets: list[np.ndarray], used: np.ndarray) -> np.ndarray:
        out = np.zeros((len(sets), len(used)), np.float32)
        for i, x in enumerate(sets):
            out[i, np.searchsorted(used, x)] = 1
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                nodes, roots, sets = read(left)
                others, other_roots, other_sets = read(right) if right else (nodes, roots, sets)
                root: dict[int, int] = {}

                def find(x: int, root: dict[int, int] = root) -> int:
                    while root.setdefault(x, x) != x:
                        root[x] = x = root[root[x]]
                    return x

                size = np.array([len(x) for x in other_sets])
                for at in range(0, len(sets), 64):  # rows that are in memory at once
                    some = sets[at : at + 64]
                    used = np.unique(np.concatenate(some))
                    both = incidence(some, used) @ incidence([x[np.isin(x, used)] for x in other_sets], used).T
                    own = np.array([len(x) for x in some])[:, None]
                    for i, j in zip(*np.nonzero(both >= similar * (own + size[None, :] - both)), strict=True):
                        p, q = find(roots[at + i]), find(other_roots[j])
                        if p != q:
                            root[max(p, q)] = min(p, q)
                            found.append((nodes[at + i], others[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    return compare


def link_grid(sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Edges (a, b) between nodes of sets(node, fp, shingles) whose fingerprints the grid links or that share one, if they are
    similar. A fingerprint's nodes meet its least one, and that meets those of linked fingerprints."""
    nodes = cut(sets.select("node", "fp").distinct())
    least = nodes.groupBy("fp").agg(F.min("node").alias("least"))
    links = cut(link_fingerprints(least.select(F.col("fp").alias("rep"), "fp")))
    side = lambda n: least.select(F.col("fp").alias(n), F.col("least").alias(f"of_{n}"))
    across = links.join(side("a"), "a").join(side("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    within = nodes.join(least, "fp").select(F.col("node").alias("a"), F.col("least").alias("b"))
    pairs = cut(across.union(within).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = sets.select("node", "shingles").join(met, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))
    return cut(verified(pairs, some, similar))


def link_sets(sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Edges (a, b) between nodes of sets(node, fp, bands, shingles), enough of them to connect all that are similar and are linked by
    the grid or share a band; rows of a node have equal shingles."""
    grid = link_grid(sets, similar)
    members = sets.groupBy("node").agg(F.first("bands").alias("bands")).select("node", F.explode("bands").alias("band"))
    members = cut(members.join(members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "band"))
    sets = cut(sets.select("node", "shingles").join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")))
    # texts at the middle of a group share more bands, with more others, than those at its edge
    weight = members.groupBy("node").agg(F.sum("n").alias("w"))
    centre = members.join(weight, "node").groupBy("band").agg(F.max_by("node", F.struct("w", "node")).alias("b"))
    beside = members.join(centre, "band").where("node <> b")
    beside = beside.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct().join(grid, ["a", "b"], "left_anti")
    stars = cut(verified(beside, sets, similar).union(grid))
    roots = components(stars)
    named = members.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    parts = named.groupBy("band", "root").agg(F.count("*").alias("k")).groupBy("band")
    parts = parts.agg(F.sum("k").alias("n"), F.count("*").alias("parts"), F.max_by("root", F.struct("k", "root")).alias("most")).where("parts > 1").drop("parts")
    open_ = cut(named.join(parts, "band"))
    few = open_.where(F.col("n") <= SMALL).groupBy("band").agg(F.array_sort(F.collect_list(F.struct("node", "root"))).alias("x"))
    pairs = F.flatten(F.transform("x", lambda b, i: F.transform(F.filter(F.slice("x", F.lit(1), i), lambda a: a["root"] != b["root"]), lambda a: F.struct(a["node"].alias("a"), b["node"].alias("b")))))
    pairs = few.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    return stars.union(verified(pairs, sets, similar)).union(link_crowds(open_.where(F.col("n") > SMALL), sets, similar))


def link_crowds(members: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) of large bands of members(band, node, root, n, most) between texts of different roots."""
    rest = members.where("root <> most").groupBy("band").agg(F.count("*").alias("m"))
    dealt = members.join(rest, "band").join(sets, "node")
    # blocks 0, 1, ... have the texts outside the largest component, blocks -1, -2, ... those within
    deal = lambda n: F.pmod(F.xxhash64("node"), F.ceil(n / CHUNK))
    part = F.when(F.col("root") != F.col("most"), deal(F.col("m"))).otherwise(-1 - deal(F.greatest(F.col("n") - F.col("m"), F.lit(1)))).cast("int")
    blocks = dealt.withColumn("part", part).groupBy("band", "part").agg(F.first("m").alias("m"), F.collect_list(F.struct("node", "root", "shingles")).alias("block"))  # about CHUNK texts
    partners = F.sequence(F.lit(0), (F.ceil(F.col("m") / CHUNK) - 1).cast("int"))
    inner = F.when(F.col("part") < 0, partners).otherwise(F.sequence(F.lit(0), F.col("part")))
    # a block outside meets itself and the earlier ones outside; a block within is met by all outside
    left = blocks.select("band", F.col("part").alias("right_part"), F.explode(inner).alias("part"), F.col("block").alias("right"))
    both = left.join(blocks.where("part >= 0").select("band", "part", F.col("block").alias("left")), ["band", "part"])
    return both.select("left", F.when(F.col("right_part") != F.col("part"), F.col("right")).alias("right")).mapInArrow(comparer(similar), "a long, b long")


def keep_first(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR, seed: int = SEED) -> DataFrame:
    """docs with one row of each component of similar texts: that of the smallest doc_id, null ids last, then of the smallest
    hash of the row. Texts without words, null ones among them, are one component. Ids only order rows: rows of a null or repeated id go only if they are near-duplicates of a kept one."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    prints = cut(rows.mapInArrow(setter(words, seed), "row long, id long, node long, fp long, bands array<long>, shingles array<int>"))
    roots = components(link_sets(prints, similar)).select("node", "root")
    rows = prints.select("row", "id", "node").join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "id", "row")
    return first_rows(docs, row, rows)


def first_rows(docs: DataFrame, row: Column, rows: DataFrame) -> DataFrame:
    """docs with the first row of each root of rows(root, id, row); equal rows count once."""
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "row")).alias("__lacuna_first"))
    found = first.select(F.col("__lacuna_first.row").alias("__lacuna_key")).distinct()
    kept = docs.withColumn("__lacuna_key", row).join(found, "__lacuna_key", "left_semi")
    # equal rows have equal keys; each task leaves one of them before they meet
    kept = kept.withColumn("__lacuna_row", F.row_number().over(Window.partitionBy("__lacuna_key").orderBy("__lacuna_key")))
    return kept.where("__lacuna_row = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
