"""Extended XYZ read by byte ranges: a Python data source whose partitions are ranges of files.

A frame is a line with the number of its atoms, a header and a line for each atom; blank lines between frames are passed
over, a cut-off frame is an error. It belongs to the range in which its first line begins. A range that does not begin a
file finds its first frame by trial: a line that is one number, after which as many atom lines as it says follow, and then a
number again, a blank line or the end. Numbers in headers can look so too, hence ranges tell in a first pass (option
`mode` = index) where their first frame begins, where the first frame after them does and how many they have. Of each two
neighbouring ranges these must agree; a range that guessed wrong is read again from where the one before it ends. So the
frames are those of a reading from the file's start, wherever it is cut. The same counts number the frames.

Files are opened through pyarrow's file systems (local, HDFS, S3 and others by their URI).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lacuna.operators.stats import stored
from lacuna.sources.readers import STRUCTURE, header, one_frame

RANGE_BYTES, LEAST_BYTES = 64 << 20, 1 << 18
BLOCK = 1 << 20
INDEX = "file string, start long, stop long, first long, beyond long, frames long, told boolean"
FRAMES = STRUCTURE.replace("structure_id long", "start long, place long")
#: Frames of a batch that a task hands over at once.
BATCH = 1000


@dataclass
class Range(InputPartition):
    file: str
    start: int
    stop: int
    #: Where the first frame begins, if that is known.
    entry: int | None


class Lines:
    """Lines of an opened file from a byte on, with the byte at which they begin."""

    def __init__(self, file, at: int, block: int = BLOCK):
        #: `read` bytes of `held`, which begins at byte `start`, are used up; `ends` are its line ends, of which `place` are.
        self.file, self.start, self.block, self.held, self.read = file, at, block, b"", 0
        self.ends, self.place = [], 0
        file.seek(at)

    @property
    def at(self) -> int:
        return self.start + self.read

    def more(self) -> bool:
        """Reads the next block; False at the end of the file."""
        if not (more := self.file.read(self.block)):
            return False
        self.start, self.held, self.read, self.place = self.at, self.held[self.read :] + more, 0, 0
        self.ends = (np.flatnonzero(np.frombuffer(self.held, np.uint8) == 10) + 1).tolist()
        return True

    def next(self) -> tuple[int, bytes] | None:
        return self.several(1)

    def several(self, k: int) -> tuple[int, bytes] | None:
        """The next k lines in one; None if there are fewer. The last line of a file may lack its line feed."""
        at, parts = self.at, []
        while k:
            if have := min(k, len(self.ends) - self.place):
                self.place, k, stop = self.place + have, k - have, self.ends[self.place + have - 1]
            elif self.more():
                continue
            elif k == 1 and self.read < len(self.held):
                k, stop = 0, len(self.held)
            else:
                return None
            parts.append(self.held[self.read : stop])
            self.read = stop
        return at, b"".join(parts)

    def back(self) -> None:
        """Puts the file where this reading left it, after something else has read from it."""
        self.file.seek(self.start + len(self.held))


def opened(file: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(file) if "://" in file or file.startswith("file:") else (fs.LocalFileSystem(), file)
    return system.open_input_file(path)


def listed(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of a file or of a folder's files, in order of name; hidden ones are left out."""
    from pyarrow import fs

    whole = "://" in path or path.startswith("file:")
    system, inner = fs.FileSystem.from_uri(path) if whole else (fs.LocalFileSystem(), path)
    prefix = path[: -len(inner)] if whole and path.endswith(inner) else "file://" if whole else ""
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(inner, recursive=True))
    hidden = lambda p: any(x[:1] in "._" for x in p[len(inner.rstrip("/")) + 1 :].split("/") if x)
    return sorted((prefix + x.path, x.size) for x in found if x.is_file and not hidden(x.path))


def dealt_bytes(spark: SparkSession, path: str, each: int = 4) -> int:
    """Bytes of a range with which files are dealt to `each` tasks a core: LEAST_BYTES for small files, RANGE_BYTES at most."""
    share = sum(size for _, size in listed(path)) // (each * max(1, spark.sparkContext.defaultParallelism))
    return min(RANGE_BYTES, max(LEAST_BYTES, share))


def number(line: bytes) -> int | None:
    """The number that a line has and nothing else."""
    word = line.strip()
    return int(word) if word.isdigit() else None


def plausible(file, at: int, n: int) -> bool:
    """Whether what begins at a byte reads as a frame of n atoms, and what follows as the next one's beginning or the end."""
    lines = Lines(file, at, 1 << 14)
    lines.next()
    if lines.next() is None:
        return False
    for _ in range(n):
        line = lines.next()
        if line is None or len(line[1].split()) < 4:
            return False
    after = lines.next()
    return after is None or not after[1].strip() or number(after[1]) is not None


def guessed(file, start: int, stop: int) -> int | None:
    """Where the first frame that begins in a range seems to do so."""
    if not start:
        return 0
    lines = Lines(file, start - 1)
    lines.next()  # the line that holds the byte before the range
    while (line := lines.next()) and line[0] < stop:
        n = number(line[1])
        if n is not None:
            if plausible(file, line[0], n):
                return line[0]
            lines.back()
    return None


def frames_in(file, entry: int, stop: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first byte, lines) of each frame that begins before `stop`, from one that begins at `entry`, and at last the first
    byte of the frame after them (that of the file's end where there is none) with no lines."""
    lines = Lines(file, entry)
    while True:
        head = lines.next()
        if head is None:
            yield lines.at, []
            return
        if not head[1].strip():
            continue
        if head[0] >= stop:
            yield head[0], []
            return
        try:
            n = int(head[1].split()[0])
        except ValueError:
            raise ValueError(f"byte {head[0]}: no number of atoms: {head[1][:60]!r}") from None
        body = lines.several(n + 1)
        if body is None:
            raise ValueError(f"the frame at byte {head[0]} is cut off")
        yield head[0], [head[1], *body[1].removesuffix(b"\n").split(b"\n")]


class FrameReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.mode = options["path"], options.get("mode", "frames")
        self.size = int(options.get("rangebytes", RANGE_BYTES))
        #: JSON: file -> start of a range -> where its first frame begins; with `only`, other ranges are left out.
        self.entries = json.loads(options.get("entries", "{}"))
        self.only = options.get("only", "false") == "true"

    def partitions(self) -> list[Range]:
        out = []
        for file, size in listed(self.path):
            for start in range(0, size, self.size):
                known = self.entries.get(file, {})
                if str(start) in known or not self.only:
                    out.append(Range(file, start, min(start + self.size, size), known.get(str(start))))
        return out or [Range("", 0, 0, None)]

    def read(self, part: Range) -> Iterator:
        if not part.file:
            return
        with opened(part.file) as file:
            entry = part.entry if part.entry is not None else guessed(file, part.start, part.stop)
            if self.mode == "index":
                count, beyond = 0, None
                try:
                    for at, lines in frames_in(file, entry, part.stop) if entry is not None else ():
                        count, beyond = count + bool(lines), at
                except ValueError:
                    if part.entry is not None:
                        raise
                    count, beyond = 0, None  # a wrong guess, or an error that shows when the range before tells the entry
                yield part.file, part.start, part.stop, entry, beyond, count, part.entry is not None
            elif entry is not None:
                batch = []
                for place, (_, lines) in enumerate(frames_in(file, entry, part.stop)):
                    if lines:
                        batch.append((place, [x.decode("utf-8", "replace") for x in lines]))
                    if batch and (not lines or len(batch) == BATCH):
                        yield parsed(part, batch)
                        batch = []


def parsed(part: Range, batch: list[tuple[int, list[str]]]) -> pa.RecordBatch:
    """A batch of (place, lines): its atoms by columns where all frames have the same ones, else frame by frame, which is also
    the way that tells what is wrong in a malformed one."""
    try:
        return by_columns(part, batch)
    except (ValueError, KeyError, IndexError):  # Arrow's errors of conversion among them
        rows = [{"file": part.file, "start": part.start, "place": place, **one_frame(lines)} for place, lines in batch]
        return pa.RecordBatch.from_pylist([x | {"info": list(x["info"].items())} for x in rows], arrow_schema())


def by_columns(part: Range, batch: list[tuple[int, list[str]]]) -> pa.RecordBatch:
    heads = [header(lines[1]) for _, lines in batch]
    layout = heads[0][1]
    if any(x != layout for _, x in heads):
        raise ValueError("frames of several layouts")
    sizes = np.array([len(lines) - 2 for _, lines in batch])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    text = pa.array([x for _, lines in batch for x in lines[2:]], pa.string())
    words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(text))
    widths = pc.unique(pc.list_value_length(words)).to_pylist()
    if len(widths) != 1:
        raise ValueError("atom lines of several lengths")
    flat, every = words.flatten(), np.arange(len(words))
    column = lambda a, w: flat.take(pa.array((every[:, None] * widths[0] + np.arange(a, a + w)).ravel()))
    a_list = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    def vectors(*names: str) -> pa.Array:
        for name in names:
            if name in layout:
                a, w = layout[name]
                if a + w > widths[0]:
                    raise ValueError("atom lines without all columns")
                return a_list(ends, a_list(np.arange(len(words) + 1) * w, column(a, w).cast(pa.float64())))
        return pa.nulls(len(batch), arrow_schema().field("positions").type)

    species = column(layout.get("species", (0, 1))[0], 1)
    atoms = {"symbols": a_list(ends, species), "positions": vectors("pos"), "forces": vectors("forces", "force")}
    found = [x for x, _ in heads]
    plain = {"file": [part.file] * len(batch), "start": [part.start] * len(batch), "place": [x for x, _ in batch], "n_atoms": sizes, "info": [list(x["info"].items()) for x in found]}
    return pa.RecordBatch.from_arrays([atoms[f.name] if f.name in atoms else pa.array(plain[f.name] if f.name in plain else [x[f.name] for x in found], f.type) for f in arrow_schema()], schema=arrow_schema())


def arrow_schema() -> pa.Schema:
    vectors = pa.list_(pa.list_(pa.float64()))
    return pa.schema([
        ("file", pa.string()), ("start", pa.int64()), ("place", pa.int64()), ("n_atoms", pa.int32()), ("cell", pa.list_(pa.float64())), ("symbols", pa.list_(pa.string())), ("positions", vectors),
        ("forces", vectors), ("energy", pa.float64()), ("virial", pa.list_(pa.float64())), ("main", pa.int32()), ("label", pa.string()), ("info", pa.map_(pa.string(), pa.string())),
    ])


class FrameSource(DataSource):
    """spark.read.format("extxyz").option("rangeBytes", n).load(path), after spark.dataSource.register(FrameSource)."""

    @classmethod
    def name(cls) -> str:
        return "extxyz"

    def schema(self) -> str:
        return INDEX if self.options.get("mode") == "index" else FRAMES

    def reader(self, schema) -> FrameReader:
        return FrameReader({k.lower(): v for k, v in self.options.items()})


def load(spark: SparkSession, path: str, range_bytes: int, **options: str) -> DataFrame:
    spark.dataSource.register(FrameSource)
    return spark.read.format("extxyz").option("rangeBytes", range_bytes).options(**options).load(path)


def frame_index(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file, start, first, frames, told (whether the range before told the entry) and offset (frames of the file before the
    range) of each range, after all neighbours agree. A row a range."""
    index = stored(load(spark, path, range_bytes, mode="index"))
    order = Window.partitionBy("file").orderBy("start")  # a row for each `range_bytes` of a file
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    while True:
        # the range before may have no frame of its own: what counts is the last one that has
        chained = index.withColumn("entry", F.coalesce(F.last("beyond", ignorenulls=True).over(before), F.lit(0)))
        none = F.col("first").isNull() & (F.col("entry") >= F.col("stop"))
        right = none | (F.col("first").eqNullSafe(F.col("entry")) & F.col("beyond").isNotNull())
        # the first wrong range of each file is put right; what it tells may put later ones right or wrong
        wrong = chained.where(~right).groupBy("file").agg(F.min(F.struct("start", "entry")).alias("x")).select("file", "x.*").collect()
        if not wrong:
            return chained.select("file", "start", "first", "frames", "told", F.coalesce(F.sum("frames").over(before), F.lit(0)).alias("offset"))
        entries = json.dumps({r.file: {str(r.start): r.entry} for r in wrong})
        again = load(spark, path, range_bytes, mode="index", entries=entries, only="true")
        gone = spark.createDataFrame([(r.file, r.start) for r in wrong], "file string, start long")
        index = stored(index.join(gone, ["file", "start"], "left_anti").select(*again.columns).union(again))


def read_frames(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, index: DataFrame | None = None) -> DataFrame:
    """The structures of extended XYZ files, read by one task for each `range_bytes`; structure_id is the place in the file.
    `index` is the stored frame_index of these ranges, where there is one already."""
    index = stored(frame_index(spark, path, range_bytes)) if index is None else index
    entries: dict[str, dict[str, int]] = {}
    for r in index.where("told").select("file", "start", "first").collect():  # rare: a number where a frame might begin
        entries.setdefault(r.file, {})[str(r.start)] = r.first
    rows = load(spark, path, range_bytes, entries=json.dumps(entries))
    offsets = index.where("frames > 0").select("file", "start", "offset")  # a row a range
    placed = rows.join(F.broadcast(offsets), ["file", "start"]).withColumn("structure_id", F.col("offset") + F.col("place"))
    return placed.select(*[c.split()[0] for c in re.split(r", (?![^<]*>)", STRUCTURE)])
