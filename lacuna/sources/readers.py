"""Readers of structure files. Files are split into blocks by Spark itself (a block separator as line separator), so large
files are read in parallel from any store; extended XYZ has no separator and is read by the data source in frames.py.

Every reader gives file and structure_id (the ordinal of the block in its file); a malformed block is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lacuna.functions.tensors import box_to_cell, to_nine
from lacuna.operators.stats import stored

STRUCTURE = (
    "file string, structure_id long, n_atoms int, cell array<double>, symbols array<string>, positions array<array<double>>, "
    "forces array<array<double>>, energy double, virial array<double>, main int, label string, info map<string,string>"
)
#: The elements of the universal type numbers, from 0; noble gases and rare radioactive ones have none.
UNIVERSAL = (
    "H Li Be B C N O F Na Mg Al Si P S Cl K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I "
    "Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Ac Th Pa U Np Pu"
).split()
_PAIR = re.compile(r"""([A-Za-z_][\w-]*)=(?:"([^"]*)"|'([^']*)'|(\S+))""")


def blocks(spark: SparkSession, path: str | list[str], separator: str, marker: str, across: bool = False) -> DataFrame:
    """file, structure_id and block: the text between separators that contains marker, numbered in file order; with `across`,
    over all files in order of name, as if they were one. Blocks of a split follow one another in their task; the splits'
    counts, a row each, number them over the file, and are sent to the blocks, which stay in their tasks."""
    rows = spark.read.option("lineSep", separator).text(path).select(F.col("value").alias("block"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    rows = rows.where(F.col("block").contains(marker)).withColumn("row", F.monotonically_increasing_id())
    splits = rows.groupBy("file", "at").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    order = Window.orderBy("file", "at") if across else Window.partitionBy("file").orderBy("at")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))  # a row a split
    offsets = splits.select("file", "at", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(F.broadcast(offsets), ["file", "at"]).select("file", (F.col("row") + F.col("shift")).alias("structure_id"), "block")


def lines_of(block: Column) -> Column:
    return F.filter(F.split(block, r"\r?\n"), lambda x: F.trim(x) != "")


def words(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def numbers(line: Column) -> Column:
    return F.transform(F.filter(words(line), lambda x: x != ""), lambda x: x.cast("double"))


def after(lines: Column, starts: str) -> Column:
    """The line after the first one that begins so; null if there is none."""
    at = F.array_position(F.transform(lines, lambda x: F.startswith(F.trim(x), F.lit(starts))), F.lit(True))
    return F.when(at > 0, F.get(lines, at.cast("int")))


def read_cfg(spark: SparkSession, path: str, elements: list[str] | str | None = None) -> DataFrame:
    """file, structure_id, n_atoms, cell, atoms (id, type, position, force or null), energy, stress6 (xx yy zz yz xz xy), and
    symbols where `elements` names the types, or is `universal`."""
    elements = UNIVERSAL if elements == "universal" else elements
    rows = blocks(spark, path, "END_CFG", "BEGIN_CFG").withColumn("lines", lines_of(F.regexp_extract("block", r"(?s)(BEGIN_CFG.*)", 1)))
    line = lambda k: F.get("lines", F.lit(k - 1))  # noqa: E731  null for what is no block
    size = F.get(words(line(3)), F.lit(0)).cast("int")
    rows = rows.withColumn("n_atoms", size)
    atom_words = F.transform(F.slice("lines", F.lit(9), F.col("n_atoms")), words)
    at = lambda w, k: F.get(w, F.lit(k)).cast("double")
    force = lambda w: F.when(F.size(w) >= 8, F.array(*[at(w, k) for k in (5, 6, 7)]))
    atoms = F.transform(atom_words, lambda w: F.struct(F.get(w, F.lit(0)).cast("int").alias("id"), F.get(w, F.lit(1)).cast("int").alias("type"), F.array(*[at(w, k) for k in (2, 3, 4)]).alias("position"), force(w).alias("force")))
    rest = F.slice("lines", F.col("n_atoms") + 9, F.size("lines"))
    out = rows.select("file", "structure_id", "n_atoms", F.concat(numbers(line(5)), numbers(line(6)), numbers(line(7))).alias("cell"), atoms.alias("atoms"), F.get(numbers(after(rest, "Energy")), F.lit(0)).alias("energy"), numbers(after(rest, "PlusStress")).alias("stress6"))
    if elements:
        names = F.array(*[F.lit(e) for e in elements])
        out = out.withColumn("symbols", F.transform("atoms", lambda a: F.get(names, a["type"])))
    return out


def cfg_to_structures(cfg: DataFrame) -> DataFrame:
    """Structures of read_cfg(..., elements): the 6-vector becomes 9 numbers, forces are null unless every atom has one."""
    forces = F.when(F.forall("atoms", lambda a: a["force"].isNotNull()), F.transform("atoms", lambda a: a["force"]))
    return cfg.select("file", "structure_id", "n_atoms", "cell", "symbols", F.transform("atoms", lambda a: a["position"]).alias("positions"), forces.alias("forces"), "energy", to_nine(F.col("stress6")).alias("virial"))


def count_cfg(spark: SparkSession, path: str, strict: bool = False) -> int:
    """Blocks by their first lines, with blanks around or, if strict, exactly so and ended by a line feed alone."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.where((F.col("value") if strict else F.regexp_replace("value", r"^\s+|\s+$", "")) == "BEGIN_CFG").count()


def read_descriptors(spark: SparkSession, path: str, elements: int | None = None) -> DataFrame:
    """file, structure_id, atom_idx, elem and features of `#start N` blocks; blank atom lines and types outside
    [0, elements) are dropped."""
    rows = blocks(spark, path, "#start", "\n").withColumn("lines", F.split("block", r"\r?\n"))
    rows = rows.where(F.trim(F.get("lines", F.lit(0))).rlike(r"^\d+"))
    n = F.get(words(F.get("lines", F.lit(0))), F.lit(0)).try_cast("int")
    atoms = rows.select("file", "structure_id", F.posexplode(F.slice("lines", F.lit(2), n)).alias("atom_idx", "line")).where(F.trim("line") != "")
    out = atoms.select("file", "structure_id", "atom_idx", numbers(F.col("line")).alias("x"))
    out = out.where(F.size("x") >= 2).select("file", "structure_id", "atom_idx", F.get("x", F.lit(0)).cast("int").alias("elem"), F.slice("x", F.lit(2), F.size("x")).alias("features"))
    return out.where(F.col("elem").between(0, elements - 1)) if elements is not None else out


def read_dump(spark: SparkSession, path: str, elements: list[str], across: bool = False) -> DataFrame:
    """Structures of a trajectory dump: atoms by id, unknown types count as the last element, energy is the sum of c_pe,
    absent forces and energies are 0. With `across`, a folder's files are one trajectory in order of name."""
    rows = blocks(spark, path, "ITEM: TIMESTEP", "ITEM: ATOMS", across).withColumn("lines", lines_of(F.col("block")))
    n = F.trim(after(F.col("lines"), "ITEM: NUMBER OF ATOMS")).cast("int")
    lines = F.col("lines")
    box_at = F.array_position(F.transform(lines, lambda x: F.startswith(F.trim(x), F.lit("ITEM: BOX BOUNDS"))), F.lit(True)).cast("int")
    atoms_at = F.array_position(F.transform(lines, lambda x: F.startswith(F.trim(x), F.lit("ITEM: ATOMS"))), F.lit(True)).cast("int")
    bound = lambda k: F.concat(numbers(F.get(lines, box_at + k)), F.array(F.lit(0.0)))  # noqa: E731  orthogonal boxes have no tilt
    bounds = F.concat(*[F.slice(bound(k), 1, 3) for k in range(3)])
    rows = rows.select("file", "structure_id", n.alias("n_atoms"), box_to_cell(bounds).alias("cell"), F.slice(words(F.get(lines, atoms_at - 1)), F.lit(3), F.lit(1000)).alias("names"), F.transform(F.slice(lines, atoms_at + 1, n), words).alias("rows"))
    place = lambda name: F.array_position("names", F.lit(name)).cast("int") - 1
    value = lambda r, name, default: F.coalesce(F.when(place(name) >= 0, F.get(r, place(name))).cast("double"), F.lit(default))
    need = F.raise_error(F.lit("a dump needs the columns id, type, x, y and z"))
    rows = rows.withColumn("rows", F.when(F.size(F.array_intersect("names", F.array(*[F.lit(x) for x in ("id", "type", "x", "y", "z")]))) == 5, F.col("rows")).otherwise(need.cast("array<array<string>>")))
    atom = lambda r: F.struct(value(r, "id", None).cast("long").alias("id"), value(r, "type", None).cast("int").alias("type"), F.array(*[value(r, c, None) for c in "xyz"]).alias("p"), F.array(*[value(r, c, 0.0) for c in ("fx", "fy", "fz")]).alias("f"), value(r, "c_pe", 0.0).alias("pe"))
    rows = rows.withColumn("atoms", F.array_sort(F.transform("rows", atom)))
    names = F.array(*[F.lit(e) for e in elements])
    symbols = F.transform("atoms", lambda a: F.get(names, F.least(a["type"], F.lit(len(elements))) - 1))
    energy = F.aggregate("atoms", F.lit(0.0), lambda s, a: s + a["pe"])
    return rows.select("file", "structure_id", "n_atoms", "cell", symbols.alias("symbols"), F.transform("atoms", lambda a: a["p"]).alias("positions"), F.transform("atoms", lambda a: a["f"]).alias("forces"), energy.alias("energy"))


@lru_cache(64)
def layout(properties: str) -> dict[str, tuple[int, int]]:
    """Where each column of atom lines begins, and its width."""
    columns, place = {}, 0
    parts = properties.split(":")
    for name, _, width in zip(parts[::3], parts[1::3], parts[2::3], strict=True):
        columns[name.lower()] = (place, int(width))
        place += int(width)
    return columns


def header(line: str) -> tuple[dict, dict[str, tuple[int, int]]]:
    """What the header of a frame of extended XYZ tells, and the layout of its atom lines."""
    info = {m[1]: m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] for m in _PAIR.finditer(line)}
    by_name = {k.lower(): v for k, v in info.items()}

    def floats(key: str) -> list[float] | None:
        return [float(x) for x in by_name[key].split()] if by_name.get(key) else None

    main = by_name.get("main")
    found = {
        "cell": floats("lattice"), "energy": float(by_name["energy"]) if "energy" in by_name else None, "virial": floats("virial"),
        "main": int(round(float(main))) if main is not None else None, "label": by_name.get("label"),
        "info": {k: v for k, v in info.items() if k.lower() not in ("lattice", "properties", "energy", "virial", "main", "label", "pbc")},
    }
    return found, layout(by_name.get("properties", "species:S:1:pos:R:3"))


def one_frame(lines: list[str]) -> dict:
    """A frame of extended XYZ from its lines: the number of atoms, the header, the atoms."""
    n = int(lines[0].split()[0])
    found, columns = header(lines[1])
    rows = [x.split() for x in lines[2 : 2 + n]]

    def vectors(*names: str) -> list[list[float]] | None:
        for name in names:
            if name in columns:
                a, w = columns[name]
                return [[float(x) for x in r[a : a + w]] for r in rows]
        return None

    species = columns.get("species", (0, 1))[0]
    return {"n_atoms": n, "symbols": [r[species] for r in rows], "positions": vectors("pos"), "forces": vectors("forces", "force"), **found}


def parse_frames(text: str) -> Iterator[dict]:
    """Frames of an extended XYZ text; blank lines between frames are passed over, a cut-off frame is an error."""
    lines, at, ordinal = text.split("\n"), 0, 0
    lines = lines[:-1] if lines[-1] == "" else lines
    while at < len(lines):
        if not lines[at].strip():
            at += 1
            continue
        n = int(lines[at].split()[0])
        if at + 2 + n > len(lines):
            raise ValueError(f"frame {ordinal} is cut off")
        yield {"structure_id": ordinal, **one_frame(lines[at : at + 2 + n])}
        ordinal, at = ordinal + 1, at + 2 + n


def read_extxyz(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """Structures of extended XYZ files, read by ranges of bytes."""
    from lacuna.sources import frames

    return frames.read_frames(spark, path, range_bytes or frames.RANGE_BYTES)


def read_extxyz_whole(spark: SparkSession, path: str) -> DataFrame:
    """The same with one file a task, for stores that only Spark's readers open."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in re.split(r", (?![^<]*>)", STRUCTURE)]
        for pdf in batches:
            for file, text in zip(pdf["file"], pdf["value"], strict=True):
                frames = [{"file": file, **f} for f in parse_frames(text)]
                for i in range(0, len(frames), 1000):
                    yield pd.DataFrame(frames[i : i + 1000], columns=names, dtype=object)

    return texts.mapInPandas(parse, STRUCTURE)


def count_extxyz(spark: SparkSession, path: str) -> int:
    """Frames of a file; 0 where it is missing or empty."""
    from lacuna.sources import frames

    try:
        frames.listed(path)
    except FileNotFoundError:
        return 0
    return frames.frame_index(spark, path).agg(F.coalesce(F.sum("frames"), F.lit(0))).first()[0]


def scan_folder(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (".cif", ".vasp", ".xyz"), prefixes: tuple[str, ...] = ("POSCAR", "CONTCAR")) -> DataFrame:
    """path, name and length of structure files by suffix or prefix, in order of name; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.element_at(F.split("path", "/"), -1).alias("name"))
    wanted = F.lit(False)
    for s in suffixes:
        wanted |= F.lower("name").endswith(s)
    for s in prefixes:
        wanted |= F.col("name").startswith(s)
    return files.where(wanted).orderBy("name")


def select_blocks(spark: SparkSession, path: str, selected: DataFrame, across: bool = False) -> DataFrame:
    """structure_id and value: the descriptor blocks of selected(structure_id), with their `#start` lines."""
    rows = blocks(spark, path, "#start", "\n", across).where(F.trim("block").rlike(r"^\d+"))
    return rows.join(selected.select("structure_id").distinct(), "structure_id", "left_semi").select("structure_id", F.concat(F.lit("#start"), F.regexp_replace("block", r"\s+$", "")).alias("value"))


def read_ensemble(spark: SparkSession, paths: dict[str, str], elements: list[str]) -> DataFrame:
    """model, structure_id, atom_idx, symbol, fx, fy and fz of the dumps of several models over the same frames: all are cut to
    the shortest complete prefix. A dump's prefix is as many frames from its start as have the first frame's number of atoms;
    a torn frame has fewer. A folder's files are one dump. First frames of unequal numbers of atoms are an error."""
    dumps = None
    for model, path in paths.items():
        one = read_dump(spark, path, elements, across=True).withColumn("model", F.lit(model))
        dumps = one if dumps is None else dumps.unionByName(one)
    sizes = stored(dumps.select("model", "structure_id", F.size("symbols").alias("n")))  # atom rows that are there, not those announced
    firsts = sizes.groupBy("model").agg(F.min_by("n", "structure_id").alias("first"))
    prefixes = sizes.join(F.broadcast(firsts), "model").groupBy("model").agg(F.count_if(F.col("n") == F.col("first")).alias("k"), F.first("first").alias("first"))
    k = prefixes.agg(F.min("k").alias("k"), F.min("first").alias("low"), F.max("first").alias("high"), F.count("*").alias("models")).first()
    if k.models != len(paths) or k.low != k.high:
        raise ValueError(f"dumps without frames, or of unequal numbers of atoms: {[(r.model, r['first']) for r in prefixes.orderBy('model').collect()]}")
    atoms = F.arrays_zip(F.col("symbols").alias("symbol"), F.col("forces").alias("f"))
    rows = dumps.where(F.col("structure_id") < k.k).select("model", "structure_id", F.posexplode(atoms).alias("atom_idx", "x"))
    return rows.select("model", "structure_id", "atom_idx", "x.symbol", *[F.get("x.f", F.lit(i)).alias(f"f{c}") for i, c in enumerate("xyz")])
