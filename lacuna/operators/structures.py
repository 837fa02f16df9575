"""Filters, fingerprints, summaries and generators of structures."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.tensors import cartesian, determinant, fractional, fractions, max_force, scaled
from lacuna.functions.text import glob_to_regex
from lacuna.operators import symmetry


#: The elements in order of atomic number, from 1.
ATOMIC_ORDER = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe "
    "Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
).split()


def by_atomic_number(elements: list[str]) -> list[str]:
    """Elements, each once, in order of atomic number; a name that is none is an error."""
    if wrong := [e for e in elements if e not in ATOMIC_ORDER]:
        raise ValueError(f"no elements: {wrong}")
    return sorted(dict.fromkeys(elements), key=ATOMIC_ORDER.index)


def body_slice(df: DataFrame, index: list[int], features: str = "features") -> DataFrame:
    return df.withColumn(features, F.array(*[F.get(features, F.lit(i)) for i in index]))


def stack_bodies(parts: list[DataFrame], on: list[str], features: str = "features") -> DataFrame:
    """Feature arrays of several bodies side by side, joined on the atom."""
    out = parts[0]
    for i, part in enumerate(parts[1:], 1):
        out = out.join(part.select(*on, F.col(features).alias(f"_{i}")), on).withColumn(features, F.concat(features, f"_{i}")).drop(f"_{i}")
    return out


def in_elements(df: DataFrame, elements: int, elem: str = "elem") -> DataFrame:
    return df.where((F.col(elem) >= 0) & (F.col(elem) < elements))


def element_index(df: DataFrame, elements: list[str], symbol: str = "symbol", by_number: bool = False) -> DataFrame:
    """Type index by place in `elements`, as given or in order of atomic number; null for others."""
    elements = by_atomic_number(elements) if by_number else elements
    at = F.array_position(F.array(*[F.lit(e) for e in elements]), F.col(symbol)).cast("int") - 1
    return df.withColumn("elem", F.when(at >= 0, at))


def missing_elements(wanted: DataFrame, there: DataFrame, elem: str = "elem") -> DataFrame:
    return wanted.select(elem).distinct().join(there.select(elem).distinct(), elem, "left_anti")


def require_elements(wanted: DataFrame, there: DataFrame, elem: str = "elem") -> None:
    if gone := sorted(r[0] for r in missing_elements(wanted, there, elem).limit(50).collect()):
        raise ValueError(f"elements without data: {gone}")


def distinct_elements(structures: DataFrame) -> DataFrame:
    return structures.select(F.explode("symbols").alias("symbol")).distinct()


def force_filter(frames: DataFrame, threshold: float, group: list[str] | None = None, max_f: str = "max_f", order: str = "frame_idx") -> DataFrame:
    """Frames with a largest force strictly below the threshold; a group without any keeps its first frame of least force."""
    group, key = group or [], F.struct(max_f, order)
    least = frames.groupBy(*group).agg(F.count_if(F.col(max_f) < threshold).alias("_n"), F.min(key).alias("_least"))
    if group:
        same = F.lit(True)
        for c in group:
            same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        joined = frames.join(least.withColumnsRenamed({c: f"_of_{c}" for c in group}), same).drop(*[f"_of_{c}" for c in group])
    else:
        joined = frames.crossJoin(F.broadcast(least))  # one row
    first = F.row_number().over(Window.partitionBy(*(group or [F.lit(0)])).orderBy(order))  # of frames equal in force and order
    equal = joined.where((F.col("_n") == 0) & (key == F.col("_least"))).withColumn("_r", first).where("_r = 1").drop("_n", "_least", "_r")
    return joined.where(F.col(max_f) < threshold).drop("_n", "_least").unionByName(equal)


def force_at_most(frames: DataFrame, threshold: float, forces: str = "forces") -> DataFrame:
    """Inclusive; frames without forces stay."""
    return frames.where(F.coalesce(max_force(F.col(forces)) <= threshold, F.lit(True)))


def converged_runs(df: DataFrame, steps: str = "last_step", most: str = "nelm") -> DataFrame:
    return df.where(F.col(steps) != F.col(most))


def finite_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    keep = F.lit(True)
    for c in columns:
        keep &= F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf"))
    return df.where(keep)


def axis_limits(df: DataFrame, columns: list[str], pad: float = 0.05) -> DataFrame:
    out = []
    for c in columns:
        span = F.max(c) - F.min(c)
        span = F.when(span > 0, span).otherwise(F.lit(1.0))
        out += [(F.min(c) - span * pad).alias(f"{c}_lo"), (F.max(c) + span * pad).alias(f"{c}_hi")]
    return finite_rows(df, columns).agg(*out)


def downsample(df: DataFrame, n: int, idx: str, seed: int) -> DataFrame:
    """n rows without replacement, by hash of id and seed, in order of id."""
    return df.orderBy(F.xxhash64(F.col(idx), F.lit(seed)), idx).limit(n).orderBy(idx)


def selectors_of(wanted: str | list[str] | None) -> list[str]:
    """Selectors from a text or texts with commas; `all` where there is none."""
    items = [wanted] if isinstance(wanted, str) else [str(x) for x in wanted or []]
    return [p for x in items for part in x.split(",") if (p := part.strip())] or ["all"]


def select_structures(df: DataFrame, selectors: str | list[str] | None, name: str = "name", idx: str = "idx", frame: str | None = None) -> DataFrame:
    """Rows in order of selector and place, each once. Selectors: all, first (in any case), index:N, or a text or shell pattern
    that equals the name, its last path part, that without its ending, or name:frame. A selector without rows is an error."""
    wanted = selectors_of(selectors)
    if "all" in [s.lower() for s in wanted]:
        wanted = ["all"]
    base = F.regexp_replace(F.col(name), r"^.*/", "")
    known = [F.col(name), base, F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")]
    known += [F.concat(k, F.lit(":"), F.col(frame).cast("string")) for k in known[:2]] if frame else []
    hits = []
    for s in wanted:
        if s.lower() == "all":
            hits.append(F.lit(True))
        elif s.lower() == "first":
            hits.append(F.col(idx) == 0)
        elif s.lower().startswith("index:"):
            if not s[6:].strip().lstrip("+-").isdigit():
                raise ValueError(f"not a place: {s!r}")
            hits.append(F.col(idx) == int(s[6:]))
        else:
            hits.append(F.coalesce(F.exists(F.array(*known), lambda k: (k == s) | k.rlike(glob_to_regex(s))), F.lit(False)))  # noqa: B023
    counts = df.agg(*[F.count_if(h).alias(f"n{i}") for i, h in enumerate(hits)]).first()
    if nothing := [s for s, n in zip(wanted, counts, strict=True) if not n and s.lower() != "all"]:
        raise ValueError(f"selectors without structures: {nothing}")
    places = F.array_min(F.array(*[F.when(h, F.lit(i)) for i, h in enumerate(hits)]))
    return df.withColumn("selector_pos", places).where("selector_pos is not null").orderBy("selector_pos", idx)


def fingerprint(symbols: Column, positions: Column, cell: Column) -> Column:
    """Symbols, cell to 8 decimals and wrapped fractional coordinates to 6 decimals; -0 is 0."""
    rounded = lambda x, d: F.transform(x, lambda v: F.bround(v, d) + 0.0)
    return F.struct(symbols.alias("s"), rounded(cell, 8).alias("c"), F.transform(fractions(positions, cell), lambda p: rounded(p, 6)).alias("p"))


def first_of(df: DataFrame, key: list[str | Column], order: str) -> DataFrame:
    """The first row of each key. Aggregated (min_by), so a key with many copies is reduced before the shuffle. Rows are sorted for
    that, first by a hash of the key, which is compared faster than the key."""
    everything = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    keys = [(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(key)]
    return df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(F.min_by(everything, order).alias("_row")).select("_row.*")


def dedup(structures: DataFrame, order: str = "structure_id") -> DataFrame:
    return first_of(structures, [fingerprint(F.col("symbols"), F.col("positions"), F.col("cell"))], order)


def collection_summary(df: DataFrame, columns: list[str], n_atoms: str = "n_atoms") -> DataFrame:
    """level, name, n, and atom count minimum, maximum and mean, for each value of each column and in total; null values
    are `unknown`."""
    named = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in columns], F.col(n_atoms).alias("a"))
    sets = [[F.col(c)] for c in columns] + [[]]
    out = named.groupingSets(sets, *columns).agg(F.grouping_id(*columns).alias("g"), F.count("*").alias("n"), F.min("a").alias("n_min"), F.max("a").alias("n_max"), F.avg("a").alias("n_mean"))
    whole, level = (1 << len(columns)) - 1, F.lit("all")
    for i, c in enumerate(columns):
        level = F.when(F.col("g") == whole - (1 << (len(columns) - 1 - i)), F.lit(c)).otherwise(level)
    return out.select(level.alias("level"), F.coalesce(*columns, F.lit("all")).alias("name"), "n", "n_min", "n_max", "n_mean")


def formula(symbols: Column) -> Column:
    """Counts by symbol: carbon and hydrogen first where there is carbon, the others by letter."""
    kinds = F.array_sort(F.array_distinct(symbols))
    count = lambda s: F.size(F.filter(symbols, lambda x: x == s))
    hill = F.concat(F.filter(kinds, lambda s: s == "C"), F.filter(kinds, lambda s: s == "H"), F.filter(kinds, lambda s: ~s.isin("C", "H")))
    kinds = F.when(F.array_contains(symbols, "C"), hill).otherwise(kinds)
    return F.array_join(F.transform(kinds, lambda s: F.when(count(s) > 1, F.concat(s, count(s).cast("string"))).otherwise(s)), "")


def power_set(items: list) -> list[tuple]:
    """Non-empty combinations by size, then in order."""
    return [c for n in range(1, len(items) + 1) for c in itertools.combinations(items, n)]


def supercell(structures: DataFrame, repeats: tuple[int, int, int]) -> DataFrame:
    """Every structure repeated along its cell vectors, images in order of their shifts, atoms in order within an image."""
    shifts = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in itertools.product(*(range(n) for n in repeats))])
    c = F.col("cell")
    add = lambda p, q: F.zip_with(p, q, lambda x, y: x + y)
    positions = F.flatten(F.transform(shifts, lambda s: F.transform("positions", lambda p: add(p, cartesian(s, c)))))
    rows = F.concat(*[scaled(F.slice(c, 3 * i + 1, 3), float(repeats[i])) for i in range(3)])
    symbols = F.flatten(F.transform(shifts, lambda s: F.col("symbols")))
    n = repeats[0] * repeats[1] * repeats[2]
    # one by one: within one call, a lambda would see the new cell
    moved = structures.withColumn("positions", positions).withColumn("symbols", symbols)
    return moved.withColumn("cell", rows).withColumn("n_atoms", F.col("n_atoms") * n)


def strain_and_rattle(structures: DataFrame, strains: list[float], rattle_count: int, rattle_step: float, seed: int, index: str = "structure_id") -> DataFrame:
    """For every structure and strain factor: the strained structure, and rattle_count copies with normal noise of growing
    amplitude (i + 1) * step. Draws are those of numpy's RandomState with a seed of the place, so that a row is the same
    wherever it is made. candidate_idx numbers all in order of structure, strain and copy."""
    each = rattle_count + 1
    table = structures.select(*structures.columns, F.posexplode(F.array(*[F.lit(float(s)) for s in strains])).alias("strain_pos", "strain"))
    frac = F.transform("positions", lambda p: fractional(p, F.col("cell"), wrap=False))
    table = table.withColumns({"_f": frac, "_c": scaled(F.col("cell"), F.col("strain"))}).withColumn("_p", F.transform("_f", lambda f: cartesian(f, F.col("_c"))))
    table = table.withColumns({"cell": F.col("_c"), "positions": F.col("_p")}).drop("_f", "_c", "_p").withColumn("rattle", F.explode(F.sequence(F.lit(0), F.lit(rattle_count))))
    table = table.withColumn("candidate_idx", F.col(index) * (len(strains) * each) + F.col("strain_pos") * each + F.col("rattle"))
    own = F.lit(seed) + F.col(index) * 100000 + F.bround(F.col("strain") * 1000).cast("long") * 100 + F.col("rattle") - 1

    def noise(p: pd.Series, rattle: pd.Series, s: pd.Series) -> pd.Series:
        out = []
        for positions, r, k in zip(p, rattle, s, strict=True):
            x = np.array([list(v) for v in positions])
            out.append((x + np.random.RandomState(int(k) % (1 << 32)).normal(scale=r * rattle_step, size=x.shape)).tolist() if r else x.tolist())
        return pd.Series(out)

    return table.withColumn("positions", F.pandas_udf(noise, "array<array<double>>")(F.col("positions"), F.col("rattle"), own)).drop("strain_pos")


def direction_displacement(direction: Column, cell: Column, length: float) -> Column:
    """A direction in cell coordinates to a displacement of a fixed length; null for no direction."""
    v = cartesian(direction, cell)
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(size > 0, F.transform(v, lambda x: x * F.try_divide(F.lit(float(length)), size)))


def displacements(sites: DataFrame, length: float, candidates: tuple = symmetry.DIAGONAL, minus: str = "auto", trigonal: bool = False) -> DataFrame:
    """sites(structure_id, atom_idx, cell, rotations) -> one row per displacement with dx, dy, dz."""
    out = symmetry.directions(sites, candidates, minus, trigonal).withColumn("direction", F.col("direction").cast("array<double>"))
    v = direction_displacement(F.col("direction"), F.col("cell"), length)
    return out.select("structure_id", "atom_idx", "k", "direction", *[F.get(v, F.lit(i)).alias(f"d{c}") for i, c in enumerate("xyz")])


def trim_overlaps(structures: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Structures without atoms that lie, across periodic images, within tolerance of an earlier atom."""

    def keep(p: pd.Series, cells: pd.Series) -> pd.Series:
        out = []
        for positions, c in zip(p, cells, strict=True):
            x, m = np.array([list(v) for v in positions]), np.array(list(c)).reshape(3, 3)
            f = x @ np.linalg.inv(m)
            kept: list[int] = []
            for i in range(len(f)):
                d = f[kept] - f[i]
                if not kept or np.linalg.norm((d - np.round(d)) @ m, axis=1).min() > tolerance:
                    kept.append(i)
            out.append(kept)
        return pd.Series(out)

    kept = structures.where(determinant(F.col("cell")) != 0).withColumn("_k", F.pandas_udf(keep, "array<int>")("positions", "cell"))
    pick = lambda c: F.transform("_k", lambda i: F.get(c, i))
    return kept.withColumns({"positions": pick("positions"), "symbols": pick("symbols"), "n_atoms": F.size("_k")}).drop("_k")


def parameter_grid(structures: DataFrame, **axes: list) -> DataFrame:
    """Every structure with every combination of the axes' values; the axes are literals, so nothing is shuffled."""
    for name, values in axes.items():
        structures = structures.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return structures


def sort_atoms(structures: DataFrame) -> DataFrame:
    """Atoms in order of symbol, as they came within a symbol."""
    n = F.sequence(F.lit(0), F.size("symbols") - 1)
    order = F.transform(F.array_sort(F.zip_with("symbols", n, lambda s, i: F.struct(s.alias("s"), i.alias("i")))), lambda x: x["i"])
    pick = lambda c: F.transform("_o", lambda i: F.get(c, i))
    out = structures.withColumn("_o", F.when(F.size("symbols") > 0, order).otherwise(F.array().cast("array<int>")))
    names = [c for c in ("symbols", "positions", "forces") if c in structures.columns]
    return out.withColumns({c: F.when(F.col(c).isNotNull(), pick(c)) for c in names}).drop("_o")


def step_snapshots(df: DataFrame, every: int, step: str = "step") -> DataFrame:
    return df.where(F.col(step) % every == 0)
