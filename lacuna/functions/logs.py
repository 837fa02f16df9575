"""Labels in the logs of two simulation programs, each log one text: energies in eV, forces in eV/A, stresses in eV/A^3.

Lines are found by their marks; all frames of a log are one array, so that callers take the last one or explode it. What a log
does not tell is null. A log is the unit of work; many logs spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lacuna.functions.tensors import cartesian, scaled, volume

#: Units of the two programs' logs.
HARTREE_TO_EV = 27.211386245988
HARTREE_PER_BOHR_TO_EV_PER_A = 51.422067476326
GPA_TO_EV_PER_A3 = 0.006241509073
KBAR_TO_EV_PER_A3 = 0.0006241509073


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value made once, however often `then` names it: Spark makes a named expression anew at each place,
    and within lambdas for each element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _lines(log: Column) -> Column:
    return F.split(log, r"\r?\n")


def _words(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda x: x != "")


def _numbers(line: Column, first: int, count: int | None = None) -> Column:
    """Numbers of a line's words from `first`; all to its end where no count is given."""
    cut = lambda words: F.slice(words, first + 1, count if count is not None else F.greatest(F.size(words), F.lit(1)))
    return F.transform(cut(_words(line)) if count is not None else _let(_words(line), cut), lambda x: x.try_cast("double"))


def _places(lines: Column, mark: Callable[[Column], Column]) -> Column:
    """Places, from 0, of the lines with a mark."""
    return F.array_compact(F.transform(lines, lambda x, i: F.when(mark(x), i)))


def _rows(lines: Column, start: Column, count: Column | int, first: int, width: int | None = None) -> Column:
    """Numbers of `count` lines from place `start`."""
    return F.transform(F.slice(lines, start + 1, count), lambda x: _numbers(x, first, width))


def _first(places: Column) -> Column:
    return F.get(places, F.lit(0))


def quickstep(log: Column) -> Column:
    """energy, forces and stress (9 numbers) of a single-point log: the first energy and the first stress, and the forces
    between the last heading before the first sum of forces and that sum."""

    def found(lines: Column) -> Column:
        energy_at = _first(_places(lines, lambda x: x.contains("ENERGY| Total FORCE_EVAL ( QS ) energy [a.u.]")))
        energy = F.try_element_at(_words(F.get(lines, energy_at)), F.lit(-1)).try_cast("double") * HARTREE_TO_EV
        heads = _places(lines, lambda x: x.contains("ATOMIC FORCES in [a.u.]"))
        span = lambda end: F.struct(F.try_element_at(F.filter(heads, lambda i: i < end), F.lit(-1)).alias("start"), end.alias("end"))
        block = lambda s: F.slice(lines, s["start"] + 3, F.greatest(s["end"] - s["start"] - 2, F.lit(0)))
        atoms = F.filter(_let(_let(_first(_places(lines, lambda x: x.contains("SUM OF ATOMIC FORCES"))), span), block), lambda x: F.get(_words(x), F.lit(0)).rlike(r"^\d+$"))
        forces = F.transform(atoms, lambda x: scaled(_numbers(x, 3, 3), HARTREE_PER_BOHR_TO_EV_PER_A))
        stress_at = _first(_places(lines, lambda x: x.contains("STRESS| Analytical stress tensor [GPa]")))
        stress = scaled(F.flatten(_let(stress_at, lambda at: _rows(lines, at + 2, 3, 2))), GPA_TO_EV_PER_A3)
        return F.struct(energy.alias("energy"), forces.alias("forces"), stress.alias("stress"))

    return _let(_lines(log), found)


def relaxation(log: Column) -> Column:
    """converged and frames (symbols, cell, positions, forces, energy, virial) of a relaxation log, a frame for each energy. A
    frame's parts are those of its place among parts of their kind; symbols are those of the last force table; virial is
    stress times volume."""
    marks = {
        "sizes": lambda x: x.contains("TOTAL ATOM NUMBER"), "forces": lambda x: x.contains("TOTAL-FORCE (eV/Angstrom)"), "stress": lambda x: x.contains("TOTAL-STRESS (KBAR)"),
        "cells": lambda x: x.contains("Lattice vectors: (Cartesian coordinate: in unit of a_0)"), "positions": lambda x: F.trim(x) == "DIRECT COORDINATES", "energies": lambda x: x.contains("final"),
    }

    def frames(lines: Column, at: Column) -> Column:
        size = lambda i: F.get(_words(F.get(lines, F.try_element_at(F.filter(at["sizes"], lambda s: s <= i), F.lit(-1)))), F.lit(4)).try_cast("int")
        named = lambda last: F.transform(F.slice(lines, last + 3, size(last)), lambda x: F.regexp_replace(F.get(_words(x), F.lit(0)), r"\d+", ""))

        def frame(symbols: Column, i: Column) -> Column:
            c, f, p, s = (F.get(at[k], i) for k in ("cells", "forces", "positions", "stress"))
            direct = _rows(lines, p + 2, size(p), 1, 3)
            return _let(F.flatten(_rows(lines, c + 1, 3, 0)), lambda cell: F.struct(
                symbols.alias("symbols"), cell.alias("cell"), F.transform(direct, lambda x: cartesian(x, cell)).alias("positions"), _rows(lines, f + 2, size(f), 1).alias("forces"),
                F.get(_words(F.get(lines, F.get(at["energies"], i))), F.lit(3)).try_cast("double").alias("energy"),
                scaled(F.flatten(_rows(lines, s + 2, 3, 0)), F.lit(KBAR_TO_EV_PER_A3) * volume(cell)).alias("virial"),
            ))

        return _let(named(F.try_element_at(at["forces"], F.lit(-1))), lambda symbols: F.transform(at["energies"], lambda _, i: frame(symbols, i)))

    every = _let(_lines(log), lambda lines: _let(F.struct(*[_places(lines, mark).alias(k) for k, mark in marks.items()]), lambda at: frames(lines, at)))
    return F.struct(F.coalesce(log.contains("Relaxation is converged"), F.lit(False)).alias("converged"), every.alias("frames"))
