"""Stress, virial and cell arithmetic on array columns; tensors are 9 numbers by rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lacuna.functions.numeric import norm

#: Fixed values.
EV_PER_A3_TO_GPA = 160.21766208
KBAR_TO_EV_PER_A3 = 0.0006241509073
#: Place in xx, yy, zz, yz, xz, xy of each of the 9 components.
VOIGT = (0, 5, 4, 5, 1, 3, 4, 3, 2)


def to_nine(t: Column) -> Column:
    """A 6-vector (xx, yy, zz, yz, xz, xy) or 9 numbers to 9 numbers; anything else is null."""
    return F.when(F.size(t) == 6, F.array(*[F.get(t, F.lit(i)) for i in VOIGT])).when(F.size(t) == 9, t)


def to_voigt(t: Column) -> Column:
    return F.when(F.size(t) == 6, t).when(F.size(t) == 9, F.array(*[F.get(t, F.lit(i)) for i in (0, 4, 8, 5, 2, 1)]))


def unit_factor(unit: Column) -> Column:
    """Factor to eV/A^3 of a stress unit's spelling; null if it is unknown."""
    name = F.regexp_replace(F.lower(F.trim(unit)), r"[\s_]", "")
    return (
        F.when(name.isin("ev/a3", "ev/a^3", "ev/ang3", "ev/ang^3", "ev/angstrom3", "ev/angstrom^3", "ev/å^3", "ev/å3"), F.lit(1.0))
        .when(name == "gpa", F.lit(1.0 / EV_PER_A3_TO_GPA))
        .when(name == "kbar", F.lit(KBAR_TO_EV_PER_A3))
    )


def scaled(t: Column, factor: Column | float) -> Column:
    f = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.transform(t, lambda x: x * f)


def cell(c: Column, i: int, j: int) -> Column:
    return F.get(c, F.lit(3 * i + j))


def cofactor(c: Column, i: int, j: int) -> Column:
    a, b, p, q = (i + 1) % 3, (i + 2) % 3, (j + 1) % 3, (j + 2) % 3
    return cell(c, a, p) * cell(c, b, q) - cell(c, a, q) * cell(c, b, p)


def determinant(c: Column) -> Column:
    return sum((cell(c, 0, j) * cofactor(c, 0, j) for j in range(1, 3)), cell(c, 0, 0) * cofactor(c, 0, 0))


def volume(c: Column) -> Column:
    return F.abs(determinant(c))


def fractional(p: Column, c: Column, wrap: bool = True) -> Column:
    """Fractional coordinates of a position in a cell, p times the inverse of c; null where the cell is flat."""
    out = [F.try_divide(sum((F.get(p, F.lit(i)) * cofactor(c, k, i) for i in range(1, 3)), F.get(p, F.lit(0)) * cofactor(c, k, 0)), determinant(c)) for k in range(3)]
    return F.array(*[x - F.floor(x) for x in out]) if wrap else F.array(*out)


def fractions(positions: Column, c: Column) -> Column:
    """The wrapped fractional coordinates of all positions, as `fractional` gives them; the cell's cofactors and determinant are
    computed once, not anew for each coordinate."""
    inverse = F.struct(F.array(*[cofactor(c, k, i) for k in range(3) for i in range(3)]).alias("m"), determinant(c).alias("d"))

    def one(p: Column, v: Column) -> Column:
        m = lambda k, i: F.get(v["m"], F.lit(3 * k + i))
        out = [F.try_divide(sum((F.get(p, F.lit(i)) * m(k, i) for i in range(1, 3)), F.get(p, F.lit(0)) * m(k, 0)), v["d"]) for k in range(3)]
        return F.transform(F.array(*out), lambda x: x - F.floor(x))

    return F.get(F.transform(F.array(inverse), lambda v: F.transform(positions, lambda p: one(p, v))), F.lit(0))


def cartesian(f: Column, c: Column) -> Column:
    return F.array(*[sum((F.get(f, F.lit(i)) * cell(c, i, k) for i in range(1, 3)), F.get(f, F.lit(0)) * cell(c, 0, k)) for k in range(3)])


def strained(c: Column, strain: Column | float) -> Column:
    """The cell times a strain factor."""
    return scaled(c, strain)


def virial_from_stress(stress: Column, c: Column, sign: float = -1.0) -> Column:
    """virial = -stress * volume by default; some label sources use the other sign."""
    return scaled(to_nine(stress), F.lit(float(sign)) * volume(c))


def stress_gpa(stress_gpa_: Column, stress: Column, calculator: Column, virial: Column, c: Column) -> Column:
    """Stress in GPa from the first that is there: stress_gpa, stress and calculator (eV/A^3), virial (sign turned)."""
    from_virial = scaled(to_nine(virial), F.try_divide(F.lit(-EV_PER_A3_TO_GPA), volume(c)))
    return F.coalesce(to_nine(stress_gpa_), scaled(to_nine(stress), EV_PER_A3_TO_GPA), scaled(to_nine(calculator), EV_PER_A3_TO_GPA), from_virial)


def parity_gpa(virial: Column, c: Column) -> Column:
    """The sign that parity reports use, + virial / volume; never to be compared with stress_gpa."""
    return scaled(to_nine(virial), F.try_divide(F.lit(EV_PER_A3_TO_GPA), volume(c)))


def max_force(forces: Column) -> Column:
    """The largest norm of an array of vectors; null if there is none."""
    return F.array_max(F.transform(forces, norm))


def box_to_cell(bounds: Column) -> Column:
    """(xlo, xhi, xy, ylo, yhi, xz, zlo, zhi, yz) of a triclinic box, as a dump writes it, to a cell of 9 numbers."""
    b = [F.get(bounds, F.lit(i)) for i in range(9)]
    xlo, xhi, xy, ylo, yhi, xz, zlo, zhi, yz = b
    zero = F.lit(0.0)
    lx = (xhi - F.greatest(zero, xy, xz, xy + xz)) - (xlo - F.least(zero, xy, xz, xy + xz))
    ly = (yhi - F.greatest(zero, yz)) - (ylo - F.least(zero, yz))
    return F.array(lx, zero, zero, xy, ly, zero, xz, yz, zhi - zlo)
