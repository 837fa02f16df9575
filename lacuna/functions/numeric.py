"""Bin-count rules and small numeric helpers as column expressions. Division is guarded, so ANSI mode never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cube_root_of(n: Column) -> Column:
    return F.pow(n.cast("double"), F.lit(1.0 / 3.0))


def _bins(span: Column, width: Column) -> Column:
    return F.when((width > 0) & (span > 0), F.greatest(F.lit(1), F.ceil(F.try_divide(span, width)))).otherwise(F.lit(1)).cast("long")


def fd_bins(n: Column, span: Column, iqr: Column, sigma: Column, factor: float = 1.0) -> Column:
    """Freedman-Diaconis with ceiling: width 2 IQR / n^(1/3), or 3.5 sigma / n^(1/3) where IQR is 0, times factor; at least 1."""
    width = F.when(iqr > 0, F.lit(2.0) * iqr / cube_root_of(n) * F.lit(factor)).otherwise(F.lit(3.5) * sigma / cube_root_of(n) * F.lit(factor))
    return F.when(n <= 1, F.lit(1)).otherwise(_bins(span, width)).cast("long")


def scott_bins(n: Column, span: Column, sigma: Column, factor: float = 1.0) -> Column:
    return F.when(n <= 1, F.lit(1)).otherwise(_bins(span, F.lit(3.5) * sigma / cube_root_of(n) * F.lit(factor))).cast("long")


def std_bins(span: Column, sigma: Column) -> Column:
    """Ten bins to a standard deviation."""
    return _bins(span, sigma / F.lit(10.0))


def width_bins(span: Column, width: Column | float) -> Column:
    """Bins of a given width; 1 where the width is not positive."""
    return _bins(span, width if isinstance(width, Column) else F.lit(float(width)))


def grid_bins(n: Column, span: Column, iqr: Column, factor: float = 1.0) -> Column:
    """The other Freedman-Diaconis rule, of coverage grids: floor, and the whole range where the width is not positive."""
    width = F.lit(2.0) * iqr / cube_root_of(n) * F.lit(factor)
    width = F.when((width > 0) & ~F.isnan(width), width).otherwise(span)
    return F.when((n > 0) & (span > 0), F.greatest(F.lit(1), F.floor(F.try_divide(span, width)))).otherwise(F.lit(1)).cast("long")


def bin_index(v: Column, vmin: Column, vmax: Column, nbins: Column) -> Column:
    """Equal-width bin of v, equal bit for bit to the reference histogram: an estimate, then one step to either side by the
    edges themselves; the last bin is closed. A constant dimension is one bin."""
    step = (vmax - vmin) / nbins
    guess = F.least(F.floor((v - vmin) * F.try_divide(nbins, vmax - vmin)), nbins - 1)
    moved = F.when(v < vmin + guess * step, guess - 1).when((v >= vmin + (guess + 1) * step) & (guess < nbins - 1), guess + 1).otherwise(guess)
    return F.when(vmax > vmin, moved).otherwise(F.lit(0)).cast("long")


def edge(k: Column, vmin: Column, vmax: Column, nbins: Column) -> Column:
    """The k-th of nbins + 1 edges; half a unit to either side where the dimension is constant."""
    inner = F.when(k >= nbins, vmax).otherwise(vmin + k * ((vmax - vmin) / nbins))
    return F.when(vmax > vmin, inner).otherwise(F.when(k <= 0, vmin - 0.5).otherwise(vmax + 0.5))


def isclose(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)


def linspace(low: float, high: float, count: int) -> list[float]:
    return [low] if count == 1 else [high if i == count - 1 else low + i * ((high - low) / (count - 1)) for i in range(count)]


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
