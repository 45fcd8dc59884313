"""Fixed-width vector arithmetic on ARRAY columns.

Widths are known from the dataset config, so every helper unrolls into plain element arithmetic: that stays inside
whole-stage codegen, where lambdas (`transform`, `zip_with`) would be interpreted row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(vector: Column | str, i: int) -> Column:
    """Element `i` (0-based, negative counts from the end)."""
    return F.element_at(_col(vector), i + 1 if i >= 0 else i)


def elements(vector: Column | str, width: int) -> list[Column]:
    return [_col(vector)[i] for i in range(width)]


def each(vector: Column | str, width: int, fn: Callable[[Column, int], Column]) -> Column:
    return F.array(*[fn(x, i) for i, x in enumerate(elements(vector, width))])


def span(vector: Column | str, start: int, stop: int | None = None) -> Column:
    """Python slice `vector[start:stop]` for constant bounds."""
    v = _col(vector)
    if start >= 0 and stop is not None and stop >= 0:
        return F.slice(v, start + 1, max(stop - start, 0))
    if start < 0 and stop is None:
        return F.slice(v, start, -start)
    if start < 0 and stop is not None and stop < 0:
        return F.slice(v, start, stop - start)
    size = F.size(v)
    last = size if stop is None else (F.lit(stop) if stop >= 0 else size + stop)
    first = F.lit(start) if start >= 0 else size + start
    return F.slice(v, first + 1, F.greatest(last - first, F.lit(0)))


def zeros(n: int) -> Column:
    return F.array(*[F.lit(0.0)] * n)


def ones(n: int) -> Column:
    return F.array(*[F.lit(1.0)] * n)


def doubles(vector: Column | str) -> Column:
    return _col(vector).cast("array<double>")


def join(*pieces: Column) -> Column:
    return F.concat(*pieces)


def clip(x: Column, low: float, high: float) -> Column:
    """Clip that keeps NaN: Spark orders NaN above every number, so greatest/least alone would turn it into `high`."""
    return F.when(F.isnan(x), x).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), x)))


def norm(vector: Column | str, dims: Sequence[int]) -> Column:
    v = _col(vector)
    total = F.lit(0.0)
    for i in dims:
        total = total + v[i] * v[i]
    return F.sqrt(total)
