"""Vector expressions over arrays of numbers, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doubles(v: str | Column) -> Column:
    return _col(v).cast("array<double>")


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: str | Column) -> Column:
    return F.sqrt(dot(v, v))


def normalized(v: str | Column) -> Column:
    """v over its norm; a zero vector stays zero."""
    v, n = _col(v), norm(v)
    return F.transform(v, lambda x: x / F.when(n > 0, n).otherwise(F.lit(1.0)))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity; 0 where a vector has no length."""
    both = norm(a) * norm(b)
    return F.when(both > 0, dot(a, b) / both).otherwise(F.lit(0.0))


def is_valid(v: str | Column, dims: int | None = None) -> Column:
    """Not null, not empty, finite, of a positive norm, and of the length dims where it is given."""
    v = doubles(v)
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (norm(v) > 0)
    return F.coalesce(ok & (F.size(v) == dims) if dims is not None else ok, F.lit(False))


def affine(v: str | Column, weights: list[list[float]], bias: list[float] | None = None) -> Column:
    """W v + b with a bounded matrix of literals."""
    v = _col(v)
    rows = [dot(F.array(*map(F.lit, row)), v) + F.lit((bias or [0.0] * len(weights))[i]) for i, row in enumerate(weights)]
    return F.array(*rows)
