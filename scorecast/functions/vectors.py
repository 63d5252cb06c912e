"""Array<double> expressions: argmax, norms, dot products, element-wise maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def argmax(v) -> Column:
    """A10: 0-based index of the largest element (the first one on ties)."""
    return (F.array_position(_c(v), F.array_max(_c(v))) - 1).cast("int")


def sum_squares(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x * x)


def l2_norm(v) -> Column:
    return F.sqrt(sum_squares(v))


def scale(v, s) -> Column:
    s = _c(s) if not isinstance(s, (int, float)) else F.lit(float(s))
    return F.transform(_c(v), lambda x: F.try_divide(x, s))


def l2_normalize(v) -> Column:
    """V / ||v|| (an all-zero row stays all null-free zeros... divides to null)."""
    return scale(v, l2_norm(v))


def dot(a, b) -> Column:
    """Inner product of two equal-length arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def dot_literal(v, w: list[float]) -> Column:
    """Inner product with a fixed vector held as a literal (no join)."""
    return dot(v, F.array(*[F.lit(float(x)) for x in w]))


def zscore_literal(v, mean: list[float], sd: list[float]) -> Column:
    """(v - mean) / sd element-wise with literal column statistics."""
    m = F.array(*[F.lit(float(x)) for x in mean])
    s = F.array(*[F.lit(float(x)) for x in sd])
    return F.transform(_c(v), lambda x, i: F.try_divide(x - m[i], s[i]))


def round_all(v, digits: int = 9) -> Column:
    return F.transform(_c(v), lambda x: F.round(x, digits))
