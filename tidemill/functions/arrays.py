"""Array and vector columns: slices, masks, reshapes, products and norms. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def doubles(column) -> Column:
    return _c(column).cast("array<double>")


def element(column, index: int) -> Column:
    """Zero-based element; negative counts from the end; null when out of range."""
    return F.try_element_at(_c(column), F.lit(index + 1 if index >= 0 else index))


def cut_slice(column, start: int, stop: int) -> Column:
    """Zero-based half-open slice."""
    return F.slice(_c(column), start + 1, max(stop - start, 0))


def where(column, predicate) -> Column:
    """Keep the elements for which `predicate` holds."""
    return F.filter(_c(column), predicate)


def scale(column, factor: float) -> Column:
    return F.transform(doubles(column), lambda x: x * F.lit(factor))


def reshape(column, width: int) -> Column:
    """Array of rows of `width` elements; the size must be a multiple of `width`."""
    c = _c(column)
    starts = F.sequence(F.lit(1), F.size(c), F.lit(width))
    return F.transform(starts, lambda s: F.slice(c, s, F.lit(width)))


def flatten(column) -> Column:
    return F.flatten(_c(column))


def total(column) -> Column:
    return F.aggregate(doubles(column), F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return total(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(column) -> Column:
    return F.sqrt(total(F.transform(doubles(column), lambda x: x * x)))


def normalised(column) -> Column:
    """Unit-length copy; a zero vector stays zero."""
    c = doubles(column)
    length = norm(c)
    return F.transform(c, lambda x: x / F.when(length == 0, 1.0).otherwise(length))


def mean_square(a, b) -> Column:
    """Mean squared difference of two vectors of equal length."""
    squares = F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y))
    return total(squares) / F.size(_c(a))
