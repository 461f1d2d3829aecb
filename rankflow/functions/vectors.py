"""Functions on array<double> columns.

For a known, moderate width the terms are written out, which keeps them inside
generated code; array lambdas serve the other widths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


# Beyond this many terms the generated method grows too large to be compiled.
UNROLLED = 32


def as_vector(col: Column) -> Column:
    return col.cast("array<double>")


def dot(a: Column, b: Column, dim: int | None = None) -> Column:
    """Inner product, of the first `dim` elements if given."""
    if dim is not None and dim <= UNROLLED:
        return reduce(lambda s, x: s + x, [F.get(a, F.lit(i)) * F.get(b, F.lit(i)) for i in range(dim)])
    if dim is not None:
        a, b = F.slice(a, 1, dim), F.slice(b, 1, dim)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def relu_vector(v: Column) -> Column:
    return F.transform(v, lambda x: F.greatest(x, F.lit(0.0)))


def softmax(v: Column) -> Column:
    shifted = F.transform(v, lambda x: F.exp(x - F.array_max(v)))
    total = F.aggregate(shifted, F.lit(0.0), lambda s, x: s + x)
    return F.transform(shifted, lambda x: x / total)


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def sum_vectors(v: Column, dim: int, weight: Column | None = None) -> list[Column]:
    """One (weighted) sum per element: plain partial aggregates, combined before the shuffle."""
    items = [F.get(v, F.lit(i)) for i in range(dim)]
    return [F.sum(x if weight is None else x * weight).alias(f"__s{i}") for i, x in enumerate(items)]


def collected_sums(dim: int) -> Column:
    return F.array(*[F.col(f"__s{i}") for i in range(dim)])
