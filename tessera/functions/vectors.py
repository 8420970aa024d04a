"""Column expressions over array-valued feature columns.

All of these stay JVM-side (built-in SQL functions and higher-order
functions); no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays, summed left to right."""
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y),
                       F.lit(0.0), lambda acc, v: acc + v)


def gather(a, indices: Sequence[int]) -> Column:
    """Dense slice: the values at ``indices`` (0-based), in the given order."""
    arr = _col(a)
    if not indices:
        return F.array().cast("array<double>")
    return F.array(*[arr.getItem(int(i)) for i in indices])


def has_non_byte(a) -> Column:
    """True when any element is non-integral or outside [-128, 127]."""
    return F.exists(_col(a), lambda v: (v < -128) | (v > 127) | (v.cast("double") % 1 != 0))
