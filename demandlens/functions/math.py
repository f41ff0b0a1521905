"""Arithmetic column helpers with Hive-like NULL-instead-of-error semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent(part, whole, scale: int = 2) -> Column:
    """``ROUND(100.0 * part / whole, scale)`` as DOUBLE; ``whole = 0`` -> NULL."""
    ratio = F.try_divide(F.lit(100.0) * _col(part).cast("double"), _col(whole).cast("double"))
    return F.round(ratio, scale).cast("double")


def per_unit(numer, denom) -> Column:
    """``numer / greatest(denom, 1.0)`` as DOUBLE (lower-bounded divisor)."""
    return _col(numer).cast("double") / F.greatest(_col(denom).cast("double"), F.lit(1.0))


def sigmoid(margin) -> Column:
    """Logistic squash of a margin: ``1 / (1 + exp(-m))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(margin)))


def mean_of(cols) -> Column:
    """Row-wise mean of k numeric columns (NULL if any is NULL)."""
    cols = [_col(c) for c in cols]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / F.lit(float(len(cols)))
