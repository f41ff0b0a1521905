"""Shares of a whole-relation total (the reference's ``SUM(x) OVER ()``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.math import percent


def with_share(counts: DataFrame, measure: str = "posting_count",
               pct_name: str = "posting_pct", scale: int = 2) -> DataFrame:
    """Add ``ROUND(100 * m / SUM(m) OVER (), scale)`` to an aggregated frame.

    The total is a scalar subquery (its own small job, then a literal), not an
    un-partitioned window: no single-partition exchange and no cross join, so
    it holds for any number of groups.
    """
    total = counts.agg(F.sum(measure)).scalar()
    return counts.withColumn(pct_name, percent(F.col(measure), total, scale))


def share_of_total(df: DataFrame, keys: Sequence[str], measure: str = "posting_count",
                   pct_name: str = "posting_pct") -> DataFrame:
    """``GROUP BY keys`` count with its percentage of all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(measure))
    return with_share(counts, measure, pct_name)
