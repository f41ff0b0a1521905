"""Within-category quantile label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_thresholds(df: DataFrame, category: str, value: str, q: float = 0.75,
                        accuracy: int = 10000, name: str = "cat_threshold") -> DataFrame:
    """``percentile_approx(value, q)`` per category.

    The percentile sketch merges map-side, so a category holding a third of
    the rows is reduced before the shuffle.
    """
    return df.groupBy(category).agg(
        F.percentile_approx(F.col(value), q, accuracy).alias(name))


def quantile_label(df: DataFrame, category: str = "search_position", value: str = "group_count",
                   q: float = 0.75, label: str = "high_demand",
                   fit_on: DataFrame | None = None) -> DataFrame:
    """1 if ``value`` is strictly above the category's q-quantile, else 0.

    Thresholds come from ``df`` itself (the reference's semantics) unless
    ``fit_on`` names another frame (e.g. the train split only).  The join is
    a plain equi-join: AQE turns it into a broadcast when the measured
    threshold table is small and keeps a shuffle join otherwise.
    """
    thr = category_thresholds(fit_on if fit_on is not None else df, category, value, q)
    flag = F.when(F.col(value) > F.col("cat_threshold"), F.lit(1)).otherwise(F.lit(0)).cast("int")
    return df.join(thr, category, "left").select(*df.columns, flag.alias(label))
