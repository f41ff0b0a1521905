"""All registered queries, keyed as in the survey's index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandlens.plans import analytics, io, ml, mlprep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    out.update(analytics.QUERIES)
    out.update(mlprep.QUERIES)
    out.update(io.QUERIES)
    out.update(ml.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    from demandlens.plans import oracle

    out = oracle.oracle_sql()
    out.update(oracle.ml_oracle_sql())
    out.update(oracle.io_oracle_sql())
    return out
