"""Catalog helpers: database with a location, views, table listing, source checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS .. [LOCATION ..]`` and make it current."""
    stmt = f"CREATE DATABASE IF NOT EXISTS `{name}`"
    if location:
        stmt += f" LOCATION '{location}'"
    spark.sql(stmt)
    spark.catalog.setCurrentDatabase(name)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Temp views over DataFrames (the reference's persistent views)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``SHOW TABLES`` as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail before any work if a source path is missing (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(p)
    if missing:
        raise FileNotFoundError("missing source path(s): " + ", ".join(missing))
