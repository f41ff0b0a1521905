"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.session import scratch_dir

#: The characters that contracts call white space: space, tab, newline, \v, \f, \r.
WHITESPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Freezes generated row ids, cuts the lineage and outlives lost executors.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def number_rows(docs: DataFrame, name: str = "__number") -> DataFrame:
    """``docs`` with a number of each row that is the same however often it is read.

    Rows read from Parquet have one already, their file and place in it; other rows are
    numbered and written first.
    """
    try:
        place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        return docs.select("*", place.alias(name))
    except AnalysisException:
        row = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row"))
        return materialize(docs.withColumn(name, row), "numbered")


def without(docs: DataFrame, gone: DataFrame, name: str, most: int) -> DataFrame:
    """``docs`` without the rows whose number is in ``gone``, which is broadcast up to ``most`` counted rows."""
    gone = materialize(gone.select(name), "gone")
    return docs.join(F.broadcast(gone) if gone.count() <= most else gone, name, "left_anti")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once for each row."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc32_text(name: str = "text") -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes; null counts as empty."""
    return F.crc32(text_or_empty(name).cast("binary"))


def drop_clashes(df: DataFrame, names: list[str]) -> DataFrame:
    """Without the input columns whose names the operator's own columns take."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def label_fold(id_col: str, folds: int) -> Column:
    """Remainder of the CRC-32 of the id's text; a null id is in fold -1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(-1))


def fold_rest(docs: DataFrame, used: list[str]) -> DataFrame:
    """``docs`` with all columns but ``used`` in one struct, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, *([F.struct(*rest).alias("__rest")] if rest else []))


def unfold_rest(df: DataFrame, columns: list[str], used: list[str]) -> DataFrame:
    """Back to ``columns`` after ``fold_rest``."""
    return df.select(*[F.col(c) if c in used else F.col("__rest").getField(c).alias(c) for c in columns])
