"""Partition-independent sampling and splitting.

``randomSplit`` / ``orderBy(rand(seed))`` depend on how the input is
partitioned; here the draw is a hash of the row's key and the seed, so the
same row always lands in the same part on any cluster layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DRAW_BITS = 60
#: Rows of a sample up to which they are merged in one task.
MERGED_ROWS = 100_000


def hash_key(keys: Sequence[str], seed: int = 42) -> Column:
    """``concat_ws('|', k1, ..., seed)``: the string the draw is hashed from."""
    return F.concat_ws("|", *[F.col(k) for k in keys], F.lit(str(seed)))


def hash_draw(keys: Sequence[str], seed: int = 42) -> Column:
    """The first 60 bits of ``md5(key|seed)``: an even draw in ``0 .. 2**60 - 1``."""
    return F.conv(F.substring(F.md5(hash_key(keys, seed)), 1, DRAW_BITS // 4), 16, 10).cast("long")


def split_column(keys: Sequence[str], train_fraction: float = 0.7, seed: int = 42,
                 name: str = "split") -> Column:
    """``'train'`` for draws below ``fraction * 2**60``, else ``'test'``."""
    if not 0 <= train_fraction <= 1:
        raise ValueError("train_fraction must be between 0 and 1")
    return F.when(hash_draw(keys, seed) < F.lit(draw_cut(train_fraction)), F.lit("train")) \
        .otherwise(F.lit("test")).alias(name)


def draw_cut(fraction: float) -> int:
    """The draw at which a part of this share ends."""
    return int(round(fraction * (1 << DRAW_BITS)))


def hash_split(df: DataFrame, keys: Sequence[str], train_fraction: float = 0.7,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete train/test parts (narrow filters, no shuffle)."""
    tagged = df.withColumn("__split", split_column(keys, train_fraction, seed))
    train = tagged.where(F.col("__split") == "train").drop("__split")
    test = tagged.where(F.col("__split") == "test").drop("__split")
    return train, test


def random_split(df: DataFrame, train_fraction: float = 0.7, seed: int = 42):
    """The reference's ``randomSplit`` (partition-dependent), kept as an option."""
    return df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Seeded sample of exactly ``min(n, rows)`` rows, stable for any partitioning.

    Up to ``MERGED_ROWS`` rows: ``ORDER BY md5(key|seed), key LIMIT n`` plans as
    ``TakeOrderedAndProject``: each partition keeps its n best rows, only those are
    merged.  A larger sample is the same rows by ``sample_by_threshold``, in no order.
    """
    if n > MERGED_ROWS:
        return sample_by_threshold(df, keys, n, seed)
    return df.orderBy(F.md5(hash_key(keys, seed)), *[F.col(k) for k in keys]).limit(n)


def sample_by_threshold(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42, bits: int = 16) -> DataFrame:
    """The ``n`` rows of the smallest draws without gathering them in one task.

    Rows are counted by the first ``bits`` bits of their draw; the counts (2**bits rows
    at most) tell in which bucket the sample ends and how many rows it takes from it.
    All earlier buckets are kept by a plain filter; only the last bucket, one part in
    2**bits of the table, is put in order.
    """
    draw = F.md5(hash_key(keys, seed))
    bucket = F.conv(F.substring(draw, 1, 15), 16, 10).cast("long")
    rows = df.withColumns({"__bucket": F.shiftright(bucket, 60 - bits), "__draw": draw})
    counts = rows.groupBy("__bucket").agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = (counts.select("__bucket", before.alias("before")).where(F.col("before") < n)
           .agg(F.max(F.struct("__bucket", (F.lit(n) - F.col("before")).alias("left"))).alias("end")).select("end").scalar())
    whole = rows.where(F.col("__bucket") < end.getField("__bucket"))
    order = Window.partitionBy("__bucket").orderBy("__draw", *keys)
    part = (rows.where(F.col("__bucket") == end.getField("__bucket"))
            .withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= end.getField("left")).drop("__place"))
    return whole.unionByName(part).drop("__bucket", "__draw")
