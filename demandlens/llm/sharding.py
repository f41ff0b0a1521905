"""Balanced contiguous shards from global byte-size prefix sums.

The rows (without their texts) are sorted by id over range partitions and
written.  Each partition's totals give every partition its offset in bytes and
rows; adding the running sums inside a partition gives each row its place in the
whole table.  The byte range is cut at equal targets: a row belongs to the shard
that holds the middle of its bytes, so a shard is off its target by at most one
row.  Law: ``bytes``.

Sizes are UTF-8 bytes plus ``overhead``; a null text has no bytes.  Null ids come
first; rows with one id follow each other by checksum and size, and rows equal in
all three are interchangeable.  Very long texts are never cut, so a shard may
stay empty when one row is larger than a target.  An empty table gives an empty
result.  Other input columns take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlens.llm.common import crc32_text, materialize

ROW_OVERHEAD = 8


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               overhead: int = ROW_OVERHEAD) -> DataFrame:
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + F.lit(overhead)
    return docs.select(F.col(id_col).alias("doc_id"), size.alias("size"),
                       crc32_text(text_col).alias("text_crc32"))


def offsets(rows: DataFrame) -> DataFrame:
    """Per partition: bytes and rows in all partitions before it.

    One row for each partition; the running sum goes over these totals alone.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    return totals.select("part", F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
                         F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"))


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                   overhead: int = ROW_OVERHEAD) -> DataFrame:
    """Every row's shard (0 to ``shards`` - 1) and its gapless slot in that shard."""
    if shards < 1:
        raise ValueError("shards must be positive")
    sized = sized_rows(docs, id_col, text_col, overhead)
    ordered = sized.sort(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    place = F.monotonically_increasing_id()  # partition and row inside it, as Spark documents
    rows = materialize(ordered.withColumn("place", place).withColumn("part", F.shiftright("place", 33)),
                       "shard-rows")
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(offsets(rows), "shard-offsets")  # a few bytes for each partition
    total = rows.agg(F.sum("size")).first()[0] or 1
    placed = (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(F.broadcast(starts), "part")
              .withColumn("start", F.col("bytes_before") + F.col("inside"))
              .withColumn("number", F.col("rows_before") + F.expr("place & 8589934591")))
    placed = placed.withColumn("middle", (F.col("start") * 2 + F.col("size")).cast("decimal(38,0)"))
    # whole numbers throughout: a quotient with decimal places is rounded, up to the number of shards
    shard = F.expr(f"cast((middle * {shards}) div cast({2 * total} as decimal(38,0)) as int)")
    cut = materialize(placed.withColumn("shard", shard)
                      .select("doc_id", "size", "text_crc32", "number", "shard"), "shard-cut")
    firsts = cut.groupBy("shard").agg(F.min("number").alias("first"))  # one row for each shard
    return (cut.join(F.broadcast(firsts), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("number") - F.col("first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
