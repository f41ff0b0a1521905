"""Exact deduplication by two-pass Bloom filtering, with DataFrame operations only.

Pass 1 sets two bits for each text's hash and keeps the bits that two or more
rows set: a Bloom filter of the hashes that may be repeated.  Pass 2 tests each
row against it.  A row with a clear bit is surely the only one of its text and
passes straight through; only the other rows are shuffled and compared by their
full SHA-256.  False positives cost a shuffled row, never a wrong result.

The filter has ``BITS_PER_ROW`` bits for each row up to ``MAX_BITS``; that bound
(``MAX_BITS`` / 64 words of 16 bytes) is what is broadcast at most.  Beyond it
the filter is fuller, more rows are shuffled, and the result stays the same.

Texts are equal when they are identical without white space.  Null counts as
empty, so all empty, blank and null texts form one group.  Of a group stays the
row with the most code points in the original text, then the smallest id (null
last); of repeated rows with one id exactly one stays.  An empty table gives an
empty result.  Input columns named as an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import WHITESPACE, drop_clashes, materialize, text_or_empty

BITS_PER_ROW = 16
MIN_BITS = 1 << 16
MAX_BITS = 1 << 28
OUTPUT = ["keep_id", "group_size", "kept", "text_sha256"]
_ROW, _LENGTH = "__row", "__points"


def with_text_key(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the normalised text's SHA-256, its length and a row number."""
    text = text_or_empty(text_col)
    return drop_clashes(docs, [*OUTPUT, _ROW, _LENGTH]).withColumns({
        "text_sha256": F.sha2(F.translate(text, WHITESPACE, ""), 256),
        _LENGTH: F.length(text).cast("long"),
        _ROW: F.monotonically_increasing_id(),
    })


def filter_bits(rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> int:
    bits = MIN_BITS
    while bits < rows * bits_per_row and bits < max_bits:
        bits *= 2
    return bits


def bit_positions(key: Column, bits: int) -> list[Column]:
    """One bit in each half of the filter, so a row never sets one bit twice."""
    half = bits // 2
    return [F.pmod(F.xxhash64(key), F.lit(half)),
            F.pmod(F.xxhash64(key, F.lit(1)), F.lit(half)) + F.lit(half)]


def repeated_bits(keys: DataFrame, bits: int) -> DataFrame:
    """The filter's words (``word``, ``mask``): the bits set by two or more rows."""
    position = F.explode(F.array(*bit_positions(F.col("text_sha256"), bits)))
    return (keys.select(position.alias("p")).groupBy("p").agg(F.count("*").alias("n")).where("n > 1")
            .groupBy(F.shiftright("p", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("mask")))


def possibly_repeated(rows: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``__maybe``: whether the filter has both bits of the row's hash."""
    tests = []
    for i, position in enumerate(bit_positions(F.col("text_sha256"), bits)):
        side = words.select(F.col("word").alias(f"__w{i}"), F.col("mask").alias(f"__m{i}"))
        rows = rows.withColumn(f"__p{i}", position)
        rows = rows.join(F.broadcast(side), F.shiftright(f"__p{i}", 6) == F.col(f"__w{i}"), "left")
        tests.append(F.coalesce(F.expr(f"getbit(__m{i}, cast(__p{i} & 63 as int))"), F.lit(0)) == 1)
    helpers = [f"__{c}{i}" for c in "wmp" for i in range(2)]
    return rows.withColumn("__maybe", tests[0] & tests[1]).drop(*helpers)


def exact_dedup(keyed: DataFrame, id_col: str = "doc_id", bits_per_row: int = BITS_PER_ROW,
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row for each row of ``keyed`` (from ``with_text_key``), with the group's outcome.

    Adds keep_id (id of the row that stays), group_size and kept; the columns
    that ``keyed`` carries, texts included, stay beside them.
    """
    rows = materialize(keyed, "dedup-rows")
    bits = filter_bits(rows.count(), bits_per_row, max_bits)
    words = materialize(repeated_bits(rows, bits), "dedup-filter")
    probed = possibly_repeated(rows, words, bits)
    first = F.min(F.struct((-F.col(_LENGTH)).alias("a"), F.col(id_col).isNull().alias("b"),
                           F.col(id_col).alias("id"), F.col(_ROW).alias("row")))
    # written, so that the join below shuffles both its sides and AQE can split a hot text
    groups = materialize(
        probed.where("__maybe").groupBy("text_sha256")
        .agg(first.alias("first"), F.count("*").alias("group_size")).where("group_size > 1")
        .select(F.col("text_sha256").alias("__sha"), F.col("first.id").alias("keep_id"),
                F.col("first.row").alias("__first"), "group_size"), "dedup-groups")
    alone = {"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    straight = probed.where(~F.col("__maybe")).withColumns(alone)
    grouped = F.col("__first").isNotNull()
    compared = (probed.where("__maybe").join(groups, F.col("text_sha256") == F.col("__sha"), "left")
                .withColumns({"kept": ~grouped | (F.col(_ROW) == F.col("__first")),
                              "keep_id": F.when(grouped, F.col("keep_id")).otherwise(F.col(id_col)),
                              "group_size": F.coalesce("group_size", F.lit(1).cast("long"))}))
    out = straight.unionByName(compared.drop("__sha", "__first"))
    return out.drop("__maybe", _ROW, _LENGTH)
