"""RFC-4180 CSV with line breaks inside quoted fields, read by many tasks a file.

A line break ends a record only if the number of quotes before it is even (a doubled quote
adds two).  So a split can be read on its own once the parity of the quotes before it is
known:

1. one scan counts the quotes of every split; running sums over a file's splits (one row
   each) give the parity at which each split starts;
2. each task reads the lines of its splits in order, starts a record only where the parity is
   even, and hands on whole records;
3. a record that goes over a split's border is left as pieces: the end of the split it starts
   in, splits that lie inside it, and the head of the split it ends in.  Only these pieces
   are shuffled, and joined in order.

Records are parsed by Spark's own CSV parser.  Quotes must follow RFC 4180: none inside
an unquoted field.  In files whose lines end in two characters such ends inside quotes stay
as they are (the one-task scan makes them one character).  A parity belongs to a byte offset, so it stays right if a later scan
splits the files otherwise; an offset that the first scan has not seen raises.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: What a row of a split is: a whole record, the open end of the split, a head that ends
#: the record before, or a split that lies inside one record.
RECORD, OPEN, HEAD, INSIDE = 0, 1, 2, 3
PIECES = "file long, block long, kind int, first boolean, text string"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of each split, in order inside a task."""
    return spark.read.text(path, lineSep="\n").select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def start_parities(lines: DataFrame) -> DataFrame:
    """(file, block, odd): whether the quotes before each split are odd; one row a split."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    totals = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("odd"))


class Splitter:
    """Goes through the lines of a task, split by split."""

    def __init__(self):
        self.at, self.open, self.lines = None, False, []

    def enter(self, file: int, block: int, odd: bool) -> None:
        self.at, self.block, self.open, self.kind = (file, block), block, odd, HEAD
        self.lines, self.first = [], block == 0

    def leave(self) -> list[tuple]:
        """The piece that the split ends with."""
        if self.at is None or not self.open:
            return []
        kind = INSIDE if self.kind == HEAD else OPEN
        return [(*self.at, kind, self.first_open and kind == OPEN, "\n".join(self.lines))]

    first_open = False

    def read(self, values: pa.Array) -> tuple[pa.Array, bool, list[tuple]]:
        """Lines that are records by themselves, whether the first is the file's first, and the other pieces."""
        odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_numpy(zero_copy_only=False).astype(bool)
        after = np.logical_xor.accumulate(np.concatenate([[self.open], odd]))
        before, after = after[:-1], after[1:]
        plain, pieces, first = ~before & ~after, [], self.first
        for i in np.flatnonzero(~plain).tolist():
            if not before[i]:
                self.kind, self.lines, self.first_open = RECORD, [], first and i == 0
            self.lines.append(values[i].as_py())
            if not after[i]:
                pieces.append((*self.at, self.kind, self.first_open and self.kind == RECORD, "\n".join(self.lines)))
                self.lines = []
        if len(odd):
            self.open, self.first = bool(after[-1]), False
        return values.filter(pa.array(plain)), first and len(plain) > 0 and bool(plain[0]), pieces


def cut_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of lines (file, block, odd, value)."""
    names = ["file", "block", "kind", "first", "text"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    split = Splitter()
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        borders = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for start, end in zip([0, *borders], [*borders, batch.num_rows], strict=True):
            at = int(file[start]), int(block[start])
            if at != split.at:
                yield batch_of(split.leave())
                split.enter(*at, batch.column("odd")[int(start)].as_py())
            plain, first, pieces = split.read(batch.column("value").slice(start, end - start))
            n = len(plain)
            flags = np.zeros(n, bool)
            flags[:1] = first
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, at[0])), pa.array(np.full(n, at[1])), pa.array(np.full(n, RECORD, np.int32)),
                 pa.array(flags), plain], names=names)
            if pieces:
                yield batch_of(pieces)
    yield batch_of(split.leave())


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """One ``text`` a record, line breaks inside quotes included; each file's first record left out if ``header``."""
    lines = split_lines(spark, path)
    # a row for each split of the input: 30 bytes for 128 MB of it
    known = F.broadcast(start_parities(lines))
    seen = F.coalesce("odd", F.raise_error(F.lit("the files were split otherwise than before")).cast("boolean"))
    pieces = lines.join(known, ["file", "block"], "left").select("file", "block", seen.alias("odd"), "value").mapInArrow(
        cut_records, PIECES)
    whole = pieces.where(F.col("kind") == RECORD).select("first", "text")
    order = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    owner = F.last(F.when(F.col("kind") == OPEN, F.col("block")), ignorenulls=True).over(order)
    part = F.struct("block", (-F.col("kind")).alias("k"), "text")
    joined = (pieces.where(F.col("kind") != RECORD).withColumn("owner", owner).groupBy("file", "owner")
              .agg(F.max("first").alias("first"), F.sort_array(F.collect_list(part)).alias("parts"))
              .select("first", F.concat_ws("\n", F.col("parts.text")).alias("text")))
    out = whole.unionByName(joined)
    if header:
        out = out.where(~F.col("first"))
    # a line end of two characters leaves its first one outside of all quotes
    return out.select(F.regexp_replace("text", "\\r$", "").alias("text")).where("text != ''")


def parse_records(texts: DataFrame, schema: StructType | str, options: dict) -> DataFrame:
    """Columns of the ``text`` records by Spark's CSV parser."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    shown = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}
    return texts.select(F.from_csv("text", ddl, {**shown, "multiLine": "true", "mode": "FAILFAST"}).alias("r")).select("r.*")
