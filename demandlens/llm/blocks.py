"""Comparing the classes of open buckets in blocks of bounded size.

A bucket is open while its classes, its first one aside, are in different components.
Two classes of its largest component need no look, so only the other classes seek: they are
dealt into blocks, the rest into others, and a task compares a block of seekers with another
block.  There are as many blocks as the square root of the rows asks for, so a row travels
far less often than there are pairs, while a block grows with that root only.  A seeker
gets a bounded number of partners of other components, the most similar first.  Where it has
more, it waits for the next round, and with it just the classes that it has not been given;
all others are done, as their pairs have been handed out or excluded.  So neither a bucket's
classes nor its pairs ever come together in one place.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import materialize

#: Rows that a task compares at a time, about.
TASK_ROWS = 4096

#: By how much a row of the table and the places of others differ beyond what may be linked (0 or less: may be).
Test = Callable[[int, np.ndarray], np.ndarray]


def open_members(members: DataFrame, labels: DataFrame, waiting: DataFrame | None = None) -> DataFrame:
    """``members`` (h, node, center, ...) of open buckets with their ``component``, and whether they seek (``seeks``).

    ``c`` and ``s`` count the bucket's classes and those that seek: at first all outside the
    largest component, then those in ``waiting`` (h, node, seeks), to which a later round is limited.
    """
    named = members.where("node != center").drop("center")
    if waiting is not None:
        named = named.join(waiting, ["h", "node"])
    named = materialize(named.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")),
                        "blocks-named")
    if waiting is None:
        each = named.groupBy("h", "component").agg(F.count("*").alias("n"))
        open_ = (each.groupBy("h").agg(F.count("*").alias("components"), F.sum("n").alias("c"),
                                       F.max(F.struct("n", "component")).alias("main"))
                 .where("components > 1").select("h", "c", (F.col("c") - F.col("main.n")).alias("s"), "main.component"))
        open_ = materialize(open_.withColumnRenamed("component", "main"), "blocks-open")
        return named.join(open_, "h").withColumn("seeks", F.col("component") != F.col("main")).drop("main")
    open_ = (named.groupBy("h").agg(F.min("component").alias("l"), F.max("component").alias("m"), F.count("*").alias("c"),
                                    F.count_if("seeks").alias("s"))
             .where("l != m AND s > 0").select("h", "c", "s"))
    return named.join(materialize(open_, "blocks-open"), "h")


def deal(rows: DataFrame, size: Column) -> DataFrame:
    """Each row once for every pair (i, j) of its bucket's blocks that its own ``block`` is in.

    Seekers have the first blocks and meet all, others meet seekers only.  Up to ``size`` rows are one block.
    """
    def cut(rows: Column) -> Column:
        return F.greatest(F.ceil(F.sqrt(rows / size)), F.lit(1)).cast("int")

    seeks, at = F.col("seeks"), F.hash("node")
    rows = rows.withColumns({"sought": cut(F.col("s")), "rest": cut(F.col("c") - F.col("s"))})
    rows = rows.withColumns({
        "block": F.when(seeks, F.pmod(at, "sought")).otherwise(F.col("sought") + F.pmod(at, "rest")),
        "met": F.when(seeks & (F.col("c") > F.col("s")), F.col("sought") + F.col("rest")).otherwise(F.col("sought"))})
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, met - 1)")))
    return (rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
            .drop("sought", "rest", "met", "other", "c", "s", "seeks"))


def partners(rows: DataFrame, prepare: Callable[[pa.Table], Test], most: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, b): up to ``most`` partners of each seeker in each pair of blocks; (h, node, seeks): what waits.

    A seeker that has more partners waits (``seeks``), and so do those it has not been given.
    ``prepare`` gets a task's rows and returns the test of a row against others.
    """
    tasks = -(-max(1, rows.count()) // task_rows)

    def compare(table: pa.Table) -> pa.Table:
        h, i, j, block, node, component = (table.column(c).to_numpy() for c in ("h", "i", "j", "block", "node", "component"))
        order = np.lexsort((j, i, h))
        cut = np.flatnonzero((np.diff(h[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        test = prepare(table)
        ends: tuple[list, list] = ([], [])
        seeks, waits = np.zeros(len(h), bool), np.zeros(len(h), bool)
        for group in np.split(order, cut):
            left = group[block[group] == i[group[0]]]
            right = group[block[group] == j[group[0]]]
            for at, x in enumerate(left.tolist()):
                others = right[at + 1:] if i[x] == j[x] else right
                others = others[component[others] != component[x]]
                if len(others):
                    beyond = test(x, others)
                    found = others[beyond <= 0]
                    if len(found) > most:
                        found = found[np.argsort(beyond[beyond <= 0], kind="stable")]
                        seeks[x] = waits[x] = True
                        waits[found[most:]] = True
                    if len(found):
                        ends[0].append(np.full(min(most, len(found)), node[x]))
                        ends[1].append(node[found[:most]])
        a, b = (np.concatenate(e) if e else np.empty(0, np.int64) for e in ends)
        pairs = pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})
        left_over = pa.table({"h": pa.array(h[waits], pa.int64()), "node": pa.array(node[waits], pa.int64()),
                              "seeks": pa.array(seeks[waits], pa.bool_())})
        return pa.concat_tables([pairs, left_over], promote_options="default")

    dealt = rows.withColumn("task", F.pmod(F.xxhash64("h", "i", "j"), F.lit(tasks)))
    return dealt.groupBy("task").applyInArrow(compare, "a long, b long, h long, node long, seeks boolean")


def split_found(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of written ``partners``, the distinct pairs (a, b), and (h, node, seeks) of what waits."""
    waiting = found.where("node IS NOT NULL").groupBy("h", "node").agg(F.max("seeks").alias("seeks"))
    return found.where("a IS NOT NULL").select("a", "b").distinct(), waiting


def list_rows(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and members of a list column of long numbers, as unsigned ones (numpy counts the bits of magnitudes)."""
    lists = table.column(name).combine_chunks()
    return lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
