"""Left-join enrichment and join-coverage checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.session import write_once


def left_join_split(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` for a ``right`` whose keys repeat a lot.

    In a left outer join AQE can split a hot key only on the left side; in an
    inner join it can split either.  So the matches come from an inner join and
    the rest from an anti join against the distinct right keys, which partial
    aggregation collapses before its shuffle.  The left side is written once
    first: both branches read that table, and a non-deterministic left side is
    evaluated once.
    """
    left = write_once(left, "join-left")
    matched = left.join(right, key, "inner")
    fill = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    unmatched = left.join(right.select(key).distinct(), key, "left_anti").select(*left.columns, *fill)
    return matched.unionByName(unmatched)


def enrich(postings: DataFrame, skills: DataFrame, summary: DataFrame,
           key: str = "job_link", skills_col: str = "job_skills",
           summary_col: str = "job_summary", repeated_child_keys: bool = False) -> DataFrame:
    """3-way left outer equi-join on ``key`` -> one wide row per posting.

    Two plain left joins: one exchange per input, and AQE turns a side into a
    broadcast only when its measured size is under the threshold and splits a
    hot key of the postings.  With ``repeated_child_keys`` the children's keys
    may be hot too (``left_join_split``).
    """
    out = postings
    for child, value in ((skills, skills_col), (summary, summary_col)):
        child = child.select(key, value)
        out = left_join_split(out, child, key) if repeated_child_keys else out.join(child, key, "left")
    return out


def join_coverage(parent: DataFrame, key: str, children: dict[str, DataFrame],
                  total_name: str = "postings_total") -> DataFrame:
    """``COUNT(*)`` of the parent and ``COUNT(child.key)`` per left-joined child.

    Child keys are de-duplicated first (a semi-join style existence flag), so
    a repeated child key cannot inflate the counts; with unique keys the
    result equals the plain left-join form.
    """
    joined = parent.select(key)
    aggs = [F.count(F.lit(1)).alias(total_name)]
    for name, child in children.items():
        flag = f"__has_{name}"
        marks = child.select(key).where(F.col(key).isNotNull()).distinct() \
            .withColumn(flag, F.lit(1))
        joined = joined.join(marks, key, "left")
        aggs.append(F.count(F.col(flag)).alias(name))
    return joined.agg(*aggs)
