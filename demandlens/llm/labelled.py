"""Bounded, documented samples of labelled documents for the two text classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import label_fold, materialize, text_or_empty


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, float | None]:
    """(doc_id, label, text) of up to ``per_class`` documents of each class, and the share of label 1.

    Held-out ids, null ids and labels other than 0 and 1 take no part; of several
    labels of one id the larger counts.  The sample is the ids with the smallest
    hashes; the share is over all labelled ids outside the held-out fold, or None
    unless both classes occur.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
             .where(label_fold(id_col, folds) != held_out)
             .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("label")))
    known = materialize(known, "labels")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    order = known.withColumn("h", F.xxhash64("__id"))
    picked = [order.where(F.col("label") == c).orderBy("h", "__id").limit(per_class) for c in (0, 1)]
    ids = materialize(picked[0].union(picked[1]).drop("h"), "sample-ids")  # 2 * per_class rows at most
    sample = (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
              .join(F.broadcast(ids), F.col("doc_id") == F.col("__id")).drop("__id")
              # of rows with one id any may teach, but always the same one
              .groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")))
    share = counts[1] / (counts[0] + counts[1]) if len(counts) == 2 else None
    return sample, share
