"""The ML data set plan: groups -> min size -> ratios -> label -> split.

Also the small reports around it (class balance, run summary), the seeded
held-out sample, the median profile and the what-if rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.functions.math import sigmoid
from demandlens.operators import metrics
from demandlens.operators.groups import GROUP_KEYS, at_least, group_features, ratio_features
from demandlens.operators.label import quantile_label
from demandlens.operators.split import hash_draw, sample_n, split_column
from demandlens.session import write_once
from demandlens.sources import fixtures as fx

# Fixed values of the reference's preparation step.
MIN_POSTINGS_PER_GROUP = 5
HIGH_DEMAND_QUANTILE = 0.75
TRAIN_FRACTION = 0.7
SEED = 42
N_SAMPLE = 20

# Column order of the ML set (the reference's test-split schema).
DATASET_COLUMNS = ("search_country", "search_position", "group_count", "distinct_companies",
                   "distinct_job_levels", "distinct_job_types", "summary_coverage",
                   "distinct_skills", "skills_per_posting", "companies_per_posting", "high_demand")
MEDIAN_COLUMNS = ("summary_coverage", "distinct_job_levels", "distinct_job_types",
                  "skills_per_posting", "companies_per_posting", "distinct_companies",
                  "distinct_skills", "group_count")

# What-if scenarios for this data (country, position); the last country is
# unseen on purpose, the encoder keeps an "unknown" slot for it.
SCENARIOS = (("nation_1", "red plate"), ("nation_5", "new gear"), ("nation_12", "hot gear"),
             ("atlantis", "blue bolt"))


def groups(spark: SparkSession, sf: str) -> DataFrame:
    return group_features(fx.enriched(spark, sf))


def labelled(groups_df: DataFrame, min_count: int = MIN_POSTINGS_PER_GROUP,
             q: float = HIGH_DEMAND_QUANTILE) -> DataFrame:
    """The groups of enough postings with their label.

    Label and thresholds both read the groups, so these are written first: one row a
    group, instead of the postings' joins once more for the thresholds.
    """
    kept = write_once(ratio_features(at_least(groups_df, "group_count", min_count)), "groups")
    return quantile_label(kept, "search_position", "group_count", q).select(*DATASET_COLUMNS)


def dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The ML set with a ``split`` column (``train`` / ``test``)."""
    return labelled(groups(spark, sf)).withColumn(
        "split", split_column(GROUP_KEYS, TRAIN_FRACTION, SEED))


def split_part(spark: SparkSession, sf: str, part: str) -> DataFrame:
    return dataset(spark, sf).where(F.col("split") == part).drop("split")


def write_parts(data: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Train and test part of ``data``, written once under ``path`` by split and read back.

    The plan of the groups runs once; each part then reads its own folder.
    """
    spark = data.sparkSession
    data.write.mode("overwrite").partitionBy("split").parquet(path)
    stored = spark.read.schema(data.schema).parquet(path)
    if stored.isEmpty():
        raise ValueError(f"every group has fewer than {MIN_POSTINGS_PER_GROUP} postings: nothing to learn from")
    return tuple(stored.where(F.col("split") == part).drop("split") for part in ("train", "test"))


# --- registered queries ----------------------------------------------------------------------

def q_group_features(spark, sf):
    return groups(spark, sf)


def q_ratio_features(spark, sf):
    return ratio_features(at_least(groups(spark, sf), "group_count", MIN_POSTINGS_PER_GROUP))


def q_quantile_label(spark, sf):
    return labelled(groups(spark, sf))


def q_hash_split(spark, sf):
    g = groups(spark, sf)
    return g.select(*GROUP_KEYS, hash_draw(GROUP_KEYS, SEED).alias("draw"),
                    split_column(GROUP_KEYS, TRAIN_FRACTION, SEED))


def q_ml_dataset(spark, sf):
    return dataset(spark, sf)


def class_distribution(data: DataFrame) -> DataFrame:
    """Rows per label and split."""
    return data.groupBy("high_demand", "split").agg(F.count("*").alias("count"))


def q_class_distribution(spark, sf):
    return class_distribution(dataset(spark, sf))


def prepare_summary(grouped: DataFrame) -> DataFrame:
    """One-row run summary; all counts from one pass over the group table."""
    g = grouped.withColumn("split", split_column(GROUP_KEYS, TRAIN_FRACTION, SEED))
    kept = F.col("group_count") >= F.lit(MIN_POSTINGS_PER_GROUP)
    return g.agg(
        F.count(F.lit(1)).alias("rows_before_filter"),
        F.count_if(kept).alias("rows_after_filter"),
        F.count_if(kept & (F.col("split") == "train")).alias("train_rows"),
        F.count_if(kept & (F.col("split") == "test")).alias("test_rows"),
    ).select(F.lit("country_position").alias("aggregation"),
             F.lit(MIN_POSTINGS_PER_GROUP).alias("min_postings_per_group"),
             F.lit(HIGH_DEMAND_QUANTILE).alias("high_demand_quantile"),
             "rows_before_filter", "rows_after_filter", "train_rows", "test_rows",
             F.lit(SEED).alias("split_seed"))


def q_prepare_summary(spark, sf):
    return prepare_summary(groups(spark, sf))


def q_sample_n(spark, sf):
    return sample_n(split_part(spark, sf, "test"), GROUP_KEYS, N_SAMPLE, SEED)


def median_profile(test: DataFrame, cols: Sequence[str] = MEDIAN_COLUMNS) -> DataFrame:
    """Approximate medians of the numeric features, one row (8 sketches, one pass)."""
    return test.agg(*[F.percentile_approx(F.col(c), 0.5, 10000).alias(c) for c in cols])


def q_median_profile(spark, sf):
    return median_profile(split_part(spark, sf, "test"))


def whatif_rows(test: DataFrame, scenarios=SCENARIOS, n_sample: int = N_SAMPLE,
                seed: int = SEED) -> DataFrame:
    """Held-out sample plus crafted scenario rows filled with the test medians.

    The medians arrive as one scalar-subquery struct, so the scenario rows
    need no join; the scenario list is the only literal input.
    """
    spark = test.sparkSession
    held = sample_n(test, GROUP_KEYS, n_sample, seed).withColumn("source", F.lit("held_out"))
    med = median_profile(test).select(F.struct(*MEDIAN_COLUMNS)).scalar()
    rows = spark.createDataFrame(list(scenarios), "search_country string, search_position string")
    crafted = rows.select(
        *[F.col(c) for c in GROUP_KEYS],
        # an empty test part has no medians: 0, in the column's type
        *[F.coalesce(med.getField(c), F.lit(0).cast(test.schema[c].dataType)).alias(c)
          for c in DATASET_COLUMNS if c in MEDIAN_COLUMNS],
        F.lit(0).alias("high_demand"), F.lit("crafted").alias("source"),
    ).select(*DATASET_COLUMNS, "source")
    return held.select(*DATASET_COLUMNS, "source").unionByName(crafted)


def q_whatif_rows(spark, sf):
    return whatif_rows(split_part(spark, sf, "test"))


# --- metric operators on the scored-docs table ----------------------------------------------

def voted(spark, sf) -> DataFrame:
    s = fx.scored_docs(spark, sf)
    s = metrics.positive_probability(s, "margin", margin_col="margin")
    return metrics.soft_vote(s, ["p1", "p2", "prob_margin"])


# Computed probabilities and metric values are reported with 6 decimals (the
# reference's output format), so engines that differ in the last bit of
# exp() or of a summation order report the same value.
REPORT_DECIMALS = 6


def q_sigmoid_score(spark, sf):
    s = fx.scored_docs(spark, sf)
    return s.withColumn("prob_margin", F.round(sigmoid("margin"), REPORT_DECIMALS))


def q_soft_vote(spark, sf):
    return voted(spark, sf).select("doc_id", "label",
                                   F.round("prob_ensemble", REPORT_DECIMALS).alias("prob_ensemble"),
                                   "prediction")


def q_confusion(spark, sf):
    return metrics.confusion(voted(spark, sf), "label", "prediction")


def q_binary_metrics(spark, sf):
    m = metrics.binary_metrics(voted(spark, sf), "label", "prediction", "prob_ensemble")
    return m.select(*[F.round(c, REPORT_DECIMALS).alias(c) for c in m.columns])


def q_per_class_metrics(spark, sf):
    return metrics.per_class_metrics(voted(spark, sf), "label", "prediction")


def q_threshold_sweep(spark, sf):
    return metrics.threshold_sweep(voted(spark, sf), "label", "prob_ensemble", steps=20)


QUERIES = {
    "group_features": q_group_features,
    "ratio_features": q_ratio_features,
    "quantile_label": q_quantile_label,
    "hash_split": q_hash_split,
    "ml_dataset": q_ml_dataset,
    "class_distribution": q_class_distribution,
    "prepare_summary": q_prepare_summary,
    "sample_n": q_sample_n,
    "median_profile": q_median_profile,
    "whatif_rows": q_whatif_rows,
    "sigmoid_score": q_sigmoid_score,
    "soft_vote": q_soft_vote,
    "confusion": q_confusion,
    "binary_metrics": q_binary_metrics,
    "per_class_metrics": q_per_class_metrics,
    "threshold_sweep": q_threshold_sweep,
}
