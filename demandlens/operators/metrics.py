"""Classification metrics as plain DataFrame aggregates.

Confusion counts, accuracy, weighted F1, per-class precision / recall / F1,
exact AUC-ROC and AUC-PR (MLlib's curve definitions with every distinct score
as a threshold), a threshold sweep and soft voting.  The scored rows are read
once, by a count per (score, label, prediction); everything else works on those
counts.  No job runs while a plan is built, and nothing is collected: the curve
areas need prefix sums over scores in descending order, which are computed per
quantile bucket of the scores (``prefix_sums``) instead of with an un-partitioned
window, so no single task sees all distinct scores.

A NULL score is the lowest of all: such a row is predicted positive at no
threshold of the sweep, and counts last in the curves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlens.functions.math import mean_of, sigmoid


def prefix_sums(df: DataFrame, order_col: str, value_cols: Sequence[str], descending: bool = True,
                suffix: str = "_cum", buckets: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ``order_col`` order, one row per ``order_col`` value out.

    Rows with equal order values are added up first, so ties cannot be dealt in
    arbitrary order; NULL comes after every value.  The values are put in range
    buckets by approximate quantiles, which stay in the plan (a one-row scalar
    subquery with a sorted array, the same for every branch).  Each bucket
    computes a local running sum in its own task; the bucket totals (one row per
    bucket) give the offsets that are added back.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.groupBy(order_col).agg(*[F.sum(v).alias(v) for v in value_cols])
    probabilities = [i / n for i in range(1, n)] or [0.5]
    quantiles = F.array_distinct(F.percentile_approx(order_col, probabilities, 10000)).alias("b")
    # the sums are asked for so that this subquery reads the same exchange as the branches
    row = values.agg(F.struct(quantiles, *[F.sum(v).alias(f"s{i}") for i, v in enumerate(value_cols)]).alias("r"))
    bounds = row.scalar().getField("b")
    kind = values.schema[order_col].dataType.simpleString()
    held = values.withColumn("__bounds", F.coalesce(bounds, F.array().cast(f"array<{kind}>")))
    below = F.size(F.filter("__bounds", lambda b: b < F.col(order_col)))
    # NULL compares with nothing: it gets the bucket after the last, on the order's far side
    far = F.lit(-1) if descending else F.lit(n)
    tagged = held.withColumn("__b", F.when(F.col(order_col).isNull(), far).otherwise(below)).drop("__bounds")
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    inside = Window.partitionBy("__b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.select("*", *[F.sum(v).over(inside).alias(f"__l_{v}") for v in value_cols])
    totals = tagged.groupBy("__b").agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    along = F.col("__b").desc() if descending else F.col("__b").asc()
    before = Window.orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__b", *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}")
                                     for v in value_cols])
    out = local.join(F.broadcast(offsets), "__b")  # at most n + 1 rows
    return out.select(*values.columns, *[(F.col(f"__l_{v}") + F.col(f"__o_{v}")).alias(f"{v}{suffix}")
                                         for v in value_cols])


def outcome_counts(scored: DataFrame, label: str, prediction: str, score: str) -> DataFrame:
    """``(score, label, prediction, n)``: the only pass over the scored rows."""
    return scored.groupBy(F.col(score).cast("double").alias("score"), F.col(label).alias("label"),
                          F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def areas(counts: DataFrame) -> DataFrame:
    """Exact ``(auc_roc, auc_pr)`` of ``(score, label, n)`` by trapezoids over all distinct scores.

    ROC starts at (0,0); PR starts at (0, precision of the top threshold),
    as in MLlib's binary metrics without down-sampling.
    """
    sides = counts.select("score", F.when(F.col("label") == 1, F.col("n")).otherwise(0).alias("pos"),
                          F.when(F.col("label") == 1, 0).otherwise(F.col("n")).alias("neg"))
    cum = prefix_sums(sides, "score", ["pos", "neg"])
    tp, fp = F.col("pos_cum").cast("double"), F.col("neg_cum").cast("double")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    prec = tp / (tp + fp)
    prec_prev = F.when((tp0 + fp0) == 0, prec).otherwise(tp0 / (tp0 + fp0))
    parts = cum.agg(
        F.sum(F.col("neg") * (tp0 + tp) / 2.0).alias("roc_area"),
        F.sum(F.col("pos") * (prec + prec_prev) / 2.0).alias("pr_area"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return parts.select(
        F.try_divide(F.col("roc_area"), F.col("P").cast("double") * F.col("N")).alias("auc_roc"),
        F.try_divide(F.col("pr_area"), F.col("P").cast("double")).alias("auc_pr"))


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``(auc_roc, auc_pr)`` of scored rows."""
    return areas(outcome_counts(scored, label, label, score))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              count_name: str = "count") -> DataFrame:
    """``(label, prediction, count)``; cells with no rows are not emitted."""
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias(count_name))


def per_class_metrics(pred: DataFrame, label: str = "label",
                      prediction: str = "prediction") -> DataFrame:
    """Per class: support, predicted, tp, precision, recall, F1 (0 when undefined).

    Built from the confusion counts (at most k x k rows), so the input is
    scanned once.
    """
    return class_metrics(confusion(pred, label, prediction, "n"), label, prediction)


def class_metrics(conf: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class metrics of ``(label, prediction, n)`` counts."""
    long = conf.select(
        F.stack(F.lit(2),
                F.col(label).cast("double"), F.col("n"), F.lit(0).cast("long"),
                F.col(prediction).cast("double"), F.lit(0).cast("long"), F.col("n")).alias("class", "actual", "predicted"),
        (F.col(label).cast("double") == F.col(prediction).cast("double")).alias("hit"), "n")
    per = long.groupBy("class").agg(
        F.sum("actual").alias("support"),
        F.sum("predicted").alias("predicted"),
        (F.sum(F.when(F.col("hit"), F.col("actual")).otherwise(0))).alias("tp"))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    f1 = F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))
    return per.select("class", F.col("support").cast("long").alias("support"),
                      F.col("predicted").cast("long").alias("predicted"),
                      F.col("tp").cast("long").alias("tp"),
                      p.alias("precision"), r.alias("recall"), f1.alias("f1"))


def overall(classes: DataFrame) -> DataFrame:
    """One row: accuracy and weighted F1 (MLlib's ``f1``: F1 per true class
    weighted by its share of rows) of per-class metrics."""
    return classes.agg(
        F.try_divide(F.sum("tp").cast("double"), F.sum("support")).alias("accuracy"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support").cast("double"))
        .alias("f1"))


def classification_summary(pred: DataFrame, label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    return overall(per_class_metrics(pred, label, prediction))


def binary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                   score: str = "score") -> DataFrame:
    """``(accuracy, f1, auc_roc, auc_pr)`` in one row.

    Both halves read the same counts (one exchange, reused); the two one-row
    aggregates are combined through a scalar subquery, not a join.
    """
    counts = outcome_counts(pred, label, prediction, score)
    conf = counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    packed = overall(class_metrics(conf)).select(F.struct("accuracy", "f1")).scalar()
    # The struct is one column first, so the subquery runs once.
    both = areas(counts).select(packed.alias("__s"), "auc_roc", "auc_pr")
    return both.select(F.col("__s.accuracy").alias("accuracy"), F.col("__s.f1").alias("f1"),
                       "auc_roc", "auc_pr")


def threshold_sweep(scored: DataFrame, label: str = "label", score: str = "score",
                    steps: int = 20) -> DataFrame:
    """Confusion counts and F1 at thresholds ``k / steps`` for k = 1..steps-1.

    Each row is mapped to the index of the highest threshold it reaches
    (a bounded array comparison), counted per index, and the per-threshold
    counts are suffix sums over at most ``steps`` rows.  ``is_best`` marks
    the F1 maximum (lowest threshold on ties).
    """
    thresholds = [k / float(steps) for k in range(1, steps)]
    arr = F.array(*[F.lit(t) for t in thresholds])
    reached = F.size(F.filter(arr, lambda t: t <= F.col(score)))
    per = scored.groupBy(reached.alias("idx")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    spark = scored.sparkSession
    idx = spark.range(0, steps).select(F.col("id").cast("int").alias("idx"))
    full = idx.join(per, "idx", "left").fillna({"pos": 0, "neg": 0})
    down = Window.orderBy(F.col("idx").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_w = Window.partitionBy()
    cum = full.select(
        "idx",
        F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(all_w).alias("P"), F.sum("neg").over(all_w).alias("N"))
    out = cum.where(F.col("idx") >= 1).select(
        (F.col("idx").cast("double") / F.lit(float(steps))).alias("threshold"),
        F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
        (F.col("P") - F.col("tp")).cast("long").alias("fn"),
        (F.col("N") - F.col("fp")).cast("long").alias("tn"))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))
    scored_t = out.select("*", p.alias("precision"), r.alias("recall"), f1.alias("f1"))
    best = Window.orderBy(F.col("f1").desc(), F.col("threshold").asc())
    return scored_t.withColumn("is_best", F.row_number().over(best) == 1)


def positive_probability(df: DataFrame, name: str, prob_col: str | None = None,
                         margin_col: str | None = None) -> DataFrame:
    """``prob_<name>``: a probability column as is, or the sigmoid of a margin."""
    if prob_col is not None:
        return df.withColumn(f"prob_{name}", F.col(prob_col).cast("double"))
    return df.withColumn(f"prob_{name}", sigmoid(F.col(margin_col).cast("double")))


def soft_vote(df: DataFrame, prob_cols: Sequence[str], threshold: float = 0.5,
              prob_name: str = "prob_ensemble", pred_name: str = "prediction") -> DataFrame:
    """Mean of member probabilities; prediction 1.0 when mean >= threshold."""
    return (df.withColumn(prob_name, mean_of(prob_cols))
            .withColumn(pred_name, F.when(F.col(prob_name) >= F.lit(threshold), F.lit(1.0))
                        .otherwise(F.lit(0.0))))
