import random

from pyspark.sql import functions as F

from demandlens.operators import metrics


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y != 1]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def _brute_pr(rows):
    scores = sorted({s for _, s in rows}, reverse=True)
    P = sum(1 for y, _ in rows if y == 1)
    pts = []
    for t in scores:
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y != 1)
        pts.append((tp / P, tp / (tp + fp)))
    area, prev = 0.0, (0.0, pts[0][1])
    for r, p in pts:
        area += (r - prev[0]) * (p + prev[1]) / 2
        prev = (r, p)
    return area


def test_auc_matches_brute_force_with_ties(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = metrics.auc(df, "label", "score").first()
    assert abs(got.auc_roc - _brute_auc(rows)) < 1e-9
    assert abs(got.auc_pr - _brute_pr(rows)) < 1e-9


def test_prefix_sums_match_running_total(spark):
    rnd = random.Random(3)
    vals = [(float(i), rnd.randint(0, 5)) for i in range(1000)]
    df = spark.createDataFrame(vals, "score double, v long")
    out = {r.score: r.v_cum for r in metrics.prefix_sums(df, "score", ["v"], buckets=8).collect()}
    running = 0
    for s, v in sorted(vals, reverse=True):
        running += v
        assert out[s] == running


def test_per_class_never_predicted_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 0.0), (0, 0.0)], "label int, prediction double")
    pc = {r["class"]: r for r in metrics.per_class_metrics(df).collect()}
    assert pc[1.0].precision == 0.0 and pc[1.0].recall == 0.0 and pc[1.0].f1 == 0.0
    s = metrics.classification_summary(df).first()
    assert abs(s.accuracy - 1 / 3) < 1e-12
    assert abs(s.f1 - (1 / 3) * (2 * (1 / 3) * 1 / (1 / 3 + 1))) < 1e-12
    one = spark.createDataFrame([(1, 1.0), (1, 1.0)], "label int, prediction double")
    assert metrics.classification_summary(one).first().f1 == 1.0


def test_confusion_skips_empty_cells(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0), (1, 0.0)], "label int, prediction double")
    assert metrics.confusion(df).count() == 2


def test_threshold_sweep_counts(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 1), rnd.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, score double")
    out = {round(r.threshold, 2): r for r in metrics.threshold_sweep(df, steps=10).collect()}
    for k in range(1, 10):
        t = k / 10
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y != 1)
        assert out[round(t, 2)].tp == tp and out[round(t, 2)].fp == fp
    assert sum(1 for r in out.values() if r.is_best) == 1


def test_soft_vote(spark):
    df = spark.createDataFrame([(0.2, 0.5, 0.4), (0.7, 0.6, 0.3)], "a double, b double, c double")
    out = metrics.soft_vote(df, ["a", "b", "c"]).select("prediction").collect()
    assert [r.prediction for r in out] == [0.0, 1.0]



def test_null_scores_count_as_lowest_everywhere(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), None if i % 10 == 0 else round(rnd.random(), 2)) for i in range(100)]
    df = spark.createDataFrame(rows, "label int, score double")
    filled = [(y, -1.0 if s is None else s) for y, s in rows]
    got = metrics.auc(df).first()
    assert abs(got.auc_roc - _brute_auc(filled)) < 1e-9 and abs(got.auc_pr - _brute_pr(filled)) < 1e-9
    for r in metrics.threshold_sweep(df, steps=10).collect():
        assert r.tp + r.fp + r.fn + r.tn == 100
    cum = metrics.prefix_sums(df.withColumn("n", F.lit(1)), "score", ["n"]).collect()
    assert max(r.n_cum for r in cum) == 100 and [r.n_cum for r in cum if r.score is None] == [100]


def test_prefix_sums_over_many_buckets_ties_and_upwards(spark):
    rows = [(float(i % 400), 1) for i in range(2000)] + [(None, 3)]
    df = spark.createDataFrame(rows, "x double, v long")
    up = {r.x: r.v_cum for r in metrics.prefix_sums(df, "x", ["v"], descending=False, buckets=200).collect()}
    assert all(up[float(k)] == 5 * (k + 1) for k in range(400)) and up[None] == 2003


def test_building_binary_metrics_runs_no_job(spark):
    df = spark.createDataFrame([(1, 1.0, 0.9), (0, 0.0, 0.2)], "label int, prediction double, score double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("t-build", "plan building")
    try:
        built = metrics.binary_metrics(df)
        assert not tracker.getJobIdsForGroup("t-build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert built.first().accuracy == 1.0
