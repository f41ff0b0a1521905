from pyspark.sql import functions as F

from demandlens.operators.label import quantile_label
from demandlens.operators.split import hash_split, sample_n


def test_quantile_label_strict_and_sizes(spark):
    rows = []
    for size in range(1, 6):  # categories of size 1..5, counts 1..size
        rows += [(f"c{size}", f"k{i}", i) for i in range(1, size + 1)]
    rows += [("flat", f"k{i}", 7) for i in range(4)]  # all equal: no positives
    rows += [("tie", "a", 1), ("tie", "b", 3), ("tie", "c", 3), ("tie", "d", 3)]
    df = spark.createDataFrame(rows, "search_position string, k string, group_count long")
    out = {(r.search_position, r.k): r.high_demand for r in quantile_label(df).collect()}
    assert out[("c1", "k1")] == 0
    assert [out[("c4", f"k{i}")] for i in range(1, 5)] == [0, 0, 0, 1]
    assert [out[("c5", f"k{i}")] for i in range(1, 6)] == [0, 0, 0, 0, 1]
    assert all(out[("flat", f"k{i}")] == 0 for i in range(4))
    assert [out[("tie", x)] for x in "abcd"] == [0, 0, 0, 0]


def test_hash_split_disjoint_complete_and_stable(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("k"))
    a_tr, a_te = hash_split(df.repartition(3), ["k"])
    b_tr, b_te = hash_split(df.repartition(7), ["k"])
    tr = {r.k for r in a_tr.collect()}
    te = {r.k for r in a_te.collect()}
    assert tr.isdisjoint(te) and len(tr | te) == 2000
    assert tr == {r.k for r in b_tr.collect()}
    assert 0.65 < len(tr) / 2000 < 0.75


def test_sample_n_exact_and_stable(spark):
    df = spark.range(0, 500).select(F.col("id").cast("string").alias("k"))
    a = [r.k for r in sample_n(df.repartition(2), ["k"], 20).collect()]
    b = [r.k for r in sample_n(df.repartition(9), ["k"], 20).collect()]
    assert len(a) == 20 and a == b


def test_large_samples_are_the_same_rows(spark):
    from demandlens.operators import split

    df = spark.range(0, 3000).select(F.concat(F.lit("k"), F.col("id") % 2900).alias("k"), (F.col("id") * 7).alias("v"))
    for n in (0, 1, 20, 1500, 2999, 3000, 5000):
        for bits in (2, 16):
            got = sorted(r.k for r in split.sample_by_threshold(df.repartition(5), ["k"], n, bits=bits).collect())
            want = sorted(r.k for r in split.sample_n(df, ["k"], n).collect())
            assert got == want and len(got) == min(n, 3000)
    assert split.sample_by_threshold(df.where("false"), ["k"], 5).collect() == []


def test_a_large_sample_is_not_gathered(spark, monkeypatch):
    from demandlens.operators import split

    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("k"))
    monkeypatch.setattr(split, "MERGED_ROWS", 100)
    large = split.sample_n(df, ["k"], 1000)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
    assert large.count() == 1000 and large.exceptAll(df).count() == 0


def test_quantile_label_fit_on_train_only(spark):
    rows = [("p", "a", 1), ("p", "b", 2), ("p", "c", 10), ("q", "d", 5)]
    df = spark.createDataFrame(rows, "search_position string, k string, group_count long")
    fit = df.where(F.col("k") != "c")  # threshold of p from {1, 2} -> 2
    out = {r.k: r.high_demand for r in quantile_label(df, fit_on=fit).collect()}
    assert out == {"a": 0, "b": 0, "c": 1, "d": 0}


def test_balanced_class_weights(spark):
    from demandlens.ml.models import with_class_weights

    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "high_demand int")
    w = {r.high_demand: r.weight for r in with_class_weights(df).collect()}
    assert abs(w[1] - 2.0) < 1e-12 and abs(w[0] - 4 / 6) < 1e-12


def test_every_fraction_is_met(spark):
    df = spark.range(0, 20000).select(F.col("id").cast("string").alias("k"))
    for fraction in (0.0, 0.001, 0.5, 0.999, 1.0):
        train, test = hash_split(df, ["k"], fraction)
        n = train.count()
        assert n + test.count() == 20000
        assert abs(n - 20000 * fraction) <= 5 * (20000 * fraction * (1 - fraction)) ** 0.5
    import pytest

    with pytest.raises(ValueError):
        hash_split(df, ["k"], 1.5)
