import datetime as dt

from demandlens.operators.clean import apply_filters, clean_keys
from demandlens.operators.quality import value_distribution


def test_ml_dialect_drops_null_keys_keeps_blank(spark):
    df = spark.createDataFrame([(None, "p"), ("  ", "P "), (" A  B ", "x")],
                               "search_country string, search_position string")
    out = sorted((r.search_country, r.search_position) for r in clean_keys(df).collect())
    assert out == [("", "p"), ("a  b", "x")]


def test_apply_filters_eq_in_range(spark):
    rows = [("a", "x", dt.date(2020, 1, d)) for d in range(1, 6)] + [("b", "y", dt.date(2020, 1, 3))]
    df = spark.createDataFrame(rows, "c string, t string, d date")
    out = apply_filters(df, c="a", t=["x", "z"], d=(dt.date(2020, 1, 2), dt.date(2020, 1, 4)))
    assert sorted(r.d.day for r in out.collect()) == [2, 3, 4]
    assert apply_filters(df, d=(None, dt.date(2020, 1, 1))).count() == 1


def test_value_distribution_null_is_a_group(spark):
    df = spark.createDataFrame([("x", None), (None, "t"), ("x", "t")], "job_level string, job_type string")
    out = {(r.column_name, r.value): r.cnt for r in value_distribution(df, ["job_level", "job_type"]).collect()}
    assert out == {("job_level", "x"): 2, ("job_level", None): 1, ("job_type", None): 1, ("job_type", "t"): 2}
