import datetime as dt

from pyspark.sql import functions as F

from demandlens.functions.text import key_text, normalized_text, nullable_text, truthy_flag, zoned_timestamp
from demandlens.operators.typing import type_columns


def _one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


EDGE = [None, "", "  ", "\t", " A  b\tC ", "ünïcode"]


def test_normalized_text_edges(spark):
    assert _one(spark, EDGE, normalized_text) == ["unknown", "unknown", "unknown", "", "a b c", "ünïcode"]


def test_normalized_text_blank_after_clean(spark):
    out = _one(spark, EDGE, lambda c: normalized_text(c, blank_after_clean=True))
    assert out[3] == "unknown"


def test_nullable_text(spark):
    assert _one(spark, EDGE, nullable_text) == [None, None, None, "", "a b c", "ünïcode"]
    assert _one(spark, [" A  B "], lambda c: nullable_text(c, lower=False)) == ["A B"]


def test_key_text_no_collapse(spark):
    assert _one(spark, ["  A  b "], key_text) == ["a  b"]


def test_truthy_and_timestamp(spark):
    assert _one(spark, ["True", "T", "1", "yes", None, "f"], truthy_flag) == [1, 1, 1, 0, 0, 0]
    ts = _one(spark, ["2024-01-19 09:45:09.215838+00", "garbage", None], zoned_timestamp)
    assert ts == [dt.datetime(2024, 1, 19, 9, 45, 9, 215838), None, None]


def test_type_columns_keeps_order(spark):
    df = spark.createDataFrame([("k", "2024-01-01+00", "t", "2024-02-03")], "a string, ts string, f string, d string")
    out = type_columns(df, ["ts"], ["f"], ["d"])
    assert out.columns == ["a", "ts", "f", "d"]
    row = out.first()
    assert row.f == 1 and row.d == dt.date(2024, 2, 3) and row.ts == dt.datetime(2024, 1, 1)
    assert dict(out.dtypes)["ts"] == "timestamp_ntz"
