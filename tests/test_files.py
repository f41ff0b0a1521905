from pyspark.sql.types import StringType, StructField, StructType

from demandlens.session import scratch_dir
from demandlens.sources import files

SCHEMA = StructType([StructField(c, StringType()) for c in ("id", "a", "b", "c")])


def test_csv_roundtrip_quotes_newlines_empty_null(spark):
    rows = [("1", 'x "q" y', "l1\nl2, z", None), ("2", "", " spaced ", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    path = scratch_dir(spark, "t-csv")
    files.write_csv(df, path)
    back = sorted(tuple(r) for r in files.scan_csv(spark, path, SCHEMA).collect())
    assert back == sorted(rows)


def test_csv_column_subset(spark):
    df = spark.createDataFrame([("1", "a", "b", "c")], SCHEMA)
    path = scratch_dir(spark, "t-csv2")
    files.write_csv(df, path)
    assert files.scan_csv(spark, path, SCHEMA, columns=["id", "c"]).columns == ["id", "c"]


def test_delimited_landing(spark):
    rows = [("1", None, "", "text\nwith\rbreaks\u0001x"), ("2", "v", "w", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    path = scratch_dir(spark, "t-landed")
    files.land_delimited(df, path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines[0] == "1\u0001\\N\u0001\u0001textwithbreaksx"
    back = sorted(tuple(r) for r in files.scan_delimited(spark, path, SCHEMA.fieldNames()).collect())
    assert back == [("1", None, "", "textwithbreaksx"), ("2", "v", "w", "")]
    counts = files.line_counts(spark, {"t": path}).first()
    assert counts.line_count == 2


def test_parquet_table_idempotent(spark):
    df = spark.range(10)
    base = scratch_dir(spark, "t-pq")
    p = files.write_table(df, base, "t")
    files.write_table(df, base, "t")
    assert spark.read.parquet(p).count() == 10


def test_text_key_ranges_cover_every_row_once(spark):
    """The conditions of a JDBC read split on a text key, tried as plain filters."""
    rows = [(k,) for k in ["a", "b", "bb", "it's", "m", "z", None, ""]]
    df = spark.createDataFrame(rows, "k string")
    for bounds in ([], ["m"], ["b", "it's", "b"], ["0", "zz"]):
        parts = [df.where(c).collect() for c in files.key_ranges("k", bounds)]
        assert sorted((r for p in parts for r in p), key=str) == sorted(df.collect(), key=str)


def test_jdbc_read_takes_one_way_to_split(spark):
    import pytest

    with pytest.raises(ValueError, match="either"):
        files.read_jdbc(spark, "jdbc:none", "t", column="id", predicates=["1 = 1"])


def test_csv_without_line_breaks_is_split(spark):
    df = spark.range(20_000).selectExpr("cast(id as string) id", "repeat('x', 20) a", "'' b", "cast(null as string) c")
    path = scratch_dir(spark, "t-csv3")
    files.write_csv(df.coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        whole = files.scan_csv(spark, path, SCHEMA)
        split = files.scan_csv(spark, path, SCHEMA, multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert split.exceptAll(whole).count() == 0 and split.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
