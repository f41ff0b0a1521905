"""Versioned tables survive failing writers; bucketed tables join without an exchange; catalog keys."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from demandlens.operators.enrich import enrich
from demandlens.plans import io
from demandlens.session import scratch_dir
from demandlens.sources import files, versions


def test_a_writer_that_fails_leaves_the_former_version(spark):
    base = scratch_dir(spark, "t-versions")
    first = files.replace_table(spark.range(100), base, "t")
    broken = spark.range(1000, numPartitions=4).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("half way")).cast("long")).alias("id"))
    reader = files.current_table(spark, base, "t")
    with pytest.raises(Exception, match="half way"):
        files.replace_table(broken, base, "t")
    assert versions.current(spark, base, "t") == first
    assert reader.count() == files.current_table(spark, base, "t").count() == 100
    files.replace_table(spark.range(7), base, "t")
    assert files.current_table(spark, base, "t").count() == 7


def test_a_crash_before_publishing_is_no_version(spark):
    base = scratch_dir(spark, "t-versions")

    def write_and_die(path):
        spark.range(5).write.parquet(path)
        raise KeyboardInterrupt

    assert versions.current(spark, base, "t") is None
    with pytest.raises(FileNotFoundError):
        files.current_table(spark, base, "t")
    with pytest.raises(KeyboardInterrupt):
        versions.publish(spark, base, "t", write_and_die)
    assert versions.current(spark, base, "t") is None
    files.replace_table(spark.range(3), base, "t")
    assert files.current_table(spark, base, "t").count() == 3


def test_a_table_may_be_replaced_from_itself_and_old_versions_go(spark):
    base = scratch_dir(spark, "t-versions")
    files.replace_table(spark.range(4).withColumn("k", F.col("id") % 2), base, "t", ["k"], keep=2)
    for _ in range(3):
        files.replace_table(files.current_table(spark, base, "t").selectExpr("id * 2 AS id", "k"), base, "t", ["k"], keep=2)
    assert sorted(r.id for r in files.current_table(spark, base, "t").collect()) == [0, 8, 16, 24]
    assert len(versions.pointers(spark, base, "t")) == 2
    assert len([n for n in versions.names_in(spark, f"{base}/t") if n.startswith("v-")]) == 2


@pytest.fixture
def no_broadcasts(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_bucketed_sources_join_without_an_exchange(spark, no_broadcasts):
    names = io.stored_sources(spark, SF_SMALL, "t_bucketed", 4)
    tables = [spark.table(names[n]) for n in ("postings", "skills", "summary")]
    joined = enrich(*tables)
    joined.count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    plain = enrich(*[spark.read.parquet(t.inputFiles()[0].rsplit("/", 1)[0]) for t in tables])
    assert plain.exceptAll(joined).count() == 0 and joined.count() == plain.count()
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()


def test_catalog_keys_read_by_name(spark):
    rows = {r.table_name: (r.is_view, r.row_count) for r in io.q_catalog_tables(spark, SF_SMALL).collect()}
    assert {n: v for n, (v, _) in rows.items()} == {"postings": False, "skills": False, "summary": False,
                                                   "listing_postings": True, "listing_skills": True}
    assert rows["listing_postings"][1] == rows["postings"][1] and rows["listing_skills"][1] > rows["skills"][1]
    assert spark.catalog.currentDatabase() == "default"
