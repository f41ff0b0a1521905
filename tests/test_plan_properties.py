"""Scale guards: properties of the physical plans, not just of the results."""

import pytest

from conftest import SF_SMALL
from demandlens.operators import demand, quality, share
from demandlens.operators.clean import apply_filters, clean_jobs
from demandlens.operators.explode import explode_list
from demandlens.session import scratch_dir
from demandlens.sources import fixtures as fx
from demandlens.sources.files import write_table


@pytest.fixture(scope="module")
def enriched(spark):
    path = write_table(fx.enriched(spark, SF_SMALL), scratch_dir(spark, "t-plans"), "e")
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(enriched):
    plan = _plan(demand.top_skills_global(explode_list(clean_jobs(enriched))))
    assert "ReadSchema: struct<job_link:string,search_country:string,job_skills:string>" in plan


def test_coverage_report_skips_regex_on_summary(enriched):
    plan = _plan(quality.null_coverage(clean_jobs(enriched, nullable="presence")))
    assert "regexp_replace(job_summary" not in plan
    assert "regexp_replace(job_summary" in _plan(quality.null_coverage(clean_jobs(enriched)))


def test_share_has_no_unpartitioned_window(enriched):
    plan = _plan(share.share_of_total(clean_jobs(enriched), ["job_type"]))
    assert "Window" not in plan and "Subquery" in plan


def test_date_filter_pushed_to_parquet(enriched):
    q = demand.top_positions_by_country(
        apply_filters(clean_jobs(enriched), first_seen=("1996-01-01", "1998-12-31")))
    assert "GreaterThanOrEqual(first_seen,1996-01-01)" in _plan(q)


def test_distinct_rewrite_shuffles_on_key_and_value(enriched):
    plan = _plan(demand.top_companies(clean_jobs(enriched)))
    assert "Expand" in plan


def test_sample_and_top_n_use_take_ordered(spark, enriched):
    from demandlens.operators.split import sample_n

    top = demand.top_n(demand.top_companies(clean_jobs(enriched)), "posting_count", ["company"], 50)
    assert "TakeOrderedAndProject" in _plan(top)
    assert "TakeOrderedAndProject" in _plan(sample_n(enriched, ["job_link"], 20))


def test_auc_running_sums_are_windowed_per_bucket(spark):
    from pyspark.sql import functions as F

    from demandlens.operators import metrics

    df = spark.range(0, 500).select((F.col("id") % 2).cast("int").alias("label"),
                                    (F.col("id") / 500.0).alias("score"))
    plan = _plan(metrics.auc(df, "label", "score"))
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    # Running sums over the scores are partitioned by bucket (partition spec,
    # then the order); the only un-partitioned window runs over bucket totals.
    assert any("windowspecdefinition(__b#" in w and "score#" in w for w in windows)
    assert all("score#" not in w for w in windows if "windowspecdefinition(__b#" not in w)


def test_plain_enrichment_reads_each_input_once(spark, enriched):
    from demandlens.operators.enrich import enrich
    from demandlens.sources.fixtures import POSTING_COLUMNS

    base = scratch_dir(spark, "t-enrich")
    tables = {"p": enriched.select(*POSTING_COLUMNS), "s": enriched.select("job_link", "job_skills"),
              "m": enriched.select("job_link", "job_summary")}
    stored = {k: spark.read.parquet(write_table(df, base, k)) for k, df in tables.items()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(enrich(stored["p"], stored["s"], stored["m"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= 3 and plan.count("FileScan parquet") == 3


def test_dashboard_filters_are_pushed(spark, enriched):
    from demandlens.plans.analytics import dashboard_slice
    from demandlens.plans.eda import write_clean

    stored = write_clean(enriched, scratch_dir(spark, "t-slice"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = _plan(dashboard_slice(spark.read.parquet(stored)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "In(search_country" in pushed and "In(job_type" in pushed
    assert "GreaterThanOrEqual(first_seen,1996-01-01)" in pushed and "LessThanOrEqual(first_seen,1998-12-31)" in pushed


def test_no_private_checkpoint_folder_on_a_cluster():
    from demandlens.session import checkpoint_dir, is_single_jvm

    assert is_single_jvm("local") and is_single_jvm("local[4]")
    assert not is_single_jvm("local-cluster[2,1,1024]") and not is_single_jvm("yarn")

    class Session:
        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)


def test_derived_sources_join_by_link_alone(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(fx.enriched(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # by link: orders, first parts, names, both uses of the documents' keys; the skill lists move no second time
    assert plan.count("Exchange hashpartitioning(job_link") == 5
    assert "Exchange hashpartitioning(o_orderkey" not in plan


def test_labels_and_thresholds_read_the_written_groups(spark):
    from demandlens.plans import mlprep

    plan = _plan(mlprep.dataset(spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 2 and "l_orderkey" not in plan
