import time

from conftest import SF_SMALL
from demandlens.plans import runner
from demandlens.session import scratch_dir
from demandlens.sources import files
from demandlens.sources import fixtures as fx
from demandlens.sources.catalog import list_tables, register_views, require_paths
from demandlens.streaming.landing import stream_landed, write_typed


def test_runner_writes_every_stage(spark):
    from test_ml import POINT

    out = scratch_dir(spark, "t-pipe")
    res = runner.run(spark, SF_SMALL, out, grids=POINT)
    enriched = spark.read.parquet(res["enriched"])
    # landing takes the line breaks out of the summaries
    want = fx.enriched(spark, SF_SMALL).drop("job_summary")
    assert enriched.drop("job_summary").exceptAll(want).count() == 0 and enriched.count() == want.count()
    assert len(res["tables"]) == 13 and res["models"] == ["rf", "gbt", "svm", "nb"]
    top = spark.read.parquet(f"{out}/analytics/top_positions_global")
    assert top.count() > 0
    require_paths(spark, [res["enriched"], f"{out}/typed/postings", f"{out}/previews/top_companies",
                          f"{out}/reports/table_counts", *[f"{out}/ml/models/{m}" for m in res["models"]]])
    counts = spark.read.csv(f"{out}/reports/table_counts", sep="\t", header=True).collect()
    assert {r.table_name for r in counts} == {"postings", "skills", "summary", "enriched"}
    want = {"class_distribution": 1, "prepare_summary": 1, "model_metrics": 5, "best_params": 4, "cv_grid": 5,
            "feature_importance": 2, "confusion": 5, "per_class_metrics": 5, "ensemble_info": 1, "predictions": 4}
    assert sorted(want) == res["results"]
    for name, least in want.items():
        rows = spark.read.csv(f"{out}/results/{name}", header=True)
        assert rows.count() >= least, name
    assert "prob_gbt" in spark.read.csv(f"{out}/results/predictions", header=True).columns
    clean = spark.table("clean_postings").where("job_summary is not null").select("job_summary")
    assert clean.where("job_summary rlike '\\\\s\\\\s'").count() == 0  # normalised, not raw
    assert "exploded_skills" in {r.tableName for r in list_tables(spark).collect()}


def test_reports_taken_during_writes_equal_those_read_from_the_tables(spark):
    from demandlens.operators import quality

    base = scratch_dir(spark, "t-seen")
    path, seen = files.write_counted(fx.enriched(spark, SF_SMALL), base, "wide",
                                     quality.count_measures() | quality.coverage_measures() | quality.range_measures())
    wide = spark.read.parquet(path)
    for report in (quality.enriched_coverage(wide), quality.time_range(wide)):
        taken = quality.seen_row(spark, seen, report)
        assert taken.schema.simpleString() == report.schema.simpleString() and taken.collect() == report.collect()
        assert taken.inputFiles() == []  # no second scan
    assert seen["row_count"] == wide.count() > 0
    empty = files.write_counted(fx.enriched(spark, SF_SMALL).where("false"), base, "none", quality.count_measures())[1]
    assert empty == {"row_count": 0}


def test_runner_checks_its_sources_first(spark, tmp_path):
    import pytest

    with pytest.raises(FileNotFoundError):
        runner.run(spark, str(tmp_path), str(tmp_path / "out"))


def test_require_paths_fails_early(spark):
    import pytest

    with pytest.raises(FileNotFoundError):
        require_paths(spark, ["/definitely/not/here"])


def test_views_and_listing(spark):
    register_views({"fx_postings_view": fx.postings_raw(spark, SF_SMALL)})
    names = {r.tableName for r in list_tables(spark).collect()}
    assert "fx_postings_view" in names


def test_streaming_landing_matches_batch(spark):
    src = fx.postings_raw(spark, SF_SMALL)
    landing = scratch_dir(spark, "t-stream-in")
    files.land_delimited(src, landing)
    out, ckpt = scratch_dir(spark, "t-stream-out"), scratch_dir(spark, "t-stream-ckpt")
    q = write_typed(stream_landed(spark, landing, src.columns), out, ckpt)
    q.awaitTermination(300)
    typed = spark.read.parquet(out)
    assert typed.count() == src.count()
    assert dict(typed.dtypes)["last_processed_time"] == "timestamp_ntz"
    # A second run over the same files adds nothing (checkpointed file log).
    q2 = write_typed(stream_landed(spark, landing, src.columns), out, ckpt)
    q2.awaitTermination(300)
    time.sleep(0.1)
    assert spark.read.parquet(out).count() == src.count()


def test_database_with_location_and_table_scan(spark):
    from demandlens.sources.catalog import ensure_database
    from demandlens.sources.files import save_table

    loc = scratch_dir(spark, "t-db")
    current = spark.catalog.currentDatabase()
    try:
        ensure_database(spark, "demandlens_t", loc)
        save_table(spark.range(5), "t_ids")
        save_table(spark.range(7), "t_ids")  # idempotent replace
        assert spark.table("demandlens_t.t_ids").count() == 7
        assert "t_ids" in {r.tableName for r in list_tables(spark, "demandlens_t").collect()}
    finally:
        spark.catalog.setCurrentDatabase(current)


def test_batch_job_clean_once_equals_per_table_cleaning(spark):
    from demandlens.plans import eda
    from demandlens.sources.files import write_table

    p = write_table(fx.enriched(spark, SF_SMALL), scratch_dir(spark, "t-eda"), "e")
    o1, o2 = scratch_dir(spark, "t-eda-a"), scratch_dir(spark, "t-eda-b")
    names = eda.build_all(spark, p, o1, materialize_clean=False)
    assert eda.build_all(spark, p, o2, materialize_clean=True) == names
    for n in names:
        a, b = spark.read.parquet(f"{o1}/{n}"), spark.read.parquet(f"{o2}/{n}")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, n
