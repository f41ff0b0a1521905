"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Stage 1 lands the enriched table (typed postings left-joined to skills and
summary, derived from the driver's tables) as Parquet, as the reference's
pipeline does, and writes the cleaned table once (as the batch job does);
the analytics queries run over the cleaned table, the ML-set queries over
the enriched one.
Every query is fully executed into Spark's ``noop`` sink (no collect).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from demandlens.operators import demand, metrics, quality, share  # noqa: E402
from demandlens.operators.explode import explode_list  # noqa: E402
from demandlens.plans import analytics, eda, io, ml, mlprep  # noqa: E402
from demandlens.session import build_session, scratch_dir  # noqa: E402
from demandlens.sources import fixtures as fx  # noqa: E402
from demandlens.sources.files import write_table  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def headline(spark, sf_dir: str, scratch: str) -> dict:
    """Name -> thunk; ``enrich`` then ``clean`` run first (the others read their output)."""
    enriched_path = f"{scratch}/enriched"
    state = {}

    def enrich():
        write_table(fx.enriched(spark, sf_dir), scratch, "enriched")
        state["enriched"] = spark.read.parquet(enriched_path)

    def clean():
        # The batch job's cleaned table: one normalisation pass for all tables.
        state["clean"] = spark.read.parquet(eda.write_clean(state["enriched"], scratch, "clean"))
        state["report"] = state["clean"]
        state["skills"] = explode_list(state["clean"], mark=demand.FIRST_MENTION)

    def q(build):
        return lambda: run(build())

    return {
        "enrich": enrich,
        "clean": clean,
        "top_positions_global": q(lambda: demand.top_positions_global(state["clean"])),
        "top_positions_by_country": q(lambda: demand.top_positions_by_country(state["clean"])),
        "top_skills_global": q(lambda: demand.top_skills_global(state["skills"])),
        "top_skills_by_country": q(lambda: demand.top_skills_by_country(state["skills"])),
        "skills_by_level": q(lambda: demand.skills_by_level(state["skills"])),
        "top_companies": q(lambda: demand.top_companies(state["clean"])),
        "demand_by_date": q(lambda: demand.demand_by_date(state["clean"])),
        "share_of_total": q(lambda: share.share_of_total(state["clean"], ["job_type"])),
        "null_coverage": q(lambda: quality.null_coverage(state["report"])),
        "data_characteristics": q(lambda: quality.data_characteristics(
            state["report"], state["enriched"].columns)),
        "group_features": q(lambda: mlprep.group_features(state["enriched"])),
        "ml_dataset": q(lambda: mlprep.labelled(mlprep.group_features(state["enriched"]))),
        "binary_metrics": q(lambda: metrics.binary_metrics(
            mlprep.voted(spark, sf_dir), "label", "prediction", "prob_ensemble")),
        "top_n_export": q(lambda: demand.top_n(demand.top_companies(state["clean"]),
                                               "posting_count", ["company"], 50)),
        "filtered_slice": q(lambda: analytics.dashboard_slice(state["clean"])),
        "scan_csv": q(lambda: io.q_scan_csv(spark, sf_dir)),
        "land_delimited": q(lambda: io.q_land_delimited(spark, sf_dir)),
        "scan_delimited": q(lambda: io.q_scan_delimited(spark, sf_dir)),
        "roundtrip_parquet": q(lambda: io.q_roundtrip_parquet(spark, sf_dir)),
        "scan_csv_split": q(lambda: io.q_scan_csv_split(spark, sf_dir)),
        "catalog_enrich": q(lambda: io.q_catalog_enrich(spark, sf_dir)),
        "train_nb": q(lambda: ml.q_train_nb(spark, sf_dir)),
        "train_svm": q(lambda: ml.q_train_svm(spark, sf_dir)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR",
                              os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    spark = build_session(f"local[{cpus}]", "demandlens-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g",
                                 "spark.sql.files.maxPartitionBytes": "64m"})
    # Warm-up (untimed): the whole set once on small tables (JIT, codegen caches).
    if os.path.isdir(warm_dir) and warm_dir.rstrip("/") != sf_dir.rstrip("/"):
        for fn in headline(spark, warm_dir, scratch_dir(spark, "bench-warm")).values():
            fn()

    times: dict[str, float] = {}
    for name, fn in headline(spark, sf_dir, scratch_dir(spark, "bench")).items():
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
