"""End-to-end run: land -> scan -> type -> enrich -> analytics -> ML set -> models -> scores.

    python -m demandlens.plans.runner --sf /root/testdata/sf0.01 --out <shared folder>

Each stage writes its output under ``--out`` and the next stage reads it back,
like the reference's staged jobs; every write is an overwrite, so a re-run
replaces the previous results.  Result tables of bounded size (metrics, grids,
importances, predictions, run summaries) are CSV folders under ``results``.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import SparkSession

from demandlens.ml import models as mdl
from demandlens.operators import quality
from demandlens.operators.enrich import enrich, join_coverage
from demandlens.operators.typing import type_postings
from demandlens.plans import eda, mlprep
from demandlens.plans.ml import Run
from demandlens.session import build_session
from demandlens.sources import files
from demandlens.sources import fixtures as fx
from demandlens.sources.catalog import require_paths

SOURCES = ("region", "nation", "customer", "part", "orders", "lineitem", "documents")


def run(spark: SparkSession, sf: str, out: str, train_models: bool = True,
        grids: Mapping[str, Mapping] | None = None) -> dict:
    """All stages; ``grids`` replaces the classifiers' whole grids by name."""
    out = out.rstrip("/")
    require_paths(spark, [f"{sf.rstrip('/')}/{name}.parquet" for name in SOURCES])
    raw = {"postings": fx.postings_raw(spark, sf), "skills": fx.skills_raw(spark, sf),
           "summary": fx.summary_raw(spark, sf)}
    # Stage 1: land the three sources as \001 text, read them back, store them typed.
    typed, seen = {}, {}
    for name, df in raw.items():
        files.land_delimited(df, f"{out}/raw/{name}")
        landed = files.scan_delimited(spark, f"{out}/raw/{name}", df.columns)
        shaped = type_postings(landed) if name == "postings" else landed
        path, seen[name] = files.write_counted(
            shaped, f"{out}/typed", name, quality.count_measures() | (quality.range_measures() if name == "postings" else {}))
        typed[name] = spark.read.parquet(path)
    enriched_path, seen["enriched"] = files.write_counted(
        enrich(typed["postings"], typed["skills"], typed["summary"]), f"{out}/enriched", "postings_enriched",
        quality.count_measures() | quality.coverage_measures())
    # Quality reports of the typed sources and the wide table, as TSV.
    wide = spark.read.parquet(enriched_path)
    files.write_report({
        # counted while the tables were written
        "table_counts": spark.createDataFrame([(n, int(v["row_count"])) for n, v in seen.items()],
                                              "table_name string, row_count long"),
        "distinct_keys": quality.distinct_keys(typed),
        "time_range": quality.seen_row(spark, seen["postings"], quality.time_range(typed["postings"])),
        "join_coverage": join_coverage(typed["postings"], "job_link",
                                       {"postings_with_skills": typed["skills"],
                                        "postings_with_summary": typed["summary"]}),
        "distributions": quality.value_distribution(typed["postings"], ["job_level", "job_type"]),
        "enriched_coverage": quality.seen_row(spark, seen["enriched"], quality.enriched_coverage(wide)),
    }, f"{out}/reports")
    # Stage 2: analytics tables and previews.
    tables = eda.build_all(spark, enriched_path, f"{out}/analytics", f"{out}/previews")
    # Stage 3: ML set and its reports, models, scores.
    grouped = spark.read.parquet(files.write_table(mlprep.group_features(wide), f"{out}/ml", "groups"))
    data = mlprep.labelled(grouped).withColumn(
        "split", mlprep.split_column(mlprep.GROUP_KEYS, mlprep.TRAIN_FRACTION, mlprep.SEED))
    training = Run(data, f"{out}/ml", grids)
    try:
        stored = spark.read.parquet(f"{out}/ml/dataset")
        reports = {"class_distribution": mlprep.class_distribution(stored), "prepare_summary": mlprep.prepare_summary(grouped)}
        if train_models:
            reports |= training.artefacts()
        for name, table in reports.items():
            files.write_csv(table.coalesce(1), f"{out}/results/{name}")  # reports of bounded size
    finally:
        training.close()
    return {"enriched": enriched_path, "tables": tables, "ml": f"{out}/ml/dataset", "results": sorted(reports),
            "models": list(mdl.MODEL_NAMES) if train_models else []}


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--no-models", action="store_true", help="stop after the ML set")
    args = ap.parse_args()
    spark = build_session()
    print(run(spark, args.sf, args.out, not args.no_models))
    spark.stop()


if __name__ == "__main__":
    main()
