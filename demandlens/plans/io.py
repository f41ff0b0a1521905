"""Source and sink queries: write with the library's writers, read back.

Each query writes into a fresh folder under the cluster's shared checkpoint
location (``spark.checkpoint.dir``), reads the result back with the matching
reader and returns the rows read, so the oracle is a plain SELECT on the
source tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from demandlens.operators import demand, quality, share
from demandlens.operators.enrich import enrich
from demandlens.operators.explode import explode_list
from demandlens.operators.typing import type_postings
from demandlens.plans.analytics import clean, enriched, report_clean
from demandlens.session import scratch_dir, write_once
from demandlens.sources import catalog, files
from demandlens.sources import fixtures as fx


def _all_strings(columns):
    return StructType([StructField(c, StringType(), True) for c in columns])


def raw_wide(spark, sf):
    """The three landed sources joined as strings (the CSV export's shape)."""
    p, s, m = fx.postings_raw(spark, sf), fx.skills_raw(spark, sf), fx.summary_raw(spark, sf)
    return p.join(s, "job_link", "left").join(m, "job_link", "left")


def q_scan_csv(spark, sf):
    src = raw_wide(spark, sf)
    path = scratch_dir(spark, "csv")
    files.write_csv(src, path)
    return files.scan_csv(spark, path, _all_strings(src.columns))


def q_land_delimited(spark, sf):
    path = scratch_dir(spark, "landed")
    files.land_delimited(raw_wide(spark, sf), path)
    return spark.read.text(path)


def q_scan_delimited(spark, sf):
    src = fx.postings_raw(spark, sf)
    path = scratch_dir(spark, "landed")
    files.land_delimited(src, path)
    return files.scan_delimited(spark, path, src.columns)


def q_landed_line_counts(spark, sf):
    paths = {}
    for name, df in (("postings", fx.postings_raw(spark, sf)), ("skills", fx.skills_raw(spark, sf)),
                     ("summary", fx.summary_raw(spark, sf))):
        paths[name] = scratch_dir(spark, f"landed-{name}")
        files.land_delimited(df, paths[name])
    return files.line_counts(spark, paths)


def q_roundtrip_parquet(spark, sf):
    """The enrichment written once, then replaced by a version written from the stored one."""
    base = scratch_dir(spark, "tables")
    files.replace_table(enriched(spark, sf), base, "postings_enriched")
    files.replace_table(files.current_table(spark, base, "postings_enriched"), base, "postings_enriched")
    return files.current_table(spark, base, "postings_enriched")


def q_scan_csv_split(spark, sf):
    """The CSV export read by many tasks a file, line breaks inside quotes included."""
    src = raw_wide(spark, sf)
    path = scratch_dir(spark, "csv")
    files.write_csv(src, path)
    return files.scan_csv(spark, path, _all_strings(src.columns), split=True)


#: Buckets of the stored source tables; a cluster passes a few times its cores.
BUCKETS = 8


def stored_sources(spark, sf, database, buckets=BUCKETS):
    """The three typed sources as catalog tables of ``database``, bucketed and sorted by the posting key."""
    folder = scratch_dir(spark, database)
    before = spark.catalog.currentDatabase()
    catalog.ensure_database(spark, database, folder)
    sources = {"postings": type_postings(fx.postings_raw(spark, sf)), "skills": fx.skills_raw(spark, sf),
               "summary": fx.summary_raw(spark, sf)}
    for name, df in sources.items():
        # an own folder for each call: a former call's readers keep their files
        files.save_bucketed(df, f"{database}.{name}", "job_link", buckets, f"{folder}/{name}")
    spark.catalog.setCurrentDatabase(before)
    return {name: f"{database}.{name}" for name in sources}


def q_catalog_enrich(spark, sf):
    """The enrichment of bucketed catalog tables, read by name and joined without an exchange."""
    names = stored_sources(spark, sf, "demandlens_sources")
    return enrich(*[spark.table(names[n]) for n in ("postings", "skills", "summary")])


def q_catalog_tables(spark, sf):
    """What the catalog lists: the stored tables and the views over them, with the rows that each name reads."""
    names = stored_sources(spark, sf, "demandlens_listing")
    catalog.register_views({"listing_postings": spark.table(names["postings"]).select("job_link"),
                            "listing_skills": explode_list(spark.table(names["skills"]), keep=["job_link"])})
    listed = catalog.list_tables(spark, "demandlens_listing").where(
        "namespace = 'demandlens_listing' OR tableName LIKE 'listing\\_%'")
    counts = None
    for name in (*names.values(), "listing_postings", "listing_skills"):
        part = spark.table(name).agg(F.count("*").alias("row_count")).select(
            F.lit(name.split(".")[-1]).alias("table_name"), "row_count")
        counts = part if counts is None else counts.unionByName(part)
    return listed.select(F.col("tableName").alias("table_name"), F.col("isTemporary").alias("is_view")).join(counts, "table_name")


def q_report_roundtrip(spark, sf):
    """The null coverage report as its TSV file holds it."""
    report = quality.null_coverage(report_clean(spark, sf))
    path = files.write_report({"null_coverage": report}, scratch_dir(spark, "report"))[0]
    return spark.read.csv(path, schema=report.schema, sep="\t", header=True)


_MATRIX_SCHEMA = "search_country string, skill string, skill_mentions bigint, posting_count bigint"


def skill_mentions(clean_postings):
    """Exploded lists by country for the skill tables.

    The postings' columns that these read are written once.  If no posting key
    repeats there, first mentions are marked, so that a task sums them instead of
    holding every (posting, skill) that it meets; else distinct keys are counted.
    """
    stored = write_once(clean_postings.select("job_link", "search_country", "job_skills"), "skill-lists")
    return explode_list(stored, mark=demand.FIRST_MENTION if demand.has_unique_keys(stored) else None)


def q_preview_topn(spark, sf):
    """First 50 rows of the skill x country matrix in key order, as CSV."""
    path = scratch_dir(spark, "preview")
    m = demand.top_skills_by_country(skill_mentions(clean(spark, sf)))
    files.preview_topn(m, [F.col("search_country"), F.col("skill")], 50, path)
    return files.scan_csv(spark, path, _MATRIX_SCHEMA)


def _export(spark, df, measure, key, schema):
    path = scratch_dir(spark, "export")
    files.preview_topn(df, [F.col(measure).desc(), F.col(key)], 50, path)
    return files.scan_csv(spark, path, schema)


def q_export_top_positions(spark, sf):
    return _export(spark, demand.top_positions_global(clean(spark, sf)), "posting_count",
                   "search_position", "search_position string, posting_count bigint, "
                   "company_count bigint, country_count bigint")


def q_export_top_skills(spark, sf):
    return _export(spark, demand.top_skills_global(skill_mentions(clean(spark, sf))), "skill_mentions", "skill",
                   "skill string, skill_mentions bigint, posting_count bigint, country_count bigint")


def q_export_top_companies(spark, sf):
    return _export(spark, demand.top_companies(clean(spark, sf)), "posting_count", "company",
                   "company string, posting_count bigint, country_count bigint, position_count bigint")


def q_export_type_shares(spark, sf):
    return _export(spark, share.share_of_total(clean(spark, sf), ["job_type"]), "posting_count", "job_type",
                   "job_type string, posting_count bigint, posting_pct double")


def q_export_characteristics(spark, sf):
    """The one-row profile as the CSV export writes it."""
    path = scratch_dir(spark, "export")
    profile = quality.data_characteristics_wide(report_clean(spark, sf))
    files.write_csv(profile.coalesce(1), path)
    return files.scan_csv(spark, path, profile.schema)


QUERIES = {
    "export_type_shares": q_export_type_shares,
    "export_characteristics": q_export_characteristics,
    "scan_csv": q_scan_csv,
    "scan_csv_split": q_scan_csv_split,
    "catalog_enrich": q_catalog_enrich,
    "catalog_tables": q_catalog_tables,
    "report_roundtrip": q_report_roundtrip,
    "land_delimited": q_land_delimited,
    "scan_delimited": q_scan_delimited,
    "landed_line_counts": q_landed_line_counts,
    "roundtrip_parquet": q_roundtrip_parquet,
    "preview_topn": q_preview_topn,
    "export_top_positions": q_export_top_positions,
    "export_top_skills": q_export_top_skills,
    "export_top_companies": q_export_top_companies,
}
