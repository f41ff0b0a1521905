"""Named query plans over a data folder: one function per registered query.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the driver's tables through the posting-shaped fixtures.  The shared
stages (typed -> enriched -> clean -> exploded) are plain functions; the
batch job (``plans.eda.build_all``) runs the same operators over the written
enriched Parquet table, where each table reads only its own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.functions.text import normalized_text, nullable_text
from demandlens.operators import demand, quality, share
from demandlens.operators.clean import apply_filters, clean_jobs
from demandlens.operators.enrich import join_coverage
from demandlens.operators.explode import explode_list
from demandlens.operators.typing import type_postings
from demandlens.sources import fixtures as fx


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return fx.enriched(spark, sf)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_jobs(enriched(spark, sf))


def exploded(spark: SparkSession, sf: str) -> DataFrame:
    return explode_list(clean(spark, sf))


def marked_skills(spark: SparkSession, sf: str) -> DataFrame:
    """Exploded lists with first mentions marked: the order key is the postings' primary key."""
    return explode_list(clean(spark, sf), mark=demand.FIRST_MENTION)


# --- typing, cleaning, explode, join -------------------------------------------------------

def q_type_postings(spark, sf):
    return type_postings(fx.postings_raw(spark, sf))


def q_enrich(spark, sf):
    return enriched(spark, sf)


def q_clean_jobs(spark, sf):
    return clean(spark, sf)


def q_clean_text(spark, sf):
    """The three normalisers side by side, incl. the blank-after-clean option."""
    e = enriched(spark, sf)
    return e.select(
        "job_link",
        normalized_text("job_title").alias("job_title_clean"),
        normalized_text("search_city").alias("search_city_clean"),
        normalized_text("search_country", blank_after_clean=True).alias("search_country_strict"),
        nullable_text("job_skills", lower=True).alias("job_skills_clean"),
        nullable_text("job_summary", lower=False).alias("job_summary_clean"),
    )


def q_explode_list(spark, sf):
    return exploded(spark, sf)


def dashboard_slice(clean_table: DataFrame) -> DataFrame:
    """Dashboard filters (country list, type list, first-seen range), then the
    country x position table.  Plain comparisons on stored columns: all three
    are pushed into the scan of a stored clean table."""
    sliced = apply_filters(clean_table, search_country=["nation_1", "nation_2", "nation_3", "nation_24"],
                           job_type=["onsite", "hybrid"],
                           first_seen=("1996-01-01", "1998-12-31"))
    return demand.top_positions_by_country(sliced)


def q_filtered_slice(spark, sf):
    """The dashboard slice of the stored clean table."""
    from demandlens.plans.eda import write_clean
    from demandlens.session import scratch_dir

    return dashboard_slice(spark.read.parquet(write_clean(enriched(spark, sf), scratch_dir(spark, "slice"))))


# --- demand tables ---------------------------------------------------------------------------

def q_top_positions_global(spark, sf):
    return demand.top_positions_global(clean(spark, sf))


def q_top_positions_by_country(spark, sf):
    return demand.top_positions_by_country(clean(spark, sf))


def q_top_skills_global(spark, sf):
    return demand.top_skills_global(marked_skills(spark, sf))


def q_top_skills_by_country(spark, sf):
    return demand.top_skills_by_country(marked_skills(spark, sf))


def q_skills_by_level(spark, sf):
    return demand.skills_by_level(marked_skills(spark, sf))


def q_country_skill_matrix(spark, sf):
    """Country x skill mentions in wide form: the ten skills mentioned most, the others summed."""
    cells = demand.top_skills_by_country(marked_skills(spark, sf))
    return demand.wide_matrix(cells, "search_country", "skill", "skill_mentions", 10, "skill")


def q_country_position_matrix(spark, sf):
    """Country x position postings in wide form: the ten positions with the most postings, the others summed."""
    cells = demand.top_positions_by_country(clean(spark, sf))
    return demand.wide_matrix(cells, "search_country", "search_position", "posting_count", 10, "position")


def q_level_by_country(spark, sf):
    return demand.level_by_country(clean(spark, sf))


def q_top_companies(spark, sf):
    return demand.top_companies(clean(spark, sf))


def q_demand_by_date(spark, sf):
    return demand.demand_by_date(clean(spark, sf))


def q_demand_by_country(spark, sf):
    return demand.demand_by_country(clean(spark, sf))


def q_share_of_total(spark, sf):
    return share.share_of_total(clean(spark, sf), ["job_type"])


# --- quality ---------------------------------------------------------------------------------

def report_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Clean frame for coverage reports: nullable texts only tested for NULL."""
    return clean_jobs(enriched(spark, sf), nullable="presence")


def q_data_characteristics(spark, sf):
    e = enriched(spark, sf)
    return quality.data_characteristics(clean_jobs(e, nullable="presence"), feature_names=e.columns)


def q_data_characteristics_wide(spark, sf):
    return quality.data_characteristics_wide(report_clean(spark, sf))


def q_null_coverage(spark, sf):
    return quality.null_coverage(report_clean(spark, sf))


def q_qc_distribution(spark, sf):
    return quality.value_distribution(fx.postings_raw(spark, sf), ["job_level", "job_type"])


def _sources(spark, sf):
    return {"postings": fx.postings_raw(spark, sf), "skills": fx.skills_raw(spark, sf),
            "summary": fx.summary_raw(spark, sf)}


def q_table_counts(spark, sf):
    tables = _sources(spark, sf)
    tables["enriched"] = enriched(spark, sf)
    return quality.table_counts(tables)


def q_qc_distinct_keys(spark, sf):
    return quality.distinct_keys(_sources(spark, sf))


def q_qc_time_range(spark, sf):
    return quality.time_range(type_postings(fx.postings_raw(spark, sf)))


def q_qc_join_coverage(spark, sf):
    s = _sources(spark, sf)
    return join_coverage(s["postings"], "job_link",
                         {"postings_with_skills": s["skills"], "postings_with_summary": s["summary"]})


def q_enriched_coverage(spark, sf):
    return quality.enriched_coverage(enriched(spark, sf))


QUERIES = {
    "type_postings": q_type_postings,
    "enrich": q_enrich,
    "clean_jobs": q_clean_jobs,
    "clean_text": q_clean_text,
    "explode_list": q_explode_list,
    "filtered_slice": q_filtered_slice,
    "top_positions_global": q_top_positions_global,
    "top_positions_by_country": q_top_positions_by_country,
    "top_skills_global": q_top_skills_global,
    "top_skills_by_country": q_top_skills_by_country,
    "skills_by_level": q_skills_by_level,
    "country_skill_matrix": q_country_skill_matrix,
    "country_position_matrix": q_country_position_matrix,
    "level_by_country": q_level_by_country,
    "top_companies": q_top_companies,
    "demand_by_date": q_demand_by_date,
    "demand_by_country": q_demand_by_country,
    "share_of_total": q_share_of_total,
    "data_characteristics": q_data_characteristics,
    "data_characteristics_wide": q_data_characteristics_wide,
    "null_coverage": q_null_coverage,
    "qc_distribution": q_qc_distribution,
    "table_counts": q_table_counts,
    "qc_distinct_keys": q_qc_distinct_keys,
    "qc_time_range": q_qc_time_range,
    "qc_join_coverage": q_qc_join_coverage,
    "enriched_coverage": q_enriched_coverage,
}


