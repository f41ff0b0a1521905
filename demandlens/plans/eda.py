"""Batch job: every analytics table from the enriched Parquet table.

The enriched table is written once (the reference's CTAS) and, by default,
the cleaned table too (one pass of the text normalisation instead of one per
table); every table is then its own job over that columnar table, so each
reads only the columns it needs (e.g. the long summary text is read only by
the coverage reports).  Nothing is cached in memory, which would not fit at
scale anyway.  Previews are ordered top-n CSV files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.operators import demand, quality, share
from demandlens.operators.clean import clean_jobs
from demandlens.operators.explode import explode_list
from demandlens.sources import files
from demandlens.sources.catalog import register_views


def analytics_tables(enriched: DataFrame, clean: DataFrame | None = None,
                     feature_names=None) -> dict[str, Callable[[], DataFrame]]:
    """Table name -> lazy builder over the enriched table (or over the clean and
    exploded views, when the clean table was written)."""
    feature_names = feature_names or enriched.columns
    if clean is None:
        clean = clean_jobs(enriched)
        report = clean_jobs(enriched, nullable="presence")  # NULL tests only
        skills = explode_list(clean)  # distinct postings are counted
    else:
        report = clean
        skills = clean.sparkSession.table(EXPLODED_VIEW)
    return {
        "data_characteristics": lambda: quality.data_characteristics(report, feature_names),
        "null_coverage": lambda: quality.null_coverage(report),
        "top_positions_global": lambda: demand.top_positions_global(clean),
        "top_positions_by_country": lambda: demand.top_positions_by_country(clean),
        "top_skills_global": lambda: demand.top_skills_global(skills),
        "top_skills_by_country": lambda: demand.top_skills_by_country(skills),
        "skills_by_job_level": lambda: demand.skills_by_level(skills),
        "job_type_distribution": lambda: share.share_of_total(clean, ["job_type"]),
        "job_level_distribution": lambda: demand.level_by_country(clean),
        "top_companies": lambda: demand.top_companies(clean),
        "demand_by_date": lambda: demand.demand_by_date(clean),
        "demand_by_country": lambda: demand.demand_by_country(clean),
        "data_characteristics_wide": lambda: quality.data_characteristics_wide(report),
    }


# Preview order per table: (measure, key) for ranked tables, keys otherwise.
_PREVIEW_ORDER = {
    "top_positions_global": ("posting_count", "search_position"),
    "top_skills_global": ("skill_mentions", "skill"),
    "top_companies": ("posting_count", "company"),
    "demand_by_country": ("posting_count", "search_country"),
    "job_type_distribution": ("posting_count", "job_type"),
}


CLEAN_VIEW, EXPLODED_VIEW = "clean_postings", "exploded_skills"


def write_clean(enriched: DataFrame, base: str, name: str = "_clean_postings") -> str:
    """The clean frame as a Parquet table, clustered for the dashboard filters.

    Rows are sorted inside each task by country and date, so the row groups'
    statistics let a filtered read skip most of the table.
    """
    clustered = clean_jobs(enriched).sortWithinPartitions("search_country", "first_seen")
    return files.write_table(clustered, base, name)


def build_all(spark: SparkSession, enriched_path: str, out_base: str,
              preview_base: str | None = None, preview_rows: int = 50,
              materialize_clean: bool = True) -> list[str]:
    """Write every table as Parquet under ``out_base`` (and ordered CSV
    previews under ``preview_base``); returns the table names.

    ``materialize_clean=True`` writes the cleaned table once (one pass of
    the text normalisation) and builds every table from it; each table still
    reads only its own columns.  The clean and the exploded frame are registered
    as views, which the tables read.
    """
    enriched = spark.read.parquet(enriched_path)
    clean = None
    if materialize_clean:
        stored = spark.read.parquet(write_clean(enriched, out_base))
        # repeated posting keys are counted as such; otherwise marked first mentions are summed
        mark = demand.FIRST_MENTION if demand.has_unique_keys(stored) else None
        register_views({CLEAN_VIEW: stored, EXPLODED_VIEW: explode_list(stored, mark=mark)})
        clean = spark.table(CLEAN_VIEW)
    names = []
    for name, build in analytics_tables(enriched, clean, enriched.columns).items():
        df = build()
        files.write_table(df, out_base, name)
        if preview_base:
            table = spark.read.parquet(f"{out_base.rstrip('/')}/{name}")
            if name in _PREVIEW_ORDER:
                measure, key = _PREVIEW_ORDER[name]
                order = [F.col(measure).desc(), F.col(key)]
            else:
                order = [F.col(c) for c in table.columns]
            files.preview_topn(table, order, preview_rows, f"{preview_base.rstrip('/')}/{name}")
        names.append(name)
    return names
