"""Cleaning dialects.

* ``clean_jobs``  - analytics dialect: eight text columns normalised with the
  ``unknown`` sentinel, skills lower-cased and nullable, summary nullable
  with its case kept.  Names are kept (no ``_clean`` suffix).
* ``clean_keys``  - ML dialect: rows with a NULL key are dropped, keys become
  ``trim(lower(x))`` without whitespace collapsing (``''`` stays a group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.text import SENTINEL, is_blank, key_text, normalized_text, nullable_text

SENTINEL_COLUMNS = ("job_title", "company", "job_location", "search_city", "search_country",
                    "search_position", "job_level", "job_type")
LOWER_NULLABLE = ("job_skills",)
CASED_NULLABLE = ("job_summary",)


def clean_text(df: DataFrame, sentinel_cols: Sequence[str] = (), lower_nullable: Sequence[str] = (),
               cased_nullable: Sequence[str] = (), sentinel: str = SENTINEL,
               blank_after_clean: bool = False, presence: Sequence[str] = ()) -> DataFrame:
    """Normalise the named columns in one projection; others pass through.

    Nullable columns listed in ``presence`` only get the blank -> NULL rule
    (values stay raw).  NULL-ness is exactly that of the cleaned value, so
    consumers that only test NULL-ness skip the regex over long texts.
    """
    exprs = []
    for name in df.columns:
        if name in sentinel_cols:
            exprs.append(normalized_text(name, sentinel, True, blank_after_clean).alias(name))
        elif (name in lower_nullable or name in cased_nullable) and name in presence:
            exprs.append(F.when(is_blank(name), F.lit(None).cast("string"))
                         .otherwise(F.col(name)).alias(name))
        elif name in lower_nullable:
            exprs.append(nullable_text(name, lower=True).alias(name))
        elif name in cased_nullable:
            exprs.append(nullable_text(name, lower=False).alias(name))
        else:
            exprs.append(F.col(name))
    return df.select(*exprs)


def clean_jobs(enriched: DataFrame, sentinel: str = SENTINEL,
               blank_after_clean: bool = False, nullable: str = "clean") -> DataFrame:
    """The clean analytics base frame over the enriched posting table.

    ``nullable="presence"`` leaves the nullable texts raw but for blank -> NULL:
    coverage reports only test them for NULL, and so skip the regex over long
    texts.  What is written as the clean table uses the full normalisation.
    """
    present = set(enriched.columns)
    presence = {"clean": (), "presence": LOWER_NULLABLE + CASED_NULLABLE}[nullable]
    return clean_text(
        enriched,
        [c for c in SENTINEL_COLUMNS if c in present],
        [c for c in LOWER_NULLABLE if c in present],
        [c for c in CASED_NULLABLE if c in present],
        sentinel, blank_after_clean, presence)


def clean_keys(df: DataFrame, keys: Sequence[str] = ("search_country", "search_position")) -> DataFrame:
    """ML dialect: drop rows with a NULL key, then ``trim(lower(key))``."""
    return df.dropna(subset=list(keys)).withColumns({k: key_text(k) for k in keys})


def apply_filters(df: DataFrame, **conditions) -> DataFrame:
    """Dashboard filter set: ``col=value`` (equality), ``col=[a, b]`` (IN) or
    ``col=(lo, hi)`` (inclusive range, either end may be None).

    Plain comparisons on source columns, so Catalyst pushes them to the scan.
    """
    out = df
    for name, cond in conditions.items():
        c = F.col(name)
        if isinstance(cond, tuple):
            lo, hi = cond
            if lo is not None:
                out = out.where(c >= F.lit(lo))
            if hi is not None:
                out = out.where(c <= F.lit(hi))
        elif isinstance(cond, list):
            out = out.where(c.isin(*cond))
        else:
            out = out.where(c == F.lit(cond))
    return out
