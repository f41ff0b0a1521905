"""Delimited list -> one row per element (a narrow Generate, no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKILL_CONTEXT = ("job_link", "first_seen", "search_country", "search_position", "job_level",
                 "job_type", "company")


def explode_list(df: DataFrame, list_col: str = "job_skills", out_col: str = "skill",
                 keep: Sequence[str] = SKILL_CONTEXT, sep: str = ",",
                 lower: bool = False, mark: str | None = None) -> DataFrame:
    """Split ``list_col`` on ``sep`` and emit one row per element.

    NULL lists give no rows; elements are trimmed (and lower-cased if asked);
    empty elements are dropped; duplicates inside one list are kept.
    ``sep`` is a literal, not a pattern.

    ``mark`` names a boolean column that is true for an element's first place in
    its own list.  Where each list belongs to another key, the distinct keys of
    any grouping by the element and the row's other columns are the marked rows:
    a sum inside the row's task instead of a distinct count over all rows.
    """
    cols = [c for c in keep if c in df.columns]
    parts = F.split(F.coalesce(F.col(list_col), F.lit("")), literal(sep))
    if mark is None:
        exploded = df.select(*cols, F.explode(parts).alias("__item")).select(*cols, _item("__item", lower).alias(out_col))
    else:
        items = F.transform(parts, lambda x: _item(x, lower))
        exploded = (df.select(*cols, items.alias("__items"))
                    .select(*cols, "__items", F.posexplode("__items").alias("__place", out_col))
                    .select(*cols, out_col, (F.array_position("__items", F.col(out_col)) == F.col("__place") + 1).alias(mark)))
    return exploded.where(F.col(out_col) != F.lit(""))


def literal(sep: str) -> str:
    """The pattern that matches ``sep`` itself.

    A single sign is escaped by a backslash: that form is split without a pattern,
    while a quoted one is compiled anew for every row.
    """
    return f"\\{sep}" if len(sep) == 1 and sep.isascii() and not sep.isalnum() else f"\\Q{sep}\\E"


def _item(value: Column | str, lower: bool) -> Column:
    return F.trim(F.lower(value)) if lower else F.trim(value)
