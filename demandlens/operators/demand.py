"""Grouped demand tables: counts and distinct counts per key set.

All tables are one generic operator, ``counts_by``.  Spark plans the
``count(*)`` as a partial (map-side) plus final hash aggregate; distinct
measures go through Catalyst's distinct rewrite, whose first shuffle is on
``(keys, value)``, so a hot key is spread over its distinct values before the
final, already-reduced aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlens.functions.text import SENTINEL

#: Column of ``explode_list`` that marks an element's first place in its own list.
FIRST_MENTION = "first_mention"


def drop_sentinel(df: DataFrame, cols: Sequence[str], sentinel: str = SENTINEL) -> DataFrame:
    """``WHERE c1 <> 'unknown' AND c2 <> 'unknown'`` (NULLs drop as in SQL)."""
    for c in cols:
        df = df.where(F.col(c) != F.lit(sentinel))
    return df


def counts_by(df: DataFrame, keys: Sequence, count_name: str = "posting_count",
              distinct: Mapping[str, str] | None = None, exclude: Sequence[str] = (),
              sentinel: str = SENTINEL, approx: bool = False,
              prededupe: bool = False, extra: Sequence = ()) -> DataFrame:
    """``GROUP BY keys`` with ``COUNT(*)`` and ``COUNT(DISTINCT col)`` measures.

    ``keys`` may hold names or ``(alias, Column)`` pairs (e.g. ``to_date``).
    ``exclude`` names the columns whose sentinel rows are filtered first; the
    distinct measures still count the sentinel as a value of other columns.
    ``extra`` adds further aggregates to the same pass.
    ``approx=True`` switches distinct counts to HyperLogLog++ (opt-in).
    ``prededupe=True`` first counts rows per (keys, distinct columns) and then
    sums those counts and counts distinct values over the smaller frame (same
    result; pays off only when that combination repeats a lot).
    """
    src = drop_sentinel(df, exclude, sentinel)
    group_cols = [F.col(k) if isinstance(k, str) else k[1].alias(k[0]) for k in keys]
    if prededupe and distinct and not approx and not extra:
        names = [k if isinstance(k, str) else k[0] for k in keys]
        cols = list(dict.fromkeys(distinct.values()))
        level1 = src.groupBy(*group_cols, *[F.col(c) for c in cols]).agg(
            F.count(F.lit(1)).alias("__m"))
        return level1.groupBy(*names).agg(
            F.sum("__m").alias(count_name),
            *[F.count_distinct(F.col(c)).alias(n) for n, c in distinct.items()])
    measures = [F.count(F.lit(1)).alias(count_name)]
    for name, col in (distinct or {}).items():
        fn = F.approx_count_distinct if approx else F.count_distinct
        measures.append(fn(F.col(col)).alias(name))
    return src.groupBy(*group_cols).agg(*measures, *extra)


def top_positions_global(clean: DataFrame) -> DataFrame:
    """Position; postings, distinct companies, distinct countries."""
    return counts_by(clean, ["search_position"],
                     distinct={"company_count": "company", "country_count": "search_country"},
                     exclude=["search_position"])


def top_positions_by_country(clean: DataFrame) -> DataFrame:
    """(country, position); postings, distinct companies.  Also the country x
    position matrix, which the reference computes twice under two names."""
    return counts_by(clean, ["search_country", "search_position"],
                     distinct={"company_count": "company"},
                     exclude=["search_country", "search_position"])


def has_unique_keys(df: DataFrame, key: str = "job_link") -> bool:
    """Whether no key occurs twice (NULL keys aside): one narrow shuffle of the key column."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.isEmpty()


def skill_counts(exploded: DataFrame, keys: Sequence[str], distinct: Mapping[str, str] | None = None,
                 exclude: Sequence[str] = ()) -> DataFrame:
    """Mentions and distinct postings per key set of the exploded lists.

    With the mark of ``explode_list(..., mark=FIRST_MENTION)`` the distinct postings
    are the sum of marked rows: one exchange of already summed rows.  Marks are for
    postings whose keys don't repeat; without them distinct keys are counted.
    """
    if FIRST_MENTION not in exploded.columns:
        return counts_by(exploded, keys, count_name="skill_mentions",
                         distinct={"posting_count": "job_link", **(distinct or {})}, exclude=exclude)
    postings = F.count_if(F.col(FIRST_MENTION) & F.col("job_link").isNotNull()).alias("posting_count")
    out = counts_by(exploded, keys, count_name="skill_mentions", distinct=distinct, exclude=exclude, extra=[postings])
    return out.select(*keys, "skill_mentions", "posting_count", *(distinct or {}))


def top_skills_global(exploded: DataFrame) -> DataFrame:
    """Skill; mentions, distinct postings, distinct countries (sentinel counted)."""
    return skill_counts(exploded, ["skill"], {"country_count": "search_country"})


def top_skills_by_country(exploded: DataFrame) -> DataFrame:
    """(country, skill); mentions, distinct postings; country not sentinel."""
    return skill_counts(exploded, ["search_country", "skill"], exclude=["search_country"])


def skills_by_level(exploded: DataFrame) -> DataFrame:
    """(level, skill); mentions, distinct postings; level not sentinel."""
    return skill_counts(exploded, ["job_level", "skill"], exclude=["job_level"])


def matrix_columns(cells: DataFrame, column_key: str, measure: str, top: int) -> DataFrame:
    """(column key, place): the ``top`` values by the measure's sum over all cells (ties by value), numbered from 1."""
    best = cells.groupBy(column_key).agg(F.sum(measure).alias("n")).orderBy(F.desc("n"), column_key).limit(top)
    # ``top`` rows at most come here, so one task may number them
    return best.select(column_key, F.row_number().over(Window.orderBy(F.desc("n"), column_key)).alias("place"))


def wide_matrix(cells: DataFrame, row_key: str, column_key: str, measure: str, top: int, prefix: str) -> DataFrame:
    """A heatmap's wide form of long (row, column) cells, of bounded width whatever the data.

    Columns ``<prefix>_1`` to ``<prefix>_<top>`` hold the measure for the column
    values of the greatest totals (``matrix_columns`` says which), ``other`` the sum
    over all remaining ones, ``total`` the sum of the row.  Missing cells are 0.
    """
    ranked = cells.join(F.broadcast(matrix_columns(cells, column_key, measure, top)), column_key, "left")
    value, place = F.col(measure), F.col("place")
    columns = [F.coalesce(F.sum(F.when(place == k, value)), F.lit(0)).alias(f"{prefix}_{k}") for k in range(1, top + 1)]
    rest = F.coalesce(F.sum(F.when(place.isNull(), value)), F.lit(0)).alias("other")
    return ranked.groupBy(row_key).agg(*columns, rest, F.sum(value).alias("total"))


def level_by_country(clean: DataFrame) -> DataFrame:
    """(country, level); postings; country not sentinel, sentinel level kept."""
    return counts_by(clean, ["search_country", "job_level"], exclude=["search_country"])


def top_companies(clean: DataFrame) -> DataFrame:
    """Company; postings, distinct countries, distinct positions."""
    return counts_by(clean, ["company"],
                     distinct={"country_count": "search_country",
                               "position_count": "search_position"},
                     exclude=["company"])


def demand_by_date(clean: DataFrame, date_col: str = "first_seen") -> DataFrame:
    """(date, country, position); postings; date not NULL, no sentinels."""
    src = clean.where(F.col(date_col).isNotNull())
    return counts_by(src, [("first_seen_date", F.to_date(F.col(date_col))),
                           "search_country", "search_position"],
                     exclude=["search_country", "search_position"])


def demand_by_country(clean: DataFrame) -> DataFrame:
    """Country; postings, distinct positions, distinct companies."""
    return counts_by(clean, ["search_country"],
                     distinct={"position_count": "search_position", "company_count": "company"},
                     exclude=["search_country"])


def top_n(df: DataFrame, measure: str, keys: Sequence[str], n: int | None = None) -> DataFrame:
    """``ORDER BY measure DESC, keys`` (+ ``LIMIT n``): a total order, so ties
    are deterministic; with a limit Spark plans ``TakeOrderedAndProject``
    (a per-partition top-n, then a merge of n rows per partition)."""
    out = df.orderBy(F.col(measure).desc(), *[F.col(k).asc_nulls_first() for k in keys])
    return out.limit(n) if n is not None else out
