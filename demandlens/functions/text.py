"""Column expressions for text normalisation and typing (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
SENTINEL = "unknown"
TRUTHY = ("true", "t", "1")
ZONE_SUFFIX = r"\+00$"
WHITESPACE_RUN = r"\s+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """NULL or only spaces (``trim`` strips spaces only, like Hive)."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def collapse_ws(c) -> Column:
    """Every whitespace run becomes one space, then the ends are trimmed."""
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_RUN, " "))


def normalized_text(c, sentinel: str = SENTINEL, lower: bool = True,
                    blank_after_clean: bool = False) -> Column:
    """NULL/blank -> sentinel, else ``lower(trim(collapse(x)))``.

    A value made only of tabs is not blank before cleaning and is ``''``
    after it; that is the reference's result.  ``blank_after_clean=True``
    maps such values to the sentinel as well.
    """
    c = _col(c)
    cleaned = collapse_ws(c)
    if lower:
        cleaned = F.lower(cleaned)
    cond = is_blank(c)
    if blank_after_clean:
        cond = cond | (cleaned == F.lit(""))
    return F.when(cond, F.lit(sentinel)).otherwise(cleaned)


def nullable_text(c, lower: bool = True) -> Column:
    """NULL/blank -> NULL, else the collapsed text (lower-cased if asked)."""
    c = _col(c)
    cleaned = collapse_ws(c)
    if lower:
        cleaned = F.lower(cleaned)
    return F.when(is_blank(c), F.lit(None).cast("string")).otherwise(cleaned)


def key_text(c) -> Column:
    """Group-key form used by the ML dialect: ``trim(lower(x))``, no collapse."""
    return F.trim(F.lower(_col(c)))


def truthy_flag(c, truthy=TRUTHY) -> Column:
    """String flag -> 1/0; NULL and anything not truthy -> 0."""
    return F.when(F.lower(_col(c)).isin(*truthy), F.lit(1)).otherwise(F.lit(0))


def zoned_timestamp(c, suffix: str = ZONE_SUFFIX) -> Column:
    """``'2024-01-19 09:45:09.2+00'`` -> zone-less timestamp; bad input -> NULL."""
    return F.regexp_replace(_col(c), suffix, "").try_cast("timestamp_ntz")


def safe_date(c) -> Column:
    """String/timestamp -> date; bad input -> NULL (Hive cast semantics)."""
    return _col(c).try_cast("date")
