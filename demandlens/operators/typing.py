"""Typing of all-string landed tables (the reference's CTAS to Parquet)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.functions.text import safe_date, truthy_flag, zoned_timestamp

POSTING_TIMESTAMPS = ("last_processed_time",)
POSTING_FLAGS = ("got_summary", "got_ner", "is_being_worked")
POSTING_DATES = ("first_seen",)


def type_columns(df: DataFrame, timestamps: Sequence[str] = (), flags: Sequence[str] = (),
                 dates: Sequence[str] = ()) -> DataFrame:
    """One projection: zoned text -> TIMESTAMP_NTZ, truthy text -> INT 0/1, text -> DATE.

    Column order is kept; other columns pass through unchanged.  Bad values
    become NULL instead of failing the job (Hive cast semantics under ANSI).
    """
    exprs = []
    for name in df.columns:
        if name in timestamps:
            exprs.append(zoned_timestamp(name).alias(name))
        elif name in flags:
            exprs.append(truthy_flag(name).alias(name))
        elif name in dates:
            exprs.append(safe_date(name).alias(name))
        else:
            exprs.append(F.col(name))
    return df.select(*exprs)


def type_postings(raw: DataFrame) -> DataFrame:
    """The postings CTAS: timestamp, three 0/1 flags, ``first_seen`` date."""
    return type_columns(raw, POSTING_TIMESTAMPS, POSTING_FLAGS, POSTING_DATES)
