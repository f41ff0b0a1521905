"""Incremental landing: new ``\\001`` text files -> typed Parquet.

The same parse and typing as the batch scan (``files.parse_delimited`` and
``typing.type_postings``), over a file-source stream.  The checkpoint keeps
the set of files already processed, so a restarted or re-run job picks up
only new files and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from demandlens.operators.typing import type_postings
from demandlens.sources.files import FIELD_SEP, NULL_MARK, parse_delimited


def stream_landed(spark: SparkSession, landing_dir: str, columns: Sequence[str],
                  typer: Callable[[DataFrame], DataFrame] = type_postings,
                  sep: str = FIELD_SEP, null: str = NULL_MARK,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of typed rows from text files landing in ``landing_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typer(parse_delimited(reader.load(landing_dir), columns, sep, null))


def write_typed(stream: DataFrame, out_path: str, checkpoint: str,
                once: bool = True) -> StreamingQuery:
    """Append to a Parquet table; ``once=True`` processes what is there and stops."""
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start(out_path)
