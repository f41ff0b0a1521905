"""File and JDBC sources and sinks.

* CSV (RFC 4180: header, ``"`` quote, quote doubled as escape, embedded
  newlines).  NULL is an unquoted empty field and ``''`` a quoted one, as in a
  database COPY; both stay apart on the way back in.
* ``\\001``-delimited landing text with ``\\N`` for NULL, delimiters and line
  breaks scrubbed from values (the bulk-import layout), and its reader.
* Parquet tables, ordered CSV previews / top-n exports, JDBC reads.

Writers run as Spark jobs (one file per task); nothing passes the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demandlens.sources import csv_split, versions

# Fixed values of the landing format.
FIELD_SEP = "\u0001"
NULL_MARK = "\\N"
SCRUB = "[\\n\\r\\u0001]"
EMPTY_MARK = "\u0000<empty>\u0000"


def _csv_options(sep: str) -> dict:
    return {"header": True, "sep": sep, "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """CSV with header; NULL -> unquoted empty, ``''`` -> ``""``; spaces kept."""
    df.write.mode(mode).options(**_csv_options(sep)).csv(path)


def scan_csv(spark: SparkSession, path: str, schema, columns: Sequence[str] | None = None,
             sep: str = ",", multi_line: bool = True, split: bool = False) -> DataFrame:
    """RFC-4180 CSV scan with an explicit schema.

    ``multi_line`` allows line breaks inside quoted fields, and then a file is
    one task however large it is, unless ``split`` is set: then many tasks read
    each file (``csv_split``), with the same rows.  Without ``multi_line`` Spark
    splits each file at line ends.

    A quoted empty field reads as a marker first and is mapped back to
    ``''``, so it stays distinct from NULL.  ``columns`` selects a subset
    (pruned at the scan).
    """
    options = {**_csv_options(sep), "emptyValue": EMPTY_MARK}
    if multi_line and split:
        df = csv_split.parse_records(csv_split.records(spark, path), schema, options)
    else:
        df = (spark.read.options(**options).option("multiLine", multi_line).option("mode", "FAILFAST")
              .schema(schema).csv(path))
    exprs = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        if f.dataType.simpleString() == "string":
            exprs.append(F.when(F.col(f.name) == F.lit(EMPTY_MARK), F.lit(""))
                         .otherwise(F.col(f.name)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def delimited_line(df: DataFrame, sep: str = FIELD_SEP, null: str = NULL_MARK) -> DataFrame:
    """One ``value`` line per row: scrubbed fields, NULL marker, joined by ``sep``."""
    fields = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), SCRUB, ""), F.lit(null))
              for c in df.columns]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def land_delimited(df: DataFrame, path: str, sep: str = FIELD_SEP, null: str = NULL_MARK,
                   mode: str = "overwrite") -> None:
    """Write the landing text layout (one record per line)."""
    delimited_line(df, sep, null).write.mode(mode).text(path)


def scan_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = FIELD_SEP,
                   null: str = NULL_MARK) -> DataFrame:
    """All-string scan of landed text: split with limit -1 (trailing empty
    fields kept), ``\\N`` -> NULL, ``''`` stays ``''``."""
    return parse_delimited(spark.read.text(path), columns, sep, null)


def parse_delimited(lines: DataFrame, columns: Sequence[str], sep: str = FIELD_SEP,
                    null: str = NULL_MARK) -> DataFrame:
    """``value`` lines -> named string columns (batch or streaming input)."""
    parts = F.split(F.col("value"), "\\Q" + sep + "\\E", -1)  # literal, not a pattern
    raw = lines.select(parts.alias("__f"))
    return raw.select(*[F.nullif(F.get(F.col("__f"), i), F.lit(null)).alias(c)
                        for i, c in enumerate(columns)])


def write_report(reports: Mapping[str, DataFrame], base_path: str, sep: str = "\t",
                 mode: str = "overwrite") -> list[str]:
    """Several result sets as TSV with header, NULL written as an empty field."""
    paths = []
    for name, df in reports.items():
        path = f"{base_path.rstrip('/')}/{name}"
        df.write.mode(mode).option("header", True).option("sep", sep).option("nullValue", "") \
            .option("emptyValue", "").csv(path)
        paths.append(path)
    return paths


def line_counts(spark: SparkSession, paths: Mapping[str, str],
                count_name: str = "line_count") -> DataFrame:
    """``(table_name, line_count)`` of landed folders (all part files)."""
    out = None
    for name, path in paths.items():
        part = spark.read.text(path).agg(F.count(F.lit(1)).alias(count_name)) \
            .select(F.lit(name).alias("table_name"), count_name)
        out = part if out is None else out.unionByName(part)
    return out


def write_table(df: DataFrame, base_path: str, name: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """Named Parquet table (Snappy) at ``base/name``; returns the path."""
    path = f"{base_path.rstrip('/')}/{name}"
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_counted(df: DataFrame, base_path: str, name: str, metrics: Mapping[str, Column],
                  partition_by: Sequence[str] = ()) -> tuple[str, dict]:
    """``write_table`` that also takes aggregates while the rows go by; returns path and values.

    ``metrics`` are non-distinct aggregates (counts, ranges, class counts).  They come
    from the writing tasks, so no report reads the table again.
    """
    seen = Observation(f"write-{name}")
    path = write_table(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), base_path, name, partition_by=partition_by)
    return path, seen.get


def replace_table(df: DataFrame, base_path: str, name: str, partition_by: Sequence[str] = (), keep: int = 1) -> str:
    """A new version of the Parquet table ``base/name``; returns the version's folder.

    The former version stays readable until the new one is complete and published
    (``versions``), so ``df`` may read it.  ``current_table`` reads the last one.
    """
    spark = df.sparkSession
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    path = versions.publish(spark, base_path, name, writer.parquet)
    versions.drop_old(spark, base_path, name, keep)
    return path


def current_table(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    """The version of ``base/name`` that was published last."""
    path = versions.current(spark, base_path, name)
    if path is None:
        raise FileNotFoundError(f"no table {base_path.rstrip('/')}/{name} was published")
    return spark.read.parquet(path)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Catalog table dealt into ``buckets`` by a hash of ``key`` and sorted by it inside each.

    Tables bucketed alike are joined and grouped on the key without an exchange (Spark
    sorts a bucket again unless told to trust the order of its files).
    Rows are dealt before the write, so each bucket is one file.
    """
    w = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """Catalog table stored as Parquet (optionally at an explicit location)."""
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def preview_topn(df: DataFrame, order: Sequence, n: int, path: str, sep: str = ",") -> None:
    """First ``n`` rows in a total order, written as one CSV file.

    ``ORDER BY .. LIMIT n`` is a per-partition top-n plus a merge of n rows
    per partition, so only n rows reach the single writing task.
    """
    write_csv(df.orderBy(*order).limit(n).coalesce(1), path, sep)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, predicates: Sequence[str] | None = None) -> DataFrame:
    """Bulk JDBC read, in parallel if it is told how to split the table.

    ``column`` with bounds runs ``num_partitions`` range queries over a numeric
    or date column.  ``predicates`` runs one query per condition and so also
    splits on a text key; ``key_ranges`` makes them from sorted key samples.
    """
    props = dict(properties or {})
    if predicates is not None and column is not None:
        raise ValueError("give either a column with bounds or predicates")
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if column is not None:
        return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions or 1, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def key_ranges(column: str, bounds: Sequence[str]) -> list[str]:
    """Conditions that split a text key at ``bounds``: disjoint, and together all rows (NULL keys too)."""
    cuts = ["'" + b.replace("'", "''") + "'" for b in sorted(set(bounds))]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "overwrite") -> None:
    """JDBC writer (one connection per task)."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))
