"""Posting-shaped inputs derived by Spark from the driver's tables.

The reference's own corpus is not available, so three source relations with
the reference's schemas are derived from the TPC-H-like tables:

* ``postings_raw``  - one row per order, every column a string as landed
  (zoned timestamp text, truthy flags, date text, blank / NULL / untrimmed
  values injected on purpose);
* ``skills_raw``    - one comma list of part names per order;
* ``summary_raw``   - one long text per document.

Everything is plain joins and aggregations, so the work grows with the data.  All
three are joined and grouped by the link itself, the key that the enrichment joins
on, so its joins need no exchange of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Column order of the landed postings and of the enriched table.
POSTING_COLUMNS = ("job_link", "last_processed_time", "got_summary", "got_ner", "is_being_worked", "job_title",
                   "company", "job_location", "first_seen", "search_city", "search_country", "search_position",
                   "job_level", "job_type")
ENRICHED_COLUMNS = (*POSTING_COLUMNS, "job_skills", "job_summary")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (filters and columns push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _link(c) -> F.Column:
    return F.concat(F.lit("job/"), c.cast("string"))


def postings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string postings relation (the reference's raw landed schema).

    An order's first part finds its names on its own narrow row, so that the wide
    orders move by customer and by link only.
    """
    o = read_table(spark, sf_dir, "orders").select(
        _link(F.col("o_orderkey")).alias("job_link"), "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    first_part = (read_table(spark, sf_dir, "lineitem")
                  .groupBy("l_orderkey").agg(F.min("l_partkey").alias("pk")))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    named_part = (first_part.join(p, p.p_partkey == first_part.pk, "left")
                  .select(_link(F.col("l_orderkey")).alias("job_link"), "p_name", "p_type"))
    d = read_table(spark, sf_dir, "documents").select(_link(F.col("doc_id")).alias("job_link"), "doc_id")

    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey)
         .join(named_part, "job_link", "left")
         .join(d, "job_link", "left"))
    status = F.col("o_orderstatus")
    return j.select(
        "job_link",
        F.concat(F.col("o_orderdate").cast("string"), F.lit("+00")).alias("last_processed_time"),
        F.when(F.col("doc_id").isNotNull(), "true").otherwise("false").alias("got_summary"),
        F.when(status == "F", "t").otherwise("f").alias("got_ner"),
        F.when(status == "P", "1").otherwise("0").alias("is_being_worked"),
        F.concat(F.lit(" "), F.upper("p_name"), F.lit("  "), F.col("p_type")).alias("job_title"),
        F.col("c_name").alias("company"),
        F.concat(F.col("n_name"), F.lit(", "), F.col("r_name")).alias("job_location"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("first_seen"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment"))
        .alias("search_city"),
        F.when(F.col("n_nationkey") == 24, "  ").otherwise(F.col("n_name")).alias("search_country"),
        F.col("p_name").alias("search_position"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("job_level"),
        F.when(status == "F", "Onsite").when(status == "O", " Hybrid").otherwise("REMOTE ")
        .alias("job_type"),
    )


def skills_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(job_link, job_skills)``: sorted part names of an order, comma separated.

    The source format is one list string per posting, so the aggregate holds
    one order's names (bounded by its line items).  The names are dealt out by
    link first: lists of a few names each take more to move than the names.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    names = F.expr("listagg(p_name, ', ') WITHIN GROUP (ORDER BY p_name)")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(_link(F.col("l_orderkey")).alias("job_link"), "p_name")
            .repartition("job_link")
            .groupBy("job_link")
            .agg(names.alias("job_skills")))


def summary_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(job_link, job_summary)``: one document text per posting key."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(_link(F.col("doc_id")).alias("job_link"), F.col("text").alias("job_summary"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed 16-column wide table: typed postings left-joined to skills and summary."""
    from demandlens.operators.enrich import enrich
    from demandlens.operators.typing import type_postings

    return enrich(type_postings(postings_raw(spark, sf_dir)),
                  skills_raw(spark, sf_dir), summary_raw(spark, sf_dir))


def scored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored table for the metric operators: a 0/1 label, two probability
    columns and a margin, derived from ``labels`` and ``documents``.  Scores
    repeat on purpose (ties)."""
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    return j.select(
        "doc_id",
        F.col("quality").alias("label"),
        ((F.col("n_chars") % 101).cast("double") / F.lit(100.0)).alias("p1"),
        (((F.col("doc_id") * 37) % 101).cast("double") / F.lit(100.0)).alias("p2"),
        ((((F.col("doc_id") * 53) % 41).cast("double") - F.lit(20.0)) / F.lit(10.0)).alias("margin"),
    )
