"""DuckDB twins of the registered queries (the correctness oracle).

Every statement runs on DuckDB with the driver's tables registered as
views.  A common prefix of CTEs rebuilds the posting-shaped fixtures, the
typed and enriched tables, the clean frame and the exploded skills exactly
as the Spark side defines them; each query appends its own SELECT.
Dialect notes: ``regexp_replace(.., 'g')`` replaces every match,
``string_split``/``unnest`` stand for ``split``/``explode``, and
``quantile_disc`` equals ``percentile_approx`` on these group sizes.
"""

from __future__ import annotations

from demandlens.sources.fixtures import ENRICHED_COLUMNS


def _norm(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'unknown' "
            f"ELSE lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))) END AS {c}")


def _nullable(c: str, lower: bool) -> str:
    inner = f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
    if lower:
        inner = f"lower({inner})"
    return f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN NULL ELSE {inner} END AS {c}"


_FLAG = "CASE WHEN lower({c}) IN ('true', 't', '1') THEN 1 ELSE 0 END AS {c}"

PREFIX = f"""
WITH fx_postings AS (
  SELECT concat('job/', cast(o.o_orderkey AS varchar)) AS job_link,
    concat(cast(o.o_orderdate AS varchar), '+00') AS last_processed_time,
    CASE WHEN d.doc_id IS NOT NULL THEN 'true' ELSE 'false' END AS got_summary,
    CASE WHEN o.o_orderstatus = 'F' THEN 't' ELSE 'f' END AS got_ner,
    CASE WHEN o.o_orderstatus = 'P' THEN '1' ELSE '0' END AS is_being_worked,
    CASE WHEN p.p_name IS NULL OR p.p_type IS NULL THEN NULL
         ELSE concat(' ', upper(p.p_name), '  ', p.p_type) END AS job_title,
    c.c_name AS company,
    concat(n.n_name, ', ', r.r_name) AS job_location,
    substr(cast(o.o_orderdate AS varchar), 1, 10) AS first_seen,
    CASE WHEN c.c_mktsegment = 'MACHINERY' THEN '' ELSE c.c_mktsegment END AS search_city,
    CASE WHEN n.n_nationkey = 24 THEN '  ' ELSE n.n_name END AS search_country,
    p.p_name AS search_position,
    CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o.o_orderpriority END AS job_level,
    CASE o.o_orderstatus WHEN 'F' THEN 'Onsite' WHEN 'O' THEN ' Hybrid' ELSE 'REMOTE ' END AS job_type
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM lineitem GROUP BY l_orderkey) l
    ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON p.p_partkey = l.pk
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey
),
fx_skills AS (
  SELECT concat('job/', cast(l_orderkey AS varchar)) AS job_link,
    string_agg(p_name, ', ' ORDER BY p_name) AS job_skills
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
),
fx_summary AS (
  SELECT concat('job/', cast(doc_id AS varchar)) AS job_link, text AS job_summary FROM documents
),
fx_typed AS (
  SELECT job_link,
    try_cast(regexp_replace(last_processed_time, '\\+00$', '') AS timestamp) AS last_processed_time,
    {_FLAG.format(c='got_summary')}, {_FLAG.format(c='got_ner')}, {_FLAG.format(c='is_being_worked')},
    job_title, company, job_location, try_cast(first_seen AS date) AS first_seen,
    search_city, search_country, search_position, job_level, job_type
  FROM fx_postings
),
fx_enriched AS (
  SELECT p.*, s.job_skills, m.job_summary FROM fx_typed p
  LEFT JOIN fx_skills s ON p.job_link = s.job_link
  LEFT JOIN fx_summary m ON p.job_link = m.job_link
),
fx_clean AS (
  SELECT job_link, last_processed_time, got_summary, got_ner, is_being_worked,
    {_norm('job_title')}, {_norm('company')}, {_norm('job_location')}, first_seen,
    {_norm('search_city')}, {_norm('search_country')}, {_norm('search_position')},
    {_norm('job_level')}, {_norm('job_type')},
    {_nullable('job_skills', True)}, {_nullable('job_summary', False)}
  FROM fx_enriched
),
fx_exploded AS (
  SELECT job_link, first_seen, search_country, search_position, job_level, job_type, company,
    trim(raw_skill) AS skill
  FROM (SELECT *, unnest(string_split(coalesce(job_skills, ''), ',')) AS raw_skill FROM fx_clean) x
  WHERE trim(raw_skill) <> ''
)
"""

_PCT = "cast(round(100.0 * cast({a} AS double) / cast({b} AS double), 2) AS double)"



def _profile(known_only: bool) -> dict[str, str]:
    """DuckDB expression of each profile measure."""
    out = {"total_rows": "count(*)"}
    for name, column in (("countries", "search_country"), ("positions", "search_position"), ("companies", "company")):
        known = f" FILTER (WHERE {column} <> 'unknown')" if known_only else ""
        out[f"distinct_{name}"] = f"count(DISTINCT {column}){known}"
    for name in ("skills", "summary"):
        out[f"rows_with_{name}"] = f"count(job_{name})"
    for bound in ("min", "max"):
        out[f"{bound}_first_seen"] = f"{bound}(first_seen)"
    return out


BODIES: dict[str, str] = {
    "type_postings": "SELECT * FROM fx_typed",
    "enrich": "SELECT * FROM fx_enriched",
    "clean_jobs": "SELECT * FROM fx_clean",
    "clean_text": f"""
SELECT job_link,
  {_norm('job_title').replace(' AS job_title', ' AS job_title_clean')},
  {_norm('search_city').replace(' AS search_city', ' AS search_city_clean')},
  CASE WHEN search_country IS NULL OR trim(search_country) = ''
         OR lower(trim(regexp_replace(search_country, '\\s+', ' ', 'g'))) = '' THEN 'unknown'
       ELSE lower(trim(regexp_replace(search_country, '\\s+', ' ', 'g'))) END AS search_country_strict,
  {_nullable('job_skills', True).replace(' AS job_skills', ' AS job_skills_clean')},
  {_nullable('job_summary', False).replace(' AS job_summary', ' AS job_summary_clean')}
FROM fx_enriched""",
    "explode_list": "SELECT * FROM fx_exploded",
    "filtered_slice": """
SELECT search_country, search_position, count(*) AS posting_count,
  count(DISTINCT company) AS company_count
FROM fx_clean
WHERE search_country IN ('nation_1', 'nation_2', 'nation_3', 'nation_24')
  AND job_type IN ('onsite', 'hybrid')
  AND first_seen >= DATE '1996-01-01' AND first_seen <= DATE '1998-12-31'
  AND search_country <> 'unknown' AND search_position <> 'unknown'
GROUP BY search_country, search_position""",
    "top_positions_global": """
SELECT search_position, count(*) AS posting_count, count(DISTINCT company) AS company_count,
  count(DISTINCT search_country) AS country_count
FROM fx_clean WHERE search_position <> 'unknown' GROUP BY search_position""",
    "top_positions_by_country": """
SELECT search_country, search_position, count(*) AS posting_count,
  count(DISTINCT company) AS company_count
FROM fx_clean WHERE search_country <> 'unknown' AND search_position <> 'unknown'
GROUP BY search_country, search_position""",
    "top_skills_global": """
SELECT skill, count(*) AS skill_mentions, count(DISTINCT job_link) AS posting_count,
  count(DISTINCT search_country) AS country_count
FROM fx_exploded GROUP BY skill""",
    "top_skills_by_country": """
SELECT search_country, skill, count(*) AS skill_mentions, count(DISTINCT job_link) AS posting_count
FROM fx_exploded WHERE search_country <> 'unknown' GROUP BY search_country, skill""",
    "skills_by_level": """
SELECT job_level, skill, count(*) AS skill_mentions, count(DISTINCT job_link) AS posting_count
FROM fx_exploded WHERE job_level <> 'unknown' GROUP BY job_level, skill""",
    "level_by_country": """
SELECT search_country, job_level, count(*) AS posting_count
FROM fx_clean WHERE search_country <> 'unknown' GROUP BY search_country, job_level""",
    "top_companies": """
SELECT company, count(*) AS posting_count, count(DISTINCT search_country) AS country_count,
  count(DISTINCT search_position) AS position_count
FROM fx_clean WHERE company <> 'unknown' GROUP BY company""",
    "demand_by_date": """
SELECT cast(first_seen AS date) AS first_seen_date, search_country, search_position,
  count(*) AS posting_count
FROM fx_clean
WHERE first_seen IS NOT NULL AND search_country <> 'unknown' AND search_position <> 'unknown'
GROUP BY cast(first_seen AS date), search_country, search_position""",
    "demand_by_country": """
SELECT search_country, count(*) AS posting_count, count(DISTINCT search_position) AS position_count,
  count(DISTINCT company) AS company_count
FROM fx_clean WHERE search_country <> 'unknown' GROUP BY search_country""",
    "share_of_total": f"""
SELECT job_type, posting_count,
  {_PCT.format(a='posting_count', b='sum(posting_count) OVER ()')} AS posting_pct
FROM (SELECT job_type, count(*) AS posting_count FROM fx_clean GROUP BY job_type) t""",
    "data_characteristics": f"""
, measured AS (
  SELECT {", ".join(f"cast({e} AS varchar) AS {n}" for n, e in _profile(known_only=True).items())} FROM fx_clean),
described AS (SELECT *, '{len(ENRICHED_COLUMNS)}' AS feature_count,
                     '{",".join(ENRICHED_COLUMNS)}' AS feature_names FROM measured)
UNPIVOT described ON COLUMNS(*) INTO NAME metric_name VALUE metric_value""",
    "data_characteristics_wide": "SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in _profile(known_only=False).items()) + " FROM fx_clean",
    "null_coverage": "\n".join(
        [", agg AS (SELECT count(*) AS total_rows,"]
        + [f"  count(*) FILTER (WHERE {c} = 'unknown' OR {c} IS NULL) AS m_{c},"
           for c in ("job_title", "company", "search_country", "search_position", "job_level",
                     "job_type")]
        + ["  count(*) FILTER (WHERE job_skills IS NULL) AS m_job_skills,",
           "  count(*) FILTER (WHERE job_summary IS NULL) AS m_job_summary FROM fx_clean)"]
        + ["\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, total_rows, m_{c} AS missing_rows, "
            + _PCT.format(a=f"m_{c}", b="total_rows") + " AS missing_pct FROM agg"
            for c in ("job_title", "company", "search_country", "search_position", "job_level",
                      "job_type", "job_skills", "job_summary"))]),
    "qc_distribution": """
SELECT 'job_level' AS column_name, job_level AS value, count(*) AS cnt FROM fx_postings GROUP BY job_level
UNION ALL
SELECT 'job_type' AS column_name, job_type AS value, count(*) AS cnt FROM fx_postings GROUP BY job_type""",
    "table_counts": """
SELECT 'postings' AS table_name, count(*) AS row_count FROM fx_postings
UNION ALL SELECT 'skills', count(*) FROM fx_skills
UNION ALL SELECT 'summary', count(*) FROM fx_summary
UNION ALL SELECT 'enriched', count(*) FROM fx_enriched""",
    "qc_distinct_keys": """
SELECT 'postings' AS table_name, count(DISTINCT job_link) AS distinct_job_links FROM fx_postings
UNION ALL SELECT 'skills', count(DISTINCT job_link) FROM fx_skills
UNION ALL SELECT 'summary', count(DISTINCT job_link) FROM fx_summary""",
    "qc_time_range": """
SELECT min(first_seen) AS min_first_seen, max(first_seen) AS max_first_seen,
  min(last_processed_time) AS min_last_processed_time,
  max(last_processed_time) AS max_last_processed_time
FROM fx_typed""",
    "qc_join_coverage": """
SELECT count(*) AS postings_total, count(s.job_link) AS postings_with_skills,
  count(sm.job_link) AS postings_with_summary
FROM fx_postings p
LEFT JOIN fx_skills s ON p.job_link = s.job_link
LEFT JOIN fx_summary sm ON p.job_link = sm.job_link""",
    "enriched_coverage": """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE job_skills IS NOT NULL) AS rows_with_skills,
  count(*) FILTER (WHERE job_summary IS NOT NULL) AS rows_with_summary
FROM fx_enriched""",
}


BODIES["report_roundtrip"] = BODIES["null_coverage"]


def _matrix_sql(source: str, row: str, column: str, where: str, prefix: str, top: int = 10) -> str:
    """A wide matrix: counts of the ``top`` column values with the most rows, and of all others."""
    cells = "".join(f", count(*) FILTER (place = {k}) AS {prefix}_{k}" for k in range(1, top + 1))
    return f"""
, cells AS (SELECT {row}, {column} FROM {source} WHERE {where}),
ranks AS (
  SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) AS place FROM cells GROUP BY {column}
  QUALIFY place <= {top})
SELECT {row}{cells}, count(*) FILTER (place IS NULL) AS other, count(*) AS total
FROM cells LEFT JOIN ranks USING ({column}) GROUP BY {row}"""


BODIES["country_skill_matrix"] = _matrix_sql("fx_exploded", "search_country", "skill", "search_country <> 'unknown'", "skill")
BODIES["country_position_matrix"] = _matrix_sql(
    "fx_clean", "search_country", "search_position", "search_country <> 'unknown' AND search_position <> 'unknown'", "position")


def oracle_sql() -> dict[str, str]:
    """Full statements: the shared CTE prefix plus each query's body."""
    # A body that starts with "," adds its own CTEs after the shared ones.
    return {key: PREFIX + body.strip() for key, body in BODIES.items()}


# --- ML set and metric oracles --------------------------------------------------------------

_DRAW = ("cast('0x' || substr(md5(concat_ws('|', search_country, search_position, '42')), 1, 15) AS bigint)")
_IS_TRAIN = f"{_DRAW} < cast(round(0.7::double * 1152921504606846976::double) AS bigint)"

ML_CTES = f"""
, fx_keys AS (
  SELECT * REPLACE (trim(lower(search_country)) AS search_country,
                    trim(lower(search_position)) AS search_position)
  FROM fx_enriched WHERE search_country IS NOT NULL AND search_position IS NOT NULL
),
fx_base AS (
  SELECT search_country, search_position, count(*) AS group_count,
    count(DISTINCT company) AS distinct_companies, count(DISTINCT job_level) AS distinct_job_levels,
    count(DISTINCT job_type) AS distinct_job_types,
    avg(CASE WHEN got_summary = 1 THEN 1.0::double ELSE 0.0::double END) AS summary_coverage
  FROM fx_keys GROUP BY search_country, search_position
),
fx_group_skills AS (
  SELECT search_country, search_position, count(DISTINCT skill) AS distinct_skills
  FROM (SELECT search_country, search_position,
          trim(lower(unnest(string_split(job_skills, ',')))) AS skill
        FROM fx_keys WHERE job_skills IS NOT NULL) x
  WHERE skill <> '' GROUP BY search_country, search_position
),
fx_groups AS (
  SELECT b.*, coalesce(s.distinct_skills, 0) AS distinct_skills
  FROM fx_base b LEFT JOIN fx_group_skills s
    ON b.search_country = s.search_country AND b.search_position = s.search_position
),
fx_ratios AS (
  SELECT *, cast(distinct_skills AS double) / greatest(cast(group_count AS double), 1.0) AS skills_per_posting,
    cast(distinct_companies AS double) / greatest(cast(group_count AS double), 1.0) AS companies_per_posting
  FROM fx_groups WHERE group_count >= 5
),
fx_thr AS (
  SELECT search_position, quantile_disc(group_count, 0.75) AS thr FROM fx_ratios GROUP BY search_position
),
fx_labelled AS (
  SELECT r.search_country, r.search_position, r.group_count, r.distinct_companies,
    r.distinct_job_levels, r.distinct_job_types, r.summary_coverage, r.distinct_skills,
    r.skills_per_posting, r.companies_per_posting,
    CASE WHEN r.group_count > t.thr THEN 1 ELSE 0 END AS high_demand
  FROM fx_ratios r LEFT JOIN fx_thr t ON r.search_position = t.search_position
),
fx_dataset AS (
  SELECT *, CASE WHEN {_IS_TRAIN} THEN 'train' ELSE 'test' END AS split FROM fx_labelled
),
fx_test AS (SELECT * EXCLUDE (split) FROM fx_dataset WHERE split = 'test'),
fx_scored AS (
  SELECT l.doc_id, l.quality AS label,
    cast(d.n_chars % 101 AS double) / 100.0::double AS p1,
    cast((l.doc_id * 37) % 101 AS double) / 100.0::double AS p2,
    (cast((l.doc_id * 53) % 41 AS double) - 20.0::double) / 10.0::double AS margin
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
),
fx_voted AS (
  SELECT *, CASE WHEN prob_ensemble >= 0.5 THEN 1.0::double ELSE 0.0::double END AS prediction
  FROM (SELECT *, (p1 + p2 + prob_margin) / 3.0::double AS prob_ensemble
        FROM (SELECT *, 1.0::double / (1.0::double + exp(-margin)) AS prob_margin FROM fx_scored) a) b
),
fx_conf AS (SELECT label, prediction, count(*) AS n FROM fx_voted GROUP BY label, prediction),
fx_classes AS (
  SELECT class, sum(actual) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
    SELECT cast(label AS double) AS class, n AS actual, 0 AS predicted,
      CASE WHEN cast(label AS double) = prediction THEN n ELSE 0 END AS tp FROM fx_conf
    UNION ALL
    SELECT prediction AS class, 0, n, 0 FROM fx_conf) u
  GROUP BY class
),
fx_per_class AS (
  SELECT class, cast(support AS bigint) AS support, cast(predicted AS bigint) AS predicted,
    cast(tp AS bigint) AS tp,
    CASE WHEN predicted = 0 THEN 0.0 ELSE tp / cast(predicted AS double) END AS precision,
    CASE WHEN support = 0 THEN 0.0 ELSE tp / cast(support AS double) END AS recall
  FROM fx_classes
),
fx_per_class_f1 AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM fx_per_class
),
fx_curve AS (
  SELECT score, pos, neg,
    sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM (SELECT prob_ensemble AS score, count(*) FILTER (WHERE label = 1) AS pos,
          count(*) FILTER (WHERE label <> 1) AS neg FROM fx_voted GROUP BY prob_ensemble) s
)
"""

_MEDIANS = ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in (
    "summary_coverage", "distinct_job_levels", "distinct_job_types", "skills_per_posting",
    "companies_per_posting", "distinct_companies", "distinct_skills", "group_count"))

ML_BODIES: dict[str, str] = {
    "group_features": "SELECT * FROM fx_groups",
    "ratio_features": "SELECT * FROM fx_ratios",
    "quantile_label": "SELECT * FROM fx_labelled",
    "hash_split": f"""
SELECT search_country, search_position, {_DRAW} AS draw,
  CASE WHEN {_IS_TRAIN} THEN 'train' ELSE 'test' END AS split FROM fx_groups""",
    "ml_dataset": "SELECT * FROM fx_dataset",
    "class_distribution": 'SELECT high_demand, split, count(*) AS "count" FROM fx_dataset GROUP BY high_demand, split',
    "prepare_summary": f"""
SELECT 'country_position' AS aggregation, 5 AS min_postings_per_group, 0.75::double AS high_demand_quantile,
  count(*) AS rows_before_filter,
  count(*) FILTER (WHERE group_count >= 5) AS rows_after_filter,
  count(*) FILTER (WHERE group_count >= 5 AND {_IS_TRAIN}) AS train_rows,
  count(*) FILTER (WHERE group_count >= 5 AND NOT ({_IS_TRAIN})) AS test_rows,
  42 AS split_seed
FROM fx_groups""",
    "sample_n": """
SELECT * FROM fx_test
ORDER BY md5(concat_ws('|', search_country, search_position, '42')), search_country, search_position
LIMIT 20""",
    "median_profile": f"SELECT {_MEDIANS} FROM fx_test",
    "whatif_rows": f"""
, med AS (SELECT {_MEDIANS} FROM fx_test),
scen(search_country, search_position) AS (VALUES ('nation_1', 'red plate'), ('nation_5', 'new gear'),
  ('nation_12', 'hot gear'), ('atlantis', 'blue bolt'))
SELECT *, 'held_out' AS source FROM (
  SELECT * FROM fx_test
  ORDER BY md5(concat_ws('|', search_country, search_position, '42')), search_country, search_position
  LIMIT 20) h
UNION ALL
SELECT s.search_country, s.search_position, m.group_count, m.distinct_companies, m.distinct_job_levels,
  m.distinct_job_types, m.summary_coverage, m.distinct_skills, m.skills_per_posting,
  m.companies_per_posting, 0 AS high_demand, 'crafted' AS source
FROM scen s, med m""",
    "sigmoid_score": "SELECT *, round(1.0::double / (1.0::double + exp(-margin)), 6) AS prob_margin FROM fx_scored",
    "soft_vote": "SELECT doc_id, label, round(prob_ensemble, 6) AS prob_ensemble, prediction FROM fx_voted",
    "confusion": 'SELECT label, prediction, count(*) AS "count" FROM fx_voted GROUP BY label, prediction',
    "per_class_metrics": "SELECT class, support, predicted, tp, precision, recall, f1 FROM fx_per_class_f1",
    "binary_metrics": """
SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(auc_roc, 6) AS auc_roc,
  round(auc_pr, 6) AS auc_pr FROM (
SELECT (SELECT sum(tp) / cast(sum(support) AS double) FROM fx_per_class_f1) AS accuracy,
  (SELECT sum(f1 * support) / cast(sum(support) AS double) FROM fx_per_class_f1) AS f1,
  sum(neg * ((tp - pos) + tp) / 2.0) / (cast(sum(pos) AS double) * sum(neg)) AS auc_roc,
  sum(pos * (tp / cast(tp + fp AS double)
             + CASE WHEN (tp - pos) + (fp - neg) = 0 THEN tp / cast(tp + fp AS double)
                    ELSE (tp - pos) / cast((tp - pos) + (fp - neg) AS double) END) / 2.0)
    / cast(sum(pos) AS double) AS auc_pr
FROM fx_curve) m""",
    "threshold_sweep": """
, thr AS (SELECT cast(k AS double) / 20.0::double AS threshold FROM range(1, 20) t(k)),
sw AS (
  SELECT t.threshold,
    count(*) FILTER (WHERE v.label = 1 AND v.prob_ensemble >= t.threshold) AS tp,
    count(*) FILTER (WHERE v.label <> 1 AND v.prob_ensemble >= t.threshold) AS fp,
    count(*) FILTER (WHERE v.label = 1 AND v.prob_ensemble < t.threshold) AS fn,
    count(*) FILTER (WHERE v.label <> 1 AND v.prob_ensemble < t.threshold) AS tn
  FROM thr t, fx_voted v GROUP BY t.threshold
),
pr AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / cast(tp + fp AS double) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / cast(tp + fn AS double) END AS recall FROM sw
),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                     ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr)
SELECT *, row_number() OVER (ORDER BY f1 DESC, threshold ASC) = 1 AS is_best FROM f""",
}

# --- features and models --------------------------------------------------------------------

_NUMERIC = ("summary_coverage", "distinct_job_levels", "distinct_job_types", "skills_per_posting",
            "companies_per_posting")
_CATEGORICAL = ("search_country", "search_position")

# Each key's values get codes by falling count, then alphabetically; the next code is the unseen one.
FEATURE_CTES = """
, fx_train AS (SELECT * EXCLUDE (split) FROM fx_dataset WHERE split = 'train')""" + "".join(f"""
, code_{c} AS (
  SELECT v, n, row_number() OVER (ORDER BY n DESC, v) - 1 AS code
  FROM (SELECT coalesce(nullif({c}, ''), '(blank)') AS v, count(*) AS n FROM fx_train GROUP BY 1) x)"""
                                                                                          for c in _CATEGORICAL) + """
, fx_base_slots AS (
  SELECT 5 AS country, 5 + (SELECT count(*) FROM code_search_country) + 1 AS position,
    5 + (SELECT count(*) FROM code_search_country) + 1 + (SELECT count(*) FROM code_search_position) + 1 AS slots,
    (SELECT count(*) FROM fx_train)::double AS n)
"""


def _one_hot(key: str, base: str) -> str:
    deviation = "sqrt((c.n - c.n * c.n / b.n) / (b.n - 1))"
    return f"""
SELECT t.search_country, t.search_position,
  cast(b.{base} + coalesce(c.code, (SELECT count(*) FROM code_{key})) AS int) AS slot, 1.0::double AS raw_value,
  round(coalesce(CASE WHEN {deviation} = 0 THEN 0 ELSE 1 / {deviation} END, 0), 6)::double AS scaled_value
FROM fx_test t CROSS JOIN fx_base_slots b
LEFT JOIN code_{key} c ON c.v = coalesce(nullif(t.{key}, ''), '(blank)')"""


FEATURE_BODIES: dict[str, str] = {
    "encode_features": "\nUNION ALL\n".join(
        [f"""
SELECT search_country, search_position, {i} AS slot, round({c}::double, 6) AS raw_value,
  round(coalesce({c} / nullif((SELECT stddev_samp({c}::double) FROM fx_train), 0), 0), 6) AS scaled_value
FROM fx_test""" for i, c in enumerate(_NUMERIC)]
        + [_one_hot("search_country", "country"), _one_hot("search_position", "position")]),
    "nb_parameters": """
, sums AS (""" + "\nUNION ALL\n".join(
        [f"  SELECT high_demand AS label, {i} AS slot, sum({c}::double) AS s FROM fx_train GROUP BY 1"
         for i, c in enumerate(_NUMERIC)]
        + [f"""  SELECT high_demand, cast(b.{base} + c.code AS int), count(*)::double FROM fx_train t
  CROSS JOIN fx_base_slots b JOIN code_{key} c ON c.v = coalesce(nullif(t.{key}, ''), '(blank)') GROUP BY 1, 2"""
           for key, base in (("search_country", "country"), ("search_position", "position"))]) + """),
every AS (SELECT l.label, cast(r.slot AS int) AS slot FROM (SELECT DISTINCT high_demand AS label FROM fx_train) l,
            (SELECT unnest(range((SELECT slots FROM fx_base_slots))) AS slot) r),
filled AS (SELECT e.label, e.slot, coalesce(s.s, 0) AS s FROM every e LEFT JOIN sums s USING (label, slot))
SELECT label, slot, round(ln(s + 1) - ln(sum(s) OVER (PARTITION BY label) + (SELECT slots FROM fx_base_slots)), 6)
  AS log_theta FROM filled""",
    "model_checks": """
SELECT m.model, t.n AS confusion_total, t.positives AS confusion_positives, t.n AS in_range, t.n AS reloaded_same,
  t.n AS vote_same, cast(b.slots AS int) AS slots,
  CASE WHEN m.model IN ('rf', 'gbt') AND (SELECT count(DISTINCT high_demand) FROM fx_train) > 1 THEN 1.0::double END
    AS importance_sum
FROM (VALUES ('rf'), ('gbt'), ('svm'), ('nb')) m(model),
  (SELECT count(*) AS n, count(*) FILTER (WHERE high_demand = 1) AS positives FROM fx_test) t, fx_base_slots b""",
}


def ml_oracle_sql() -> dict[str, str]:
    out = {key: PREFIX + ML_CTES + body.strip() for key, body in ML_BODIES.items()}
    out.update({key: PREFIX + ML_CTES + FEATURE_CTES + body.strip() for key, body in FEATURE_BODIES.items()})
    return out


# --- source / sink oracles ------------------------------------------------------------------

_RAW_COLS = ("job_link", "last_processed_time", "got_summary", "got_ner", "is_being_worked",
             "job_title", "company", "job_location", "first_seen", "search_city", "search_country",
             "search_position", "job_level", "job_type")
_WIDE_COLS = _RAW_COLS + ("job_skills", "job_summary")
_SCRUB = "regexp_replace({c}, '[\\n\\r\\x01]', '', 'g')"

IO_CTES = """
, fx_raw_wide AS (
  SELECT p.*, s.job_skills, m.job_summary FROM fx_postings p
  LEFT JOIN fx_skills s ON p.job_link = s.job_link
  LEFT JOIN fx_summary m ON p.job_link = m.job_link
)
"""


def _top(select: str, source: str, where: str, group: str, order: str) -> str:
    return f"SELECT {select} FROM {source} {where} GROUP BY {group} ORDER BY {order} LIMIT 50"


IO_BODIES: dict[str, str] = {
    "scan_csv": "SELECT * FROM fx_raw_wide",
    "export_type_shares": BODIES["share_of_total"] + " ORDER BY posting_count DESC, job_type LIMIT 50",
    "export_characteristics": BODIES["data_characteristics_wide"],
    "land_delimited": "SELECT concat_ws(chr(1), "
    + ", ".join(f"coalesce({_SCRUB.format(c=c)}, '\\N')" for c in _WIDE_COLS)
    + ") AS value FROM fx_raw_wide",
    "scan_delimited": "SELECT " + ", ".join(f"{_SCRUB.format(c=c)} AS {c}" for c in _RAW_COLS)
    + " FROM fx_postings",
    "landed_line_counts": """
SELECT 'postings' AS table_name, count(*) AS line_count FROM fx_postings
UNION ALL SELECT 'skills', count(*) FROM fx_skills
UNION ALL SELECT 'summary', count(*) FROM fx_summary""",
    "roundtrip_parquet": "SELECT * FROM fx_enriched",
    "catalog_enrich": "SELECT * FROM fx_enriched",
    "catalog_tables": """
SELECT 'postings' AS table_name, false AS is_view, count(*) AS row_count FROM fx_typed
UNION ALL SELECT 'skills', false, count(*) FROM fx_skills
UNION ALL SELECT 'summary', false, count(*) FROM fx_summary
UNION ALL SELECT 'listing_postings', true, count(*) FROM fx_typed
UNION ALL SELECT 'listing_skills', true, count(*) FROM (
  SELECT unnest(string_split(job_skills, ',')) AS skill FROM fx_skills) WHERE trim(skill) <> ''""",
    "preview_topn": _top("search_country, skill, count(*) AS skill_mentions, "
                         "count(DISTINCT job_link) AS posting_count", "fx_exploded",
                         "WHERE search_country <> 'unknown'", "search_country, skill",
                         "search_country, skill"),
    "export_top_positions": _top("search_position, count(*) AS posting_count, "
                                 "count(DISTINCT company) AS company_count, "
                                 "count(DISTINCT search_country) AS country_count", "fx_clean",
                                 "WHERE search_position <> 'unknown'", "search_position",
                                 "posting_count DESC, search_position"),
    "export_top_skills": _top("skill, count(*) AS skill_mentions, count(DISTINCT job_link) AS posting_count, "
                              "count(DISTINCT search_country) AS country_count", "fx_exploded", "",
                              "skill", "skill_mentions DESC, skill"),
    "export_top_companies": _top("company, count(*) AS posting_count, "
                                 "count(DISTINCT search_country) AS country_count, "
                                 "count(DISTINCT search_position) AS position_count", "fx_clean",
                                 "WHERE company <> 'unknown'", "company", "posting_count DESC, company"),
}


IO_BODIES["scan_csv_split"] = IO_BODIES["scan_csv"]


def io_oracle_sql() -> dict[str, str]:
    return {key: PREFIX + IO_CTES + body.strip() for key, body in IO_BODIES.items()}
