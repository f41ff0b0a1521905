from pyspark.sql import functions as F

from demandlens.operators import demand, share
from demandlens.operators.explode import explode_list


def test_explode_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, ","), (4, "a, b,,c "), (5, "a,a")],
                               "job_link int, job_skills string")
    out = sorted((r.job_link, r.skill) for r in explode_list(df, keep=["job_link"]).collect())
    assert out == [(4, "a"), (4, "b"), (4, "c"), (5, "a"), (5, "a")]


def test_explode_literal_separator(spark):
    df = spark.createDataFrame([(1, "a|b.c")], "job_link int, job_skills string")
    assert [r.skill for r in explode_list(df, sep="|", keep=["job_link"]).collect()] == ["a", "b.c"]


def test_explode_splits_by_a_plain_sign_and_never_by_a_pattern(spark):
    df = spark.createDataFrame([(1, "q")], "job_link int, job_skills string")
    for sep in (",", "|", ".", "\\", "\t", "-", "^", "$", "a", "1", "||", ".*", "é"):
        lists = df.select("job_link", F.lit(f"x{sep}y z{sep}{sep}Q").alias("job_skills"))
        exploded = explode_list(lists, sep=sep, keep=["job_link"])
        assert [r.skill for r in exploded.collect()] == ["x", "y z", "Q"], sep
    # a quoted pattern is compiled anew for every row; a single escaped sign is not
    assert "\\Q" not in explode_list(df)._jdf.queryExecution().toString()


def test_counts_by_sentinel_only_on_named_columns(spark):
    df = spark.createDataFrame(
        [("p", "c1", "unknown"), ("p", "c2", "x"), ("unknown", "c1", "x")],
        "search_position string, company string, search_country string")
    out = demand.top_positions_global(df).collect()
    assert [(r.search_position, r.posting_count, r.company_count, r.country_count) for r in out] == [("p", 2, 2, 2)]


def test_share_sums_to_100(spark):
    df = spark.range(0, 1003).select((F.col("id") % 7).cast("string").alias("job_type"))
    rows = share.share_of_total(df, ["job_type"]).collect()
    assert abs(sum(r.posting_pct for r in rows) - 100.0) <= 0.05
    assert sum(r.posting_count for r in rows) == 1003


def test_empty_input_aggregates(spark):
    from demandlens.operators import quality

    df = spark.createDataFrame([], "search_country string, search_position string, company string, "
                               "job_title string, job_level string, job_type string, job_skills string, "
                               "job_summary string, first_seen date")
    cov = quality.null_coverage(df).collect()
    assert all(r.total_rows == 0 and r.missing_rows == 0 and r.missing_pct is None for r in cov)
    assert demand.top_positions_global(df).count() == 0
    wide = quality.data_characteristics_wide(df).first()
    assert wide.total_rows == 0 and wide.rows_with_skills == 0


def test_counts_by_approx_distinct_is_close(spark):
    df = spark.range(0, 20000).select((F.col("id") % 3).cast("string").alias("k"),
                                      F.col("id").cast("string").alias("v"))
    exact = {r.k: r.n for r in demand.counts_by(df, ["k"], distinct={"n": "v"}).collect()}
    approx = {r.k: r.n for r in demand.counts_by(df, ["k"], distinct={"n": "v"}, approx=True).collect()}
    assert all(abs(approx[k] - exact[k]) / exact[k] < 0.05 for k in exact)


def test_split_left_join_equals_left_join_with_a_hot_child_key(spark):
    from demandlens.operators.enrich import enrich

    posts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "job_link string, x int")
    skills = spark.createDataFrame([("a", "s1")] * 50 + [("a", "s2"), ("c", "s3"), (None, "s4"), ("z", "s5")],
                                   "job_link string, job_skills string")
    summ = spark.createDataFrame([("b", "t1"), ("b", "t2"), ("q", "t3")], "job_link string, job_summary string")
    plain = enrich(posts, skills, summ)
    safe = enrich(posts, skills, summ, repeated_child_keys=True)
    assert safe.columns == plain.columns
    assert sorted(map(tuple, safe.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert safe.count() == 55


def test_counts_by_prededupe_equals_single_level(spark):
    rows = [("s1", "j1", "c1"), ("s1", "j1", "c1"), ("s1", "j2", "c2"), ("s2", "j1", "c1"),
            ("s2", None, "c3"), ("s1", "j3", None)]
    df = spark.createDataFrame(rows, "skill string, job_link string, search_country string")
    d = {"posting_count": "job_link", "country_count": "search_country"}
    a = demand.counts_by(df, ["skill"], "skill_mentions", d)
    b = demand.counts_by(df, ["skill"], "skill_mentions", d, prededupe=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


SKILL_ROWS = [("j1", "a, b,a", "c1", "l1"), ("j2", "b,, b ,c", "c1", "l2"), ("j3", "a", "unknown", "l1"), ("j4", None, "c2", "l1"),
              ("j5", "", "c2", "unknown"), (None, "a,a", "c2", "l1"), ("j6", "a,B,b", "c2", "l2")]


def skill_rows(spark, repeat=False):
    rows = SKILL_ROWS + ([("j1", "a,d", "c1", "l1")] if repeat else [])
    return spark.createDataFrame(rows, "job_link string, job_skills string, search_country string, job_level string")


def test_marked_first_mentions_count_distinct_postings(spark):
    df = skill_rows(spark)
    plain, marked = explode_list(df), explode_list(df, mark=demand.FIRST_MENTION)
    assert demand.has_unique_keys(df) and not demand.has_unique_keys(skill_rows(spark, repeat=True))
    for table in (demand.top_skills_global, demand.top_skills_by_country, demand.skills_by_level):
        want, got = table(plain), table(marked)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    lower = explode_list(df, mark="m", lower=True).where("skill = 'b' AND job_link = 'j6'").collect()
    assert sorted(r.m for r in lower) == [False, True]  # B and b are one element then


def test_marked_skill_tables_have_one_exchange_and_no_expand(spark, tmp_path):
    path = str(tmp_path / "p")
    skill_rows(spark).write.parquet(path)
    marked = explode_list(spark.read.parquet(path), mark=demand.FIRST_MENTION)
    for table, exchanges in ((demand.top_skills_by_country, 1), (demand.skills_by_level, 1), (demand.top_skills_global, 2)):
        plan = table(marked)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == exchanges
        assert "hashpartitioning(job_link" not in plan and ", job_link" not in plan.split("Exchange")[1].split("\n")[0]


def test_wide_matrix_is_bounded_and_whole(spark):
    rows = [("x", f"s{k}", k) for k in range(1, 30)] + [("y", "s29", 5), ("y", "s1", 1), ("z", "s2", 0)]
    cells = spark.createDataFrame(rows, "r string, c string, n long")
    got = {r.r: r for r in demand.wide_matrix(cells, "r", "c", "n", 3, "c").collect()}
    assert [got["x"][f"c_{k}"] for k in (1, 2, 3)] == [29, 28, 27] and got["x"].other == sum(range(1, 27))
    assert (got["y"].c_1, got["y"].other, got["y"].total, got["z"].total, got["z"].c_1) == (5, 1, 6, 0, 0)
    assert got["x"].total == sum(range(1, 30))
    assert [r.c for r in demand.matrix_columns(cells, "c", "n", 3).orderBy("place").collect()] == ["s29", "s28", "s27"]
    assert demand.wide_matrix(cells.where("false"), "r", "c", "n", 3, "c").collect() == []


def test_previewed_skills_sum_marks_unless_posting_keys_repeat(spark):
    from demandlens.operators.demand import FIRST_MENTION, top_skills_by_country, top_skills_global
    from demandlens.plans.io import skill_mentions

    rows = [("j1", "a", "x,y,x"), ("j2", "a", "x"), ("j3", "b", None), (None, "b", "y,y")]
    again = [*rows, ("j2", "a", "x,z"), ("j2", "b", "x")]
    for data, marked in ((rows, True), (again, False)):
        df = spark.createDataFrame(data, "job_link string, search_country string, job_skills string")
        skills = skill_mentions(df)
        assert (FIRST_MENTION in skills.columns) == marked
        plain = explode_list(df)
        for table in (top_skills_by_country, top_skills_global):
            got, want = table(skills), table(plain)
            assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
