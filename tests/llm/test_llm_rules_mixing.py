"""Quality rules and mixing against brute force and, for mixing, an independent budgeting."""

import hashlib
import re
from collections import Counter, defaultdict

import frames
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from demandlens.llm import mixing, quality_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for p in range(k, k + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


def counted(df):
    return [(r["doc_id"], *(r[c] for c in quality_rules.COUNTS), r["base_failed"]) for r in df.collect()]


def key(r):
    return (r[0] is None, *[x or 0 for x in r])


AWKWARD = ["a b c d e f g h " * 9, "a " * 40, "one\ntwo\none\n \n\none", "x|y <b> #tag 100% & $5 *", "\x0bv\x0ct\r\n\r\n",
           "w1 w2 w3 w4 w5 w6 w7 w8 w9 w1 w2 w3 w4 w5 w6 w7 w8", "😀 " * 8 + "é", "one two three four five six seven"]


def test_counts_equal_brute_force(spark):
    rows = [*frames.rows(), *[(900 + i, t, "en", "s", 0) for i, t in enumerate(AWKWARD)]]
    got = quality_rules.judge(spark.createDataFrame(rows, frames.SCHEMA), keep_columns=False)
    assert sorted(counted(got), key=key) == sorted(((r[0], *brute_counts(r[1])) for r in rows), key=key)
    assert got.where("base_failed and kept").count() == 0


def test_counts_of_the_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op10_supervised_rules(spark, SF_SMALL)
    assert sorted(counted(got)) == sorted((r["doc_id"], *brute_counts(r["text"])) for r in docs)


def test_verdicts_agree_with_labels(spark):
    got = queries.op10_supervised_rules(spark, SF_MID).drop("quality")
    both = got.join(spark.read.parquet(f"{SF_MID}/labels.parquet"), "doc_id").where("not base_failed")
    right = both.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.98


def test_rules_keep_other_columns_and_take_empty_tables(spark):
    got = quality_rules.judge(frames.documents(spark, clashing=True))
    assert {"text", "score", "tokens", "kept"} <= set(got.columns) and got.count() == len(frames.rows())
    assert quality_rules.judge(frames.empty(spark)).count() == 0


def test_em_finds_which_rules_tell():
    """Two telling rules and one that votes at random: the telling ones must weigh more."""
    patterns = [((1, 1, 1), 400), ((1, 1, -1), 400), ((-1, -1, 1), 90), ((-1, -1, -1), 90), ((1, -1, 1), 10), ((-1, 1, -1), 10)]
    prior, odds = quality_rules.estimate(patterns, 3)
    assert prior > 0 and odds[0][-1] < -2 and odds[1][-1] < -2 and abs(odds[2][-1]) < 0.5
    assert quality_rules.estimate([], 3)[1][0] == {-1: 0.0, 0: 0.0, 1: 0.0}


def water_fill(budget, children):
    """Give by weight; whoever can't take its share gets all it can, and the rest is shared again."""
    out, open_, left = {}, dict(children), budget
    while open_:
        weights = sum(w for _, w in open_.values())
        full = {k: s for k, (s, w) in open_.items() if s * weights <= left * w}
        if not full:
            return out | {k: left * w // weights for k, (s, w) in open_.items()}
        for k, s in full.items():
            out[k] = s
            left -= s
            del open_[k]
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.integers(1, 500)), min_size=1, max_size=6,
                unique_by=lambda r: r[:2]), st.integers(0, 2500))
def test_budgets_equal_iterated_sharing(spark, leaves, budget):
    weights = {"a": 3, "x": 2, "z": 5}
    rows = spark.createDataFrame(leaves, "top string, low string, tokens long")
    got = mixing.allot(rows, ["top", "low"], {"top": weights, "low": weights}, budget, 2).collect()
    tops = defaultdict(int)
    for top, _, tokens in leaves:
        tops[top] += 2 * tokens
    shares = water_fill(budget, {k: (s, weights.get(k, 1)) for k, s in tops.items()})
    want = {}
    for top in tops:
        family = {low: (2 * n, weights.get(low, 1)) for t, low, n in leaves if t == top}
        want |= {(top, low): v for low, v in water_fill(shares[top], family).items()}
    assert {(r["top"], r["low"]): r["allotted"] for r in got} == want


def test_weight_zero_takes_nothing_and_is_no_supply(spark):
    rows = spark.createDataFrame([("a", "x", 100), ("a", "y", 10), ("b", "x", 100)], "top string, low string, tokens long")
    got = mixing.allot(rows, ["top", "low"], {"low": {"x": 0}}, 60, 1).collect()
    assert {(r["top"], r["low"]): r["allotted"] for r in got} == {("a", "x"): 0, ("a", "y"): 10, ("b", "x"): 0}


def test_prefix_of_the_seeded_epoch(spark):
    docs = spark.createDataFrame([(i, frames.prose(i, 3 + i % 9), "en", "s") for i in range(200)],
                                 "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, {"source": F.col("source")}, {}, share=(3, 2), max_epochs=2, seed=5).collect()
    words = {i: 3 + i % 9 for i in range(200)}
    total = sum(words.values())
    assert [r["doc_id"] for r in got if r["epoch"] == 0] and sum(r["epoch"] == 0 for r in got) == 200
    order = sorted(words, key=lambda i: hashlib.md5(f"5:1:{i}".encode()).hexdigest())
    want, used = set(), 0
    for i in order:
        if used + words[i] > total * 3 // 2 - total:
            break
        used += words[i]
        want.add(i)
    assert {r["doc_id"] for r in got if r["epoch"] == 1} == want


def test_mixing_awkward_rows(spark):
    levels = {"domain": queries.domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    got = mixing.mix(frames.documents(spark, clashing=True), levels, {}, share=(1, 1), max_epochs=1)
    assert got.count() == len(frames.rows()) and got.where("source = '(none)'").count() == 1
    assert mixing.mix(frames.empty(spark), levels, {}).count() == 0
    again = mixing.mix(frames.documents(spark).repartition(13), levels, {}, share=(1, 2), max_epochs=1)
    once = mixing.mix(frames.documents(spark), levels, {}, share=(1, 2), max_epochs=1)
    assert sorted(r["doc_id"] or -1 for r in again.collect()) == sorted(r["doc_id"] or -1 for r in once.collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    from tools.oracle_check import canon

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = queries.QUERIES[name](spark, SF_SMALL)
    rel = con.sql(queries.ORACLE_SQL[name])
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == canon(rel.columns, rel.fetchall())
