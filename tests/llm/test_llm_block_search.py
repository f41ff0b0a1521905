"""Ranked search against scoring every document, with small blocks, several batches and ties."""

import math
import random
import re
from collections import Counter

import pytest
from frames import documents, empty, prose
from pyspark.sql import functions as F

from demandlens.llm import block_search as bs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, top):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    known = [c for _, c in counts if c]
    total, length = len(known), sum(c.total() for c in known)
    df = Counter(t for c in known for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 50 + (50 * c.total() * total) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted((tuple(r) for r in bs.search(docs, items, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(9)
    words = prose(50, 400).split()
    common = [rng.choices(words, weights=[1 / (k + 1) for k in range(400)], k=rng.randint(1, 90)) for _ in range(700)]
    docs = [(i, " ".join(w)) for i, w in enumerate(common)]
    docs += [(1000 + i, docs[3][1]) for i in range(150)]  # a hot group of equal scores
    docs += [(None, docs[5][1]), (2000, None), (2001, ""), (2002, "?! .."), (2003, "Été ÉTÉ été"), (2003, "Été ÉTÉ été")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(70)]
    items += [(100, docs[3][1]), (101, None), (102, "-"), (103, "nowhere"), (104, "ÉTÉ"), (104, "ÉTÉ"), (None, words[0])]
    return docs, items


def frames_of(spark, tables):
    docs, items = tables
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("options", [{}, {"neighbours": 32, "size": 4, "first_blocks": 1, "top": 7}])
def test_ranks_as_scoring_everything_does(spark, tables, options):
    got = found(*frames_of(spark, tables), **options)
    assert got == brute_force(*tables, options.get("top", 50))


def test_batches_of_queries(spark, tables):
    docs, items = frames_of(spark, tables)
    items = items.where("item_id < 12")
    want = brute_force(tables[0], [i for i in tables[1] if i[0] is not None and i[0] < 12], 50)
    assert found(docs, items, batch_terms=60) == want


def test_blocks_are_skipped_and_bound_their_documents(spark, tables):
    docs, items = frames_of(spark, tables)
    queries = next(bs.query_batches(items.where("item_id < 70").withColumn("__q", F.monotonically_increasing_id()), "text", 10**6))
    index = bs.build_index(docs, queries, neighbours=64, size=6)
    weighed = {r["__row"]: dict(zip(r.terms, r.weights, strict=True)) for r in index.weighed.collect()}
    blocks = index.blocks.collect()
    listed = Counter((r.term, d) for r in blocks for d in r.docs)
    assert set(listed.values()) == {1} and len(listed) == sum(map(len, weighed.values()))  # every posting once
    together = queries.together()
    for r in blocks:
        top = {c: m * bs.STEP for c, m in zip(r.coords, r.maxima, strict=True)}
        for d in r.docs:
            assert all(top[t] >= x for t, x in weighed[d].items() if t in set(together[r.term].tolist()))
    scores = bs.answer(index, queries, 5)
    least = {r.q: r.score for r in scores.where("rank = 5").collect()}
    thresholds = bs.np.array([least.get(q, 0) for q in range(len(queries.terms))])
    left = sum(bin(r.bits).count("1") for r in bs.left_blocks(index, queries, thresholds).collect())
    every = sum(bin(r.bits).count("1") for r in bs.left_blocks(index, queries, thresholds * 0).collect())
    assert left < 0.6 * every


def test_empty_tables_and_clashing_names(spark):
    items = spark.createDataFrame([(1, "alpha word")], "item_id long, text string")
    assert found(empty(spark), items) == [] and found(documents(spark), items.where("false")) == []
    df = documents(spark, clashing=True).withColumns({c: F.lit("x") for c in ("q", "rank", "terms", "item_id")})
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert found(df, items.withColumn("score", F.lit(1))) == brute_force(rows, [(1, "alpha word")], 50)
