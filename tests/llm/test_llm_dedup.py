"""Exact and near deduplication against brute force."""

import hashlib
import itertools
from collections import defaultdict

import frames
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from demandlens.llm import exact_dedup, near_dedup, queries

SPACE = {ord(c): None for c in " \t\n\x0b\x0c\r"}


def brute_exact(rows):
    groups = defaultdict(list)
    for n, (i, t, *_) in enumerate(rows):
        groups[(t or "").translate(SPACE)].append((-len(t or ""), i is None, i or 0, n, i))
    out = {}
    for text, members in groups.items():
        first = min(members)
        for m in members:
            out.setdefault((m[4], first[4], len(members), hashlib.sha256(text.encode()).hexdigest()), []).append(m is first)
    return {k: sorted(v) for k, v in out.items()}


def found_exact(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]), []).append(r["kept"])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("max_bits", [1 << 28, 1 << 16])
def test_exact_dedup_equals_brute_force(spark, max_bits):
    docs = frames.documents(spark)
    got = exact_dedup.exact_dedup(exact_dedup.with_text_key(docs), max_bits=max_bits)
    assert found_exact(got) == brute_exact(frames.rows())


def test_a_full_filter_only_costs_shuffles(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MIN_BITS", 8)  # nearly every bit is repeated
    got = exact_dedup.exact_dedup(exact_dedup.with_text_key(frames.documents(spark)), max_bits=8)
    assert found_exact(got) == brute_exact(frames.rows())


def test_the_filter_lets_single_texts_pass(spark):
    keyed = exact_dedup.with_text_key(frames.documents(spark))
    bits = exact_dedup.filter_bits(keyed.count())
    probed = exact_dedup.possibly_repeated(keyed, exact_dedup.repeated_bits(keyed, bits), bits)
    maybe = {r["doc_id"] for r in probed.where("__maybe").select("doc_id").collect()}
    assert {1, 2, 3, 4, 5, 11, *range(80, 95)} <= maybe
    assert len(maybe & set(range(40, 80))) <= 2


def test_exact_dedup_clashing_columns_and_empty_table(spark):
    got = exact_dedup.exact_dedup(exact_dedup.with_text_key(frames.documents(spark, clashing=True)))
    assert found_exact(got) == brute_exact(frames.rows())
    assert {"text", "score", "part"} <= set(got.columns)
    assert exact_dedup.exact_dedup(exact_dedup.with_text_key(frames.empty(spark))).count() == 0


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:], strict=False)) if len(words) > 1 else frozenset(words)


def brute_components(pairs):
    """Smallest id of each row's component; rows are (id, text)."""
    sets = [shingle_set(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(range(len(pairs)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            parent[top(a)] = top(b)
    groups = defaultdict(list)
    for n, (i, _) in enumerate(pairs):
        groups[top(n)].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((i, len(sets[n]), least[top(n)]) for n, (i, _) in enumerate(pairs)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def found_components(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_near_duplicates_equal_brute_force(spark):
    got = near_dedup.near_duplicates(frames.documents(spark, clashing=True))
    assert found_components(got) == brute_components([(r[0], r[1]) for r in frames.rows()])
    kept = [r["doc_id"] for r in got.where("kept").collect()]
    assert len(kept) == got.select("component_id").distinct().count() == len(set(kept))  # one row of the repeated id


def test_near_query_equals_brute_force_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op3_odd_sketch_dedup(spark, SF_SMALL)
    assert found_components(got) == brute_components([(r["doc_id"], r["text"]) for r in docs])


def test_chains_join_one_component(spark):
    """Each text is near the next but not the one after; all buckets' centers alone wouldn't join them."""
    words = frames.prose(3, 120).split()
    texts = []
    for i in range(30):
        words = words[:]
        for k in range(4):
            words[(i * 4 + k) % 120] = f"z{i}{k}"
        texts.append((i, " ".join(words)))
    got = near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert found_components(got) == brute_components(texts)


def test_near_duplicates_of_an_empty_table(spark):
    assert near_dedup.near_duplicates(frames.empty(spark)).count() == 0


@pytest.mark.parametrize("size", [30, 600, 9_000])
def test_odd_sketches_allow_what_reaches_the_similarity_and_not_much_more(spark, size):
    rng = np.random.default_rng(size)
    base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    rows = []
    for percent in (100, 95, 85, 80, 70, 60, 30):
        same = round(size * 2 * percent / (100 + percent))  # two sets of one size at this similarity
        for _ in range(12):
            other = np.concatenate([rng.permutation(base)[:same], rng.integers(0, 1 << 63, size - same, dtype=np.uint64)])
            rows.append((percent, near_dedup.odd_sketch(base).tolist(), near_dedup.odd_sketch(other).tolist()))
    df = spark.createDataFrame(rows, "percent int, a array<long>, b array<long>")
    open_ = df.groupBy("percent").agg(F.avg(near_dedup.may_reach(F.col("a"), F.col("b"), 80).cast("double")).alias("p"))
    found = {r["percent"]: r["p"] for r in open_.collect()}
    assert all(found[p] == 1 for p in (100, 95, 85, 80)) and found[30] == 0
    assert found[60] < 0.3 or size < 100


def test_minhash_estimates_similarity():
    seeds = near_dedup.sketch_seeds()
    a, b = near_dedup.shingles(frames.prose(1, 400)), near_dedup.shingles(frames.prose(1, 400) + " " + frames.prose(2, 80))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((near_dedup.minhash(a, seeds) == near_dedup.minhash(b, seeds)).mean() - true) < 0.12


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    got = {r["node"]: r["component"] for r in
           near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_only_words_of_the_contract_count():
    assert len(near_dedup.shingles("A b c")) == 1  # a no-break space is part of a word
    assert np.array_equal(near_dedup.shingles("ÀB c"), near_dedup.shingles("Àb C"))
    assert not np.array_equal(near_dedup.shingles("À b"), near_dedup.shingles("à b"))
    assert len(near_dedup.shingles("")) == 0 == len(near_dedup.shingles(" \n"))
