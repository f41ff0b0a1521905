"""The parity-sketch join against brute force over full sets, with hot families and forced blocks."""

import random

import numpy as np
import pytest
from frames import documents, empty, prose
from pyspark.sql import functions as F

from demandlens.llm import parity_join as pj
from demandlens.llm.near_dedup import shingles


def word_sets(rows, width):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        count = len(words) - min(width, len(words)) + 1
        out.append({tuple(words[i:i + width]) for i in range(count)} if words else set())
    return out


def brute_force(rows, percent, width):
    """(id, set size, smallest reachable id) of every row, from all pairs."""
    sets = word_sets(rows, width)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if a and 100 * same >= percent * (len(a) + len(sets[j]) - same):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((r[0], len(s), least.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))),
                  key=repr)


def family(seed, words, members, most_edits):
    """Texts that differ from a base in up to ``most_edits`` words."""
    rng, base = random.Random(seed), prose(seed, words).split()
    for m in range(members):
        text = list(base)
        for k in range(rng.randint(0, most_edits)):
            text[rng.randrange(len(text))] = f"w{m}x{k}"
        yield " ".join(text)


def joined(df, percent=90, width=3):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in pj.similarity_components(df, percent, width).collect()),
                  key=repr)


@pytest.mark.parametrize(("percent", "width"), [(90, 3), (80, 1)])
def test_joins_as_all_pairs_do(spark, percent, width):
    df = documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert joined(df, percent, width) == brute_force(rows, percent, width)


def test_families_about_the_similarity_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(pj, "BLOCK_WORDS", 64)  # a few classes a block
    monkeypatch.setattr(pj, "TASK_ROWS", 50)
    monkeypatch.setattr(pj, "FIRST", 1)
    texts = [t for seed, words in ((1, 60), (2, 150), (3, 25)) for t in family(seed, words, 70, 6)]
    rows = [(i, t) for i, t in enumerate(texts)]
    random.Random(5).shuffle(rows)
    got = joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert got == brute_force(rows, 90, 3)
    assert 3 < len({c for _, _, c in got}) < len(rows)


def test_partners_are_all_pairs_of_the_bound(spark):
    df = spark.createDataFrame(list(enumerate(family(4, 80, 60, 5))), "doc_id long, text string")
    nodes = pj.signatures(df, 90, 3, "doc_id", "text").withColumn("node", F.col("doc_id")).cache()
    members = nodes.select(F.lit(1).alias("h"), "node", F.lit(True).alias("own"), F.lit(-1).alias("center"))
    rows = pj.block_rows(members, nodes.where("false").select("node", F.col("node").alias("component")), nodes)
    sets = {r.node: r for r in nodes.collect()}
    want = {(a, b) for a in sets for b in sets if a < b
            and sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(sets[a].own, sets[b].own, strict=True))
            <= pj.most_apart(sets[a].n + sets[b].n, 90)}
    got = {(r.a, r.b) for r in pj.partners(rows, 90, 1000).collect()}
    assert got == want and 20 < len(want) < 60 * 59 / 2


def test_hot_copies_are_one_class_and_rows_stay(spark):
    rows = [(i, prose(1, 40)) for i in range(300)] + [(1000, prose(1, 40) + " end"), (1001, prose(2, 40))]
    got = joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert len(got) == 302 and {c for _, _, c in got} == {0, 1001}


def test_no_words_no_links(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, None), (4, "one"), (5, "ONE"), (None, "two"), (None, "two")]
    got = joined(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 0, None), (4, 1, 4), (5, 1, 4), (None, 1, None),
                          (None, 1, None)], key=repr)


def test_empty_tables_and_clashing_names(spark):
    assert joined(empty(spark)) == []
    df = documents(spark, clashing=True)
    clash = df.withColumns({c: F.lit("x") for c in ("band", "own", "up", "node", "h", "component", "center")})
    assert joined(clash) == joined(documents(spark))


def test_sketches_bound_the_difference_and_share_a_word():
    rng = np.random.default_rng(1)
    bands = pj.Bands(90)
    for n in (9, 10, 19, 60, 500, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        reach = int(n * 0.1)
        for drop in {0, reach // 2, reach}:
            b = a[drop:]  # similarity 1 - drop / n
            if 100 * len(b) < 90 * len(a):
                continue
            band = max(bands.of(len(a)), bands.of(len(b)))
            x, y = pj.sketch(a, bands.words(band)), pj.sketch(b, bands.words(band))
            assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= drop < len(x) and (x == y).any()
            for s in (a, b):
                own, first, up = bands.sketches(s)
                assert band in (own, own + 1) and (first if own == band else up).tolist() == pj.sketch(s, bands.words(band)).tolist()


def test_bands_reach_their_neighbours():
    for percent in (50, 80, 90, 99):
        starts = pj.band_starts(percent, 100_000)
        for size in range(1, 20_000):
            band = np.searchsorted(starts, size, "right") - 1
            partner = np.searchsorted(starts, size * 100 // percent, "right") - 1
            assert partner - band <= 1
    assert len(shingles("a b c", 3)) == 1
