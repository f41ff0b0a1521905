"""Dealing open buckets: rows that travel, pairs that meet, what waits for the next round."""

import numpy as np
from frames import prose
from pyspark.sql import functions as F
from test_llm_dedup import brute_components, found_components

from demandlens.llm import blocks, near_dedup


def bucket(spark, classes, inside):
    """One bucket; its first ``inside`` classes are one component, the others are alone."""
    members = spark.range(classes).select(F.lit(7).cast("long").alias("h"), F.col("id").alias("node"),
                                          F.lit(-1).cast("long").alias("center"))
    return members, spark.range(inside).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("component"))


def dealt_rows(spark, classes, inside):
    return blocks.deal(blocks.open_members(*bucket(spark, classes, inside)), F.lit(16))


def test_rows_of_a_hot_group_grow_with_its_size(spark):
    """Nine of ten classes are linked already: they travel once a block of the rest, whatever the group's size."""
    few, many = (dealt_rows(spark, n, n * 9 // 10).count() for n in (160, 1600))
    assert few < 2 * 160 and many < 8 * 1600
    alone = [dealt_rows(spark, n, 0).count() for n in (256, 4096)]
    assert alone[1] < 16 ** 1.6 * alone[0]  # not linked at all: 16 times the classes, not 256 times the rows


def test_every_pair_of_two_components_meets(spark):
    rows = dealt_rows(spark, 120, 60)
    pairs = rows.groupBy("h", "i", "j").agg(F.collect_list(F.struct("block", "node")).alias("m")).collect()
    meets = {tuple(sorted((a, b))) for r in pairs for x, a in r.m for y, b in r.m if x == r.i and y == r.j}
    assert {(a, b) for a in range(120) for b in range(a + 1, 120) if b >= 60} <= meets


def test_what_is_not_given_waits_and_the_nearest_come_first(spark):
    def prepare(table):
        node = table.column("node").to_numpy()
        return lambda x, others: np.abs(node[others] - node[x]) - 5

    found = blocks.partners(dealt_rows(spark, 60, 50), prepare, 2).cache()
    given, waiting = blocks.split_found(found)
    pairs = {(r.a, r.b) for r in given.collect()}
    waits = {r.node: r.seeks for r in waiting.collect()}
    assert all(abs(a - b) <= 5 and b >= 50 for a, b in pairs)
    left = {(a, b) for b in range(50, 60) for a in range(b - 5, b)} - pairs
    assert left and all(a in waits and b in waits and (waits[a] or waits[b]) for a, b in left)
    assert not set(waits) & set(range(45))
    members, labels = bucket(spark, 60, 50)
    again, none = blocks.split_found(blocks.partners(
        blocks.deal(blocks.open_members(members, labels, waiting), F.lit(16)), prepare, 100).cache())
    assert left <= {(r.a, r.b) for r in again.collect()} and none.isEmpty()


def test_near_families_in_small_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "FIRST", 1)
    monkeypatch.setattr(near_dedup, "GROWTH", 2)
    rng, rows = np.random.default_rng(3), []
    for seed, words in ((1, 60), (2, 150), (3, 25)):
        base = prose(seed, words).split()
        for m in range(60):
            text = list(base)
            for k in range(int(rng.integers(0, words // 8))):
                text[int(rng.integers(words))] = f"w{m}x{k}"
            rows.append((len(rows), " ".join(text)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert found_components(got) == brute_components(rows)


def test_small_sets_are_bounded_by_the_shingles_that_differ(spark):
    """A whole set's flips are at most the shingles that differ: 10 of 40 and 40 can't reach 80 percent."""
    a = np.arange(1, 41, dtype=np.uint64) << np.uint64(20)
    rows = []
    for differ in (2, 4, 5, 6):  # on each side; 100 * (40 - d) >= 80 * (40 + d) up to 4
        b = np.concatenate([a[differ:], np.arange(1, differ + 1, dtype=np.uint64)])
        rows.append((differ, near_dedup.odd_sketch(a).tolist(), near_dedup.odd_sketch(b).tolist()))
    df = spark.createDataFrame(rows, "differ int, a array<long>, b array<long>")
    got = {r.differ: r.open for r in df.select("differ", near_dedup.may_reach(F.col("a"), F.col("b"), 80).alias("open")).collect()}
    assert got == {2: True, 4: True, 5: False, 6: False}
