"""Words left out as keys of the parity join: no link is lost, fewer texts meet by chance."""

import numpy as np
from frames import prose

from demandlens.llm import parity_join as pj


def keys(words):
    """Places and words that are join keys."""
    least = pj.least_bits(words)
    return {(i, w) for i, w in enumerate(words.view(np.uint64).tolist()) if w.bit_count() >= least}


def test_linked_sets_share_a_key_that_is_not_left_out():
    rng, bands, left_out = np.random.default_rng(2), pj.Bands(90), 0
    for n in (9, 20, 60, 140, 150, 300, 900):
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            apart = pj.most_apart(2 * len(a), 90) // 2  # as many on each side as the similarity allows
            b = np.concatenate([a[apart:], rng.integers(0, 1 << 63, apart, dtype=np.uint64)])
            assert 100 * (len(a) - apart) >= 90 * (len(a) + apart)
            x, y = (pj.sketch(s, bands.words(bands.of(len(a)))) for s in (a, b))
            assert keys(x) & keys(y)
            left_out += len(x) - len(keys(x))
    assert left_out > 50


def test_fewer_texts_meet_by_chance(spark):
    """Unlike texts of one band: nothing links them, and hardly any words bring them together."""
    docs = spark.createDataFrame([(i, prose(i, 300)) for i in range(1500)], "doc_id long, text string")
    nodes = pj.signatures(docs, 90, 3, "doc_id", "text").withColumnRenamed("doc_id", "node").cache()
    met = pj.bucket_members(nodes).select("node").distinct().count()
    every = pj.bucket_members(nodes.selectExpr("node", "band", "own", "up", "0 AS own_bits", "0 AS up_bits")).select("node")
    assert met < 0.5 * every.distinct().count()
