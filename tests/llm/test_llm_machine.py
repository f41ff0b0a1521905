"""The factorization machine: pairs against a plain sum, a planted pair in long texts, and the registered training."""

import random

import numpy as np
import pytest

from demandlens.llm import toxicity as tx
from demandlens.llm.common import read

SF_LARGE = "/root/testdata/sf0.1"


def planted(n, words, seed):
    """Texts toxic if exactly one of two words occurs: each word alone is as frequent in both classes."""
    rng = random.Random(seed)
    known = [a + b + c for a in "bcdfgl" for b in ("ari", "olu", "ent", "ima", "ost") for c in ("n", "mo", "rik", "stal", "da", "vep", "lu")]
    texts, labels = [], []
    for _ in range(n):
        text = rng.choices(known, k=words)
        for word in ("zorbly", "quandar"):
            if rng.random() < 0.5:
                text[rng.randrange(words)] = word
        texts.append(" ".join(text))
        labels.append(int(("zorbly" in text) != ("quandar" in text)))
    return texts, labels


def without_pairs(machine):
    return tx.Machine(machine.columns, machine.bias, machine.weights, machine.vectors * 0)


@pytest.mark.parametrize("words", [15, 300])
def test_a_pair_is_found_out_of_sample_and_lost_without_vectors(words):
    (texts, labels), (unseen, want) = planted(1600, words, 1), planted(600, words, 2)
    terms = tx.Terms()
    machine = tx.fit([terms.of(t) for t in texts], labels, 0.5)
    known = tx.Terms(machine.columns)

    def accuracy(m):
        return np.mean([(m.log_odds(known.of(t)) > 0) == (y == 1) for t, y in zip(unseen, want, strict=True)])

    assert accuracy(machine) > 0.95 and accuracy(without_pairs(machine)) < 0.6


def test_log_odds_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(4)
    machine = tx.Machine({}, 0.3, rng.normal(size=40), rng.normal(size=(40, 5)))
    for size in (0, 1, 2, 17, 40):
        active = sorted(rng.choice(40, size, replace=False).tolist())
        want = 0.3 + sum(machine.weights[i] for i in active)
        want += sum(machine.vectors[i] @ machine.vectors[j] for k, i in enumerate(active) for j in active[k + 1:])
        assert machine.log_odds(active) == pytest.approx(want, abs=1e-9)


def test_batches_of_odds_are_those_of_single_documents():
    rng = np.random.default_rng(5)
    rows = [np.sort(rng.choice(30, k, replace=False)) for k in (0, 3, 30, 1, 0)]
    weights, vectors = rng.normal(size=30).astype(np.float32), rng.normal(size=(30, 4)).astype(np.float32)
    machine = tx.Machine({}, -0.2, weights, vectors)
    got = tx.Rows(rows, np.zeros(5), 30).odds(-0.2, weights, vectors)
    assert got == pytest.approx([machine.log_odds(r.tolist()) for r in rows], abs=1e-3)


def test_telling_pairs_are_those_of_a_plain_count():
    rng = np.random.default_rng(6)
    active = rng.random((600, 25)) < 0.4
    labels = (active[:, 3] ^ active[:, 8] ^ (rng.random(600) < 0.1)).astype(np.float32)
    rows = tx.Rows([np.flatnonzero(r) for r in active], labels, 25)
    i, j, gain = tx.telling_pairs(rows, np.zeros(600, np.float32))
    error = labels - labels.mean()
    want = set()
    for a in range(25):
        for b in range(a + 1, 25):
            both = active[:, a] & active[:, b]
            extra = error[both].sum() - both.sum() * (error[active[:, a]].mean() + error[active[:, b]].mean())
            if abs(extra) >= tx.PAIR_Z * np.sqrt((error[both] ** 2).sum()):
                want.add((a, b))
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and (3, 8) in want
    assert gain[(i == 3) & (j == 8)][0] < 0


def test_the_registered_training_leaves_pairs_that_score(spark):
    docs, labels = read(spark, SF_LARGE, "documents"), read(spark, SF_LARGE, "labels")
    machine = tx.train(docs, labels)
    norms = np.linalg.norm(machine.vectors, axis=1)
    assert (norms > 0).all() and len(norms) == len(machine.columns)
    texts = [r.text or "" for r in docs.orderBy("doc_id").limit(400).collect()]
    known = tx.Terms(machine.columns)
    moved = [machine.log_odds(known.of(t)) - without_pairs(machine).log_odds(known.of(t)) for t in texts]
    assert np.mean(np.abs(moved) > 0.05) > 0.5


def test_nothing_to_learn_from_pairs():
    machine = tx.fit([[1], [2], [1, 2], []] * 3, [0, 1, 1, 0] * 3, 0.5)
    assert np.isfinite([machine.log_odds([]), machine.log_odds([0])]).all()
    machine = tx.fit([[], [], [], []], [0, 1, 1, 0], 0.5)
    assert machine.columns == {} and np.isfinite(machine.log_odds([]))
