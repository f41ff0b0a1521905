"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words in lower case and their longer words' first
letters (stems), hashed into ``BUCKETS``.  A linear weight for each bucket and an
inner product of learned vectors for each pair of buckets give the log-odds, so a
pair (an insult and the mention of a group) can weigh more or less than its parts.
The machine learns from a bounded sample of labelled documents (``PER_CLASS`` of
each class) in numpy on the driver.  All buckets of at least ``LEAST_DOCUMENTS`` of
them get a weight and a vector, whether or not they tell the classes apart alone.
Weights are learned first.  Where the common documents of two buckets are then still
misjudged to one side, the pair gives both vectors a first direction; all others start
small.  Then weights and vectors are learned together on mini-batches.  Scoring covers whole texts and all
documents, one pass without a shuffle.

A null text counts as empty; without known terms the score is that of the bias
alone.  Without labelled documents of both classes there is nothing to learn and
every score is 0.  Repeated rows get equal scores.  An empty table gives an empty
result.  Only ids and texts are read; labels, language and source never enter a
score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from demandlens.llm.common import label_fold, text_or_empty
from demandlens.llm.labelled import training_sample

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
#: Labelled documents of each class to learn from, at most.
PER_CLASS = 2_000
BUCKETS = 1 << 20
#: Letters of the stems; a stem counts for words at least two letters longer.
STEMS = (4, 5, 6, 7)
LEAST_DOCUMENTS = 4
VECTOR, START = 8, 0.003
#: Mini-batches of weights alone, those of weights and vectors at most, documents in each, and after how many to look.
LINEAR_STEPS, STEPS, BATCH, EVERY = 300, 300, 256, 50
RATE, RATE_PAIRS = 0.1, 0.05
#: Squared slopes that count as seen before the first step: large ones keep rare slopes small.
SEEN, SEEN_PAIRS = 1e-8, 1e-2
#: Shrinkage of weights and vectors.
L1, L2, L2_PAIRS = 1e-3, 1e-4, 1e-3
#: Standard deviations of a pair's summed errors from which it gives vectors their first direction.
PAIR_Z = 6
#: Columns whose pairs are looked at in one product, and columns of eigenvectors.
PAIR_BLOCK, PAIR_COLUMNS = 512, 1500
#: Factors tried for the first directions.
SCALES = (0.0, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0)
#: Words whose buckets a worker remembers before it starts anew.
REMEMBERED = 300_000
WORD = re.compile(r"[^\W\d_]+")


def buckets_of(word: str) -> tuple[int, ...]:
    terms = [word, *(f"{word[:n]}+" for n in STEMS if len(word) >= n + 2)]
    return tuple(xxhash.xxh32_intdigest(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in terms)


class Terms:
    """The buckets of a text, optionally mapped to a model's columns; remembers words."""

    def __init__(self, columns: dict[int, int] | None = None):
        self.columns, self.words = columns, {}

    def of(self, text: str) -> list[int]:
        if len(self.words) > REMEMBERED:
            self.words.clear()
        found = set()
        for word in set(WORD.findall(text.lower())):
            known = self.words.get(word)
            if known is None:
                known = buckets_of(word)
                if self.columns is not None:
                    known = tuple(self.columns[b] for b in known if b in self.columns)
                self.words[word] = known
            found.update(known)
        return sorted(found)


@dataclass
class Machine:
    """log-odds = bias + w.x + half of (|xV|^2 - sum of x |V|^2) for a 0/1 vector x."""

    columns: dict[int, int]
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def log_odds(self, active: list[int]) -> float:
        v = self.vectors[active]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[active].sum() + 0.5 * (total @ total - (v * v).sum()))


def known_buckets(rows: Sequence[Sequence[int]]) -> dict[int, int]:
    """Column of each bucket that occurs in ``LEAST_DOCUMENTS`` rows; one that is in every row is the bias."""
    ids, n = np.unique(np.concatenate([np.asarray(r, np.int32) for r in rows]), return_counts=True)
    return {int(b): k for k, b in enumerate(ids[(n >= LEAST_DOCUMENTS) & (n < len(rows))])}


class Rows:
    """Documents as columns of active buckets, one after another."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, width: int):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.columns = np.concatenate([*rows, np.empty(0, np.int32)])
        self.labels, self.width = labels, width

    def __len__(self) -> int:
        return len(self.sizes)

    def take(self, at: np.ndarray) -> Rows:
        return Rows([self.columns[self.starts[i]:self.starts[i] + self.sizes[i]] for i in at], self.labels[at], self.width)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Each document's sum of its columns' rows of ``values``."""
        out = np.zeros((len(self), values.shape[1]), np.float32)
        full = np.flatnonzero(self.sizes)
        if len(full):
            out[full] = np.add.reduceat(values[self.columns], self.starts[full], axis=0)
        return out

    def odds(self, bias: float, weights: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        out = []
        for start in range(0, len(self), BATCH):  # a part at a time, as each takes a row of values a column
            part = self.take(np.arange(start, min(start + BATCH, len(self))))
            found = np.concatenate([part.sums(weights[:, None]), part.sums(vectors),
                                    part.sums((vectors ** 2).sum(axis=1, keepdims=True))], axis=1)
            total = found[:, 1:-1]
            out.append(bias + found[:, 0] + 0.5 * ((total * total).sum(axis=1) - found[:, -1]))
        return np.concatenate(out) if out else np.empty(0, np.float32)

    def dense(self, columns: np.ndarray) -> np.ndarray:
        """0/1 matrix of the documents and some columns."""
        place = np.full(self.width, -1)
        place[columns] = np.arange(len(columns))
        at = place[self.columns]
        out = np.zeros((len(self), len(columns)), np.uint8)
        out[np.repeat(np.arange(len(self)), self.sizes)[at >= 0], at[at >= 0]] = 1
        return out


def probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def log_loss(odds: np.ndarray, labels: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(labels > 0, -odds, odds)).mean())


def telling_pairs(rows: Rows, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of columns (i, j) whose common documents the odds misjudge to one side, and the weight that mends it.

    A pair's errors count beyond what the mean errors of its two columns make
    expected.  Their sum over its standard deviation is at most about the root of the
    common documents, so a column of fewer than ``PAIR_Z`` squared documents has none.
    Weights are Newton steps on the pair's weight alone.
    """
    df = np.bincount(rows.columns, minlength=rows.width)
    columns = np.flatnonzero(df >= PAIR_Z ** 2)
    shift = 0.0
    for _ in range(20):  # the bias at which errors add up to nothing
        p = probability(odds + shift)
        shift += float((rows.labels - p).sum() / max((p * (1 - p)).sum(), 1e-9))
    p = probability(odds + shift)
    error = (rows.labels - p).astype(np.float32)
    of = np.repeat(np.arange(len(rows)), rows.sizes)
    mean = np.bincount(rows.columns, error[of], rows.width) / np.maximum(df, 1)
    parts = np.stack([error, error ** 2, (p * (1 - p)).astype(np.float32), np.ones(len(rows), np.float32)])[:, :, None]
    blocks = [columns[k:k + PAIR_BLOCK] for k in range(0, len(columns), PAIR_BLOCK)]
    x = [rows.dense(block) for block in blocks]
    found: list[list[np.ndarray]] = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
    for a, left in enumerate(x):
        moved = (left * parts).transpose(0, 2, 1)
        for b in range(a, len(x)):
            gain, spread, curve, both = moved @ x[b].astype(np.float32)
            gain = gain - both * (mean[blocks[a]][:, None] + mean[blocks[b]][None, :])
            z = np.abs(gain) / np.sqrt(np.maximum(spread, 1e-9))
            i, j = np.nonzero(np.triu(z >= PAIR_Z, 1) if a == b else z >= PAIR_Z)
            for out, part in zip(found, (blocks[a][i], blocks[b][j], gain[i, j] / (curve[i, j] + 1)), strict=True):
                out.append(part)
    return tuple(np.concatenate(f) for f in found)


def leading_vectors(rows: Rows, bias: float, weights: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Vectors to start from: small random ones, and on the telling pairs their weights' leading eigenvectors.

    Off the diagonal the positive part of a pair's weight matrix has half its weight,
    whatever its sign; the diagonal takes no part in the machine.  The eigenvectors are
    scaled by the factor of least loss.
    """
    small = rng.normal(0, START, (rows.width, VECTOR)).astype(np.float32)
    odds = rows.odds(bias, weights, np.zeros((rows.width, VECTOR), np.float32))
    i, j, gain = telling_pairs(rows, odds)
    if not len(i):
        return small
    used = np.unique(np.concatenate([i, j]))
    if len(used) > PAIR_COLUMNS:  # those of the most weight; the rest start small and are learned as all others
        weight = np.bincount(np.concatenate([i, j]), np.concatenate([np.abs(gain)] * 2), rows.width)
        used = np.sort(used[np.argsort(-weight[used], kind="stable")[:PAIR_COLUMNS]])
        kept = np.isin(i, used) & np.isin(j, used)
        i, j, gain = i[kept], j[kept], gain[kept]
    matrix = np.zeros((len(used), len(used)))
    matrix[np.searchsorted(used, i), np.searchsorted(used, j)] = gain
    values, directions = np.linalg.eigh(matrix + matrix.T)
    top = np.argsort(-values)[:VECTOR]
    lead = np.zeros((rows.width, VECTOR), np.float32)
    lead[used, :len(top)] = directions[:, top] * np.sqrt(2 * np.maximum(values[top], 0))
    losses = [(log_loss(rows.odds(bias, weights, lead * np.float32(math.sqrt(f))), rows.labels), f) for f in SCALES]
    return small + lead * np.float32(math.sqrt(min(losses)[1]))


def descend(rows: Rows, steps: int, seed: int, watch: Rows | None = None) -> tuple[float, np.ndarray, np.ndarray, int]:
    """Adagrad on the log loss of mini-batches: weights alone first, then weights and vectors together.

    Returns bias, weights, vectors and the number of joint steps after which the
    documents to ``watch`` had the least loss (all steps without any).
    """
    rng = np.random.default_rng(seed)
    theta = np.zeros((rows.width, 1 + VECTOR), np.float32)
    seen = np.full(theta.shape, SEEN_PAIRS, np.float32)
    seen[:, 0] = SEEN
    decay = np.array([L2] + [L2_PAIRS] * VECTOR, np.float32)
    rates = np.array([RATE] + [RATE_PAIRS] * VECTOR, np.float32)
    bias, seen_bias, order, best = 0.0, SEEN, np.empty(0, np.int64), (np.inf, 0)
    for step in range(LINEAR_STEPS + steps):
        if step == LINEAR_STEPS:
            theta[:, 1:] = leading_vectors(rows, bias, theta[:, 0], rng)
        joint = step >= LINEAR_STEPS
        while len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(rows))])
        batch, order = rows.take(order[:BATCH]), order[BATCH:]
        found = batch.sums(np.concatenate([theta, (theta[:, 1:] ** 2).sum(axis=1, keepdims=True)], axis=1))
        total = found[:, 1:-1]
        odds = bias + found[:, 0] + 0.5 * ((total * total).sum(axis=1) - found[:, -1])
        error = ((probability(odds) - batch.labels) / BATCH).astype(np.float32)
        seen_bias += float(error.sum()) ** 2
        bias -= RATE * float(error.sum()) / np.sqrt(seen_bias)
        if len(batch.columns):
            used = np.flatnonzero(np.bincount(batch.columns, minlength=rows.width))
            pull = np.concatenate([np.ones((BATCH, 1), np.float32), total], axis=1) * error[:, None]
            pull = np.repeat(pull if joint else pull[:, :1], batch.sizes, axis=0)
            slopes = np.zeros((len(used), 1 + VECTOR), np.float32)
            for k in range(pull.shape[1]):
                slopes[:, k] = np.bincount(batch.columns, pull[:, k], rows.width)[used]
            now = theta[used]
            if joint:
                slopes[:, 1:] -= slopes[:, :1] * now[:, 1:]
            slopes += decay * now
            seen[used] += slopes * slopes
            rate = rates / np.sqrt(seen[used])
            now -= rate * slopes
            now[:, 0] = np.sign(now[:, 0]) * np.maximum(np.abs(now[:, 0]) - rate[:, 0] * L1, 0)
            theta[used] = now
        if watch is not None and joint and (step - LINEAR_STEPS + 1) % EVERY == 0:
            loss = log_loss(watch.odds(bias, theta[:, 0], theta[:, 1:]), watch.labels)
            best = min(best, (loss, step - LINEAR_STEPS + 1))
    return bias, theta[:, 0], theta[:, 1:], best[1] if watch is not None else steps


def fit(rows: Sequence[Sequence[int]], labels: list[int], share: float, seed: int = 5) -> Machine:
    """A machine from labelled rows; the bias is moved from the sample's share of label 1 to ``share``.

    How long weights and vectors are learned together is chosen on a fifth of these
    rows that a first run leaves out.
    """
    y = np.asarray(labels, np.float32)
    columns = known_buckets(rows)
    known = np.array(sorted(columns), np.int64)  # columns are numbered in this order
    found = []
    for row in rows:
        at = np.searchsorted(known, row)
        at[at == len(known)] = 0
        found.append(at[known[at] == row].astype(np.int32) if len(known) and len(row) else np.empty(0, np.int32))
    data = Rows(found, y, len(columns))
    order = np.random.default_rng(seed).permutation(len(data))
    part = len(data) // 5
    steps = STEPS
    if part and len(set(y[order[:part]])) == 2 and len(set(y[order[part:]])) == 2:
        steps = descend(data.take(order[part:]), STEPS, seed, data.take(order[:part]))[3]
    bias, weights, vectors, _ = descend(data, steps, seed)
    sampled = float(y.mean())
    shift = np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))
    return Machine(columns, float(bias + shift), weights, vectors)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id",
          text_col: str = "text") -> Machine | None:
    sample, share = training_sample(docs, labels, "toxic", FOLDS, HELD_OUT, per_class, id_col, text_col)
    if share is None:
        return None

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            found = [terms.of(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"),
                                              pa.array(found, pa.list_(pa.int32()))], names=["key", "label", "terms"])

    keyed = sample.select(F.xxhash64("doc_id").alias("key"), "label", "text")
    table = keyed.mapInArrow(hashed, "key long, label int, terms array<int>").toArrow()  # 2 * per_class at most
    order = np.argsort(table.column("key").to_numpy(), kind="stable")
    labels_of = table.column("label").to_numpy()[order]
    if len(set(labels_of.tolist())) < 2:
        return None
    terms = table.column("terms").combine_chunks()
    starts, members = terms.offsets.to_numpy(), terms.values.to_numpy()
    return fit([members[starts[i]:starts[i + 1]] for i in order], labels_of.tolist(), share)


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    docs = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("__text"))
    schema = StructType([docs.schema["doc_id"]]).add("score", DoubleType())

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(machine.columns) if machine else None
        for batch in batches:
            odds = np.array([machine.log_odds(terms.of(t.as_py())) if machine else -np.inf
                             for t in batch.column("__text")], np.float64)
            probability = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(probability * np.isfinite(odds))], names=schema.names)

    return docs.mapInArrow(scored, schema).select(
        "doc_id", (label_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
