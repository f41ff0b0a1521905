"""Quality by a byte-level convolutional network in numpy.

Every byte has a learned vector.  ``FILTERS`` learned filters look at ``WIDTH``
bytes at a time, every ``STRIDE`` bytes.  A text is covered by chunks of
``CHUNK`` bytes, each overlapping the next by half; a filter's largest response in a
chunk is the chunk's feature.  Over all chunks the features' largest and mean
values enter one logistic unit, which gives the document's probability.

The filters learn by back-propagation from chunks of a bounded sample of labelled
documents (``PER_CLASS`` of each class, ``CHUNKS`` chunks of each), the last unit
from the same documents' whole texts.  Scoring reads whole texts in one pass
without a shuffle.

A null text counts as empty; an empty text has no response, so its score is the
bias's.  Without labelled documents of both classes there is nothing to learn and
every score is 0.5.  Repeated rows get equal scores.  An empty table gives an empty
result.  Only ids and texts are read; labels, language and source never enter a
score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from demandlens.llm.common import label_fold, text_or_empty
from demandlens.llm.labelled import training_sample

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Labelled documents of each class to learn from, at most, and chunks of each for the filters.
PER_CLASS, CHUNKS = 1_500, 4
EMBED, FILTERS = 8, 16
STRIDE, WIDTH, CHUNK = 4, 8, 512
HALF = CHUNK // 2 // STRIDE  # filter positions in half a chunk
PASSES, BATCH, RATE = 8, 64, 0.004


@dataclass
class Network:
    embed: np.ndarray  # 256 x EMBED
    near: np.ndarray  # STRIDE * EMBED x FILTERS: the filter's first half
    far: np.ndarray  # the same for its second half
    bias: np.ndarray
    out: np.ndarray | None = None  # weights of the last unit, its bias last
    center: np.ndarray | None = None
    spread: np.ndarray | None = None

    def responses(self, text: bytes) -> np.ndarray:
        """Each filter's response at each position; no position for an empty text."""
        codes = np.frombuffer(text, np.uint8)
        steps = -(-len(codes) // STRIDE)
        if not steps:
            return np.zeros((0, FILTERS), np.float32)
        seen = np.zeros(((steps + 1) * STRIDE, EMBED), np.float32)  # beyond the end: zero vectors
        np.take(self.embed, codes, axis=0, out=seen[:len(codes)])
        groups = seen.reshape(steps + 1, STRIDE * EMBED)
        out = groups[:-1] @ self.near
        out += groups[1:] @ self.far
        out += self.bias
        return np.maximum(out, 0, out=out)

    def pooled(self, text: bytes) -> np.ndarray:
        """Largest response over all chunks, then the mean of the chunks' largest responses."""
        r = self.responses(text)
        if not len(r):
            return np.zeros(2 * FILTERS, np.float32)
        halves = np.maximum.reduceat(r, np.arange(0, len(r), HALF), axis=0)
        chunks = np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves
        return np.concatenate([chunks.max(axis=0), chunks.mean(axis=0)])

    def probability(self, text: bytes) -> float:
        x = (self.pooled(text) - self.center) / self.spread
        odds = float(x @ self.out[:-1] + self.out[-1])
        return float(1 / (1 + np.exp(-np.clip(odds, -700, 700))))


class Adam:
    def __init__(self, parameters: list[np.ndarray], rate: float):
        self.parameters, self.rate, self.step = parameters, rate, 0
        self.first = [np.zeros_like(p) for p in parameters]
        self.second = [np.zeros_like(p) for p in parameters]

    def update(self, slopes: list[np.ndarray]) -> None:
        self.step += 1
        for p, g, a, b in zip(self.parameters, slopes, self.first, self.second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= self.rate * (a / (1 - 0.9 ** self.step)) / (np.sqrt(b / (1 - 0.999 ** self.step)) + 1e-8)


def fit_filters(chunks: list[bytes], labels: list[int], seed: int = 3) -> Network:
    """Back-propagation through max-pooling: only the strongest position of each filter passes a slope back."""
    rng = np.random.default_rng(seed)
    codes = np.zeros((len(chunks), CHUNK + STRIDE), np.int64)
    steps = np.array([-(-len(c) // STRIDE) for c in chunks])
    present = np.zeros((len(chunks), CHUNK + STRIDE, 1), np.float32)
    for i, c in enumerate(chunks):
        codes[i, :len(c)], present[i, :len(c)] = np.frombuffer(c, np.uint8), 1
    y = np.asarray(labels, np.float32)
    wide = STRIDE * EMBED
    embed, near, far, bias, head, base = (
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, 0.2, (wide, FILTERS)).astype(np.float32),
        rng.normal(0, 0.2, (wide, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.2, FILTERS).astype(np.float32), np.zeros(1, np.float32))
    adam = Adam([embed, near, far, bias, head, base], RATE)
    places = CHUNK // STRIDE
    filters = np.arange(FILTERS)
    for _ in range(PASSES):
        order = rng.permutation(len(chunks))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            n = len(pick)
            rows = np.arange(n)[:, None]
            groups = (embed[codes[pick]] * present[pick]).reshape(n, places + 1, wide)
            r = groups[:, :-1] @ near + groups[:, 1:] @ far + bias
            r[np.arange(places)[None, :] >= steps[pick][:, None]] = -np.inf  # beyond the chunk's end
            best = r.argmax(axis=1)
            top = np.maximum(r[rows, best, filters], 0)
            odds = top @ head + base[0]
            error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y[pick]) / n
            slope = error[:, None] * head[None, :] * (top > 0)
            seen, after = groups[rows, best], groups[rows, best + 1]  # n x FILTERS x wide
            back = np.zeros_like(embed)
            for half, weights in ((0, near), (1, far)):
                at_bytes = ((best + half) * STRIDE)[:, :, None] + np.arange(STRIDE)
                which = codes[pick][rows[:, :, None], at_bytes]
                share = (slope[:, :, None] * weights.T[None]).reshape(n, FILTERS, STRIDE, EMBED)
                share = share * present[pick][rows[:, :, None], at_bytes]
                np.add.at(back, which.reshape(-1), share.reshape(-1, EMBED))
            adam.update([back, np.einsum("nf,nfw->wf", slope, seen), np.einsum("nf,nfw->wf", slope, after),
                         slope.sum(axis=0), top.T @ error, np.array([error.sum()], np.float32)])
    return Network(embed, near, far, bias)


def fit_last(network: Network, pooled: np.ndarray, labels: np.ndarray, share: float) -> Network:
    """The last unit on standardised document features, by Newton steps with a ridge; then the prior is moved."""
    x, y = pooled.astype(np.float64), labels.astype(np.float64)
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = np.hstack([(x - center) / spread, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], 0.5)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        w -= np.linalg.solve(curve, slope)
    sampled = y.mean()
    w[-1] += np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))
    return Network(network.embed, network.near, network.far, network.bias, w, center, spread)


def chunk_starts(size: int, key: bytes) -> list[int]:
    """Up to ``CHUNKS`` starts of half-overlapping chunks, drawn by the document's hash."""
    all_starts = list(range(0, max(size - CHUNK // 2, 1), CHUNK // 2))
    return sorted(all_starts, key=lambda s: xxhash.xxh64_intdigest(key + s.to_bytes(8, "little")))[:CHUNKS]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id",
          text_col: str = "text") -> Network | None:
    sample, share = training_sample(docs, labels, "quality", FOLDS, HELD_OUT, per_class, id_col, text_col)
    if share is None:
        return None
    sample = sample.select(F.xxhash64("doc_id").alias("key"), "label", "text").persist()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, label, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for start in chunk_starts(len(data), key.to_bytes(8, "little", signed=True)) if data else []:
                    rows.append((key, start, label, data[start:start + CHUNK]))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["key", "start", "label", "chunk"])

    chunks = sample.mapInArrow(cut, "key long, start long, label int, chunk binary").collect()  # bounded sample
    chunks.sort(key=lambda r: (r["key"], r["start"]))
    if len({r["label"] for r in chunks}) < 2:
        return None
    filters = fit_filters([bytes(r["chunk"]) for r in chunks], [r["label"] for r in chunks])

    def pool(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [filters.pooled(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"),
                                              pa.array(found, pa.list_(pa.float32()))], names=["key", "label", "x"])

    rows = sample.mapInArrow(pool, "key long, label int, x array<float>").collect()  # 2 * per_class at most
    sample.unpersist()
    rows.sort(key=lambda r: r["key"])
    return fit_last(filters, np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]), share)


def score(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    docs = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("__text"))
    schema = StructType([docs.schema["doc_id"]]).add("score", DoubleType())

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = [network.probability(t.as_py().encode("utf-8", "surrogatepass")) if network else 0.5
                 for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], names=schema.names)

    return docs.mapInArrow(scored, schema).select(
        "doc_id", (label_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
