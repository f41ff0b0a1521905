"""Ranked lexical search over posting lists cut into geometric blocks with exact bounds.

Documents are weighed against the terms that the queries ask for, sorted by weighted
min-hashes of their weight vectors (alike vectors stand together) and taken in
neighbourhoods.  Inside a neighbourhood each term's posting list is clustered by document
similarity: every document goes to the most similar of some documents of the list.  Such a
block stores its documents and the coordinatewise maximum of their weights, rounded up, for
all terms that some query holds together with the block's term.  The inner product of a
query and that summary is at least the score of every document of the block.

A search first reads for each query the ``FIRST_BLOCKS`` blocks of the greatest bounds and
scores their documents; the score at rank k is a threshold that the final one can't be
below.  Then every block is skipped whose bound is below its query's threshold, and so are
lists whose greatest contributions together stay below it.  Documents of all other blocks
are scored in full.  A document that belongs to the result is in no skipped block, so the
ranking is exact, ties included.

Queries are answered in batches of about ``BATCH_TERMS`` (query, term) pairs; vocabulary and
query weights of a batch are what tasks and the driver hold, however many documents there
are.  Lists, blocks and scores never leave the executors, but for one threshold per query.

Terms are maximal runs of characters other than ASCII ones that aren't letters or digits; of
the whole text, only A-Z lower-cased.  Null has none.  Documents without terms count for no
statistic and are never found; a query without terms finds nothing.  Equal scores are
ordered by id, null last; of repeated rows and queries each has its own rank or ranking.
Empty tables give an empty result.  Other input columns take no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from demandlens.llm.common import materialize, text_or_empty

TOP = 50
#: (query, term) pairs of a batch of queries, about.
BATCH_TERMS = 200_000
#: Documents of a neighbourhood, and of a block on average where a list has that many in it.
NEIGHBOURS, BLOCK = 2048, 48
#: Cells of a neighbourhood's weight matrix; wider vocabularies get smaller neighbourhoods.
CELLS = 1 << 24
SIGNATURE, SEED = 3, 13
INTS = ArrayType(IntegerType())
#: A summary's unit: weights are below 1,000,000 and are rounded up to one of 245 steps.
STEP = 4096
#: Blocks of each query that are scored for its first threshold.
FIRST_BLOCKS = 8
#: Every byte that ends a term becomes a space, and A-Z become a-z.
TABLE = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20
              for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split()


@dataclass
class Queries:
    """A batch of queries: distinct terms of each, as columns of the batch's vocabulary."""

    numbers: list[int]
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]

    def together(self) -> list[np.ndarray]:
        """For each term the sorted terms that some query holds together with it."""
        found: list[list[np.ndarray]] = [[] for _ in self.vocabulary]
        for terms in self.terms:
            for t in terms.tolist():
                found[t].append(terms)
        return [np.unique(np.concatenate(f)) for f in found]

    def holding(self) -> list[list[int]]:
        """For each term the places of the queries that hold it."""
        out: list[list[int]] = [[] for _ in self.vocabulary]
        for place, terms in enumerate(self.terms):
            for t in terms.tolist():
                out[t].append(place)
        return out


@dataclass
class Index:
    """Weighed documents (``__row``, doc_id, terms, weights), their blocks, and the lists' weights and maxima."""

    weighed: DataFrame
    blocks: DataFrame
    weights: np.ndarray
    maxima: np.ndarray


def counted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (all terms of the text), and the vocabulary's ``terms`` in it with their occurrences ``tf``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("__text"))
    schema = StructType([docs.schema["doc_id"]]).add("n", "long").add("terms", INTS).add("tf", INTS)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, tf = [], [], []
            for text in batch.column("__text"):
                words = terms_of(text.as_py())
                found = sorted((vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary)
                n.append(len(words))
                terms.append([t for t, _ in found])
                tf.append([c for _, c in found])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, ints),
                                              pa.array(tf, ints)], names=schema.names)

    return docs.mapInArrow(count, schema)


def lists_of(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, ...]:
    """Sizes of a batch's lists and the members of each named list column."""
    columns = [batch.column(n) for n in names]
    sizes = np.diff(columns[0].offsets.to_numpy()).astype(np.int64)
    return sizes, *(c.flatten().to_numpy() for c in columns)


def lists(members: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(members, kind))


def weigh(rows: DataFrame, documents: int, length: int, weights: np.ndarray) -> DataFrame:
    """``rows`` with their terms' weights and the signature of the weight vector, without rows that hold no term."""
    rows = rows.where(F.size("terms") > 0)
    schema = StructType([rows.schema["__row"], rows.schema["doc_id"], rows.schema["terms"]]).add("weights", INTS)
    for k in range(SIGNATURE):
        schema = schema.add(f"s{k}", IntegerType())

    def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = np.random.default_rng(SEED).exponential(size=(SIGNATURE, len(weights)))
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, terms, tf = lists_of(batch, "terms", "tf")
            m = 50 + 50 * batch.column("n").to_numpy() * documents // length
            tf = tf.astype(np.int64)
            x = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, sizes))
            part = weights[terms] * x + 1e-9
            starts = np.cumsum(sizes) - sizes
            signature = []
            for draw in draws:
                # the least of exponential draws over weights picks a term with probability as its weight
                drawn = draw[terms] / part
                least = drawn == np.repeat(np.minimum.reduceat(drawn, starts), sizes)
                signature.append(np.maximum.reduceat(np.where(least, terms, -1), starts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__row"), batch.column("doc_id"), batch.column("terms"), lists(x, sizes, pa.int32()),
                 *(pa.array(s, pa.int32()) for s in signature)], names=schema.names)

    return rows.mapInArrow(weighed, schema)


def clusters(vectors: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of a list's documents by the most similar of evenly spaced ones; long lists get fewer, larger blocks."""
    k = round(math.sqrt(len(vectors) / size)) if len(vectors) > size else 1
    if k <= 1:
        return [np.arange(len(vectors))]
    v = vectors.astype(np.float32)
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    centers = v[np.linspace(0, len(v) - 1, k).astype(np.int64)]
    nearest = (v @ centers.T).argmax(axis=1)
    return [found for c in range(k) if len(found := np.flatnonzero(nearest == c))]


def block_up(weighed: DataFrame, queries: Queries, neighbours: int = NEIGHBOURS, size: int = BLOCK) -> DataFrame:
    """(term, docs, coords, maxima): the blocks of every posting list; maxima are in ``STEP``s, rounded up."""
    order = [f"s{k}" for k in range(SIGNATURE)] + ["__row"]
    near = weighed.repartitionByRange(*order).sortWithinPartitions(*order).select("__row", "terms", "weights")
    together, width = queries.together(), len(queries.vocabulary)

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.empty(width, np.int64)
        for whole in batches:
            start = 0
            while start < whole.num_rows:
                batch = whole.slice(start, neighbours)
                sizes, terms, x = lists_of(batch, "terms", "weights")
                used = np.unique(terms)
                if len(used) * batch.num_rows > CELLS and batch.num_rows > 1:
                    batch = batch.slice(0, max(1, CELLS // len(used)))
                    sizes, terms, x = lists_of(batch, "terms", "weights")
                    used = np.unique(terms)
                start += batch.num_rows
                at[used] = np.arange(len(used))
                matrix = np.zeros((batch.num_rows, len(used)), np.uint8)
                matrix[np.repeat(np.arange(batch.num_rows), sizes), at[terms]] = -(-x // STEP)
                present = np.zeros(width, bool)
                present[used] = True
                ids = batch.column("__row").to_numpy()
                out: tuple[list, ...] = ([], [], [], [])
                for column, term in enumerate(used.tolist()):
                    rows = np.flatnonzero(matrix[:, column])
                    coords = together[term][present[together[term]]]
                    vectors = matrix[rows[:, None], at[coords]]
                    for members in clusters(vectors, size):
                        top = vectors[members].max(axis=0)
                        out[0].append(term)
                        out[1].append(ids[rows[members]])
                        out[2].append(coords[top > 0])
                        out[3].append(top[top > 0])
                docs, coords, maxima = (lists(np.concatenate(part), np.array([len(p) for p in part]), kind)
                                        for part, kind in zip(out[1:], (pa.int64(), pa.int32(), pa.int16()), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), docs, coords, maxima],
                                                 names=["term", "docs", "coords", "maxima"])

    return near.mapInArrow(blocks, "term int, docs array<long>, coords array<int>, maxima array<short>")


def build_index(docs: DataFrame, queries: Queries, id_col: str = "doc_id", text_col: str = "text",
                neighbours: int = NEIGHBOURS, size: int = BLOCK) -> Index | None:
    """The index of all documents for a batch's terms, or None if no document has a term."""
    rows = materialize(counted(docs, queries.vocabulary, id_col, text_col)
                       .withColumn("__row", F.monotonically_increasing_id()), "search-counted")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    if not total.documents:
        return None
    weights = np.zeros(len(queries.vocabulary), np.int64)
    df = rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    for r in df.collect():  # a row for each term of the batch, at most
        weights[r.t] = math.floor(1000 * math.log((2 * total.documents + 2) / (2 * r.df + 1)))
    weighed = materialize(weigh(rows, total.documents, total.length, weights), "search-weighed")
    maxima = np.zeros(len(weights), np.int64)
    each = weighed.select(F.inline(F.arrays_zip("terms", "weights")))
    for r in each.groupBy("terms").agg(F.max("weights").alias("most")).collect():  # as above
        maxima[r.terms] = r.most
    blocks = materialize(block_up(weighed, queries, neighbours, size), "search-blocks")
    return Index(weighed, blocks, weights, maxima)


class Scorer:
    """Inner products of the queries of a batch with sparse vectors."""

    def __init__(self, queries: Queries, weights: np.ndarray):
        self.scratch = np.zeros(len(weights), np.int64)
        self.holding = [np.array(h, np.int64) for h in queries.holding()]
        self.terms, self.weights = queries.terms, [weights[t] for t in queries.terms]
        self.known: dict[int, tuple[np.ndarray, ...]] = {}
        self.every = self.joined(np.arange(len(queries.terms)))

    def joined(self, places: np.ndarray) -> tuple[np.ndarray, ...]:
        terms = [self.terms[p] for p in places.tolist()]
        sizes = np.array([len(t) for t in terms], np.int64)
        return (places, np.concatenate(terms), np.concatenate([self.weights[p] for p in places.tolist()]),
                np.cumsum(sizes) - sizes)

    def products(self, coords: np.ndarray, values: np.ndarray, term: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the queries (of those that hold ``term``) and their products with a vector."""
        if term is None:
            places, terms, weights, starts = self.every
        else:
            if term not in self.known:
                self.known[term] = self.joined(self.holding[term])
            places, terms, weights, starts = self.known[term]
        self.scratch[coords] = values
        out = np.add.reduceat(weights * self.scratch[terms], starts)
        self.scratch[coords] = 0
        return places, out


def block_bounds(batch: pa.RecordBatch, scorer: Scorer) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each block the places of the queries that hold its term, and their bounds."""
    sizes, coords, maxima = lists_of(batch, "coords", "maxima")
    maxima = maxima.astype(np.int64) * STEP
    ends = np.cumsum(sizes).tolist()
    for term, start, end in zip(batch.column("term").to_pylist(), [0, *ends], ends, strict=False):
        yield scorer.products(coords[start:end], maxima[start:end], term)


def best_blocks(index: Index, queries: Queries, most: int) -> DataFrame:
    """(q, docs) of the ``most`` blocks of each query with the greatest bounds."""
    weights = index.weights

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(queries, weights)
        least = np.zeros(len(queries.terms), np.int64)  # of the kept blocks, once there are enough
        kept: list[list[tuple[int, list[int]]]] = [[] for _ in queries.terms]
        for batch in batches:
            docs = batch.column("docs")
            for i, (places, bounds) in enumerate(block_bounds(batch, scorer)):
                for p in np.flatnonzero(bounds > least[places]).tolist():
                    q = int(places[p])
                    kept[q].append((int(bounds[p]), docs[i].as_py()))
                    if len(kept[q]) > most:
                        kept[q].sort(key=lambda b: -b[0])
                        del kept[q][most:]
                        least[q] = kept[q][-1][0]
        rows = [(q, bound, members) for q, found in enumerate(kept) for bound, members in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["q", "bound", "docs"])

    found = index.blocks.mapInArrow(best, "q int, bound long, docs array<long>")
    order = Window.partitionBy("q").orderBy(F.desc("bound"), F.col("docs")[0])
    return found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= most).select("q", "docs")


def left_blocks(index: Index, queries: Queries, thresholds: np.ndarray) -> DataFrame:
    """(__row, word, bits): the documents of all blocks that can't be skipped, with their queries as bits."""
    weights, maxima = index.weights, index.maxima
    needed = np.maximum(thresholds, 1)
    # a query's lists of the least contributions that together stay below its threshold
    spare = []
    for terms, least in zip(queries.terms, needed.tolist(), strict=True):
        part = weights[terms] * maxima[terms]
        order = np.argsort(part, kind="stable")
        spare.append(set(terms[order[np.cumsum(part[order]) < least]].tolist()))

    def left(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(queries, weights)
        asking = [np.array([t not in spare[q] for q in held.tolist()], bool) for t, held in enumerate(scorer.holding)]
        for batch in batches:
            docs, terms = batch.column("docs"), batch.column("term").to_pylist()
            offsets, members = docs.offsets.to_numpy(), docs.values.to_numpy()
            out: tuple[list, ...] = ([], [], [])
            for i, (places, bounds) in enumerate(block_bounds(batch, scorer)):
                stay = places[(bounds >= needed[places]) & asking[terms[i]]]
                if len(stay):
                    block = members[offsets[i]:offsets[i + 1]]
                    for word in np.unique(stay // 63).tolist():
                        bits = sum(1 << (p % 63) for p in stay[stay // 63 == word].tolist())
                        out[0].append(block)
                        out[1].append(np.full(len(block), word, np.int32))
                        out[2].append(np.full(len(block), bits, np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["__row", "word", "bits"])

    found = index.blocks.mapInArrow(left, "__row long, word int, bits long")
    return found.groupBy("__row", "word").agg(F.bit_or("bits").alias("bits"))


def scored(index: Index, asked: DataFrame, queries: Queries, thresholds: np.ndarray) -> DataFrame:
    """(q, __row, doc_id, score) of the asked (__row, word, bits) whose score is above 0 and not below the threshold."""
    asked = asked.groupBy("__row").agg(F.collect_list(F.struct("word", "bits")).alias("asked"))  # a few words each
    rows = index.weighed.select("__row", "doc_id", "terms", "weights").join(asked, "__row").select(
        "__row", "doc_id", "terms", "weights", F.col("asked.word").alias("word"), F.col("asked.bits").alias("bits"))
    weights, needed = index.weights, np.maximum(thresholds, 1)
    schema = StructType([rows.schema["__row"], rows.schema["doc_id"]]).add("q", IntegerType()).add("score", "long")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(queries, weights)
        for batch in batches:
            sizes, terms, x = lists_of(batch, "terms", "weights")
            counts, words, bits = lists_of(batch, "word", "bits")
            ends, asked_ends = np.cumsum(sizes).tolist(), np.cumsum(counts).tolist()
            take, found, scores = [], [], []
            for i, (start, end, a, b) in enumerate(zip([0, *ends], ends, [0, *asked_ends], asked_ends, strict=False)):
                _, got = scorer.products(terms[start:end], x[start:end])
                wanted = np.zeros(len(got), bool)
                for word, mask in zip(words[a:b].tolist(), bits[a:b].tolist(), strict=True):
                    part = wanted[word * 63:word * 63 + 63]
                    part |= (mask >> np.arange(len(part)) & 1).astype(bool)
                good = np.flatnonzero(wanted & (got >= needed))
                take.append(np.full(len(good), i))
                found.append(good)
                scores.append(got[good])
            if take:
                at = pa.array(np.concatenate(take))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__row").take(at), batch.column("doc_id").take(at),
                     pa.array(np.concatenate(found), pa.int32()), pa.array(np.concatenate(scores), pa.int64())],
                    names=schema.names)

    return rows.mapInArrow(score, schema)


def ranked(scores: DataFrame, top: int) -> DataFrame:
    """The ``top`` best rows of each query, with their rank."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "__row")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def answer(index: Index, queries: Queries, top: int = TOP, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """(q, rank, doc_id, score): the exact ranking of each query of a batch."""
    none = np.zeros(len(queries.terms), np.int64)
    word = F.expr("q div 63").cast("int")
    first = (best_blocks(index, queries, first_blocks)
             .select(F.explode("docs").alias("__row"), word.alias("word"), F.expr("shiftleft(1L, q % 63)").alias("bits"))
             .groupBy("__row", "word").agg(F.bit_or("bits").alias("bits")))
    thresholds = none.copy()
    # one number for each query of the batch
    for r in ranked(scored(index, first, queries, none), top).where(F.col("rank") == top).select("q", "score").collect():
        thresholds[r.q] = r.score
    found = scored(index, left_blocks(index, queries, thresholds), queries, thresholds)
    return ranked(found, top).select("q", "rank", "doc_id", "score")


def query_batches(items: DataFrame, text_col: str, batch_terms: int) -> Iterator[Queries]:
    """Queries with at least one term, in batches; ``items`` are numbered by ``__q``."""
    schema = "__q long, terms array<binary>"

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t.as_py()))) for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays([batch.column("__q"), pa.array(terms, pa.list_(pa.binary()))], names=["__q", "terms"])

    held = items.select("__q", text_or_empty(text_col).alias("__text")).mapInArrow(found, schema).where(F.size("terms") > 0)
    held = materialize(held, "search-queries")
    pairs = held.agg(F.sum(F.size("terms"))).first()[0] or 0
    batches = -(-pairs // batch_terms)
    for b in range(batches):
        rows = held.where(F.pmod(F.xxhash64("__q"), F.lit(batches)) == b).orderBy("__q").collect()  # batch_terms pairs, about
        if rows:
            known = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
            yield Queries([r["__q"] for r in rows], known,
                          [np.array([known[bytes(t)] for t in r.terms], np.int64) for r in rows])


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", batch_terms: int = BATCH_TERMS,
           neighbours: int = NEIGHBOURS, size: int = BLOCK, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` documents."""
    items = materialize(items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
                        .withColumn("__q", F.monotonically_increasing_id()), "search-items")
    spark, out = docs.sparkSession, None
    for queries in query_batches(items, "text", batch_terms):
        index = build_index(docs, queries, id_col, text_col, neighbours, size)
        if index is None:
            break
        numbers = spark.createDataFrame(list(enumerate(queries.numbers)), "q int, __q long")
        part = materialize(answer(index, queries, top, first_blocks).join(F.broadcast(numbers), "q").drop("q"), "search-answer")
        out = part if out is None else out.unionByName(part)
    if out is None:
        doc_type = docs.schema[id_col].dataType
        out = spark.createDataFrame([], StructType().add("__q", "long").add("rank", IntegerType()).add("doc_id", doc_type)
                                    .add("score", "long"))
    return out.join(items.select("__q", "item_id"), "__q").select("item_id", "rank", "doc_id", "score")
