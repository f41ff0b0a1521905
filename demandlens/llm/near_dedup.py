"""Near-duplicate groups: MinHash bands find candidates, odd sketches and full sets confirm them.

A document's set holds its distinct shingles (two words, or ``width``) as 64-bit
hashes; a shorter text is its only shingle.  Documents
with equal sets form one class; everything up to the last step works on classes, so
thousands of copies cost as much as one.  A class has ``SAMPLES`` MinHash samples.
``BANDS`` bands of ``ROWS`` samples give its buckets: two sets of similarity 0.8
share one with probability 1 - 7e-6.  The odd sketch is folded from the set's
bottom samples, its smallest hashes: below a threshold that halves for every
doubling of the set, so that 256 to 1,024 remain (a smaller set counts whole).
Every sample flips one bit of a bitmap of ``SKETCH_BITS``; the population count of
two bitmaps' XOR estimates how many samples are in one set only, most precisely
at high similarity.  Candidates that differ by ``DEVIATIONS`` standard deviations
more than the similarity allows are dropped; all others are confirmed on full sets.

In a bucket pairs aren't all formed.  First every class is compared with the bucket's first.
Then only buckets go on whose other classes are still in different components, cut into
blocks (``blocks``); a task compares the sketches of two blocks and gives each class outside
the bucket's largest component its ``FIRST`` most similar partners of other components that the
sketches leave open.  Just classes with more go on, with the partners they have not been given, and get
``GROWTH`` times as many in the next round.  When no class has a partner left, pairs not compared in full are
inside one component already or excluded by their sketches, so the components are those of
all links.  Links are joined to components by alternating large-star and small-star steps
over written tables.

Sets, links and components never leave the executors.  An empty or null text, or
one of white space, has an empty set and is linked with nothing.  Of each component
the smallest id stays (null last); of repeated rows with one id exactly one.  An empty table gives an empty result.  Other input
columns take no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from demandlens.llm import blocks
from demandlens.llm.blocks import Test, deal, list_rows, open_members, split_found
from demandlens.llm.common import materialize, text_or_empty

#: Words of a shingle.
WIDTH = 2
BANDS, ROWS = 30, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS, SKETCH_WORDS = 1024, 16
SKETCH_SAMPLES = 512
DEVIATIONS = 5
#: Allowed for the rounding of numbers of samples in doubles.
ROUNDING = 1e-6
#: Classes that are one block, partners that a class is given at first, and by how much more in each round.
BLOCK, FIRST, GROWTH = 512, 2, 8
SEED = 20_240_229
#: Rows of ids (up to 60 bytes each) up to which such a table is broadcast; else it is a shuffle join.
MAX_BROADCAST_ROWS = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``width`` words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    count = len(hashes) - min(width, len(hashes)) + 1
    out = hashes[:count]
    for i in range(1, min(width, len(hashes))):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + mixed(hashes[i:i + count]))
    return np.unique(out)


def minhash(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The smallest value of each of len(seeds) scrambles over the set."""
    out = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 512):
        part = (hashes[i:i + 512, None] ^ seeds[None, :]) * np.uint64(0xD6E8FEB86659FD93)
        part ^= part >> np.uint64(32)
        part *= seeds[None, :] | np.uint64(1)
        np.minimum(out, part.min(axis=0), out=out)
    return out


def bands_of(samples: np.ndarray) -> np.ndarray:
    out = np.arange(BANDS, dtype=np.uint64)
    for row in samples.reshape(BANDS, ROWS).T:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + row)
    return out


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the bottom samples at a level and the next, then the level and both sample counts.

    At level l a hash counts if its first l bits are zero.  Sets whose sizes are
    within a factor of two have a level in common.
    """
    drawn = mixed(hashes ^ np.uint64(0xA24BAED4963EE407))
    level = max(0, (len(hashes) // SKETCH_SAMPLES).bit_length() - 1)
    words, counts = [], []
    for at in (level, level + 1):
        kept = drawn[(drawn >> np.uint64(64 - at)) == 0] if at else drawn
        odd = np.bincount((kept % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) % 2 == 1
        words.append(np.packbits(odd).view(np.int64))
        counts.append(len(kept))
    return np.concatenate([*words, np.array([level, *counts], np.int64)])


def sketch_seeds() -> np.ndarray:
    """Seeds of the samples."""
    return np.random.default_rng(SEED).integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def signatures(docs: DataFrame, id_col: str, text_col: str, carry: list[str], width: int = WIDTH) -> DataFrame:
    """doc_id and ``carry`` with n, a digest of the set, its bands and its sketch."""
    docs = docs.select(F.col(id_col).alias("doc_id"), *carry, text_or_empty(text_col).alias("__text"))
    kept = [f for f in docs.schema if f.name != "__text"]
    schema, longs = StructType(list(kept)), ArrayType(LongType())
    for name, kind in (("n", "long"), ("key", "binary"), ("bands", longs), ("sketch", longs)):
        schema = schema.add(name, kind)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = sketch_seeds()
        for batch in batches:
            n, keys, bands, sketches = [], [], [], []
            for text in batch.column("__text"):
                s = shingles(text.as_py(), width)
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                samples = minhash(s, seeds) if len(s) else None
                bands.append(None if samples is None else bands_of(samples).view(np.int64))
                sketches.append(None if samples is None else odd_sketch(s))
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                       pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(sign, schema)


def bounded(table: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted rows are within the bound."""
    return F.broadcast(table) if table.count() <= MAX_BROADCAST_ROWS else table


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """node and hashes of each class in ``wanted`` (node, id, key, rows), from its document's text.

    Only a class of several rows can come out more than once; just those are shuffled.
    """
    texts = (docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
             .join(bounded(wanted.select("node", "id", "key", "rows")), F.col("__id").eqNullSafe(F.col("id")))
             .select("node", "key", "rows", "__text"))

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, rows, hashes = [], [], []
            for node, key, n, text in zip(*(batch.column(c) for c in ("node", "key", "rows", "__text")), strict=True):
                s = shingles(text.as_py(), width)
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == key.as_py():
                    nodes.append(node.as_py())
                    rows.append(n.as_py())
                    hashes.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(rows, pa.int64()),
                                              pa.array(hashes, pa.list_(pa.int64()))], names=["node", "rows", "hashes"])

    found = materialize(texts.mapInArrow(expand, "node long, rows long, hashes array<long>"), "near-sets")
    # by a narrow number first, as whole sets of a row that repeats a lot should not travel
    several = found.where("rows > 1").withColumn("place", F.monotonically_increasing_id())
    first = several.groupBy("node").agg(F.min("place").alias("first"))
    several = several.join(bounded(first.select(F.col("first").alias("place"))), "place", "left_semi")
    return found.where("rows = 1").select("node", "hashes").union(several.select("node", "hashes"))


def most_flips(total: Column, level: Column, percent: int) -> Column:
    """XOR population count up to which sets with ``total`` samples together may reach the similarity.

    Sets of similarity t differ in (1 - t) / (1 + t) of their samples.  To that is
    added the deviation of sampling (none at level 0, where the sample is the set),
    and to the flips expected for it the deviation of bits that are hit twice.  There are
    never more flips than samples that differ.
    """
    apart = (100 - percent) / (100 + percent)
    differ = apart * total + F.when(level > 0, DEVIATIONS * 0.5 * F.sqrt(total * apart)).otherwise(0.0)
    expected = SKETCH_BITS / 2 * (1 - F.exp(-2.0 * differ / SKETCH_BITS))
    return F.least(expected + DEVIATIONS * differ / math.sqrt(SKETCH_BITS / 2) + 1, differ + ROUNDING)


def may_reach(a: Column, b: Column, percent: int) -> Column:
    """Whether two odd sketches leave it open that their sets reach the similarity."""
    level_a, level_b = a[2 * SKETCH_WORDS], b[2 * SKETCH_WORDS]
    level = F.greatest(level_a, level_b)
    up_a, up_b = (level - level_a).cast("int"), (level - level_b).cast("int")
    words = [F.bit_count(a[up_a * SKETCH_WORDS + i].bitwiseXOR(b[up_b * SKETCH_WORDS + i]))
             for i in range(SKETCH_WORDS)]
    total = (a[up_a + 2 * SKETCH_WORDS + 1] + b[up_b + 2 * SKETCH_WORDS + 1]).cast("double")
    return (F.abs(level_a - level_b) <= 1) & (sum(words[1:], words[0]) <= most_flips(total, level, percent))


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) whose sketches allow the similarity."""
    side = classes.select("node", "sketch")
    out = (pairs.distinct()
           .join(side.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
           .join(side.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b"))
    return out.where(may_reach(F.col("sa"), F.col("sb"), percent)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach ``percent`` of their union.

    Sets of the second ends travel to the first ends, of which a star of pairs has one.
    """
    pairs = materialize(pairs, "near-pairs")
    ends = bounded(pairs.select(F.col("a").alias("end")).distinct())
    left = sets.select(F.col("node").alias("na"), F.col("hashes").alias("ha")).join(ends, F.col("na") == F.col("end"), "left_semi")
    right = sets.select("node", F.col("hashes").alias("hb")).join(bounded(pairs), F.col("node") == F.col("b"))
    both = right.join(left, F.col("a") == F.col("na")).withColumn("same", F.size(F.array_intersect("ha", "hb")))
    union = F.size("ha") + F.size("hb") - F.col("same")
    return both.where(100 * F.col("same") >= percent * union).select("a", "b")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("u"), F.least("least", "a").alias("least"))
    out = both.join(least, F.col("a") == F.col("u")).where("b > a")
    return out.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    out = down.join(least.withColumnRenamed("a", "u"), F.col("a") == F.col("u"))
    linked = out.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")
    return linked.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge and its component's smallest node."""
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(edges.where("a != b").distinct(), "near-edges")
    now = state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "near-edges")
        before, now = now, state(edges)
        if before == now:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(h, node) of all buckets h with two classes or more."""
    # dealt by bucket once: the counts, the firsts and the joins read the same exchange
    each = nodes.select("node", F.explode("bands").alias("h")).repartition("h")
    shared = each.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    return each.join(shared, "h").select("h", "node")


def block_rows(members: DataFrame, labels: DataFrame, classes: DataFrame, waiting: DataFrame | None = None) -> DataFrame:
    """Rows of the open buckets with their sketches, dealt to pairs of blocks."""
    rows = open_members(members, labels, waiting)
    met = materialize(rows.select("node").distinct(), "near-met")
    return deal(rows.join(classes.select("node", "sketch").join(bounded(met), "node", "left_semi"), "node"), F.lit(BLOCK))


def partners(rows: DataFrame, percent: int, most: int) -> DataFrame:
    """Partners that the odd sketches leave open, and what waits (``blocks.partners``)."""
    apart = (100 - percent) / (100 + percent)

    def prepare(table: pa.Table) -> Test:
        _, values = list_rows(table, "sketch")
        sketches = values.reshape(-1, 2 * SKETCH_WORDS + 3)
        words = sketches[:, :2 * SKETCH_WORDS].reshape(-1, 2, SKETCH_WORDS)
        level, counts = sketches[:, -3].astype(np.int64), sketches[:, -2:].astype(np.float64)

        def test(x: int, others: np.ndarray) -> np.ndarray:
            near = np.abs(level[others] - level[x]) <= 1
            common = np.maximum(level[others], level[x])
            up, own = np.where(near, common - level[others], 0), np.where(near, common - level[x], 0)
            flips = np.bitwise_count(words[others, up] ^ words[x][own]).sum(axis=1)
            total = counts[others, up] + counts[x][own]
            differ = apart * total + np.where(common > 0, DEVIATIONS * 0.5 * np.sqrt(total * apart), 0.0)
            expected = SKETCH_BITS / 2 * (1 - np.exp(-2.0 * differ / SKETCH_BITS))
            bound = np.minimum(expected + DEVIATIONS * differ / math.sqrt(SKETCH_BITS / 2) + 1, differ + ROUNDING)
            return np.where(near, flips - bound, np.inf)

        return test

    return blocks.partners(rows, prepare, most)


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    carry: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """doc_id, the columns in ``carry``, n_shingles, component_id and kept, one row for each input row."""
    if width < 1:
        raise ValueError("the width must be positive")
    carry = carry or []
    rows = materialize(signatures(docs, id_col, text_col, carry, width)
                       .withColumn("__row", F.monotonically_increasing_id()), "near-rows")
    nodes = materialize(
        rows.where("n > 0").groupBy("key")
        .agg(F.min("doc_id").alias("id"), F.count("*").alias("rows"), *[F.first(c).alias(c) for c in ("bands", "sketch")])
        .withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    members = shared_buckets(nodes)
    first = members.groupBy("h").agg(F.min("node").alias("center"))
    members = materialize(members.join(first, "h"), "near-members")
    met = materialize(members.select("node").distinct(), "near-met")
    classes = materialize(nodes.drop("bands").join(bounded(met), "node", "left_semi"), "near-classes")

    def links_of(pairs: DataFrame) -> DataFrame:
        """The confirmed pairs, by the sets of just the classes in them."""
        ends = materialize(pairs.select(F.col("a").alias("node")).distinct().union(
            pairs.select(F.col("b").alias("node")).distinct()).distinct(), "near-ends")
        wanted = materialize(classes.select("node", "id", "key", "rows").join(bounded(ends), "node", "left_semi"), "near-wanted")
        return confirmed(pairs, full_sets(docs, wanted, id_col, text_col, width), percent)

    pairs = members.where("node != center").select(F.col("center").alias("a"), F.col("node").alias("b"))
    tested = materialize(likely(pairs, classes, percent), "near-pairs")
    labels = materialize(components(links_of(tested)), "near-labels")
    most, waiting = FIRST, None
    while waiting is None or not waiting.isEmpty():
        found = materialize(partners(block_rows(members, labels, classes, waiting), percent, most), "near-partners")
        given, waiting = split_found(found)
        new = materialize(given.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        if not new.isEmpty():
            stars = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
            labels = materialize(components(stars.union(links_of(new))), "near-labels")
            tested = tested.union(new)
        most *= GROWTH
    named = (nodes.select("key", "node").join(labels, "node", "left")
             .select(F.col("key").alias("__key"), F.coalesce("component", "node").alias("component")))
    placed = rows.drop("bands", "sketch").join(materialize(named, "near-classes"),
                                               (F.col("key") == F.col("__key")) & (F.col("n") > 0), "left")
    # a document without words is a group of its own: negative, as nodes are not
    placed = materialize(placed.withColumn("component", F.coalesce("component", -1 - F.col("__row")))
                         .drop("key", "__key"), "near-placed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("id"), F.col("__row").alias("row")))
    stays = placed.groupBy("component").agg(least.alias("least")).select(
        F.col("component").alias("__component"), F.col("least.id").alias("component_id"),
        F.col("least.row").alias("__stays"))
    out = placed.join(materialize(stays, "near-stays"), F.col("component") == F.col("__component"))
    return out.select("doc_id", *carry, F.col("n").alias("n_shingles"), "component_id",
                      (F.col("__row") == F.col("__stays")).alias("kept"))
