"""Similarity join of shingle sets by parity sketches.

A document's set holds the 64-bit hashes of its distinct shingles.  Documents with equal
sets form one class; all but the last step works on classes, so thousands of copies cost as
much as one.  Sizes are cut into bands such that sets that reach the similarity are in one
band or in neighbouring ones.  Two sets that reach it in a band differ in at most D shingles,
D following from the band's greatest size.  A set's sketch has D + 1 words of 64 bits and one to
spare for every ``SPARE`` of them: every shingle flips one bit of one word.  The XOR of two sketches
is the sketch of the symmetric difference, so

* its population count is never above the number of differing shingles: a lower bound;
* with at most D differing shingles, of D + 1 + e words at least e + 1 are equal (pigeonhole).

So (band, place, word) is the join key, and no pair of the similarity is missed.  Words of fewer
than ``LOW_BITS`` bits are those that most sets share by chance.  A set with at most e of them leaves
them out: of the e + 1 words equal with another set's one at least has more bits, and such words are
keys of all sets.  Two sets that both have more than e keep all.  A set has
the words of its own band, and those of the next one if a set of that band is within reach.

In a bucket pairs aren't all formed.  First every class is compared with the bucket's first,
by sizes and a short sketch of ``SHORT_WORDS`` words, whose bound holds likewise.
Then only buckets go on whose other classes are still in different components, cut into
blocks (``blocks``); a task compares the sketches of two blocks and gives each class outside
the bucket's largest component its ``FIRST`` most similar partners of other components that the lower bound
allows.  Just classes with more go on, with the partners they have not been given, and get
``GROWTH`` times as many in the next round.  Every pair handed out is confirmed on the full sets.  When no
class has a partner left, what hasn't been compared in full is inside one component already
or excluded by the bound, so the components are those of all links.

A text without words (null, empty, white space) has an empty set and is linked with nothing;
its component is its own id.  Of equal texts and repeated rows all get the same component.
Null ids count last.  An empty table gives an empty result.  Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from demandlens.llm import blocks
from demandlens.llm.blocks import TASK_ROWS, Test, deal, list_rows, open_members, split_found
from demandlens.llm.common import materialize, text_or_empty
from demandlens.llm.near_dedup import bounded, components, confirmed, full_sets, mixed, shingles

PERCENT, WIDTH = 90, 3
#: Words of the sketch that all sets have alike, for a first look at a pair.
SHORT_WORDS = 16
#: Words that a pair can't do without for each word to spare, and the bits from which a word is always a key.
SPARE, LOW_BITS = 16, 3
#: Words of sketches in a block; a block has as many classes as they allow.
BLOCK_WORDS = 1 << 14
#: Partners that a class is given at first, and by how much more in each round.
FIRST, GROWTH = 2, 8
SALT = 0x51ED270B4D2A9F63


def band_starts(percent: int, most: int) -> list[int]:
    """First size of each band up to one that holds ``most``; a band is wider than the similarity reaches."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, -(-out[-1] * 10_000 // (90 * percent))))
    return out


def most_apart(total: int, percent: int) -> int:
    """Shingles in which two sets with ``total`` shingles together may differ at most."""
    return total * (100 - percent) // (100 + percent)


def sketch(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` words of 64 parity bits."""
    drawn = mixed(hashes ^ np.uint64(SALT))
    at = (drawn % np.uint64(words)).astype(np.int64) * 64 + (drawn >> np.uint64(58)).astype(np.int64)
    odd = np.bincount(at, minlength=words * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class Bands:
    """Bands by size, grown as far as needed."""

    def __init__(self, percent: int):
        self.percent = percent
        self.grow(1024)

    def grow(self, most: int) -> None:
        self.starts = np.array(band_starts(self.percent, most), np.int64)

    def of(self, size: int) -> int:
        if size * 2 >= self.starts[-1]:
            self.grow(size * 4)
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def words(self, band: int) -> int:
        needed = most_apart(2 * (int(self.starts[band + 1]) - 1), self.percent) + 1
        return needed + needed // SPARE

    def sketches(self, hashes: np.ndarray) -> tuple[int, np.ndarray, np.ndarray | None]:
        """A set's band, its sketch there, and its sketch in the next band if that is within reach."""
        band = self.of(len(hashes))
        up = len(hashes) * 100 // self.percent >= self.starts[band + 1]
        return band, sketch(hashes, self.words(band)), sketch(hashes, self.words(band + 1)) if up else None


def least_bits(words: np.ndarray | None) -> int | None:
    """Bits from which a sketch's words are keys: ``LOW_BITS`` if it has no more words below than are to spare."""
    if words is None:
        return None
    spare = len(words) // (SPARE + 1)
    return LOW_BITS if np.count_nonzero(np.bitwise_count(words.view(np.uint64)) < LOW_BITS) <= spare else 0


def digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id with n, a digest of the set, its band and its sketches."""
    docs = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("__text"))
    schema, longs = StructType([docs.schema["doc_id"]]), ArrayType(LongType())
    for name, kind in (("n", LongType()), ("key", BinaryType()), ("band", IntegerType()), ("own", longs), ("up", longs),
                       ("short", longs), ("own_bits", IntegerType()), ("up_bits", IntegerType())):
        schema = schema.add(name, kind)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            n, keys, places, own, up, short = [], [], [], [], [], []
            for text in batch.column("__text"):
                s = shingles(text.as_py(), width)
                band, first, second = bands.sketches(s) if len(s) else (None, None, None)
                n.append(len(s))
                keys.append(digest(s))
                places.append(band)
                own.append(first)
                up.append(second)
                short.append(sketch(s, SHORT_WORDS) if len(s) else None)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(places, pa.int32()),
                 pa.array(own, lists), pa.array(up, lists), pa.array(short, lists),
                 *[pa.array(list(map(least_bits, s)), pa.int32()) for s in (own, up)]], names=schema.names)

    return docs.mapInArrow(sign, schema)


def word_keys(words: str, band: Column) -> Column:
    """Join keys of a sketch: a hash of band, place and word of the words that have enough bits."""
    keys = F.transform(words, lambda w, i: F.when(F.bit_count(w) >= F.col(f"{words}_bits"), F.xxhash64(band, i, w)))
    return F.filter(keys, lambda k: k.isNotNull())


def bucket_members(nodes: DataFrame) -> DataFrame:
    """(h, node, own, center): classes of all buckets with two or more, one at least in its own band."""
    own = nodes.select("node", F.lit(True).alias("own"), F.explode(word_keys("own", F.col("band"))).alias("h"))
    up = nodes.where("up IS NOT NULL").select(
        "node", F.lit(False).alias("own"), F.explode(word_keys("up", F.col("band") + 1)).alias("h"))
    # dealt by key once: the counts and the join below read the same exchange
    each = own.union(up).repartition("h")
    first = F.min(F.struct((~F.col("own")).alias("other"), "node"))
    shared = (each.groupBy("h").agg(F.count("*").alias("c"), first.alias("first")).where("c > 1 AND NOT first.other")
              .select("h", F.col("first.node").alias("center")))
    return each.join(shared, "h").select("h", "node", "own", "center")


def allowed(total: Column, percent: int) -> Column:
    return F.floor(total * (100 - percent) / (100 + percent))


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and short sketches allow the similarity.

    Most pairs of a bucket that met by chance end here, so only short sketches travel.
    """
    def side(end: str) -> DataFrame:
        return classes.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("n", "short")])

    a_n, b_n = F.col("a_n"), F.col("b_n")
    out = pairs.join(side("a"), "a").join(side("b"), "b")
    out = out.where((a_n * 100 >= b_n * percent) & (b_n * 100 >= a_n * percent))
    flips = [F.bit_count(F.col("a_short")[i].bitwiseXOR(F.col("b_short")[i])) for i in range(SHORT_WORDS)]
    return out.where(sum(flips[1:], flips[0]) <= allowed(a_n + b_n, percent)).select("a", "b")


def block_rows(members: DataFrame, labels: DataFrame, classes: DataFrame, waiting: DataFrame | None = None) -> DataFrame:
    """Rows of the open buckets with the words of the bucket's band, dealt to pairs of blocks."""
    rows = open_members(members, labels, waiting)
    met = materialize(rows.select("node").distinct(), "parity-met")
    side = classes.select("node", "n", F.col("own").alias("w"), "up", F.size("own").alias("w_size"), F.size("up").alias("up_size"))
    rows = rows.join(materialize(side.join(bounded(met), "node", "left_semi"), "parity-open"), "node")
    # sizes on their own, so that counting the rows moves no words
    rows = rows.withColumns({"words": F.when(F.col("own"), F.col("w")).otherwise(F.col("up")),
                             "size": F.when(F.col("own"), F.col("w_size")).otherwise(F.col("up_size"))})
    rows = deal(rows.drop("w", "up", "w_size", "up_size"), BLOCK_WORDS / F.greatest("size", F.lit(16)))
    return rows.drop("size")


def partners(rows: DataFrame, percent: int, most: int) -> DataFrame:
    """Partners that sizes and sketches allow, and what waits (``blocks.partners``)."""
    def prepare(table: pa.Table) -> Test:
        own, n = table.column("own").to_numpy(), table.column("n").to_numpy()
        starts, words = list_rows(table, "words")

        def test(x: int, others: np.ndarray) -> np.ndarray:
            mine = words[starts[x]:starts[x + 1]]  # all of one bucket are of one band
            apart = np.bitwise_count(words[starts[others][:, None] + np.arange(len(mine))] ^ mine).sum(axis=1)
            beyond = apart.astype(np.int64) - (n[others] + n[x]) * (100 - percent) // (100 + percent)
            return np.where(own[others] | own[x], beyond, 1)

        return test

    return blocks.partners(rows, prepare, most, TASK_ROWS)


def similarity_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id, one row for each input row."""
    if not 50 <= percent <= 100 or width < 1:
        raise ValueError("the similarity must be 50 to 100 percent and the width positive")
    rows = materialize(signatures(docs, percent, width, id_col, text_col)
                       .withColumn("__row", F.monotonically_increasing_id()), "parity-rows")
    nodes = materialize(
        rows.where("n > 0").groupBy("key")
        .agg(F.min("doc_id").alias("id"), F.count("*").alias("rows"),
             *[F.first(c).alias(c) for c in ("n", "band", "own", "up", "short", "own_bits", "up_bits")])
        .withColumn("node", F.monotonically_increasing_id()), "parity-nodes")
    members = materialize(bucket_members(nodes), "parity-members")
    met = materialize(members.select("node").distinct(), "parity-met")
    classes = materialize(nodes.drop("own_bits", "up_bits").join(bounded(met), "node", "left_semi"), "parity-classes")

    def links_of(pairs: DataFrame) -> DataFrame:
        """The confirmed pairs, by the sets of just the classes in them."""
        ends = materialize(pairs.select(F.col("a").alias("node")).distinct().union(
            pairs.select(F.col("b").alias("node")).distinct()).distinct(), "parity-ends")
        wanted = materialize(classes.select("node", "id", "key", "rows").join(bounded(ends), "node", "left_semi"), "parity-wanted")
        return confirmed(pairs, full_sets(docs, wanted, id_col, text_col, width), percent)

    # every class with the first of its buckets
    pairs = materialize(members.where("node != center").select(
        F.least("center", "node").alias("a"), F.greatest("center", "node").alias("b")).distinct(), "parity-firsts")
    tested = materialize(likely(pairs, classes, percent), "parity-pairs")
    labels = materialize(components(links_of(tested)), "parity-labels")
    most, waiting = FIRST, None
    while waiting is None or not waiting.isEmpty():
        found = materialize(partners(block_rows(members, labels, classes, waiting), percent, most), "parity-partners")
        given, waiting = split_found(found)
        new = materialize(given.join(tested, ["a", "b"], "left_anti"), "parity-pairs")
        if not new.isEmpty():
            links = links_of(new)
            stars = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
            labels = materialize(components(stars.union(links)), "parity-labels")
            tested = tested.union(new)
        most *= GROWTH
    named = nodes.select("key", "id", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialize(named, "parity-classed")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = materialize(named.join(least, "component").select(F.col("key").alias("__key"), "component_id"), "parity-named")
    out = rows.join(named, (F.col("key") == F.col("__key")) & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
