"""Vector best-fit packing of tokenised documents into sequences.

Three capacities bind every sequence: tokens, documents and attention cost (the
sum of squared lengths).  All three needs of a piece follow from its length, so
pieces of one length are interchangeable and the packing needs only how many
pieces each length has: at most ``max_tokens`` numbers, whatever the corpus.
From those the driver fills one sequence after another.  Each starts with the
longest piece left; then the one or two lengths are added that fit every residual
capacity and leave the least weighted norm of the residual vector, until nothing
fits.  A filled sequence is a pattern that is used as often as the counts allow.
Spark then gives each piece its number among the pieces of its length (salted,
so a very common length is spread) and looks up its place in the patterns.

A document is its token ids and one end id.  Only a document longer than
``max_tokens`` is cut: into full pieces, after a first one that may be shorter.  A
null or empty text is the end id alone.  A piece that alone exceeds the document
or attention capacity gets a sequence of its own.  Repeated rows are packed like
others.  An empty table gives an empty result.  Other input columns take no part.

Ids are those of the given ``tokenizers`` file.  Its byte-level vocabulary is also
given as ranks, with which ``tiktoken`` makes the same ids in about a sixth of the
time; texts with a special token's string or an extremely long word go through
``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandlens.llm.common import materialize, text_or_empty

MAX_TOKENS = 2048
END_ID = 0
#: Parts into which the pieces of one length are dealt for numbering.
SALT = 64
#: Weights of tokens, documents and attention cost in the residual's norm.
WEIGHTS = (1.0, 0.0001, 0.01)
LONG_WORD = 4000


class Encoder:
    """Token ids of a text by a ``tokenizers`` file, mostly through its ranks."""

    def __init__(self, tokenizer_file: str, ranks_file: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        # the look-ahead only matters for a run of two or more spaces
        plain = pattern.replace(r"|\s+(?!\S)", "")
        self.plain = tiktoken.Encoding("plain", pat_str=plain, mergeable_ranks=ranks, special_tokens={})
        self.full = tiktoken.Encoding("full", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.hard = re.compile("|".join([*special, rf"\S{{{LONG_WORD}}}"]))
        self.gaps = re.compile(r"\s\s")

    def ids(self, text: str) -> list[int]:
        if self.hard.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return (self.full if self.gaps.search(text) else self.plain).encode_ordinary(text)


@functools.lru_cache(maxsize=1)
def encoder(tokenizer_file: str, ranks_file: str, pattern: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(tokenizer_file, ranks_file, pattern)


def cut(total: int, max_tokens: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes what is over."""
    first = total - (total - 1) // max_tokens * max_tokens
    yield 0, first
    for start in range(first, total, max_tokens):
        yield start, max_tokens


def pieces(docs: DataFrame, tokenizer_file: str, ranks_file: str, pattern: str, max_tokens: int = MAX_TOKENS,
           end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length and the CRC-32 of its ids."""
    docs = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = StructType([docs.schema["doc_id"]])
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        schema = schema.add(name, kind)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(tokenizer_file, ranks_file, pattern)
        for batch in batches:
            rows, out = [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.array([*use.ids(text.as_py()), end_id], "<u4")
                for number, (start, length) in enumerate(cut(len(ids), max_tokens)):
                    rows.append(i)
                    out.append((number, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            columns = list(zip(*out, strict=True)) or [()] * 4
            arrays = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32())]
            arrays += [pa.array(c, pa.int64()) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(encode, schema)


def best_fill(counts: np.ndarray, tokens: int, documents: int, attention: int,
              capacities: tuple[int, int, int], weights: tuple[float, float, float]) -> list[int]:
    """The one or two lengths that leave the least weighted norm of the residual; empty if none fits."""
    top = min(tokens, len(counts) - 1)
    if documents < 1 or top < 1:
        return []
    lengths = np.flatnonzero(counts[:top + 1])
    lengths = lengths[lengths * lengths <= attention]
    if not len(lengths):
        return []
    # the longest that fits beside each length, in tokens and in attention cost
    room = np.minimum(tokens - lengths, np.sqrt(np.maximum(attention - lengths * lengths, 0)).astype(np.int64))
    at = np.searchsorted(lengths, room, "right") - 1
    second = np.where((at >= 0) & (documents > 1), lengths[np.maximum(at, 0)], 0)
    # a length with one piece left can't be taken twice: the next shorter one is
    alone = (second == lengths) & (counts[lengths] < 2)
    second = np.where(alone, np.where(at > 0, lengths[np.maximum(at - 1, 0)], 0), second)
    rest = np.stack([tokens - lengths - second, documents - 1 - (second > 0),
                     attention - lengths * lengths - second * second]) / np.array(capacities)[:, None]
    norm = (np.array(weights)[:, None] * rest * rest).sum(axis=0)
    pick = len(norm) - 1 - int(np.argmin(norm[::-1]))  # of ties the longest
    return [int(x) for x in (lengths[pick], second[pick]) if x]


def plan_patterns(counts: np.ndarray, max_tokens: int, max_documents: int, max_attention: int,
                  weights: tuple[float, float, float] = WEIGHTS) -> list[tuple[int, dict[int, int]]]:
    """(uses, pieces by length) of each kind of sequence; ``counts[l]`` pieces have length l."""
    counts, out = counts.copy(), []
    capacities = (max_tokens, max_documents, max_attention)
    while len(left := np.flatnonzero(counts)):
        filled, new = {}, [int(left[-1])]
        tokens, documents, attention = capacities
        while new:
            for length in new:
                filled[length] = filled.get(length, 0) + 1
                counts[length] -= 1
                tokens, documents, attention = tokens - length, documents - 1, attention - length * length
            new = best_fill(counts, tokens, documents, attention, capacities, weights)
        more = min(int(counts[length]) // times for length, times in filled.items())
        for length, times in filled.items():
            counts[length] -= more * times
        out.append((1 + more, filled))
    return out


def places(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, last number, first sequence, pieces a sequence, offset) of each pattern's lengths.

    Pieces of a length are numbered from 0; a pattern takes the next numbers.
    """
    taken, sequence, out = {}, 0, []
    for uses, filled in patterns:
        offset = 0
        for length, times in sorted(filled.items(), reverse=True):
            first = taken.get(length, 0)
            taken[length] = first + uses * times
            out.append((length, first, taken[length] - 1, sequence, times, offset))
            offset += length * times
        sequence += uses
    return out


def pack(docs: DataFrame, tokenizer_file: str, ranks_file: str, pattern: str, max_tokens: int = MAX_TOKENS,
         max_documents: int | None = None, max_attention: int | None = None,
         weights: tuple[float, float, float] = WEIGHTS, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Every piece with its sequence_id and its offset there.

    Without ``max_documents`` and ``max_attention`` these capacities are what
    ``max_tokens`` tokens can reach, so that only tokens bind.
    """
    max_documents = max_tokens if max_documents is None else max_documents
    max_attention = max_tokens * max_tokens if max_attention is None else max_attention
    if min(max_tokens, max_documents, max_attention) < 1:
        raise ValueError("capacities must be positive")
    spark = docs.sparkSession
    cuts = materialize(pieces(docs, tokenizer_file, ranks_file, pattern, max_tokens, end_id, id_col, text_col)
                       .withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALT))),
                       "pack-pieces")
    sizes = cuts.groupBy("length", "part").agg(F.count("*").alias("n"))  # max_tokens x SALT rows at most
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-parts")
    counts = np.zeros(max_tokens + 1, np.int64)
    for row in parts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # max_tokens rows at most
        counts[row["length"]] = row["n"]
    table = places(plan_patterns(counts, max_tokens, max_documents, max_attention, weights))
    where = spark.createDataFrame(table, "length long, first long, last long, sequence long, times long, at long")
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (cuts.withColumn("inside", F.row_number().over(inside).cast("long") - 1)
                .join(F.broadcast(parts.drop("n")), ["length", "part"])
                .withColumn("number", F.col("before") + F.col("inside")))
    slot = F.col("number") - F.col("first")
    return (numbered.join(F.broadcast(where), "length").where(F.col("number").between(F.col("first"), F.col("last")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("sequence") + F.expr("(number - first) div times")).alias("sequence_id"),
                    (F.col("at") + slot % F.col("times") * F.col("length")).alias("offset")))
