"""Alignment of two tokenizers' tokens over the bytes of each document.

Side A is a byte-level vocabulary of ``tokenizers``, read over a space and the text;
side B is a ``sentencepiece`` vocabulary with byte fallback, which adds that space
itself.  A token's place comes from the tokenizer's spans first: character offsets on
side A, the spans of sentencepiece's proto on side B (its offset mapping, as the immutable
proto is gone from current versions).  They are coarse cuts, as several
tokens of one multibyte character share a span (A) or have an empty one (byte fallback
in B).  Inside such a stretch the decoded bytes of the tokens give the ends.  Where both
sides end a token at one byte offset the text is cut into a group; the two tokens that
end there are linked.

Neither side merges over the edge of a word (A: a match of the vocabulary's own pattern;
B: spaces and what follows up to the next space, or, where no piece has both, up to the
border of ASCII letters or digits and other ASCII characters), so each worker aligns a
distinct word once and remembers it; texts are then put together from their words with numpy.  Whole
texts of any length are read, and memory grows with one batch and the remembered words.

Corpus-wide counts of linked id pairs are a grouped sum in Spark.  Their table is at most
as large as the product of the vocabularies; it is broadcast if its counted rows are
within ``MAX_BROADCAST_PAIRS``, otherwise it is a shuffle join on the pair, whose common
pairs AQE can split.  Both give the same rows.

A null or empty text, and one whose joined token bytes differ from a space and the text
(such as one with U+2581, which side B reads as a space), has no tokens: zeros and an
empty string.  Repeated rows count as often as they occur.  Ties for an id's best partner
all count.  An empty table gives an empty result.  Other input columns take no part.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from demandlens.llm.common import materialize, text_or_empty

#: Words that a worker remembers for each side before it starts anew.
REMEMBERED = 600_000
#: Bytes of text whose new words are encoded together.
TOGETHER = 1 << 19
#: Characters of words that are encoded as one text.
JOINED = 1000
MAX_BROADCAST_PAIRS = 2_000_000
#: A pair of ids in one number: a * WIDTH_B + b.
WIDTH_B = 1 << 15
SPACE = "▁"
ALNUM, MARK, WIDE = "[0-9A-Za-z]", r"[\x00-\x1F!-/:-@\[-`{-\x7F]", r"[^\x00-\x7F]"
WORD_B = f" +(?:{ALNUM}+|{MARK}+)?(?:{WIDE}+(?:{ALNUM}+|{MARK}+)?)*|(?:{ALNUM}+|{MARK}+)(?:{WIDE}+(?:{ALNUM}+|{MARK}+)?)*"
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def refined(cuts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte end of each token: its span's cut, or where there is none (-1) on from the last cut by decoded bytes."""
    decoded = np.cumsum(lengths)
    cut = cuts >= 0
    last = np.maximum.accumulate(np.where(cut, np.arange(len(cuts)), -1))
    return decoded + np.where(last >= 0, (cuts - decoded)[last], 0)


class Known(dict):
    """Numbers of words; a new word gets the next one and is kept for encoding."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Side:
    """The words of one tokenizer that a worker has met: ids and byte ends in flat arrays.

    ``encode`` gives the ids of all tokens of some words, how many each word has, their
    ends in the word's bytes, and whether each word's bytes come back.
    """

    def __init__(self, encode: Callable[[list[str], np.ndarray], tuple[np.ndarray, ...]], remembered: int):
        self.encode, self.remembered = encode, remembered
        self.clear()

    def clear(self) -> None:
        self.known = Known()
        self.ids, self.ends = np.empty(0, np.int32), np.empty(0, np.int64)
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.lengths, self.good = np.empty(0, np.int64), np.empty(0, bool)

    def numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Numbers of each text's words, all of them encoded."""
        if len(self.known) > self.remembered:
            self.clear()
        number = self.known.__getitem__
        out = [np.fromiter(map(number, words), np.int64, len(words)) for words in texts]
        new, self.known.new = self.known.new, []
        if new:
            lengths = np.array([len(w) if w.isascii() else len(w.encode()) for w in new], np.int64)
            ids, sizes, ends, good = self.encode(new, lengths)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.good = np.concatenate([self.good, good])
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, ends])
        return out

    def tokens(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and byte ends of a text's tokens, or None if some word's bytes don't come back."""
        if not self.good[words].all():
            return None
        sizes, lengths = self.sizes[words], self.lengths[words]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) + np.repeat(self.starts[words] - ends + sizes, sizes)
        return self.ids[place], self.ends[place] + np.repeat(np.cumsum(lengths) - lengths, sizes)


def flat(lists: list[list[int]], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All members of the lists in one array, and the lists' sizes."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), kind, int(sizes.sum())), sizes


def grouped(words: list[str], joinable: list[bool], fillers: list[str]) -> tuple[list[str], list[tuple[int, str]]]:
    """Texts of some ``JOINED`` characters of words with their fillers, the others alone; and the words' order in them."""
    texts, order, part, size = [], [], [], 0
    for i, joins in enumerate(joinable):
        if joins:
            part.append(fillers[i] + words[i])
            order.append((i, fillers[i]))
            size += len(part[-1])
            if size >= JOINED:
                texts.append("".join(part))
                part, size = [], 0
    if part:
        texts.append("".join(part))
    alone = [i for i, joins in enumerate(joinable) if not joins]
    return texts + [fillers[i] + words[i] for i in alone], order + [(i, fillers[i]) for i in alone]


def come_back(words: list[str], lengths: np.ndarray, tokens: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Whether the joined tokens of each word are its bytes."""
    of = np.repeat(np.arange(len(words)), sizes)
    decoded = np.bincount(of, np.fromiter(map(len, tokens), np.int64, len(tokens)), len(words))
    if (decoded == lengths).all() and b"".join(tokens) == "".join(words).encode():
        return np.ones(len(words), bool)
    at = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    return np.array([b"".join(tokens[i:j]) == w.encode() for w, i, j in zip(words, at, at[1:])], bool)


class Aligner:
    """Both tokenizers of a worker."""

    def __init__(self, file_a: str, file_b: str, pattern: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        self.words_a = regex.compile(pattern).findall
        alphabet = byte_alphabet()
        size_a, size_b = self.a.get_vocab_size(), self.b.get_piece_size()
        if size_b > WIDTH_B:
            raise ValueError(f"side B has {size_b} ids, pairs have room for {WIDTH_B}")
        names = [self.a.id_to_token(i) or "" for i in range(size_a)]
        self.bytes_a = [bytes(alphabet.get(c, 0x3F) for c in name) for name in names]
        pieces = [self.b.id_to_piece(i) for i in range(size_b)]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("side B has pieces that go over the edge of a word")
        mixed = re.compile(f"{ALNUM}{MARK}|{MARK}{ALNUM}")
        whole_words = any(mixed.search(p) for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i)
                                                                               or self.b.is_unknown(i)))
        # no piece has an ASCII letter or digit beside another ASCII character: words end there too
        self.words_b = re.compile(" +[^ ]*" if whole_words else WORD_B).findall
        self.fallback = np.array([self.b.is_byte(i) for i in range(size_b)])
        self.bytes_b = [bytes([int(p[3:5], 16)]) if byte else p.replace(SPACE, " ").encode()
                        for p, byte in zip(pieces, self.fallback, strict=True)]
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.lone_space = self.b.piece_to_id(SPACE)
        self.side_a, self.side_b = Side(self.encode_a, remembered), Side(self.encode_b, remembered)
        self.decimals = [f"{i}{mark}".encode() for i in range(max(size_a, size_b)) for mark in ",|;"]

    def encode_a(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        # words that begin with one space are cut out of a joined text as they were out of their own
        joinable = [w[0] == " " and not w[1:2].isspace() and len(w) > 1 for w in words]
        texts, order = grouped(words, joinable, [""] * len(words))
        found = self.a.encode_batch(texts, add_special_tokens=False)
        ids, counts = flat([f.ids for f in found], np.int32)
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(f.offsets for f in found)), np.int64, 2 * len(ids))
        return self.placed(words, lengths, order, texts, ids, counts, spans, self.bytes_a, self.lengths_a, None)

    def encode_b(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        # a word without a space in front stands after a filler that it can't merge with
        fillers = ["" if w[0] == " " else " ." if w[0].isalnum() else " a" for w in words]
        joinable = [SPACE not in w and w.strip(" ") != "" for w in words]
        texts, order = grouped(words, joinable, fillers)
        # sentencepiece puts the first space of a text itself, except before nothing
        found = self.b.encode([t[1:] for t in texts], return_type="offset_mapping", num_threads=1)
        lone = {"ids": [self.lone_space], "offsets": [(0, 0)]}
        found = [lone if t == " " else f for t, f in zip(texts, found, strict=True)]
        ids, counts = flat([f["ids"] for f in found], np.int32)
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(f["offsets"] for f in found)), np.int64, 2 * len(ids))
        # so spans are one character short of the text's; the first token may hold that space
        spans = (spans.reshape(-1, 2) + 1).ravel()
        return self.placed(words, lengths, order, texts, ids, counts, spans, self.bytes_b, self.lengths_b, self.fallback)

    @staticmethod
    def placed(words: list[str], lengths: np.ndarray, order: list[tuple[int, str]], texts: list[str], ids: np.ndarray,
               counts: np.ndarray, spans: np.ndarray, decoded: list[bytes], sizes_of: np.ndarray,
               fallback: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """Ids, number of tokens, byte ends and soundness of each word, from the tokens and spans of the joined texts."""
        whole = "".join(texts)
        points = np.fromiter(map(len, texts), np.int64, len(texts))
        spans = spans.reshape(-1, 2) + np.repeat(np.cumsum(points) - points, counts)[:, None]
        begin, end = spans[:, 0], spans[:, 1]
        # a token ends between two characters if the next one starts where it ends
        clean = (begin < end) & (end == np.append(begin[1:], len(whole)))
        if fallback is not None:
            clean = (begin < end) & ~fallback[ids]
        if whole.isascii():
            wide = None
            cuts = end
        else:
            code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
            wide = np.concatenate([[0], np.cumsum(1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000))])
            cuts = wide[end]
        ends = refined(np.where(clean, cuts, -1), sizes_of[ids])
        # the words' places in the joined texts, fillers between them
        parts = np.array([[len(filler), len(words[w])] for w, filler in order], np.int64).reshape(-1)
        edges = np.cumsum(parts)
        edges = (edges if wide is None else wide[edges]).reshape(-1, 2)
        first, after = np.searchsorted(ends, edges[:, 0], "right"), np.searchsorted(ends, edges[:, 1], "right")
        back = np.empty(len(words), np.int64)
        back[[w for w, _ in order]] = np.arange(len(words))
        first, sizes, start = first[back], (after - first)[back], edges[back, 0]
        at = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
        ids = ids[at]
        good = come_back(words, lengths, [decoded[i] for i in ids.tolist()], sizes)
        return ids, sizes, ends[at] - np.repeat(start, sizes), good

    def align(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None]:
        """For each text ids and byte ends of A, then of B; None for a text without tokens."""
        whole = [f" {t}" if t else "" for t in texts]
        words_a = self.side_a.numbers([self.words_a(t) for t in whole])
        words_b = self.side_b.numbers([self.words_b(t) for t in whole])
        out = []
        for a, b in zip(words_a, words_b, strict=True):
            left = self.side_a.tokens(a) if len(a) else None
            right = self.side_b.tokens(b) if len(b) else None
            out.append(None if left is None or right is None else (*left, *right))
        return out

    def groups_text(self, ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group in order; ``at_a`` and ``at_b`` are the groups' last tokens."""
        mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        mark_a[at_a], mark_b[at_b] = 1, 2
        group_a, group_b = np.cumsum(mark_a) - mark_a, (np.cumsum(mark_b) - mark_b) // 2
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        # before a token of A stand the earlier groups of B, before one of B those of A with its own
        order[np.arange(len(ids_a)) + np.concatenate([[0], at_b + 1])[group_a]] = ids_a.astype(np.int64) * 3 + mark_a
        order[np.arange(len(ids_b)) + at_a[group_b] + 1] = ids_b.astype(np.int64) * 3 + mark_b
        return b"".join([self.decimals[i] for i in order.tolist()])[:-1]


@functools.lru_cache(maxsize=1)
def aligner(file_a: str, file_b: str, pattern: str) -> Aligner:
    """One for each Python worker."""
    return Aligner(file_a, file_b, pattern)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B of the tokens that end together."""
    at = np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)
    left = np.flatnonzero(ends_b[at] == ends_a)
    return left, at[left]


def aligned(docs: DataFrame, file_a: str, file_b: str, pattern: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, the counts, groups_sha256, and the document's distinct id ``pairs`` with their ``uses``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("__text"))
    schema, ints = StructType([docs.schema["doc_id"]]), ArrayType(IntegerType())
    for name in COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string").add("pairs", ints).add("uses", ints)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(file_a, file_b, pattern)
        for batch in batches:
            texts = batch.column("__text")
            start = 0
            while start < len(texts):
                part, size = [], 0
                while start + len(part) < len(texts) and (size < TOGETHER or not part):
                    part.append(texts[start + len(part)].as_py())
                    size += len(part[-1])
                counts, shas, pairs, uses = np.zeros((4, len(part)), np.int64), [], [], []
                for i, found in enumerate(tool.align(part)):
                    if found is None:
                        shas.append("")
                        pairs.append(np.empty(0, np.int32))
                        uses.append(np.empty(0, np.int32))
                        continue
                    ids_a, ends_a, ids_b, ends_b = found
                    at_a, at_b = common_ends(ends_a, ends_b)
                    counts[:, i] = len(ids_a), len(ids_b), len(at_a), len(at_a)
                    shas.append(hashlib.sha256(tool.groups_text(ids_a, ids_b, at_a, at_b)).hexdigest())
                    pair, n = np.unique(ids_a[at_a] * np.int32(WIDTH_B) + ids_b[at_b], return_counts=True)
                    pairs.append(pair)
                    uses.append(n.astype(np.int32))
                lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()),
                                                  pa.array(np.concatenate(x), pa.int32())) for x in (pairs, uses)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(part)), *map(pa.array, counts), pa.array(shas, pa.string()),
                     *lists], names=schema.names)
                start += len(part)

    return docs.mapInArrow(cut, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair``, ``count`` (links that hold it) and ``best``: whether no other pair of its B id has more."""
    counts = (rows.select(F.inline(F.arrays_zip("pairs", "uses"))).groupBy(F.col("pairs").alias("pair"))
              .agg(F.sum("uses").alias("count")))
    counts = materialize(counts, "align-counts")
    highest = counts.groupBy((F.col("pair") % WIDTH_B).alias("b")).agg(F.max("count").alias("highest"))
    return (counts.join(highest, F.col("pair") % WIDTH_B == F.col("b"))
            .select("pair", "count", (F.col("count") == F.col("highest")).alias("best")))


def marked(pairs: DataFrame, most: int) -> DataFrame:
    """For broadcast if its counted rows are within ``most``."""
    return F.broadcast(pairs) if pairs.count() <= most else pairs


def link_pairs(rows: DataFrame) -> DataFrame:
    """``id_a``, ``id_b``, ``count`` and ``best`` of every linked id pair."""
    pair: Column = F.col("pair")
    return pair_counts(rows).select(F.expr(f"pair div {WIDTH_B}").cast("int").alias("id_a"),
                                    (pair % WIDTH_B).cast("int").alias("id_b"), "count", "best")


def align_tokenizers(docs: DataFrame, file_a: str, file_b: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", max_broadcast_pairs: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """One row per document: the counts, n_best, count_sum and groups_sha256."""
    rows = materialize(aligned(docs, file_a, file_b, pattern, id_col, text_col)
                       .withColumn("__row", F.monotonically_increasing_id()), "align-rows")
    table = marked(materialize(pair_counts(rows), "align-pairs"), max_broadcast_pairs)
    each = rows.select("__row", F.inline(F.arrays_zip("pairs", "uses"))).withColumnRenamed("pairs", "pair")
    # a document's pairs are in one task, so its sums are rows of one before the shuffle
    sums = each.join(table, "pair").groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("uses")).otherwise(0)).alias("n_best"),
        F.sum(F.col("uses") * F.col("count")).alias("count_sum"))
    return (rows.drop("pairs", "uses").join(sums, "__row", "left")
            .select("doc_id", *COUNTS, F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"), "groups_sha256"))
