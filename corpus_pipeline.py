"""The training-data pipeline: quality rules, exact and near deduplication, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept, whole
texts of any length included.  Repeated rows, null ids and other columns, whatever their
names, are kept apart; an empty table gives an empty one.
All stages but the last return the columns of ``documents``; the last returns the
packed pieces.  Stages hand their rows on as Parquet in the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm import exact_dedup, mixing, near_dedup, packing, quality_rules
from demandlens.llm.common import fold_rest, materialize, number_rows, read, unfold_rest, without
from demandlens.llm.queries import MIX_SEED, MIX_WEIGHTS, domain_of, tokenizer_files

#: Mixing keeps this share of all words and uses no document twice.
KEPT_WORDS = (9, 10)
#: Words of a shingle in the near-duplicate stage.
NEAR_WIDTH = 5
#: Documents of a sequence at most, and the sum of its pieces' squared lengths.
PACK_DOCUMENTS, PACK_ATTENTION = 48, 2048 * 1900
#: Rows dropped as near duplicates up to which their numbers are broadcast; else they are a shuffle join.
MAX_BROADCAST_ROWS = 1_000_000
#: What the operators read; a document's other columns travel as they are, whatever their names.
USED = ["doc_id", "text"]
NUMBER = "__number"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep; a null or empty text fails them."""
    judged = quality_rules.judge(fold_rest(docs, USED))
    return unfold_rest(judged.where("kept"), docs.columns, USED)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts.

    Only numbers, ids and hashes are compared; the texts that go are then left out by
    their numbers.  Null, empty and blank texts form one group.
    """
    numbered = number_rows(fold_rest(docs, USED), NUMBER)
    keyed = exact_dedup.with_text_key(numbered.select(*USED, NUMBER)).drop("text")
    judged = exact_dedup.exact_dedup(keyed)
    kept = without(numbered, judged.where("not kept"), NUMBER, MAX_BROADCAST_ROWS)
    return unfold_rest(kept, docs.columns, USED)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, linked by sets of five words.

    Rows are told apart by their numbers, so that repeated or null ids can't mix them up.
    Texts without words are groups of their own.
    """
    numbered = number_rows(fold_rest(docs, USED), NUMBER)
    judged = near_dedup.near_duplicates(numbered, carry=[NUMBER], width=NEAR_WIDTH)
    kept = without(numbered, judged.where("not kept"), NUMBER, MAX_BROADCAST_ROWS)
    return unfold_rest(kept, docs.columns, USED)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources cut to their target weights; a null language or source is a value of its own."""
    levels = {"domain": domain_of(F.col("source")), "__lang": F.col("lang"), "__source": F.col("source")}
    weights = {"domain": MIX_WEIGHTS["domain"], "__lang": MIX_WEIGHTS["lang"], "__source": MIX_WEIGHTS["source"]}
    used = [*USED, "lang", "source"]
    mixed = mixing.mix(fold_rest(docs, used), levels, weights, KEPT_WORDS, 1, MIX_SEED)
    return unfold_rest(mixed, docs.columns, used)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the documents' tokens, bounded in documents and attention cost as well.

    A piece that alone costs more than a sequence may has one of its own.
    """
    return packing.pack(docs, max_documents=PACK_DOCUMENTS, max_attention=PACK_ATTENTION, **tokenizer_files())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mix", mix), ("pack", pack)]

#: Weak supervision, links and token ids aren't SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
