"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm import (block_search, exact_dedup, mixing, near_dedup, packing, parity_join, pii, quality_model,
                            quality_rules, sharding, token_align, toxicity, url_filter)
from demandlens.llm.common import read

SHARDS = 24
#: Target weights of each level; a value that is not named has weight 1.
MIX_WEIGHTS = {"domain": {"web": 3, "books": 2, "code": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
               "source": {"src0": 2}}
MIX_SEED = 7
MIX_EPOCHS = 2
MIX_SHARE = (3, 5)
#: A demonstration key; a real run passes its own secret to ``pii.pseudonymise``.
PII_KEY = b"surrogate demonstration key"

#: (rule, verdict); the longest rule that fits wins.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


def domain_of(source: Column) -> Column:
    """A source's domain: by its number, as the synthetic sources have no other family."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit(""))
    return (F.when(number == "", "web").when(number.try_cast("int") % 3 == 0, "web")
            .when(number.try_cast("int") % 3 == 1, "books").otherwise("code"))


def op1_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(read(spark, sf_dir, "documents"), SHARDS)


def op2_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    keyed = exact_dedup.with_text_key(docs).drop("text")
    return exact_dedup.exact_dedup(keyed).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=2)


def op4_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality_model.score(docs, quality_model.train(docs, labels))


def op5_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels))


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY)


def op7_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


def tokenizer_files() -> dict[str, str]:
    """Places of the public vocabulary that the packing query uses."""
    import public_tokenizers

    return {"tokenizer_file": public_tokenizers.path("byte_bpe_50k.json"),
            "ranks_file": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op8_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), **tokenizer_files())


def op9_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    levels = {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    mixed = mixing.mix(docs, levels, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "tokens", "epoch")


def op10_supervised_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs, keep_columns=False)
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "quality")


def op11_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.similarity_components(read(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_align.align_tokenizers(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def op13_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_byte_shards, op2_bloom_dedup, op3_odd_sketch_dedup, op4_byte_network, op5_factorization_machine, op6_surrogates, op7_boosted_urls, op8_vector_packing, op9_hierarchical_mix, op10_supervised_rules,
                            op11_parity_sketch_join, op12_token_alignment, op13_block_search)
}

MIX_LEVELS = ["domain", "lang", "source"]


def _weight_sql(level: str, weights: dict[str, dict[str, int]]) -> str:
    named = " ".join(f"WHEN '{v}' THEN {w}" for v, w in weights.get(level, {}).items())
    return f"CASE {level} {named} ELSE 1 END" if named else "1"


def mix_sql(table: str, weights: dict[str, dict[str, int]], share: tuple[int, int], epochs: int, seed: int) -> str:
    """DuckDB twin of the mixing query: families filled level by level, then prefixes of hashed epochs."""
    parts = [f"""
        WITH docs AS (
            SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
                   CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'web'
                        ELSE ['web', 'books', 'code'][1 + CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 3]
                   END AS domain,
                   greatest(1, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                                               lambda x: x <> ''))) AS tokens
            FROM {table}),
        leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS HUGEINT) AS tokens FROM docs GROUP BY ALL),
        b0 AS (SELECT CAST(sum(tokens) AS HUGEINT) * {share[0]} // {share[1]} AS budget FROM leaves)"""]
    for depth, level in enumerate(MIX_LEVELS):
        path, parents = MIX_LEVELS[:depth + 1], MIX_LEVELS[:depth]
        cols, family = ", ".join(path), f"PARTITION BY {', '.join(parents)}" if parents else ""
        joined = f"JOIN b{depth} USING ({', '.join(parents)})" if parents else "CROSS JOIN b0"
        before = (f"{family} ORDER BY CAST(supply AS DOUBLE) / weight, {level} "
                  "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
        parts.append(f"""
        n{depth} AS (SELECT {cols}, sum(tokens) * {epochs} AS supply, {_weight_sql(level, weights)} AS weight
                     FROM leaves GROUP BY {cols}),
        o{depth} AS (SELECT n.*, budget,
                coalesce(sum(supply) OVER ({before}), 0) AS s0, coalesce(sum(weight) OVER ({before}), 0) AS w0,
                sum(weight) OVER ({family}) AS w
            FROM n{depth} n {joined}),
        f{depth} AS (SELECT *, s0 * weight + supply * (w - w0) <= budget * weight AS fills FROM o{depth}),
        b{depth + 1} AS (SELECT {cols}, CAST(CASE WHEN fills THEN supply ELSE
                (budget - sum(CASE WHEN fills THEN supply ELSE 0 END) OVER ({family})) * weight
                // greatest(1, sum(CASE WHEN fills THEN 0 ELSE weight END) OVER ({family})) END AS HUGEINT) AS budget
            FROM f{depth})""")
    leaf = ", ".join(MIX_LEVELS)
    parts.append(f"""
        plan AS (SELECT {leaf}, budget // tokens AS epochs, budget % tokens AS rest
                 FROM leaves JOIN b{len(MIX_LEVELS)} USING ({leaf})),
        hashed AS (SELECT docs.*, epochs, rest,
                          md5('{seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
                   FROM docs JOIN plan USING ({leaf})),
        uses AS (SELECT *, epochs + CASE WHEN sum(tokens) OVER (PARTITION BY {leaf} ORDER BY key) <= rest
                                         THEN 1 ELSE 0 END AS n FROM hashed)
        SELECT doc_id, {leaf}, tokens, CAST(e AS BIGINT) AS epoch
        FROM (SELECT *, unnest(range(CAST(n AS BIGINT))) AS e FROM uses)""")
    return ",".join(parts)


# Texts are equal when identical without white space; the longest original stays.
ORACLE_SQL: dict[str, str] = {
    "op2_bloom_dedup": r"""
        WITH keyed AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS kept,
               text_sha256
        FROM keyed""",
    "op13_block_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY ALL),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM lengths),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, total GROUP BY term),
        items AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        scores AS (
            SELECT item_id, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len)))) AS BIGINT) AS score
            FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), total
            GROUP BY ALL)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
              FROM scores WHERE score > 0)
        WHERE rank <= 50""",
    "op9_hierarchical_mix": mix_sql("documents", MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED),
}
