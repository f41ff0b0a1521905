"""URL filter: rules, and gradient-boosted trees on lexical features where no rule fits.

A rule is a host and a path prefix; it fits that host and its subdomains when the
URL's path starts with its path, and the longest fitting rule decides.  The URLs
that rules decide are the labelled URLs: the boosted trees (MLlib) learn from up to
``TRAIN_ROWS`` of them, those with the smallest hashes, and judge the others.
Features are lengths, depth, ratios, character entropy, parameter counts, and what
share of the labelled URLs with the same host suffix is blocked.  Suffix statistics
cover all labelled URLs.

A null URL or one without ``://`` has an empty host and path; no rule fits it and
the trees judge its empty features.  Without labelled URLs of both verdicts there
is nothing to learn: then the only labelled verdict decides, or ``allow``.  Repeated
rows get equal rows.  An empty table gives an empty result.  Input columns named as
an output column are replaced.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import drop_clashes, materialize

#: Most labelled URLs that the trees learn from.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 11
#: Pseudo-count of the overall block share in a suffix's share.
SMOOTHING = 10.0
#: Host suffixes up to which their statistics are broadcast; else they are a shuffle join.
MAX_BROADCAST_SUFFIXES = 200_000
ALPHABET = string.ascii_lowercase + string.digits + "-._/?=&%#:~+"
FEATURES = ["url_length", "host_length", "path_length", "query_length", "depth", "host_labels", "digit_ratio",
            "host_digits", "hyphens", "entropy", "parameters", "has_fragment", "is_https", "longest_segment",
            "suffix_share", "suffix_count"]
OUTPUT = ["host", "path", "rule", "verdict", "block_score"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")), F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def fitting_rule(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        host, slash, tail = text.partition("/")
        fits = (((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host)))
                & F.startswith(F.col("path"), F.lit(slash + tail)))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy in bits of the characters of ``ALPHABET``, letters in lower case; others count as one."""
    text = F.lower(text)
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    counts = [count_of(text, c) for c in ALPHABET]
    counts.append(F.length(F.translate(text, ALPHABET, "")).cast("double"))
    parts = [F.when(c > 0, -(c / size) * F.log2(c / size)).otherwise(0.0) for c in counts]
    return sum(parts[1:], parts[0])


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` with host, path, its host suffix and the features that need no statistics."""
    host, path = host_and_path(F.col("url"))
    pages = pages.withColumns({"host": host, "path": path, "__url": F.coalesce("url", F.lit(""))})
    url, size = F.col("__url"), F.greatest(F.length("__url"), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    segments = F.transform(F.split("path", "/"), lambda s: F.length(s))
    return pages.withColumns({
        "suffix": F.substring_index("host", ".", -2),
        "url_length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "query_length": F.length(query).cast("double"),
        "depth": count_of(F.col("path"), "/"), "host_labels": count_of(F.col("host"), ".") + 1,
        "digit_ratio": count_of(url, string.digits) / size, "host_digits": count_of(F.col("host"), string.digits),
        "hyphens": count_of(url, "-"), "entropy": entropy(url),
        "parameters": F.when(query == "", 0.0).otherwise(count_of(query, "&") + 1),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "is_https": F.startswith(F.lower(url), F.lit("https://")).cast("double"),
        "longest_segment": F.array_max(segments).cast("double")}).drop("__url")


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """Per host suffix: the smoothed share of blocked labelled URLs, and how many there are."""
    sums = labelled.groupBy("suffix").agg(F.sum("label").alias("blocked"), F.count("*").alias("n"))
    sums = materialize(sums, "url-suffixes")
    whole = sums.agg(F.sum("blocked"), F.sum("n")).first()
    prior = (whole[0] or 0.0) / (whole[1] or 1)
    share = (F.col("blocked") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)
    stats = sums.select(F.col("suffix").alias("__suffix"), share.alias("suffix_share"),
                        F.log1p(F.col("n")).alias("suffix_count"))
    return F.broadcast(stats) if sums.count() <= MAX_BROADCAST_SUFFIXES else stats


def with_statistics(pages: DataFrame, stats: DataFrame, prior: float) -> DataFrame:
    return (pages.join(stats, F.col("suffix") == F.col("__suffix"), "left").drop("__suffix")
            .withColumns({"suffix_share": F.coalesce("suffix_share", F.lit(prior)),
                          "suffix_count": F.coalesce("suffix_count", F.lit(0.0))}))


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS):
    """Boosted trees from at most ``train_rows`` labelled rows with all features."""
    sample = labelled.select("label", *FEATURES, F.xxhash64("url").alias("h")).orderBy("h").limit(train_rows)
    sample = materialize(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
                         .select("features", "label").coalesce(1), "url-sample")
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(sample)


def judge(pages: DataFrame, rules: list[tuple[str, str]], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the trees' block_score."""
    pages = drop_clashes(pages, [*OUTPUT, *FEATURES, "suffix", "label", "features", "rawPrediction", "probability",
                                 "prediction", "__suffix", "__url"])
    rule, says = fitting_rule(rules)
    ruled = materialize(lexical(pages).withColumns({"rule": rule, "__says": says}), "url-ruled")
    labelled = ruled.where("rule is not null").withColumn("label", (F.col("__says") == "block").cast("double"))
    seen = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(seen) < 2:
        only = "block" if seen.get(1.0) else "allow"
        scored = ruled.withColumn("block_score", F.lit(1.0 if only == "block" else 0.0))
    else:
        prior = seen[1.0] / sum(seen.values())
        stats = suffix_statistics(labelled)
        model = train(with_statistics(labelled, stats, prior), train_rows)
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
            with_statistics(ruled, stats, prior))
        scored = model.transform(vectors).withColumn("block_score", vector_to_array("probability")[1])
        scored = scored.drop("features", "rawPrediction", "probability", "prediction")
    method = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("__says", method)).drop("__says", "suffix", *FEATURES)
