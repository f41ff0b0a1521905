"""Quality rules combined by weak supervision, with DataFrame operations only.

Each rule votes good (1), bad (-1) or abstains (0) on a document.  No rule decides
alone: expectation-maximisation over the vote patterns of all documents estimates
how often each rule votes right on good and on bad documents, and a document stays
when its posterior probability of being good reaches ``KEEP_AT``.  Patterns are
counted in Spark; at most 3 ** (number of rules) of them reach the driver,
whatever the size of the input.

Measures are taken over whole texts in one pass without shuffling.  A document
that fails the base (fewer than ``MIN_WORDS`` words, or repeated eight-word windows
over more than ``MAX_REPEAT_PERCENT`` of its words) is rejected whatever the votes.

A null text has no words, lines or characters, so it fails the base like an empty
one.  Repeated rows get equal rows.  An empty table gives an empty result.  Input
columns named as an output column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import WHITESPACE, drop_clashes, let, materialize, text_or_empty

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_AT = 0.5
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_OTHER = ["__lines", "__capitals", "__distinct", "__stutter", "__marks", "__letters"]
MAX_ROUNDS = 100


def words_of(text: Column) -> Column:
    """The words of a text: split at single spaces after mapping white space to spaces."""
    return F.filter(F.split(F.translate(text, WHITESPACE, " " * len(WHITESPACE)), " "), lambda w: w != "")


def chars_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def window_hashes(hashes: Column) -> Column:
    """64-bit hashes of all eight-word windows, joined from pairs, fours and eights."""
    def joined(step: int):
        return lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + F.lit(step))))

    def full(h8: Column) -> Column:
        return F.slice(h8, F.lit(1), F.greatest(F.size(h8) - (WINDOW - 1), F.lit(0)))

    return let(let(let(hashes, joined(1)), joined(2)), lambda h4: full(joined(4)(h4)))


def repeated_words(windows: Column) -> Column:
    """Number of words inside windows that occur twice or more.

    Sorting (hash, position) puts equal windows side by side; the covered words
    are the gaps between the repeated windows' positions, eight at most each.
    """
    def neighbours(s: Column) -> Column:
        same = F.transform(s, lambda x, i: F.when(
            (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"]))
        return F.sort_array(F.filter(same, lambda x: x.isNotNull()))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def counted(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(let(let(by_hash, neighbours), covered)))

    return let(windows, counted)


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of each whole text."""
    text = text_or_empty(text_col)

    def of_words(w: Column) -> Column:
        def of_hashes(h: Column) -> Column:
            stutter = F.size(F.filter(h, lambda x, i: x == F.get(h, i + 1)))
            return F.struct(F.size(h).cast("long").alias("n_words"),
                            repeated_words(window_hashes(h)).alias("n_repeat_words"),
                            F.size(F.array_distinct(h)).cast("long").alias("__distinct"),
                            stutter.cast("long").alias("__stutter"))
        return let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes)

    def of_lines(lines: Column) -> Column:
        return F.struct((F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                        F.size(lines).cast("long").alias("__lines"))

    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITESPACE, "") != "")
    letters = F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long")
    marked = F.length(F.regexp_replace(text, r"[.,;:!?]+(?=[\x20\x09-\x0D]|$)", ""))
    out = drop_clashes(docs, [*COUNTS, *_OTHER, "__w", "__l"]).withColumns({
        "__w": let(words_of(text), of_words), "__l": let(lines, of_lines),
        "word_chars": F.length(F.translate(text, WHITESPACE, "")).cast("long"),
        "n_symbols": chars_of(text, SYMBOLS), "__capitals": chars_of(text, CAPITALS),
        "__letters": letters, "__marks": (F.length(text) - marked).cast("long")})
    inner = {c: F.col(f"__w.{c}") for c in ("n_words", "n_repeat_words", "__distinct", "__stutter")}
    inner |= {c: F.col(f"__l.{c}") for c in ("n_dup_lines", "__lines")}
    return out.withColumns(inner).drop("__w", "__l")


def base_failed() -> Column:
    words = F.col("n_words")
    return (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words)


def rules() -> dict[str, Column]:
    """Votes by name.

    A defect's absence is no merit: rules that look for one defect vote bad or
    abstain, and those on a text's general shape vote bad, good or abstain.
    """
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    lines = F.greatest("__lines", F.lit(1))
    variety, marks = F.col("__distinct") / words, F.col("__marks") / words
    letters, mean_word = F.col("__letters") / chars, chars / words

    def vote(bad: Column, good: Column | None = None) -> Column:
        out = F.when(bad, -1)
        return (out if good is None else out.when(good, 1)).otherwise(0)

    return {
        "symbols": vote(F.col("n_symbols") > 0.02 * chars),
        "capitals": vote(F.col("__capitals") > 0.35 * chars),
        "repeats": vote(F.col("n_repeat_words") > 0.2 * words),
        "lines": vote(F.col("n_dup_lines") > 0.4 * lines),
        "stutter": vote(F.col("__stutter") > 0.1 * words),
        "variety": vote((variety < 0.3) & (words < 2000), variety > 0.6),
        "marks": vote((marks < 0.04) | (marks > 0.6), marks.between(0.08, 0.4)),
        "letters": vote(letters < 0.9, letters > 0.95),
        "word_length": vote((mean_word > 15) | (mean_word < 2), mean_word.between(4, 6.5)),
    }


def estimate(patterns: Iterable[tuple[tuple[int, ...], int]], rule_count: int,
             rounds: int = MAX_ROUNDS) -> tuple[float, list[dict[int, float]]]:
    """EM over counted vote patterns: prior log-odds, and each rule's log-odds for -1, 0 and 1.

    Starts from the share of good among a pattern's votes.  How often a rule votes
    either way, or abstains, is estimated on good and on bad documents, with one
    document of each kind added so that no rule becomes infallible.  A vote for
    good is never evidence against a document, nor a vote for bad evidence for it.
    """
    patterns = list(patterns)
    good = [(0.5 + sum(v == 1 for v in p)) / (1 + sum(v != 0 for v in p)) for p, _ in patterns]
    prior, odds = 0.0, [dict.fromkeys((-1, 0, 1), 0.0)] * rule_count
    for _ in range(rounds):
        of_good = sum(g * n for g, (_, n) in zip(good, patterns, strict=True)) + 3.0
        of_bad = sum((1 - g) * n for g, (_, n) in zip(good, patterns, strict=True)) + 3.0
        prior, before, odds = math.log(of_good / of_bad), odds, []
        for r in range(rule_count):
            table = {v: [1.0, 1.0] for v in (-1, 0, 1)}  # by vote: on bad, on good documents
            for g, (p, n) in zip(good, patterns, strict=True):
                table[p[r]][0] += (1 - g) * n
                table[p[r]][1] += g * n
            ratio = {v: math.log((t[1] / of_good) / (t[0] / of_bad)) for v, t in table.items()}
            odds.append({-1: min(ratio[-1], 0.0), 0: ratio[0], 1: max(ratio[1], 0.0)})
        sums = [prior + sum(odds[r][v] for r, v in enumerate(p)) for p, _ in patterns]
        good = [1 / (1 + math.exp(-max(-500.0, min(500.0, x)))) for x in sums]
        if max((abs(x[v] - y[v]) for x, y in zip(before, odds, strict=True) for v in x), default=0.0) < 1e-6:
            break
    return prior, odds


def judge(docs: DataFrame, text_col: str = "text", keep_columns: bool = True) -> DataFrame:
    """``docs`` with counts, base_failed, quality (posterior) and kept.

    The measured rows are written once: the patterns and the verdicts both read
    them.  ``keep_columns=False`` leaves the text out of that table.
    """
    docs = drop_clashes(docs, ["base_failed", "quality", "kept"])
    measured = measures(docs, text_col)
    if not keep_columns:
        measured = measured.drop(text_col)
    votes = rules()
    measured = materialize(measured.withColumn("base_failed", base_failed())
                           .withColumns({f"__vote_{k}": v for k, v in votes.items()}), "quality-measures")
    names = [f"__vote_{k}" for k in votes]
    patterns = measured.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()  # <= 3 ** rules
    prior, odds = estimate([(tuple(r[c] for c in names), r["n"]) for r in patterns], len(names))
    total = F.lit(prior)
    for name, of_vote in zip(names, odds, strict=True):
        total = total + F.when(F.col(name) == -1, of_vote[-1]).when(F.col(name) == 1, of_vote[1]).otherwise(of_vote[0])
    out = measured.withColumn("quality", 1 / (1 + F.exp(-total)))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_AT))
    return out.drop(*names, *_OTHER)
