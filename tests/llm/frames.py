"""Small frames with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHES = {"kept": "'x'", "score": "1", "shard": "2", "keep_id": "3", "n": "4", "key": "5", "label": "6", "tokens": "7",
           "epoch": "8", "quality": "9", "host": "'h'", "rule": "'r'", "part": "10", "length": "11", "node": "12",
           "bands": "13", "n_emails": "14", "component": "15", "place": "16", "h": "17", "domain": "'d'"}


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))
                    for _ in range(words))


def rows():
    long = "\n".join(prose(1000 + i, 40) + "." for i in range(500))
    out = [(1, "alpha beta gamma", "en", "src0"), (2, " alpha\tbeta gamma\n", "en", "src0"), (3, None, None, None),
           (4, "", "en", "src1"), (5, " \n\t", "fr", "src1"), (6, long, "en", "src2"), (7, long + " end", "de", "src2"),
           (8, "word", "en", "src3"), (9, "Word", "en", "src3"), (10, "é¿€😀 héé", "fr", "src4"),
           (None, "no id here", "en", "src5"), (11, "same row", "en", "src6"), (11, "same row", "en", "src6")]
    base = prose(7, 60)
    for i in range(20, 40):  # near copies: one word in sixty differs
        words = base.split()
        words[i % 60] = f"x{i}"
        out.append((i, " ".join(words), "en", "src0"))
    out += [(i, prose(i, 50) + ".", "en", f"src{i % 7}") for i in range(40, 80)]
    out += [(i, base, "en", "src0") for i in range(80, 95)]  # exact copies: a hot group
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in out]


def documents(spark, clashing=False):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.selectExpr("*", *[f"{v} AS {k}" for k, v in CLASHES.items()]) if clashing else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
