"""More entities of one form than its first space of surrogates holds."""

import string

from demandlens.llm import pii

KEY = b"test key"


def test_each_attempt_has_a_larger_space():
    for kind, entity in (("email", "j@firm.de"), ("email", "j@mail.firm.de"), ("secret", "____________")):
        drawn = {pii.surrogate(KEY, kind, entity, attempt) for attempt in range(200)}
        assert len(drawn) > 190
    assert len({pii.surrogate(KEY, "email", f"{c}@firm{i}.de") for c in string.ascii_lowercase for i in range(10)}) > 100


def test_american_numbers_are_never_real_ones():
    for attempt in range(6):
        new = pii.surrogate(KEY, "phone", "12125550147", attempt)
        assert len(new) == 11 and new[0] == "1" and (new[4:7] == "555" or new[1] in "01")


def test_same_shaped_entities_get_distinct_surrogates(spark):
    letters = string.ascii_lowercase
    mails = [f"{a}@{d}" for a in letters for d in ("firm.de", "firm.com", "a.b.org")]
    mails += [f"{a}{b}@firm.com" for a in letters for b in letters] + [f"{a}{b}@firm.de" for a in letters for b in letters]
    entities = [("email", e) for e in mails] + [("secret", "_" * 12), ("secret", "-" * 12), ("secret", "/" * 16)]
    got = pii.distinct_surrogates(spark.createDataFrame(entities, "kind string, entity string"), KEY).collect()
    new = {r["surrogate"] for r in got}
    assert len(got) == len(entities) == len(new) and not new & {e for _, e in entities}
    assert all(r["surrogate"].rsplit(".", 2)[1] == "example" for r in got if r["kind"] == "email")


def test_lengthened_surrogates_reach_the_texts(spark):
    docs = spark.createDataFrame([(i, f"write to {c}@a.b.org or x@c.d.org") for i, c in enumerate(string.ascii_lowercase * 2)],
                                 "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, KEY).collect()}
    assert all(texts[i] == texts[i + 26] for i in range(26)) and len(set(texts.values())) == 26
