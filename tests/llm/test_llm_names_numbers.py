"""Names after capitalised words, American numbers of ten digits, and forms with more entities than surrogates."""

import re

import pytest

from demandlens.llm import pii

KEY = b"test key"


def rewritten(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.pseudonymise(df, KEY).orderBy("doc_id").collect()]


def test_names_after_a_capitalised_word_are_found(spark):
    texts = ["Dear Anna Smith wrote", "Yesterday Peter Brown called", "Contact John Doe now", "Hello Sarah Connor", "Anna Smith wrote",
             "Big Red House by New River", "THE END Of Paul Green"]
    got = rewritten(spark, texts)
    for text, new, names in zip(texts, got, ["Anna Smith", "Peter Brown", "John Doe", "Sarah Connor", "Anna Smith", "", "Paul Green"],
                                strict=True):
        for name in names.split():
            assert not re.search(rf"\b{name}\b", new), (text, new)
        kept = [w for w in text.split() if w not in names.split()]
        assert [w for w in new.split() if w in kept] == kept
    assert got[5] == texts[5]
    assert got[0].split()[1:3] == got[4].split()[:2]  # one person, one surrogate


def test_ten_digit_numbers_get_the_reserved_exchange(spark):
    got = rewritten(spark, ["call 212-867-5309 or 212-867-5310", "(212) 867-5309"])
    assert re.fullmatch(r"call \d{3}-555-\d{4} or \d{3}-555-\d{4}", got[0])
    assert re.sub(r"\D", "", got[1]) == re.sub(r"\D", "", got[0].split(" or ")[0])
    assert not re.search("867", got[0] + got[1])


def test_a_full_form_is_an_error_and_no_endless_loop(spark, monkeypatch):
    monkeypatch.setattr(pii, "MAX_ROUNDS", 4)
    monkeypatch.setattr(pii.Draws, "like", lambda self, text: "0" * len(text))  # every surrogate is the same
    df = spark.createDataFrame([("ssn", f"{i:09d}") for i in range(20)], "kind string, entity string")
    same = df.selectExpr("kind", "entity")
    with pytest.raises(ValueError, match="ssn: more distinct entities"):
        monkeypatch.setattr(pii, "draw", lambda entities, key: entities.selectExpr("kind", "entity", "attempt", "'9' AS surrogate"))
        pii.distinct_surrogates(same, KEY)
