"""Near duplicates on shingles of other widths than two words."""

import frames

from demandlens.llm import near_dedup


def similarity(a, b, width):
    def shingles(text):
        words = text.split()
        return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def changed(text, every):
    return " ".join(f"x{i}" if i % every == every // 2 else w for i, w in enumerate(text.split()))


def test_five_words_keep_what_only_word_pairs_link(spark):
    near, far = frames.prose(1, 180), frames.prose(2, 180)
    near_copy, far_copy = changed(near, 180), changed(far, 20)
    assert similarity(near, near_copy, 5) > 0.8 and similarity(far, far_copy, 2) > 0.8 > 0.65 > similarity(far, far_copy, 5)
    texts = [near, near_copy, far, far_copy, "one two three", "one two three", "one two four"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    five = near_dedup.near_duplicates(docs, width=5).where("kept")
    assert sorted(r["doc_id"] for r in five.collect()) == [0, 2, 3, 4, 6]
    two = near_dedup.near_duplicates(docs).where("kept")
    assert sorted(r["doc_id"] for r in two.collect()) == [0, 2, 4, 6]


def test_shingles_of_each_width():
    words = "a b c d e f".split()
    for width in range(1, 9):
        assert len(near_dedup.shingles(" ".join(words), width)) == max(1, len(words) - width + 1)
    assert len(near_dedup.shingles("", 5)) == 0
