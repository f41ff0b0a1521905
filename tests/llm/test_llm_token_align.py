"""Token alignment against whole-text encoding with decoded bytes only, and its corpus counts against a plain count."""

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from frames import documents, empty
from tokenizers import Tokenizer

from demandlens.llm import token_align as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = [None, "", " ", "   ", "a ", " a", "a  b  ", "\n", "a\n\n b\r\n", "x▁y", "é😀  x <s> <0x41>\n\tq\x00z",
           "<|endoftext|> foo", "日本語 テスト", "it's we'll 12,345.67", "a" * 3000, "１２３ ½", "a\x85c　d​"]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        decoded = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}

    def cut(text):
        """Ids and byte ends of both sides, None without tokens."""
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts_a = [decoded[i] for i in ids_a]
        parts_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        whole = (" " + text).encode()
        if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            return None

        def ends(parts):
            at, out = 0, []
            for p in parts:
                at += len(p)
                out.append(at)
            return out
        return ids_a, ends(parts_a), ids_b, ends(parts_b)
    return cut


def brute_force(rows, cut):
    found = [(i, cut(t)) for i, t in rows]
    links = [[] if f is None else [(x, y) for x, ex in zip(f[0], f[1], strict=True) for y, ey in zip(f[2], f[3], strict=True) if ex == ey]
             for _, f in found]
    count = Counter(p for ls in links for p in ls)
    best = {}
    for (_, y), c in count.items():
        best[y] = max(c, best.get(y, 0))
    out = []
    for (i, f), ls in zip(found, links, strict=True):
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, start = [], 0
        for end in sorted(set(f[1]) & set(f[3])):
            sides = [",".join(str(t) for t, e in zip(f[k], f[k + 1], strict=True) if start < e <= end) for k in (0, 2)]
            groups.append("|".join(sides))
            start = end
        out.append((i, len(f[0]), len(f[2]), len(groups), len(ls), sum(count[p] == best[p[1]] for p in ls),
                    sum(count[p] for p in ls), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr)


def aligned(df, **options):
    out = ta.align_tokenizers(df, A, B, public_tokenizers.PATTERN, **options)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_awkward_and_ordinary_texts(spark, plain):
    df = documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect() if len(r.text or "") < 20_000] + list(enumerate(AWKWARD, 1000))
    got = aligned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got == brute_force(rows, plain)
    assert sum(r[1] > 0 for r in got) > 60


def test_counts_by_shuffle_join_are_the_same(spark):
    df = documents(spark)
    assert aligned(df, max_broadcast_pairs=0) == aligned(df)


def test_empty_table_and_clashing_names(spark):
    assert aligned(empty(spark)) == []
    assert aligned(documents(spark, clashing=True)) == aligned(documents(spark))


def test_link_table_counts_every_link(spark):
    rows = materialised = ta.aligned(documents(spark), A, B, public_tokenizers.PATTERN).cache()
    table = ta.link_pairs(rows).collect()
    assert sum(r["count"] for r in table) == sum(r.n_links for r in materialised.collect())
    assert len({(r.id_a, r.id_b) for r in table}) == len(table) and any(r.best for r in table)


def test_words_are_the_same_as_whole_texts(plain):
    rng = random.Random(3)
    texts = ["".join(rng.choice(" abé😀\n\t1,.日́ -_\x00") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    tool = ta.Aligner(A, B, public_tokenizers.PATTERN, remembered=500)  # forgets on the way
    for start in range(0, len(texts), 100):
        for text, got in zip(texts[start:start + 100], tool.align(texts[start:start + 100]), strict=True):
            want = plain(text)
            assert (got is None) == (want is None)
            assert want is None or [x.tolist() for x in got] == list(want)


def test_a_very_long_text(spark, plain):
    text = "".join(f"word{i % 977} é{i % 13}\n" for i in range(200_000))
    tool = ta.Aligner(A, B, public_tokenizers.PATTERN)
    got = tool.align([text])[0]
    assert len(text) > 2_000_000 and [x.tolist() for x in got] == list(plain(text))
