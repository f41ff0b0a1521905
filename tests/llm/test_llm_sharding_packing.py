"""Shards against running sums; packing against its ids, capacities and the lower bound."""

import zlib
from collections import defaultdict

import frames
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from demandlens.llm import packing, queries, sharding


def brute_shards(rows, shards):
    sized = sorted((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8, i)
                   for i, t, *_ in rows)
    total, at, out, slots = sum(r[3] for r in sized), 0, [], defaultdict(int)
    for _, _, crc, size, i in sized:
        shard = (2 * at + size) * shards // (2 * total)
        out.append((i, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return out


def plain(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("clashing", [False, True])
def test_shards_equal_running_sums(spark, clashing):
    got = sharding.shard_by_bytes(frames.documents(spark, clashing), 7).collect()
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    found = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got]
    assert [f[1:] for f in plain(found) if f[0] is None] == [b[1:] for b in brute_shards(frames.rows(), 7) if b[0] is None]
    assert sorted(f for f in found if f[0] is not None) == sorted(b for b in brute_shards(frames.rows(), 7) if b[0] is not None)


@pytest.mark.parametrize("sizes", [[500_000_000] * 3, [15_000_000_000, 14_999_999_992, 8], [499_999_992, 8]])
def test_large_totals_stay_in_the_shards(spark, monkeypatch, sizes):
    monkeypatch.setattr(sharding, "sized_rows", lambda docs, *_: docs)
    docs = spark.createDataFrame([(i, n, 0) for i, n in enumerate(sizes)], "doc_id long, size long, text_crc32 long")
    got = {r["doc_id"]: r["shard"] for r in sharding.shard_by_bytes(docs, 24).collect()}
    assert got == {i: (2 * sum(sizes[:i]) + n) * 24 // (2 * sum(sizes)) for i, n in enumerate(sizes)}
    assert max(got.values()) < 24


def test_shard_query_is_balanced(spark):
    got = queries.op1_byte_shards(spark, SF_SMALL).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert list(sizes.index) == list(range(queries.SHARDS))
    assert (sizes - got["size"].sum() / queries.SHARDS).abs().max() <= got["size"].max()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_shards_of_an_empty_table(spark):
    assert sharding.shard_by_bytes(frames.empty(spark), 24).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(frames.empty(spark), 0)


def check_packing(got, texts, max_tokens=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_files()["tokenizer_file"])
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine, at = got[got.doc_id == i].sort_values("piece"), 0
        assert list(mine.piece) == list(range(len(mine)))
        for k, r in enumerate(mine.itertuples()):
            assert r.start == at and 0 < r.length <= max_tokens and (k == 0 or r.length == max_tokens)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= max_tokens


def test_packing_query_round_trip(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").toPandas()
    got = queries.op8_vector_packing(spark, SF_SMALL).toPandas()
    check_packing(got, dict(zip(docs.doc_id, docs.text, strict=True)))
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) * 1.02 + 1


def test_packing_awkward_rows(spark):
    docs = frames.documents(spark, clashing=True).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = packing.pack(docs, **queries.tokenizer_files(), max_tokens=64).toPandas()
    check_packing(got, {r[0]: r[1] for r in frames.rows() if r[0] is not None}, 64)
    everything = packing.pack(frames.documents(spark), **queries.tokenizer_files())
    assert everything.where("piece = 0").count() == len(frames.rows())
    assert packing.pack(frames.empty(spark), **queries.tokenizer_files()).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=25),
       st.integers(1, 8), st.integers(200, 3600))
def test_every_capacity_holds_and_every_piece_is_placed(sizes, max_documents, max_attention):
    counts = np.zeros(61, np.int64)
    for length, n in sizes.items():
        counts[length] = n
    placed = np.zeros(61, np.int64)
    for uses, filled in packing.plan_patterns(counts, 60, max_documents, max_attention):
        alone = sum(filled.values()) == 1
        assert sum(k * v for k, v in filled.items()) <= 60
        assert alone or sum(filled.values()) <= max_documents
        assert alone or sum(k * k * v for k, v in filled.items()) <= max_attention
        for length, times in filled.items():
            placed[length] += uses * times
    assert (placed == counts).all()


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=300))
def test_ranks_give_the_tokenizer_files_ids(text):
    use = packing.encoder(**queries.tokenizer_files())
    assert use.ids(text) == use.tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_and_giant_words_go_through_the_tokenizer():
    use = packing.encoder(**queries.tokenizer_files())
    for text in ("a <|endoftext|> b", "x" * 9000 + " y", "double  space\n\n end "):
        assert use.ids(text) == use.tokenizer.encode(text, add_special_tokens=False).ids
