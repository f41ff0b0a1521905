"""The pipeline's stages: each decision takes effect on all rows, and nothing else changes."""

import frames
import pytest
import test_llm_dedup
from test_llm_sharding_packing import check_packing

import corpus_pipeline
from conftest import SF_SMALL
from demandlens.llm import quality_rules
from demandlens.llm.common import materialize, number_rows


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF_SMALL), "test-stage"))
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "mix", "pack"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    before = {tuple(r) for r in stages[0].collect()}
    assert all({tuple(r) for r in s.collect()} <= before for s in stages[1:-1])


def test_quality_stage_drops_what_the_rules_reject(stages):
    kept = {r["doc_id"] for r in quality_rules.judge(stages[0]).where("kept").collect()}
    assert {i for i, _ in texts(stages[1])} == kept


def test_exact_stage_leaves_one_of_each_text(stages):
    def normal(t):
        return "".join((t or "").split())

    left = [normal(t) for _, t in texts(stages[2])]
    assert len(left) == len(set(left)) and set(left) == {normal(t) for _, t in texts(stages[1])}


def five_word_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_near_stage_leaves_one_of_each_group(stages, monkeypatch):
    monkeypatch.setattr(test_llm_dedup, "shingle_set", five_word_set)
    groups = test_llm_dedup.brute_components(texts(stages[2]))
    assert sorted(i for i, _ in texts(stages[3])) == sorted({c for _, _, c in groups})
    assert len(texts(stages[3])) < len(texts(stages[2])) and corpus_pipeline.NEAR_WIDTH == 5


def test_pack_stage_keeps_all_capacities(stages):
    packed = stages[5].toPandas()
    packed["cost"] = packed["length"] ** 2
    groups = packed.groupby("sequence_id").agg(n=("length", "size"), cost=("cost", "sum"))
    several = groups[groups.n > 1]
    assert (several.n <= corpus_pipeline.PACK_DOCUMENTS).all() and (several.cost <= corpus_pipeline.PACK_ATTENTION).all()
    assert len(several) > 0


def test_row_numbers_stay_the_same(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "doc_id")
    a, b = (sorted(tuple(r) for r in number_rows(d).select("doc_id", "__number.*").collect()) for d in (docs, docs.repartition(3)))
    assert a == b and len({x[1:] for x in a}) == len(a)
    assert number_rows(docs).inputFiles() == docs.inputFiles()  # read in place, not written again
    other = number_rows(frames.documents(spark))
    assert other.select("__number").distinct().count() == other.count()


def test_mix_stage_stays_within_its_share(stages):
    def words(df):
        return sum(max(1, len((t or "").split())) for _, t in texts(df))

    assert 0.7 * words(stages[3]) < words(stages[4]) <= 0.9 * words(stages[3])


def test_pack_stage_places_every_document(stages):
    check_packing(stages[5].toPandas(), dict(texts(stages[4])))


def test_run_gives_the_stages_rows(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    key = ["doc_id", "piece", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, stages[5].select(key).collect()))


@pytest.mark.parametrize("which", ["clashing", "empty"])
def test_stages_take_awkward_tables(spark, which):
    docs = frames.documents(spark, clashing=True) if which == "clashing" else frames.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, ""), "test-stage")
        assert out.columns == docs.columns or out.columns[0] == "doc_id"
        assert (out.count() > 0) == (which == "clashing")
        docs = docs if out.columns != docs.columns else out
