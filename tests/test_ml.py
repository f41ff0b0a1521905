"""Feature stages, classifiers and a whole training run, with one-point grids so that the tests stay short."""

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from conftest import SF_SMALL
from demandlens.ml import models as mdl
from demandlens.ml.features import ASSEMBLED, LABEL, NUMERIC, SCALED, feature_stages, slot_names
from demandlens.plans import ml as mlplan
from demandlens.plans import mlprep
from demandlens.session import scratch_dir

POINT = {"rf": {"numTrees": [5], "maxDepth": [3]}, "gbt": {"maxIter": [3], "maxDepth": [2]},
         "svm": {"regParam": [0.1], "maxIter": [5]}, "nb": {"modelType": ["multinomial", "complement"]}}


def small_set(spark, rows=240):
    """A learnable ML set: the label follows two of the ratios."""
    i = F.col("id")
    return spark.range(rows).select(
        F.concat(F.lit("c"), i % 4).alias("search_country"), F.concat(F.lit("p"), i % 15).alias("search_position"),
        (i % 9 + 5).alias("group_count"), (i % 4 + 1).alias("distinct_companies"),
        (i % 3 + 1).alias("distinct_job_levels"), (i % 2 + 1).alias("distinct_job_types"),
        ((i % 5) / 4).alias("summary_coverage"), (i % 6 + 1).alias("distinct_skills"),
        ((i % 6 + 1) / 5).alias("skills_per_posting"), ((i % 4 + 1) / 5).alias("companies_per_posting"),
        ((i % 6 + i % 4) > 5).cast("int").alias("high_demand"),
        F.when(i % 10 < 7, "train").otherwise("test").alias("split"))


@pytest.fixture(scope="module")
def run(spark):
    out = mlplan.Run(small_set(spark), scratch_dir(spark, "t-run"), POINT)
    yield out
    out.close()


def test_every_classifier_searches_its_whole_grid_by_default():
    assert [len(mdl.CLASSIFIERS[n].points()) for n in mdl.MODEL_NAMES] == [27] * 4
    assert mdl.shown({"thresholds": [0.3, 0.7], "smoothing": 1.0}) == "smoothing=1.0,thresholds=0.3|0.7"


def test_points_share_fits_that_would_be_equal():
    assert [len(mdl.CLASSIFIERS[n].fits()) for n in mdl.MODEL_NAMES] == [27, 27, 3, 7]
    for name in mdl.MODEL_NAMES:
        assert sorted(p for places in mdl.CLASSIFIERS[name].fits() for p in places) == list(range(27))


def test_shared_fits_score_every_point_as_cross_validator_does(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    from demandlens.session import write_once

    grids = {"nb": {"smoothing": [0.5, 2.0], "modelType": ["gaussian", "multinomial", "complement"],
                    "thresholds": [[0.3, 0.7], [0.6, 0.4]]},
             "svm": {"regParam": [0.05, 0.5], "threshold": [-0.4, 0.3], "aggregationDepth": [2, 3], "maxIter": [4]},
             "gbt": {"maxIter": [2], "maxDepth": [1, 3]}, "rf": {"numTrees": [3], "maxDepth": [2, 4]}}
    train = small_set(spark, 150).drop("split").coalesce(1)
    folded = write_once(mdl.stratified_folds(train, 3).coalesce(1), "t-folds").cache()
    prepared = mdl.prepare(train, 3)
    for name, grid in grids.items():
        got = mdl.tune(name, None, grid=grid, prepared=prepared)
        spec = mdl.CLASSIFIERS[name]
        estimator = spec.make(labelCol=LABEL, featuresCol=SCALED if spec.scaled else ASSEMBLED)
        search = CrossValidator(
            estimator=Pipeline(stages=[*feature_stages(scale=spec.scaled), estimator]), numFolds=3, parallelism=4, foldCol="fold",
            estimatorParamMaps=[{estimator.getParam(k): v for k, v in p.items()} for p in got.points],
            evaluator=MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1"))
        want = search.fit(folded)
        assert got.scores == pytest.approx(want.avgMetrics, abs=1e-9), name
        assert len(set(got.scores)) > 1
        a, b = (m.transform(train).select("prediction").collect() for m in (got.model, want.bestModel))
        assert a == b
    prepared.close()


def test_grid_tables(spark, run):
    grid = mdl.cv_grid_table(spark, run.all_tuned()).collect()
    assert len(grid) == sum(math.prod(map(len, g.values())) for g in POINT.values())
    best = {r.model: r for r in mdl.best_params_table(spark, run.all_tuned()).collect()}
    for name in mdl.MODEL_NAMES:
        top = max(r.mean_f1 for r in grid if r.model == name)
        assert best[name].cv_f1 == top and 0 <= top <= 1


def test_metrics_of_fitted_models_agree_with_mllib(spark, run):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    got = {r.model: r for r in run.model_metrics().collect()}
    assert set(got) == set(mlplan.SCORED)
    for name in mdl.MODEL_NAMES:
        pred = run.model(name).transform(run.test)
        for metric in ("accuracy", "f1"):
            want = MulticlassClassificationEvaluator(labelCol=LABEL, metricName=metric).evaluate(pred)
            assert abs(got[name][metric] - want) < 1e-9
        want = BinaryClassificationEvaluator(labelCol=LABEL, numBins=0).evaluate(pred)
        assert abs(got[name].auc_roc - want) < 1e-9
    assert got["gbt"].accuracy > 0.6


def test_confusions_and_class_metrics_cover_the_test_part(run):
    rows, total = run.confusions().collect(), run.test.count()
    for name in mlplan.SCORED:
        assert sum(r["count"] for r in rows if r.model == name) == total
    per = run.class_metrics().where("model = 'rf'").collect()
    assert sum(r.support for r in per) == total


def test_ensemble_is_the_members_mean(run):
    for r in run.scored().collect():
        mean = (r.prob_rf + r.prob_gbt + r.prob_svm) / 3
        assert abs(mean - r.prob_ensemble) < 1e-12 and r.pred_ensemble == int(mean >= 0.5)
        assert all(0 <= r[f"prob_{n}"] <= 1 for n in mdl.MODEL_NAMES)


def test_loaded_models_predict_as_the_fitted(run):
    for name in mdl.MODEL_NAMES:
        fitted = [r.prediction for r in run.tuned(name).model.transform(run.test).orderBy(*run.test.columns).collect()]
        loaded = [r.prediction for r in run.model(name).transform(run.test).orderBy(*run.test.columns).collect()]
        assert fitted == loaded


def test_importances_are_named_and_sum_to_one(run):
    rows = run.importances().collect()
    for name in ("rf", "gbt"):
        mine = {r.feature: r.importance for r in rows if r.model == name}
        assert abs(sum(mine.values()) - 1) < 1e-9 and set(NUMERIC) <= set(mine)
        assert any(f.endswith("__unknown") for f in mine)
    assert {r.model for r in rows} == {"rf", "gbt"}


def test_predictions_carry_probabilities(run):
    rows = run.predictions().collect()
    assert {r.source for r in rows} == {"held_out", "crafted"}
    assert all(0 <= r[f"prob_{n}"] <= 1 for r in rows for n in mlplan.SCORED)


def test_features_slots_and_scaling(spark, run):
    fitted = Pipeline(stages=feature_stages(scale=True)).fit(run.train)
    out = fitted.transform(run.test)
    names = slot_names(out)
    row = out.select(ASSEMBLED, SCALED).first()
    assert len(names) == row[0].size == row[1].size == len(NUMERIC) + 4 + 1 + 15 + 1
    unseen = run.test.withColumn("search_country", F.lit("nowhere"))
    slots = PipelineModel(stages=fitted.stages[:-1]).transform(unseen).select(ASSEMBLED).first()[0]
    assert slots[len(NUMERIC) + 4] == 1.0


def test_blank_and_null_keys_are_told_apart(spark):
    df = small_set(spark).drop("split").withColumn("search_country", F.when(F.col("group_count") > 8, "").otherwise("c"))
    fitted = Pipeline(stages=feature_stages()).fit(df)
    assert any(n.endswith("(blank)") for n in slot_names(fitted.transform(df)).values())


def test_folds_keep_every_row_and_every_class(spark):
    df = small_set(spark).drop("split").withColumn(LABEL, F.expr("cast(group_count % 3 as int)"))
    a = mdl.stratified_folds(df.repartition(3), 3)
    assert a.drop("fold").exceptAll(df).count() == 0 and a.count() == df.count()
    sizes = {(r[LABEL], r.fold): r["count"] for r in a.groupBy(LABEL, "fold").count().collect()}
    assert len(sizes) == 9
    for c in range(3):
        mine = [sizes[c, k] for k in range(3)]
        assert max(mine) - min(mine) <= 1
    b = mdl.stratified_folds(df.repartition(7), 3)
    assert a.exceptAll(b).count() == 0  # though all keys repeat
    with pytest.raises(Exception, match="has no high_demand"):
        mdl.stratified_folds(df.withColumn(LABEL, F.when(F.col("group_count") > 6, F.col(LABEL)))).collect()


def test_a_changed_input_gets_a_new_run(spark, tmp_path):
    mark = mlplan.fingerprint(spark, SF_SMALL)
    assert mark == mlplan.fingerprint(spark, SF_SMALL) != mlplan.fingerprint(spark, SF_SMALL.replace("0.001", "0.01"))


def test_medians_of_an_empty_test_part_are_zero(spark):
    empty = small_set(spark).drop("split").where("false")
    rows = mlprep.whatif_rows(empty).collect()
    assert len(rows) == len(mlprep.SCENARIOS) and all(r.group_count == 0 and r.summary_coverage == 0 for r in rows)
    with pytest.raises(ValueError, match="nothing to learn"):
        mlprep.write_parts(small_set(spark).where("false"), scratch_dir(spark, "t-empty"))


def test_searches_are_kept_for_other_processes(spark, run, monkeypatch):
    folder = scratch_dir(spark, "t-searches")
    grid = {"nb": POINT["nb"]}
    first = mlplan.Run(small_set(spark), scratch_dir(spark, "t-run"), grid).keep_in(folder)
    want = first.tuned("nb")
    first.close()
    again = mlplan.Run(small_set(spark), scratch_dir(spark, "t-run"), grid).keep_in(folder)
    monkeypatch.setattr(mdl, "tune", lambda *a, **k: pytest.fail("searched again"))
    got = again.tuned("nb")
    assert got.scores == want.scores and got.points == want.points
    rows = again.test.orderBy(*again.test.columns)
    assert got.model.transform(rows).select("prediction").collect() == want.model.transform(rows).select("prediction").collect()
    other = {"nb": {"modelType": ["complement"]}}
    assert mlplan.stored_search(spark, folder, "nb", other["nb"]) is None  # another grid is another search
    again.close()


def test_one_model_is_scored_without_training_the_others(spark):
    alone = mlplan.Run(small_set(spark), scratch_dir(spark, "t-run"), POINT)
    row = alone.metrics_of("nb", alone=True).first()
    assert set(alone._tuned) == {"nb"} and row.model == "nb" and 0 <= row.auc_roc <= 1
    alone.close()


def test_searches_of_all_classifiers_run_side_by_side(spark, monkeypatch):
    """No search waits for another: each reaches its first fits while the others are under way."""
    import threading

    together, one = threading.Barrier(len(mdl.MODEL_NAMES)), mdl.tune

    def tune(*args, **kwargs):
        together.wait(60)
        return one(*args, **kwargs)

    run = mlplan.Run(small_set(spark), scratch_dir(spark, "t-run"), POINT)
    alone = {name: mdl.tune(name, None, grid=POINT[name], prepared=run.prepared()) for name in mdl.MODEL_NAMES}
    monkeypatch.setattr(mdl, "tune", tune)
    for got in run.all_tuned():
        assert got.points == alone[got.name].points and got.scores == alone[got.name].scores
    run.close()


def test_vectors_start_at_their_checkpoint(spark):
    """No stage of a fit takes the scan, the joins and the feature stages of its rows along."""
    prepared = mdl.prepare(small_set(spark).drop("split"))
    for rows in [prepared.whole.train, *[df for part in prepared.folds for df in (part.train, part.valid)]]:
        lineage = rows._jdf.queryExecution().toRdd().toDebugString()
        assert "ReliableCheckpointRDD" in lineage and "FileScanRDD" not in lineage
        assert slot_names(rows)  # the slots' attributes stay
    prepared.close()


def test_models_are_saved_side_by_side(spark, run, monkeypatch):
    import threading

    together, one = threading.Barrier(len(mdl.MODEL_NAMES)), mlplan.Run.model

    def model(self, name):
        together.wait(60)
        return one(self, name)

    monkeypatch.setattr(mlplan.Run, "model", model)
    assert list(run.models()) == list(mdl.MODEL_NAMES)


@pytest.mark.parametrize("name", ["rf", "gbt"])
def test_trees_are_wrapped_on_demand_only(spark, name):
    """The fit is MLlib's own; no tree crosses to Python unless asked for."""
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier

    rows = Pipeline(stages=feature_stages()).fit(small_set(spark)).transform(small_set(spark)).coalesce(1)
    io = {"labelCol": LABEL, "featuresCol": ASSEMBLED}
    params = {"numTrees": 4, "maxDepth": 3} if name == "rf" else {"maxIter": 3, "maxDepth": 2}
    model = mdl.with_params(mdl.CLASSIFIERS[name].make(**io), params).fit(rows)
    copied = mdl.with_params(model, {"predictionCol": "p"})
    copied.transform(rows)
    assert "trees" not in model.__dict__ and "trees" not in copied.__dict__
    plain = {"rf": RandomForestClassifier, "gbt": GBTClassifier}[name](seed=mdl.SEED, **io, **params).fit(rows)
    assert model.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]
    assert [t.toDebugString.split("\n")[1:] for t in model.trees] == [t.toDebugString.split("\n")[1:] for t in plain.trees]
