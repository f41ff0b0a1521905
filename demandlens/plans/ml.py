"""Train, tune, evaluate and score: the MLlib queries.

``Run`` is one training run over one ML set.  The set is written once by split in
the shared scratch folder (which cuts the long lineage of the aggregation plan)
and read back cached, because cross-validation scans it many times.  Every
classifier is tuned over its whole grid, saved and loaded back; the loaded models
score the test part once, and that scored table, written too, is what all metrics
read.  Model metadata (grid scores, importances) is all that is built on the
driver.  ``close`` releases what a run holds.

The registered queries share the run of their input.  An input is told apart by
its files' names, sizes and times, so a changed folder is trained anew, and the
run of the former is closed.  Where the cluster names a shared folder, finished
searches are published there under the input's mark, so that each is done once
and not once a process.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.ml import models as mdl
from demandlens.ml.features import ASSEMBLED, LABEL, NUMERIC, SCALED, feature_stages, slot_names
from demandlens.ml.importance import feature_importance
from demandlens.ml.score import ENSEMBLE_MEMBERS, ENSEMBLE_THRESHOLD, score_with
from demandlens.operators import metrics
from demandlens.plans import mlprep
from demandlens.session import scratch_dir
from demandlens.sources import fixtures as fx
from demandlens.sources import versions

SCORED = (*mdl.MODEL_NAMES, "ensemble")


def all_of(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name of at least one table."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class Run:
    """A training run: splits, tuned models, and the test part scored by all of them."""

    def __init__(self, data: DataFrame, base: str, grids: Mapping[str, Mapping] | None = None):
        """``data`` has a ``split`` column; ``grids`` replaces the classifiers' own grids by name."""
        self.spark, self.base, self.grids = data.sparkSession, base.rstrip("/"), dict(grids or {})
        self.train, self.test = (part.cache() for part in mlprep.write_parts(data, f"{self.base}/dataset"))
        self._prepared: mdl.Prepared | None = None
        self._stored_as: str | None = None
        self._tuned: dict[str, mdl.Tuned] = {}
        self._loaded: dict[str, PipelineModel] = {}
        self._scored: DataFrame | None = None

    def close(self) -> None:
        self.train.unpersist()
        self.test.unpersist()
        if self._prepared is not None:
            self._prepared.close()

    def prepared(self) -> mdl.Prepared:
        """The folds' vectors, shared by all classifiers."""
        if self._prepared is None:
            self._prepared = mdl.prepare(self.train)
        return self._prepared

    def tuned(self, name: str) -> mdl.Tuned:
        """The searched and refitted model; a kept one of the same data and grid is loaded."""
        if not self._take_kept(name):
            self._keep(mdl.tune(name, None, grid=self.grids.get(name), prepared=self.prepared()))
        return self._tuned[name]

    def _take_kept(self, name: str) -> bool:
        """Whether the search is known, here or from the folder of kept ones."""
        if name not in self._tuned and self._stored_as:
            kept = stored_search(self.spark, self._stored_as, name, self.grids.get(name))
            if kept:
                self._tuned[name] = kept
        return name in self._tuned

    def _keep(self, tuned: mdl.Tuned) -> None:
        self._tuned[tuned.name] = tuned
        if self._stored_as:
            store_search(self.spark, self._stored_as, tuned)

    def keep_in(self, folder: str) -> Run:
        """Keep searches under ``folder`` and take those that are there; it must belong to this data alone."""
        self._stored_as = folder.rstrip("/")
        return self

    def all_tuned(self) -> list[mdl.Tuned]:
        """All searches; those not known yet run side by side, and each is kept as it ends."""
        missing = [name for name in mdl.MODEL_NAMES if not self._take_kept(name)]
        if missing:
            mdl.tune_all(missing, self.prepared(), self.grids, self._keep)
        return [self._tuned[name] for name in mdl.MODEL_NAMES]

    def model(self, name: str) -> PipelineModel:
        """The best model as saved and loaded back."""
        if name not in self._loaded:
            path = f"{self.base}/models/{name}"
            self.tuned(name).model.write().overwrite().save(path)
            self._loaded[name] = PipelineModel.load(path)
        return self._loaded[name]

    def models(self) -> dict[str, PipelineModel]:
        """All models as saved and loaded back, side by side: each is many small jobs and files."""
        self.all_tuned()
        with ThreadPoolExecutor(len(mdl.MODEL_NAMES)) as pool:
            return dict(zip(mdl.MODEL_NAMES, pool.map(self.model, mdl.MODEL_NAMES), strict=True))

    def scored(self) -> DataFrame:
        """The test part with every model's prediction, probability and margin, and the ensemble's."""
        if self._scored is None:
            path = f"{self.base}/scored_test"
            score_with(self.models(), self.test, margins=True).write.mode("overwrite").parquet(path)
            self._scored = self.spark.read.parquet(path)
        return self._scored

    def scored_by(self, name: str) -> DataFrame:
        """The test part with one model's columns; no other model is trained for it."""
        if self._scored is not None:
            return self._scored
        path = f"{self.base}/scored_by_{name}"
        score_with({name: self.model(name)}, self.test, [name], margins=True).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def metrics_of(self, name: str, alone: bool = False) -> DataFrame:
        """One row: accuracy, weighted F1 and both curve areas on the test part.

        A model's curves are drawn from its margin, the ensemble's from its mean
        probability.  ``alone`` trains no other model for it.
        """
        score = "prob_ensemble" if name == "ensemble" else f"margin_{name}"
        row = metrics.binary_metrics(self.scored_by(name) if alone else self.scored(), LABEL, f"pred_{name}", score)
        return row.select(F.lit(name).alias("model"), *row.columns)

    def model_metrics(self) -> DataFrame:
        return all_of([self.metrics_of(name) for name in SCORED])

    def confusions(self) -> DataFrame:
        """``(model, label, prediction, count)`` of every model and the ensemble."""
        return all_of([metrics.confusion(self.scored().select(F.col(LABEL).alias("label"),
                                                              F.col(f"pred_{name}").alias("prediction")))
                       .select(F.lit(name).alias("model"), "label", "prediction", "count") for name in SCORED])

    def class_metrics(self) -> DataFrame:
        """Per model and class: support, predicted, tp, precision, recall, F1."""
        parts = []
        for name in SCORED:
            part = metrics.per_class_metrics(self.scored(), LABEL, f"pred_{name}")
            parts.append(part.select(F.lit(name).alias("model"), *part.columns))
        return all_of(parts)

    def importances(self) -> DataFrame:
        found = (feature_importance(model, self.test, name) for name, model in self.models().items())
        table = all_of([part for part in found if part is not None])
        return table.orderBy("model", F.col("importance").desc(), "feature")

    def ensemble_info(self) -> DataFrame:
        row = [("|".join(ENSEMBLE_MEMBERS), ENSEMBLE_THRESHOLD, "mean of member probabilities")]
        return self.spark.createDataFrame(row, "members string, threshold double, rule string")

    def predictions(self) -> DataFrame:
        """Held-out sample and what-if rows with every model's class and probability."""
        rows = score_with(self.models(), mlprep.whatif_rows(self.test))
        shown = [f"{kind}_{name}" for name in SCORED for kind in ("pred", "prob")]
        return (rows.select("source", *mlprep.GROUP_KEYS, F.col(LABEL).alias("true_label"), *shown)
                .orderBy("source", *mlprep.GROUP_KEYS))

    def artefacts(self) -> dict[str, DataFrame]:
        """Every result table of the run by name."""
        return {"model_metrics": self.model_metrics(), "best_params": mdl.best_params_table(self.spark, self.all_tuned()),
                "cv_grid": mdl.cv_grid_table(self.spark, self.all_tuned()), "feature_importance": self.importances(),
                "confusion": self.confusions(), "per_class_metrics": self.class_metrics(),
                "ensemble_info": self.ensemble_info(), "predictions": self.predictions()}


def store_search(spark: SparkSession, folder: str, tuned: mdl.Tuned) -> None:
    """Publish the model and the score of every grid point as one version."""
    rows = [(mdl.shown(p), float(s)) for p, s in zip(tuned.points, tuned.scores, strict=True)]

    def write(path: str) -> None:
        tuned.model.write().save(f"{path}/model")
        spark.createDataFrame(rows, "params string, score double").coalesce(1).write.parquet(f"{path}/grid")

    versions.publish(spark, folder, tuned.name, write)


def stored_search(spark: SparkSession, folder: str, name: str, grid: Mapping | None) -> mdl.Tuned | None:
    """The search published for this classifier, if it was over the same points."""
    path = versions.current(spark, folder, name)
    if path is None:
        return None
    spec = mdl.CLASSIFIERS[name]
    points = (replace(spec, grid=grid) if grid is not None else spec).points()
    scores = {r.params: r.score for r in spark.read.parquet(f"{path}/grid").collect()}  # a row for each grid point
    if sorted(scores) != sorted(map(mdl.shown, points)):
        return None
    return mdl.Tuned(name, PipelineModel.load(f"{path}/model"), points, [scores[mdl.shown(p)] for p in points])


_runs: dict[str, tuple[str, Run]] = {}


def searches_folder(spark: SparkSession, mark: str) -> str | None:
    """Where processes of one cluster share the searches of an input: in the folder that it names, else nowhere."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared.rstrip('/')}/demandlens-searches/{hashlib.sha256(mark.encode()).hexdigest()[:32]}" if shared else None


def fingerprint(spark: SparkSession, sf: str) -> str:
    """Names, sizes and times of the input's files (file-system metadata only)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for table in fx.TABLES:
        for f in files.listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{table}.parquet")):
            found.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join([sf.rstrip("/"), *sorted(found)])


def run_of(spark: SparkSession, sf: str) -> Run:
    """The run over this input; a changed input gets a new one.

    Its searches are kept in the cluster's shared folder, where other processes find them.
    """
    files, application = fingerprint(spark, sf), spark.sparkContext.applicationId
    mark = f"{application}|{files}"
    known = _runs.get(sf)
    if known is None or known[0] != mark:
        if known is not None and known[0].split("|")[0] == application:
            known[1].close()
        run = Run(mlprep.dataset(spark, sf), scratch_dir(spark, "ml-run"))
        folder = searches_folder(spark, files)
        _runs[sf] = (mark, run.keep_in(folder) if folder else run)
    return _runs[sf][1]


def _train_row(spark, sf, name) -> DataFrame:
    run = run_of(spark, sf)
    best = mdl.best_params_table(spark, [run.tuned(name)]).drop("model").collect()[0]  # one row of metadata
    row = run.metrics_of(name, alone=True)
    return row.select("model", F.lit(best[0]).alias("best_params"), F.lit(best[1]).alias("cv_f1"),
                      *row.columns[1:])


def q_train_rf(spark, sf):
    return _train_row(spark, sf, "rf")


def q_train_gbt(spark, sf):
    return _train_row(spark, sf, "gbt")


def q_train_svm(spark, sf):
    return _train_row(spark, sf, "svm")


def q_train_nb(spark, sf):
    return _train_row(spark, sf, "nb")


def slot_values(features: DataFrame) -> DataFrame:
    """One row per (group, slot) of the numeric slots and of the one-hot slots that are set."""
    pair = F.arrays_zip(vector_to_array(ASSEMBLED).alias("raw"), vector_to_array(SCALED).alias("scaled"))
    long = features.select(*mlprep.GROUP_KEYS, F.posexplode(pair).alias("slot", "v"))
    return (long.where((F.col("slot") < len(NUMERIC)) | (F.col("v.raw") != 0))
            .select(*mlprep.GROUP_KEYS, "slot", F.round("v.raw", mlprep.REPORT_DECIMALS).alias("raw_value"),
                    F.round("v.scaled", mlprep.REPORT_DECIMALS).alias("scaled_value")))


def q_encode_features(spark, sf):
    """Indexed, one-hot, assembled and std-scaled features of the test part, encoders fitted on train."""
    run = run_of(spark, sf)
    return slot_values(Pipeline(stages=feature_stages(scale=True)).fit(run.train).transform(run.test))


def q_nb_parameters(spark, sf):
    """Log-probabilities of a multinomial naive Bayes model: ``(label, slot, log_theta)``."""
    run = run_of(spark, sf)
    bayes = NaiveBayes(labelCol=LABEL, featuresCol=ASSEMBLED, modelType="multinomial", smoothing=1.0)
    theta = Pipeline(stages=[*feature_stages(), bayes]).fit(run.train).stages[-1].theta.toArray()
    rows = [(label, slot, round(float(v), mlprep.REPORT_DECIMALS))
            for label, values in enumerate(theta) for slot, v in enumerate(values)]
    return spark.createDataFrame(rows, "label int, slot int, log_theta double")


def q_cv_grid(spark, sf):
    return mdl.cv_grid_table(spark, run_of(spark, sf).all_tuned())


def q_feature_importance(spark, sf):
    return run_of(spark, sf).importances()


def q_model_metrics(spark, sf):
    """One row per model plus the soft-vote ensemble, evaluated on test."""
    return run_of(spark, sf).model_metrics()


def q_model_confusion(spark, sf):
    return run_of(spark, sf).confusions()


def q_model_checks(spark, sf):
    """Per model what must hold for any fit, counted on the scored test part.

    Test rows and positives as the model's confusion counts add up to them, rows
    whose probability lies in 0..1, rows on which the loaded model predicts as
    the fitted one, rows on which the ensemble is the members' mean at the
    threshold, the number of vector slots and the sum of the importances.
    """
    run = run_of(spark, sf)
    scored = run.scored()
    mean = sum((F.col(f"prob_{m}") for m in ENSEMBLE_MEMBERS), F.lit(0.0)) / len(ENSEMBLE_MEMBERS)
    vote = F.col("pred_ensemble") == (mean >= ENSEMBLE_THRESHOLD).cast("int")
    votes = scored.agg(F.count_if(vote).alias("v")).scalar()
    parts = []
    for name in mdl.MODEL_NAMES:
        fitted = run.tuned(name).model
        again = fitted.transform(scored).select(
            "*", (F.col("prediction").cast("int") == F.col(f"pred_{name}")).alias("__same"))
        counts = metrics.confusion(scored, LABEL, f"pred_{name}", "n")
        totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.sum(F.when(F.col(LABEL) == 1, F.col("n")).otherwise(0))
                                     .alias("positives")).alias("t")).scalar()
        features = PipelineModel(stages=fitted.stages[:-1]).transform(run.test)
        weights = getattr(fitted.stages[-1], "featureImportances", None)
        parts.append(again.agg(F.count_if(F.col(f"prob_{name}").between(0, 1)).alias("in_range"),
                               F.count_if("__same").alias("reloaded_same")).select(
            F.lit(name).alias("model"), totals.getField("rows").alias("confusion_total"),
            totals.getField("positives").alias("confusion_positives"), "in_range", "reloaded_same",
            votes.alias("vote_same"), F.lit(len(slot_names(features))).alias("slots"),
            F.lit(None if weights is None else round(float(weights.values.sum()), 6)).cast("double")
            .alias("importance_sum")))
    return all_of(parts)


def q_score_models(spark, sf):
    """Held-out sample + what-if rows scored by every saved model and the ensemble."""
    return run_of(spark, sf).predictions()


QUERIES = {
    "encode_features": q_encode_features,
    "nb_parameters": q_nb_parameters,
    "train_rf": q_train_rf,
    "train_gbt": q_train_gbt,
    "train_svm": q_train_svm,
    "train_nb": q_train_nb,
    "cv_grid": q_cv_grid,
    "feature_importance": q_feature_importance,
    "model_metrics": q_model_metrics,
    "model_confusion": q_model_confusion,
    "model_checks": q_model_checks,
    "score_models": q_score_models,
}
