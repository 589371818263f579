"""Classifiers: defaults, search spaces, fitting, scoring, importance and storage."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    NaiveBayes,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from matchcast.operators.binning import Sample
from matchcast.operators.forest import ForestModel, fit_forest
from matchcast.operators.impute import FeatureState, Standardiser, fit_standardiser
from matchcast.operators.knn import NeighbourModel
from matchcast.operators.linear import LinearModel, fit_linear, problem_of
from matchcast.schema import ROW_KEY

PARALLEL_FITS = 4
FEATURES, RAW, PROBABILITY, CLASS = "_features", "_raw", "_probability", "_class"


@dataclass(frozen=True)
class Learner:
    """One kind of model: its parameters, the values a search tries, and how to build it."""

    defaults: dict[str, Any]
    space: dict[str, list] = field(default_factory=dict)
    scaled: bool = False
    probabilities: bool = True
    weights: bool = True


# The deepest tree Spark ML grows; an unlimited depth is this.
DEEPEST = 30
# Default parameters and search spaces per model. The network is trained by L-BFGS, which
# has no learning rate, so none is offered.
LEARNERS: dict[str, Learner] = {
    "logistic_regression": Learner(
        {"C": 1.0, "penalty": "l2", "max_iter": 1000},
        {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2"]},
        scaled=True,
    ),
    "random_forest": Learner(
        {"n_estimators": 100, "max_depth": None, "min_samples_split": 2, "min_samples_leaf": 1, "max_features": "sqrt"},
        {
            "n_estimators": [50, 100, 200, 300],
            "max_depth": [None, 5, 10, 15, 20],
            "min_samples_split": [2, 5, 10],
            "min_samples_leaf": [1, 2, 4],
            "max_features": ["sqrt", "log2", None],
        },
    ),
    "gradient_boosting": Learner(
        {
            "n_estimators": 100,
            "learning_rate": 0.1,
            "max_depth": 3,
            "min_samples_leaf": 1,
            "subsample": 1.0,
        },
        {
            "n_estimators": [50, 100, 200],
            "learning_rate": [0.01, 0.05, 0.1, 0.2],
            "max_depth": [3, 5, 7, 10],
            "min_samples_leaf": [1, 2, 4],
            "subsample": [0.8, 0.9, 1.0],
        },
    ),
    "mlp": Learner(
        {"hidden_layer_sizes": (100,), "max_iter": 1000},
        {"hidden_layer_sizes": [(50,), (100,), (50, 50), (100, 50), (100, 100)]},
        scaled=True,
        weights=False,
    ),
    "naive_bayes": Learner({}),
    "knn": Learner(
        {"n_neighbors": 5, "weights": "uniform", "metric": "euclidean", "p": 2},
        {
            "n_neighbors": [3, 5, 7, 9, 11, 15],
            "weights": ["uniform", "distance"],
            "metric": ["euclidean", "manhattan", "minkowski"],
            "p": [1, 2],
        },
        scaled=True,
        weights=False,
    ),
    "linear_svm": Learner(
        {"C": 1.0, "max_iter": 1000},
        {"C": [0.1, 1.0, 10.0, 100.0]},
        scaled=True,
        probabilities=False,
    ),
}
LINEAR = ("logistic_regression", "linear_svm")
# The models a comparison runs by default.
RECOMMENDED = ["logistic_regression", "random_forest", "gradient_boosting", "mlp"]


def learner(name: str) -> Learner:
    if name not in LEARNERS:
        raise ValueError(f"unknown model {name!r}; known are {sorted(LEARNERS)}")
    return LEARNERS[name]


def _depth(value: int | None) -> int:
    if value is not None and value > DEEPEST:
        raise ValueError(f"trees have a depth of {DEEPEST} at most, not {value}")
    return DEEPEST if value is None else value


def full_params(name: str, params: dict[str, Any]) -> dict[str, Any]:
    p = {**learner(name).defaults, **params}
    unknown = set(p) - set(learner(name).defaults)
    if unknown:
        raise ValueError(f"{name} has no parameters {sorted(unknown)}")
    return p


def build(
    name: str, params: dict[str, Any], width: int, label: str, weight: str | None, seed: int
) -> Estimator:
    """The Spark ML estimator of boosting, a network or naive Bayes and its parameters."""
    p = full_params(name, params)
    with_probability = {
        "featuresCol": FEATURES, "labelCol": label, "predictionCol": CLASS, "probabilityCol": PROBABILITY, "rawPredictionCol": RAW
    }
    if weight is not None:
        if not learner(name).weights:
            raise ValueError(f"{name} cannot weight rows")
        with_probability["weightCol"] = weight
    if name == "gradient_boosting":
        return GBTClassifier(
            maxIter=p["n_estimators"],
            stepSize=p["learning_rate"],
            maxDepth=_depth(p["max_depth"]),
            minInstancesPerNode=p["min_samples_leaf"],
            subsamplingRate=p["subsample"],
            seed=seed,
            **{k: v for k, v in with_probability.items() if k not in ("probabilityCol", "rawPredictionCol")},
        ).setProbabilityCol(PROBABILITY).setRawPredictionCol(RAW)
    if name == "mlp":
        return MultilayerPerceptronClassifier(
            layers=[width, *p["hidden_layer_sizes"], 2],
            maxIter=p["max_iter"],
            seed=seed,
            **with_probability,
        )
    return NaiveBayes(modelType="gaussian", **with_probability)


# Models that are no Spark ML ones: they score the assembled vectors by themselves.
OWN = (NeighbourModel, ForestModel, LinearModel)


@dataclass
class Classifier:
    """A fitted model: which columns it reads, how it scales them, and the model itself."""

    name: str
    features: list[str]
    model: Model | NeighbourModel | ForestModel | LinearModel
    scaler: Standardiser | None = None
    params: dict[str, Any] = field(default_factory=dict)

    @property
    def vector_key(self) -> tuple | None:
        """Members that agree in it can share one assembled vector; scaled ones have their own."""
        return tuple(self.features) if self.scaler is None else None

    def _transform(self, df: DataFrame, vector: str | None) -> DataFrame:
        if vector is None:
            wide = _assemble(df, self.features, self.scaler)
        else:
            wide = df.withColumn(FEATURES, F.col(vector))
        if isinstance(self.model, OWN):
            return self.model.transform(wide, FEATURES, PROBABILITY, CLASS)
        return self.model.transform(wide)

    def score(self, df: DataFrame, output: str = "p", vector: str | None = None) -> DataFrame:
        """Add the probability of class 1, or the class itself if the model has no probabilities.

        Every input column stays as it is; only the assembled vector sees scaled values. ``vector``
        names a column that has the features assembled already.
        """
        scored = self._transform(df, vector)
        if PROBABILITY in scored.columns:
            value = vector_to_array(F.col(PROBABILITY))[1]
        else:
            value = F.col(CLASS)
        return scored.withColumn(output, value).select(*df.columns, output)

    def classify(self, df: DataFrame, output: str = "prediction", vector: str | None = None) -> DataFrame:
        scored = self._transform(df, vector)
        return scored.withColumn(output, F.col(CLASS).cast("int")).select(*df.columns, output)


def shared_vectors(df: DataFrame, members: list[Classifier]) -> tuple[DataFrame, dict[tuple, str]]:
    """Add one vector for each set of features that members read unscaled, and its name."""
    names: dict[tuple, str] = {}
    for member in members:
        key = member.vector_key
        if key is not None and key not in names:
            names[key] = f"_vector_{len(names)}"
            df = _assemble(df, member.features, None).withColumnRenamed(FEATURES, names[key])
    return df, names


def _assemble(df: DataFrame, features: list[str], scaler: Standardiser | None) -> DataFrame:
    inputs = {}
    for c in features:
        value = F.col(c).cast("double")
        if scaler is not None:
            value = (value - scaler.means[c]) / scaler.deviations[c]
        inputs[f"_x_{c}"] = value
    wide = df.withColumns(inputs)
    return VectorAssembler(inputCols=list(inputs), outputCol=FEATURES).transform(wide).drop(*inputs)


def fit_classifier(
    train: DataFrame,
    features: list[str],
    label: str = "label",
    name: str = "logistic_regression",
    params: dict[str, Any] | None = None,
    weight: str | None = None,
    seed: int = 42,
    scale: bool | None = None,
) -> Classifier:
    """Fit one model; scaling is learned from these very rows if the model asks for it."""
    params = params or {}
    key = [ROW_KEY] if ROW_KEY in train.columns and ROW_KEY not in features else []
    narrow = train.select(
        *features, F.col(label).cast("double").alias(label), *([weight] if weight else []), *key
    )
    scaled = learner(name).scaled if scale is None else scale
    if name == "random_forest":
        model = fit_forest(narrow, features, label, full_params(name, params), weight, seed)
        return Classifier(name, list(features), model, None, params)
    if name in LINEAR:
        problem = problem_of(name, full_params(name, params), scaled=scaled, sample=Sample(weight=0 if weight else None))
        model, scaler = fit_linear(narrow, features, label, problem, weight)
        return Classifier(name, list(features), model, scaler, params)
    scaler = fit_standardiser(narrow, features, weight) if scaled else None
    if name == "knn":
        if weight is not None:
            raise ValueError("knn cannot weight rows")
        vectors = _assemble(narrow, features, scaler).select(FEATURES, label)
        model = NeighbourModel.fit(vectors, FEATURES, label, full_params(name, params))
        return Classifier(name, list(features), model, scaler, params)
    estimator = build(name, params, len(features), label, weight, seed)
    vectors = _assemble(narrow, features, scaler).select(
        FEATURES, label, *([weight] if weight else [])
    )
    vectors = vectors.persist()
    try:
        model = estimator.fit(vectors)
    finally:
        vectors.unpersist()
    return Classifier(name, list(features), model, scaler, params)


def in_parallel(spark: SparkSession, work, items: list, width: int = PARALLEL_FITS) -> list:
    """Submit several Spark fits at once, so that small jobs do not leave the cluster idle."""
    session_aware = inheritable_thread_target(spark)(work)
    with ThreadPool(max(1, min(width, len(items)))) as pool:
        return pool.map(session_aware, items, chunksize=1)


# --- importance ------------------------------------------------------------------------------


def importance_values(classifier: Classifier) -> list[float]:
    """Importance per feature: of the trees, or the size of the linear coefficients."""
    model = classifier.model
    if isinstance(model, ForestModel):
        return list(model.importances)
    if hasattr(model, "featureImportances"):
        return [float(v) for v in model.featureImportances.toArray()]
    if hasattr(model, "coefficients"):
        return [abs(float(v)) for v in model.coefficients.toArray()]
    raise ValueError(f"{classifier.name} has neither importances nor coefficients")


def feature_importance(spark: SparkSession, classifier: Classifier) -> DataFrame:
    """Features with their importance and rank, the most important first."""
    pairs = sorted(
        zip(classifier.features, importance_values(classifier)), key=lambda fv: (-fv[1], fv[0])
    )
    rows = [(f, v, i) for i, (f, v) in enumerate(pairs, start=1)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


# --- storage ---------------------------------------------------------------------------------


def save_classifier(
    spark: SparkSession,
    path: str,
    classifier: Classifier,
    state: FeatureState | None = None,
    metrics: dict[str, float] | None = None,
) -> None:
    """Write the model, its columns, medians and scaling, metrics and parameters below ``path``."""
    if isinstance(classifier.model, NeighbourModel):
        classifier.model.save(f"{path}/model")
    elif isinstance(classifier.model, OWN):
        classifier.model.save(f"{path}/model", spark)
    else:
        PipelineModel(stages=[classifier.model]).write().overwrite().save(f"{path}/model")
    scaler = classifier.scaler
    rows = []
    names = list(dict.fromkeys([*(state.columns if state else []), *classifier.features]))
    for c in names:
        rows.append(
            (
                c,
                state.columns.index(c) if state and c in state.columns else None,
                float(state.medians[c]) if state and c in state.columns else None,
                bool(state and c in state.empty),
                classifier.features.index(c) if c in classifier.features else None,
                scaler.means[c] if scaler and c in scaler.means else None,
                scaler.deviations[c] if scaler and c in scaler.means else None,
            )
        )
    columns = (
        "column string, position int, median double, empty boolean, feature int, mean double,"
        " deviation double"
    )
    spark.createDataFrame(rows, columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    summary = [
        (
            classifier.name,
            json.dumps(classifier.params),
            {k: float(v) for k, v in (metrics or {}).items()},
            state is not None,
        )
    ]
    spark.createDataFrame(
        summary, "name string, params string, metrics map<string,double>, has_state boolean"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/summary")


@dataclass
class Artifacts:
    """What a scoring job loads: a model with a ``score`` method, and its columns' state."""

    classifier: Any
    state: FeatureState | None
    metrics: dict[str, float]


def read_summary(spark: SparkSession, path: str) -> Row:
    """The one row that tells what is stored below ``path``."""
    try:
        return spark.read.parquet(f"{path}/summary").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no model at {path}") from error
        raise


def load_classifier(spark: SparkSession, path: str) -> Artifacts:
    """Read what ``save_classifier`` wrote; a missing path raises ``FileNotFoundError``."""
    summary = read_summary(spark, path)
    rows = spark.read.parquet(f"{path}/columns").collect()
    params = json.loads(summary["params"])
    if summary["name"] == "knn":
        model = NeighbourModel.load(spark, f"{path}/model", full_params("knn", params))
    elif summary["name"] == "random_forest" or summary["name"] in LINEAR:
        kind = ForestModel if summary["name"] == "random_forest" else LinearModel
        model = kind.load(spark, f"{path}/model")
    else:
        model = PipelineModel.load(f"{path}/model").stages[0]
    features = [r["column"] for r in sorted((r for r in rows if r["feature"] is not None), key=lambda r: r["feature"])]
    by_name = {r["column"]: r for r in rows}
    scaler = None
    if any(by_name[f]["mean"] is not None for f in features):
        scaler = Standardiser(
            {f: by_name[f]["mean"] for f in features},
            {f: by_name[f]["deviation"] for f in features},
        )
    state = None
    if summary["has_state"]:
        known = sorted((r for r in rows if r["position"] is not None), key=lambda r: r["position"])
        state = FeatureState(
            [r["column"] for r in known],
            {r["column"]: r["median"] for r in known},
            [r["column"] for r in known if r["empty"]],
        )
    classifier = Classifier(summary["name"], features, model, scaler, params)
    return Artifacts(classifier, state, dict(summary["metrics"]))
