"""Named binary classifiers, their search grids, and the pipelines around them."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
    HasRegParam,
    HasStandardization,
    HasTol,
)
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.entropy_trees import grow
from riskframe.operators.features import dot, preprocessor_stages, reduction_stages
from riskframe.operators.perceptron import ALPHA, L1_RATIO, Settings, train
from riskframe.operators.splits import assign_folds, fit_folds
from riskframe.operators.trees import pruned
from riskframe.roles import Roles

# Spark caps tree depth at 30; an unlimited depth means this.
UNLIMITED_DEPTH = 30


# --- margin classifier with calibrated probabilities ----------------------------------


class _MarginParams(
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
    HasMaxIter, HasRegParam, HasStandardization, HasTol,
):
    keyCol = Param(Params._dummy(), "keyCol", "unique row key that decides the fold", TypeConverters.toString)
    numFolds = Param(Params._dummy(), "numFolds", "number of members", TypeConverters.toInt)


class CalibratedMarginClassifier(Estimator, _MarginParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear margin classifiers, each calibrated by a sigmoid on the fold it did not see.

    The probability is the mean over the members.
    """

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        labelCol: str = "label",
        keyCol: str = "key",
        numFolds: int = 3,
        maxIter: int = 100,
        regParam: float = 0.0,
        tol: float = 1e-3,
        standardization: bool = True,
    ):
        super().__init__()
        self._setDefault(
            predictionCol="prediction",
            probabilityCol="probability",
            rawPredictionCol="rawPrediction",
            numFolds=3,
            maxIter=100,
            regParam=0.0,
            tol=1e-3,
            standardization=True,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "CalibratedMarginModel":
        x, y = self.getFeaturesCol(), self.getLabelCol()
        k = self.getOrDefault(self.numFolds)
        # Stratified, so that a rare class is in every fold.
        key = self.getOrDefault(self.keyCol)
        labelled = dataset.select(x, F.col(key).alias("_key"), F.col(y).cast("double").alias("_y"))
        rows = assign_folds(labelled, fit_folds(labelled, "_key", "_y", k=k), "_fold")

        def member(i: int) -> list[float]:
            svc = LinearSVC(
                featuresCol=x,
                labelCol="_y",
                maxIter=self.getMaxIter(),
                regParam=self.getRegParam(),
                tol=self.getTol(),
                standardization=self.getStandardization(),
            ).fit(rows.where(F.col("_fold") != i))
            weights = [float(w) for w in svc.coefficients.toArray()]
            margin = dot(F.col(x), weights) + F.lit(float(svc.intercept))
            held = rows.where(F.col("_fold") == i).select(array_to_vector(F.array(margin)).alias("_m"), "_y")
            sigmoid = LogisticRegression(featuresCol="_m", labelCol="_y", maxIter=100).fit(held)
            return [*weights, float(svc.intercept), float(sigmoid.coefficients[0]), float(sigmoid.intercept)]

        # Members are independent fits; Spark interleaves their jobs.
        with ThreadPool(k) as pool:
            members = pool.map(inheritable_thread_target(dataset.sparkSession)(member), range(k))
        model = CalibratedMarginModel(members=members)
        return self._copyValues(model)


class CalibratedPerceptron(Estimator, _MarginParams, DefaultParamsReadable, DefaultParamsWritable):
    """Perceptrons, each calibrated by a sigmoid on the fold it did not see.

    All members learn in the same passes; the probability is the mean over the members.
    """

    eta0 = Param(Params._dummy(), "eta0", "size of a step", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "none, l1, l2 or elasticnet", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "strength of the penalty", TypeConverters.toFloat)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "share of absolute weights in elasticnet", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        labelCol: str = "label",
        keyCol: str = "key",
        numFolds: int = 3,
        maxIter: int = 1000,
        eta0: float = 1.0,
        penalty: str = "none",
        alpha: float = ALPHA,
        l1Ratio: float = L1_RATIO,
        tol: float = 1e-3,
    ):
        super().__init__()
        self._setDefault(
            predictionCol="prediction",
            probabilityCol="probability",
            rawPredictionCol="rawPrediction",
            numFolds=3,
            maxIter=1000,
            eta0=1.0,
            penalty="none",
            alpha=ALPHA,
            l1Ratio=L1_RATIO,
            tol=1e-3,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "CalibratedMarginModel":
        x, y = self.getFeaturesCol(), self.getLabelCol()
        k = self.getOrDefault(self.numFolds)
        labelled = dataset.select(
            x, F.col(self.getOrDefault(self.keyCol)).alias("_key"), F.col(y).cast("double").alias("_y")
        )
        rows = assign_folds(labelled, fit_folds(labelled, "_key", "_y", k=k), "_fold")
        settings = Settings(
            max_iter=self.getMaxIter(),
            eta0=self.getOrDefault(self.eta0),
            penalty=self.getOrDefault(self.penalty),
            alpha=self.getOrDefault(self.alpha),
            l1_ratio=self.getOrDefault(self.l1Ratio),
            tol=self.getTol(),
        )
        weights = train(rows, x, "_y", "_key", fold="_fold", members=k, settings=settings).tolist()

        def member(i: int) -> list[float]:
            margin = dot(F.col(x), weights[i][:-1]) + F.lit(weights[i][-1])
            held = rows.where(F.col("_fold") == i).select(array_to_vector(F.array(margin)).alias("_m"), "_y")
            sigmoid = LogisticRegression(featuresCol="_m", labelCol="_y", maxIter=100).fit(held)
            return [*weights[i], float(sigmoid.coefficients[0]), float(sigmoid.intercept)]

        # The curves are independent fits; Spark interleaves their jobs.
        with ThreadPool(k) as pool:
            members = pool.map(inheritable_thread_target(dataset.sparkSession)(member), range(k))
        model = CalibratedMarginModel(members=members)
        return self._copyValues(model)


class CalibratedMarginModel(Model, _MarginParams, DefaultParamsReadable, DefaultParamsWritable):
    """Each member is its weights, intercept, sigmoid slope and sigmoid shift."""

    members = Param(Params._dummy(), "members", "fitted numbers per member", TypeConverters.toListListFloat)

    @keyword_only
    def __init__(self, *, members: list[list[float]] | None = None):
        super().__init__()
        self._setDefault(
            predictionCol="prediction", probabilityCol="probability", rawPredictionCol="rawPrediction", numFolds=3
        )
        if members is not None:
            self._set(members=members)

    @property
    def coefficients(self) -> list[float]:
        """Mean weight per feature over the members."""
        members = self.getOrDefault(self.members)
        return [sum(m[i] for m in members) / len(members) for i in range(len(members[0]) - 3)]

    @property
    def intercept(self) -> float:
        members = self.getOrDefault(self.members)
        return sum(m[-3] for m in members) / len(members)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        members = self.getOrDefault(self.members)
        positive = F.lit(0.0)
        for m in members:
            margin = dot(F.col(self.getFeaturesCol()), m[:-3]) + F.lit(m[-3])
            positive = positive + 1.0 / (1.0 + F.exp(-(F.lit(m[-2]) * margin + F.lit(m[-1]))))
        out = dataset.withColumn("_p1", positive / len(members))
        vector = array_to_vector(F.array(1.0 - F.col("_p1"), F.col("_p1")))
        out = out.withColumn(self.getProbabilityCol(), vector).withColumn(self.getRawPredictionCol(), vector)
        return out.withColumn(self.getPredictionCol(), (F.col("_p1") > 0.5).cast("double")).drop("_p1")


# --- trees that keep their leaf rates ---------------------------------------------------


class _RateParams(HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    def __init__(self) -> None:
        super().__init__()
        self._setDefault(predictionCol="prediction", probabilityCol="probability", rawPredictionCol="rawPrediction")


class LeafRateClassifier(Estimator, _RateParams):
    """A regression tree or forest on the 0/1 label, read as class probabilities.

    Spark's classification trees merge leaves that predict the same class, which throws
    away differing rates and with them the order of scores.  On a 0/1 label the variance
    criterion picks the same splits as Gini impurity (it is half of it) and nothing is merged.
    Nodes with fewer than ``min_split`` rows are not split.
    """

    def __init__(self, regressor: Estimator, min_split: int = 2):
        super().__init__()
        self.regressor = regressor.copy().setPredictionCol("_rate")
        self.min_split = min_split

    def _fit(self, dataset: DataFrame) -> "LeafRateModel":
        return self._copyValues(LeafRateModel(pruned(self.regressor.fit(dataset), self.min_split)))


class EntropyTreeClassifier(Estimator, _RateParams):
    """A tree by information gain whose leaves keep their rates."""

    def __init__(self, features: str, label: str, max_depth: int, min_split: int, max_bins: int):
        super().__init__()
        self.columns = (features, label)
        self.settings = {"max_depth": max_depth, "min_split": min_split, "max_bins": max_bins}

    def _fit(self, dataset: DataFrame) -> "LeafRateModel":
        return self._copyValues(LeafRateModel(grow(dataset, *self.columns, **self.settings).setPredictionCol("_rate")))


class LeafRateModel(Model, _RateParams, MLWritable, MLReadable):
    def __init__(self, tree: Model):
        super().__init__()
        self.tree = tree

    @property
    def featureImportances(self):
        return self.tree.featureImportances

    @property
    def depth(self) -> int:
        return self.tree.depth

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.tree.transform(dataset)
        vector = array_to_vector(F.array(1.0 - F.col("_rate"), F.col("_rate")))
        out = out.withColumn(self.getProbabilityCol(), vector).withColumn(self.getRawPredictionCol(), vector)
        return out.withColumn(self.getPredictionCol(), (F.col("_rate") > 0.5).cast("double")).drop("_rate")

    def write(self) -> MLWriter:
        return _LeafRateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LeafRateReader()


class _LeafRateWriter(MLWriter):
    def __init__(self, instance: LeafRateModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.tree.write().save(f"{path}/tree")


class _LeafRateReader(MLReader):
    def load(self, path: str) -> LeafRateModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LeafRateModel(DefaultParamsReader.loadParamsInstance(f"{path}/tree", self.sparkSession))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


# --- registry -------------------------------------------------------------------------


@dataclass(frozen=True)
class ModelSpec:
    """How to build a fresh estimator from plain settings, and what to search."""

    make: Callable[..., Estimator]
    grid: dict[str, list]
    search: str
    family: str


def _perceptron(roles: Roles, n_train: int, x: str, seed: int, **p) -> Estimator:
    return CalibratedPerceptron(
        featuresCol=x,
        labelCol=roles.target,
        keyCol=roles.key,
        maxIter=p.get("max_iter", 1000),
        eta0=p.get("eta0", 1.0),
        penalty=p.get("penalty") or "none",
    )


def _logistic(roles: Roles, n_train: int, x: str, seed: int, **p) -> Estimator:
    return LogisticRegression(
        featuresCol=x,
        labelCol=roles.target,
        maxIter=p.get("max_iter", 100),
        regParam=1.0 / (p.get("C", 1.0) * max(n_train, 1)),
        elasticNetParam=0.0,
        standardization=False,
    )


def _tree_settings(p: dict) -> dict:
    depth = p.get("max_depth", UNLIMITED_DEPTH)
    return {
        "maxDepth": UNLIMITED_DEPTH if depth is None else depth,
        "maxBins": p.get("max_bins", 64),
    }


def _decision_tree(roles: Roles, n_train: int, x: str, seed: int, **p) -> Estimator:
    common = {"featuresCol": x, "labelCol": roles.target, "seed": seed, **_tree_settings(p)}
    if p.get("criterion", "gini") == "gini":
        return LeafRateClassifier(DecisionTreeRegressor(**common), p.get("min_samples_split", 2))
    if p["criterion"] != "entropy":
        raise ValueError(f"unknown criterion {p['criterion']!r}; known: entropy, gini")
    return EntropyTreeClassifier(x, roles.target, common["maxDepth"], p.get("min_samples_split", 2), common["maxBins"])


def _random_forest(roles: Roles, n_train: int, x: str, seed: int, **p) -> Estimator:
    common = {
        "featuresCol": x,
        "labelCol": roles.target,
        "seed": seed,
        "numTrees": p.get("n_estimators", 100),
        "featureSubsetStrategy": p.get("max_features", "sqrt"),
        **_tree_settings(p),
    }
    if p.get("criterion", "gini") == "gini":
        return LeafRateClassifier(RandomForestRegressor(**common), p.get("min_samples_split", 2))
    return RandomForestClassifier(impurity=p["criterion"], **common)


def _boosting(roles: Roles, n_train: int, x: str, seed: int, **p) -> Estimator:
    return GBTClassifier(
        featuresCol=x,
        labelCol=roles.target,
        seed=seed,
        maxIter=p.get("n_estimators", 100),
        stepSize=p.get("learning_rate", 0.1),
        subsamplingRate=p.get("subsample", 1.0),
        **_tree_settings({"max_depth": 3, **p}),
    )


# Names, families, searches and grids.  The logistic solver is always the same,
# as the optimum does not depend on it.
MODELS: dict[str, ModelSpec] = {
    "perceptron": ModelSpec(
        _perceptron,
        {"max_iter": [300, 1000], "eta0": [0.01, 0.1, 1.0], "penalty": ["l2", "elasticnet"]},
        "grid",
        "linear",
    ),
    "logreg": ModelSpec(_logistic, {"C": [0.01, 0.1, 1.0, 10.0], "max_iter": [500]}, "grid", "linear"),
    "dtree": ModelSpec(
        _decision_tree,
        {"max_depth": [3, 5, 10, None], "min_samples_split": [2, 10, 50], "criterion": ["gini", "entropy"]},
        "grid",
        "tree",
    ),
    "rf": ModelSpec(
        _random_forest,
        {
            "n_estimators": [100, 300],
            "max_depth": [5, 10, None],
            "min_samples_split": [2, 10],
            "max_features": ["sqrt", "log2"],
        },
        "random",
        "ensemble",
    ),
    "gb": ModelSpec(
        _boosting,
        {
            "n_estimators": [100, 300],
            "learning_rate": [0.05, 0.1, 0.2],
            "max_depth": [3, 5, 7],
            "subsample": [0.8, 1.0],
        },
        "random",
        "ensemble",
    ),
}


def list_models() -> list[str]:
    return sorted(MODELS)


def model_spec(name: str) -> ModelSpec:
    if name not in MODELS:
        raise KeyError(f"unknown model {name!r}; known: {', '.join(list_models())}")
    return MODELS[name]


def register_model(name: str, spec: ModelSpec) -> None:
    """Extension point: add or replace a named classifier."""
    MODELS[name] = spec


# --- pipelines ------------------------------------------------------------------------


def build_pipeline(
    name: str,
    roles: Roles,
    *,
    n_train: int,
    seed: int = 42,
    params: dict | None = None,
    reduction: tuple[str, int] | None = None,
) -> Pipeline:
    """Preprocessing, optional reduction and a fresh classifier, fitted as one."""
    stages = preprocessor_stages(roles, "features")
    x = "features"
    if reduction is not None:
        stages += reduction_stages(*reduction, label_col=roles.target, input_col=x, output_col="reduced")
        x = "reduced"
    stages.append(model_spec(name).make(roles, n_train, x, seed, **(params or {})))
    return Pipeline(stages=stages)


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations of a grid, in grid order."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def random_points(grid: dict[str, list], n: int = 30, seed: int = 42) -> list[dict]:
    """n combinations without replacement, all of them when there are no more than n."""
    points = grid_points(grid)
    return points if len(points) <= n else random.Random(seed).sample(points, n)


def search_points(name: str, *, n_iter: int = 30, seed: int = 42, grid: dict[str, list] | None = None) -> list[dict]:
    """The combinations a model's search type visits."""
    spec = model_spec(name)
    grid = grid or spec.grid
    if spec.search == "none":
        return [{}]
    return random_points(grid, n_iter, seed) if spec.search == "random" else grid_points(grid)


def params_text(params: dict) -> str:
    """Stable text of a combination, for tables."""
    return ";".join(f"{k}={params[k]}" for k in sorted(params))


def scored(predictions: DataFrame, roles: Roles, *extra) -> DataFrame:
    """(key, y, score, prediction, extra...) of a transformed table."""
    return predictions.select(
        F.col(roles.key).alias("key"),
        F.col(roles.target).cast("int").alias("y"),
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
        *extra,
    )


def score_batch(model: Model, df: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., prediction, probability_positive, probability_negative) in one pass."""
    out = model.transform(df).withColumn("_p", vector_to_array("probability"))
    return out.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        F.col("_p")[1].alias("probability_positive"),
        F.col("_p")[0].alias("probability_negative"),
    )
