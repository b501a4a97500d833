"""Feature preparation as Spark ML stages: scaling, one-hot, PCA, Fisher projection."""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCols, HasLabelCol, HasOutputCol, HasOutputCols
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.roles import Roles

SCALED = "__scaled"
INDEXED = "__index"
ENCODED = "__onehot"


def dot(vector: Column, weights: list[float]) -> Column:
    """Inner product with fixed weights, evaluated in the JVM."""
    return F.aggregate(
        F.zip_with(vector_to_array(vector), F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


# --- scaling ------------------------------------------------------------------------


class _ScalerParams(HasInputCols, HasOutputCols):
    pass


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Zero mean and unit population deviation; a constant column is only centred."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        sums = [F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(cols)]
        sums += [F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(cols)]
        row = dataset.agg(*sums).first()
        means = [float(row[f"m{i}"] or 0.0) for i in range(len(cols))]
        scales = [float(row[f"s{i}"] or 0.0) or 1.0 for i in range(len(cols))]
        return PopulationScalerModel(
            inputCols=cols, outputCols=self.getOutputCols(), means=means, scales=scales
        ).setParent(self)


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "divisor per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        means: list[float] | None = None,
        scales: list[float] | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setParent(self, parent: Estimator) -> "PopulationScalerModel":
        self.parent = parent.uid
        return self

    def statistics(self) -> dict[str, tuple[float, float]]:
        """Column to (mean, scale)."""
        pairs = zip(self.getOrDefault(self.means), self.getOrDefault(self.scales))
        return dict(zip(self.getInputCols(), pairs))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stats = self.statistics()
        out = {
            o: (F.col(f"`{c}`").cast("double") - F.lit(stats[c][0])) / F.lit(stats[c][1])
            for c, o in zip(self.getInputCols(), self.getOutputCols())
        }
        return dataset.withColumns(out)


# --- preprocessing ------------------------------------------------------------------


def preprocessor_stages(roles: Roles, features_col: str = "features") -> list:
    """Scaled continuous, untouched ordinal and one-hot categorical columns in one vector.

    Every category seen in fitting gets a slot; an unseen one becomes all zeros.
    """
    stages: list = []
    parts: list[str] = []
    if roles.continuous:
        scaled = [c + SCALED for c in roles.continuous]
        stages.append(PopulationScaler(inputCols=list(roles.continuous), outputCols=scaled))
        parts += scaled
    parts += roles.ordinal
    if roles.categorical:
        indexed = [c + INDEXED for c in roles.categorical]
        encoded = [c + ENCODED for c in roles.categorical]
        stages.append(
            StringIndexer(
                inputCols=list(roles.categorical),
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
        parts += encoded
    stages.append(VectorAssembler(inputCols=parts, outputCol=features_col))
    return stages


def build_preprocessor(roles: Roles, features_col: str = "features") -> Pipeline:
    return Pipeline(stages=preprocessor_stages(roles, features_col))


def vector_names(df: DataFrame, column: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its metadata."""
    attrs = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])
    return [s.get("name", str(s["idx"])).replace(SCALED, "").replace(ENCODED, "").replace(INDEXED, "") for s in slots]


# --- principal components -----------------------------------------------------------


def pca_stages(k: int, input_col: str = "features", output_col: str = "reduced") -> list:
    """Centring, then projection on k components; Spark's PCA does not centre by itself."""
    centred = f"{output_col}_centred"
    return [
        StandardScaler(inputCol=input_col, outputCol=centred, withMean=True, withStd=False),
        PCA(k=k, inputCol=centred, outputCol=output_col),
    ]


def explained_variance(model: PipelineModel) -> list[float]:
    """Variance share per component of a fitted ``pca_stages``."""
    return [float(v) for v in model.stages[-1].explainedVariance]


def explained_variance_table(df: DataFrame, input_col: str = "features", k: int | None = None) -> DataFrame:
    """(component, share, cumulative) of the leading k (default all) components."""
    k = k or len(df.select(input_col).first()[0])
    shares = explained_variance(Pipeline(stages=pca_stages(k, input_col)).fit(df))
    total = np.cumsum(shares)
    rows = [(i + 1, float(s), float(c)) for i, (s, c) in enumerate(zip(shares, total))]
    return df.sparkSession.createDataFrame(rows, "component int, share double, cumulative double")


def components_for_variance(df: DataFrame, threshold: float = 0.85, input_col: str = "features") -> int:
    """Fewest components whose cumulative share reaches the threshold, at most all of them."""
    p = len(df.select(input_col).first()[0])
    shares = explained_variance(Pipeline(stages=pca_stages(p, input_col)).fit(df))
    reached = np.cumsum(shares) >= threshold
    return int(np.argmax(reached)) + 1 if reached.any() else p


# --- Fisher discriminant ------------------------------------------------------------


class _FisherParams(HasFeaturesCol, HasLabelCol, HasOutputCol):
    pass


class FisherReducer(Estimator, _FisherParams, DefaultParamsReadable, DefaultParamsWritable):
    """One discriminant direction for a 0/1 label.

    Class means and the total correlation matrix are two JVM aggregates; only p x p
    numbers reach the driver, where a pseudo-inverse copes with the singular scatter
    that complete one-hot groups cause.
    """

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", outputCol: str = "reduced"):
        super().__init__()
        self._setDefault(outputCol="reduced")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FisherModel":
        x, y = self.getFeaturesCol(), self.getLabelCol()
        summary = (
            dataset.groupBy(F.col(y).cast("int").alias("label"))
            .agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col(x)).alias("mean"))
            .where(F.col("label").isin(0, 1))
            .collect()
        )
        if len(summary) != 2:
            raise ValueError("the discriminant needs both classes")
        n = {r["label"]: r["n"] for r in summary}
        mean = {r["label"]: r["mean"].toArray() for r in summary}
        total = n[0] + n[1]
        grand = (n[0] * mean[0] + n[1] * mean[1]) / total

        variance = dataset.select(Summarizer.variance(F.col(x)).alias("v")).first()["v"].toArray()
        std = np.sqrt(np.maximum(variance, 0.0))
        corr = np.nan_to_num(Correlation.corr(dataset, x, "pearson").first()[0].toArray(), nan=0.0)
        np.fill_diagonal(corr, (std > 0).astype(float))
        scatter = corr * np.outer(std, std) * (total - 1)
        for label in (0, 1):
            shift = mean[label] - grand
            scatter -= n[label] * np.outer(shift, shift)
        within = scatter / (total - 2)
        direction = np.linalg.pinv(within, rcond=1e-10, hermitian=True) @ (mean[1] - mean[0])
        spread = float(direction @ within @ direction)
        if spread > 0:
            direction = direction / np.sqrt(spread)
        return FisherModel(
            featuresCol=x,
            labelCol=y,
            outputCol=self.getOutputCol(),
            weights=[float(w) for w in direction],
            offset=float(direction @ grand),
        )


class FisherModel(Model, _FisherParams, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "direction", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "projection of the overall mean", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        labelCol: str = "label",
        outputCol: str = "reduced",
        weights: list[float] | None = None,
        offset: float | None = None,
    ):
        super().__init__()
        self._setDefault(outputCol="reduced")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, offset = self.getOrDefault(self.weights), self.getOrDefault(self.offset)
        value = dot(F.col(self.getFeaturesCol()), weights) - F.lit(offset)
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(value)))


def reduction_stages(
    method: str, k: int, *, label_col: str, input_col: str = "features", output_col: str = "reduced"
) -> list:
    """Stages of a named reduction: ``pca`` to k components or ``lda`` to one."""
    if method == "pca":
        return pca_stages(k, input_col, output_col)
    if method == "lda":
        if k != 1:
            raise ValueError("two classes allow one discriminant component")
        return [FisherReducer(featuresCol=input_col, labelCol=label_col, outputCol=output_col)]
    raise ValueError(f"unknown reduction {method!r}: expected 'pca' or 'lda'")
