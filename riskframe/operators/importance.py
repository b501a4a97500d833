"""Which features matter: model weights, permutation, rankings and agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.expressions import name_prefix
from riskframe.operators import evaluation
from riskframe.operators.models import scored
from riskframe.operators.prefix import default_buckets
from riskframe.roles import Roles


def model_weights(spark: SparkSession, classifier, names: list[str]) -> DataFrame:
    """(feature, weight): importances of a tree model, signed coefficients of a linear one."""
    values = getattr(classifier, "featureImportances", None)
    if values is None:
        values = classifier.coefficients
    values = values.toArray() if hasattr(values, "toArray") else values
    if len(values) != len(names):
        raise ValueError(f"{len(names)} names for {len(values)} weights")
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, weight double"
    )


def risk_direction(weights: DataFrame) -> DataFrame:
    """Add ``direction``: whether a larger value raises or lowers the risk."""
    sign = F.when(F.col("weight") > 0, "raises").when(F.col("weight") < 0, "lowers").otherwise("none")
    return weights.withColumn("direction", sign)


def top_features(weights: DataFrame, n: int = 15) -> DataFrame:
    """The n features with the largest absolute weight."""
    return weights.orderBy(F.desc(F.abs("weight")), "feature").limit(n)


def weights_by_prefix(weights: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """(prefix, rank, feature, weight) inside groups of equally prefixed names.

    A weight table has one row per feature; ``limits`` cuts chosen groups.
    """
    ranked = weights.withColumn("prefix", name_prefix(F.col("feature")))
    order = Window.partitionBy("prefix").orderBy(F.desc(F.abs("weight")), "feature")
    ranked = ranked.withColumn("rank", F.row_number().over(order))
    for prefix, most in (limits or {}).items():
        ranked = ranked.where((F.col("prefix") != prefix) | (F.col("rank") <= most))
    return ranked.select("prefix", "rank", "feature", "weight")


def shared_top(first: DataFrame, second: DataFrame, n: int = 10) -> DataFrame:
    """(feature, first_weight, second_weight) of features in both models' top n."""
    a = top_features(first, n).select("feature", F.col("weight").alias("first_weight"))
    b = top_features(second, n).select("feature", F.col("weight").alias("second_weight"))
    return a.join(b, "feature")


def consensus(weights: DataFrame) -> DataFrame:
    """(feature, n_models, mean_rank) of (model, feature, weight), best agreement first."""
    order = Window.partitionBy("model").orderBy(F.desc(F.abs("weight")), "feature")
    ranked = weights.withColumn("_rank", F.rank().over(order))
    return ranked.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_models"), F.avg("_rank").alias("mean_rank")
    ).orderBy("mean_rank", "feature")


def shuffle_columns(df: DataFrame, key: str, columns: list[str], *, seed: int = 42, buckets: int | None = None) -> DataFrame:
    """The table with, per listed column, a column ``_given_<column>`` of its values permuted.

    Values move among rows of the same key-hash bucket, all columns of a row together.  They are matched by their
    rank in two different hash orders, bucket by bucket, so the permutation is exact, repeatable and never
    sorts the whole table, and all columns take one shuffle and one join.
    """
    buckets = buckets or default_buckets(df)
    tagged = df.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets)))

    def order(order_seed: int) -> Window:
        return Window.partitionBy("_bucket").orderBy(F.xxhash64(F.lit(order_seed), F.col(key)), F.col(key))

    takers = tagged.withColumn("_rank", F.row_number().over(order(seed + 1)))
    givers = tagged.select(
        "_bucket", *[F.col(c).alias(f"_given_{c}") for c in columns], F.row_number().over(order(seed + 2)).alias("_rank")
    )
    return takers.join(givers, ["_bucket", "_rank"]).drop("_bucket", "_rank")


def shuffle_column(df: DataFrame, key: str, column: str, *, seed: int = 42, buckets: int | None = None) -> DataFrame:
    """The table with one column's values permuted."""
    joined = shuffle_columns(df, key, [column], seed=seed, buckets=buckets)
    return joined.select(*[F.col(f"_given_{c}").alias(c) if c == column else F.col(c) for c in df.columns])


def permutation_importance(
    model, df: DataFrame, roles: Roles, features: list[str] | None = None, *, seed: int = 42
) -> DataFrame:
    """(feature, roc_auc, drop): loss of ROC-AUC when a column is shuffled.

    The permuted values of all features come from one join; each row is then written out once as it is and
    once per feature with that value exchanged, and all of them are scored in one pass.
    """
    features = features or roles.features
    joined = shuffle_columns(df, roles.key, features, seed=seed)

    def variant(feature: str) -> Column:
        cells = [F.col(f"_given_{c}").alias(c) if c == feature else F.col(c) for c in df.columns]
        return F.struct(F.lit(feature).alias("_feature"), *cells)

    rows = joined.select(F.inline(F.array(*[variant(f) for f in ["", *features]])))
    stacked = scored(model.transform(rows), roles, F.col("_feature").alias("feature"))
    areas = evaluation.roc_auc(stacked, ["feature"], n_groups=1 + len(features))
    base = areas.where(F.col("feature") == "").select(F.col("roc_auc").alias("_base"))
    # ``base`` is one row.
    out = areas.where(F.col("feature") != "").crossJoin(F.broadcast(base))
    return out.select("feature", "roc_auc", (F.col("_base") - F.col("roc_auc")).alias("drop"))
