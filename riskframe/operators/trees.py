"""Structure and rules of a fitted decision tree, read as a node table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from riskframe.session import fresh_path, ship


def node_table(model, spark) -> DataFrame:
    """(id, prediction, n, left, right, feature, threshold, categories) of a tree model.

    ``prediction`` is the class of a classification tree, the rate of a regression tree.

    Reads what model persistence writes, so the tree is a table like any other.
    """
    path = fresh_path(spark, "tree")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    split = F.col("split")
    return nodes.select(
        "id",
        "prediction",
        F.col("rawCount").alias("n"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        split["featureIndex"].alias("feature"),
        F.when(split["numCategories"] < 0, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(split["numCategories"] >= 0, split["leftCategoriesOrThreshold"]).alias("categories"),
    )


def _cut_below(min_split: int):
    """Nodes of one tree that stay when none with fewer than ``min_split`` rows is split, numbered anew."""

    def cut(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("id")
        rows, left, right = (nodes[c].to_numpy() for c in ("rawCount", "leftChild", "rightChild"))
        stays = np.zeros(len(nodes), bool)
        stays[0] = True
        splits = (left >= 0) & (rows >= min_split)
        # A node has a smaller number than what is below it.
        for i in np.flatnonzero(splits):
            if stays[i]:
                stays[left[i]] = stays[right[i]] = True
        number = np.cumsum(stays) - 1
        out = nodes.assign(
            new_id=number, new_left=np.where(splits, number[left], -1), new_right=np.where(splits, number[right], -1)
        )
        return out.loc[stays, ["tree", "id", "new_id", "new_left", "new_right"]]

    return cut


def pruned(model, min_split: int):
    """The tree or forest as if no node with fewer than ``min_split`` rows had been split.

    Splits are chosen from the top, so what is above such a node does not depend on it: the fully grown model is cut
    there and loaded again.  Every node keeps the prediction that it has over its own rows.
    """
    if min_split <= 2:
        return model
    spark = model._sparkSession if hasattr(model, "_sparkSession") else model.write().sparkSession
    ship(spark)
    path, cut_path = fresh_path(spark, "grown"), fresh_path(spark, "pruned")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    forest = "treeID" in data.columns
    flat = data.select(F.col("treeID").alias("tree"), "nodeData.*") if forest else data.select(F.lit(0).alias("tree"), "*")
    # One group per tree; a model is held by the driver anyway.
    kept = flat.select("tree", "id", "rawCount", "leftChild", "rightChild").groupBy("tree").applyInPandas(
        _cut_below(min_split), "tree int, id int, new_id int, new_left int, new_right int"
    )
    joined = flat.join(kept, ["tree", "id"])
    leaf = F.col("new_left") < 0
    split = flat.schema["split"].dataType
    new = {
        "id": F.col("new_id"),
        "leftChild": F.col("new_left"),
        "rightChild": F.col("new_right"),
        "gain": F.when(leaf, -1.0).otherwise(F.col("gain")),
        "split": F.when(leaf, F.struct(F.lit(-1), F.array().cast("array<double>"), F.lit(-1)).cast(split)).otherwise(F.col("split")),
    }
    columns = [new.get(c, F.col(c)).alias(c) for c in flat.columns if c != "tree"]
    out = joined.select(F.col("tree").alias("treeID"), F.struct(*columns).alias("nodeData")) if forest else joined.select(*columns)
    out.write.parquet(f"{cut_path}/data")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{cut_path}/metadata")
    if forest:
        spark.read.parquet(f"{path}/treesMetadata").write.parquet(f"{cut_path}/treesMetadata")
    return type(model).load(cut_path)


def tree_stats(nodes: DataFrame, depth: int) -> DataFrame:
    """(n_nodes, n_leaves, n_internal, depth, leaf rows min / mean / max, nodes per leaf)."""
    leaf = F.col("left") < 0
    return nodes.agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.count(F.when(leaf, 1)).alias("n_leaves"),
        F.count(F.when(~leaf, 1)).alias("n_internal"),
        F.lit(depth).cast("long").alias("depth"),
        F.min(F.when(leaf, F.col("n"))).alias("min_leaf_rows"),
        F.avg(F.when(leaf, F.col("n"))).alias("mean_leaf_rows"),
        F.max(F.when(leaf, F.col("n"))).alias("max_leaf_rows"),
    ).withColumn("nodes_per_leaf", F.col("n_nodes") / F.col("n_leaves"))


def leaf_paths(nodes: DataFrame, max_depth: int = 4) -> DataFrame:
    """(id, prediction, n, path) of leaves no deeper than ``max_depth``.

    ``path`` lists the conditions from the root; each level is one join to the children.
    """
    step = "struct<feature:int,threshold:double,categories:array<double>,goes_left:boolean>"
    level = nodes.where(F.col("id") == 0).withColumn("path", F.array().cast(f"array<{step}>"))
    found = level.where(F.col("left") < 0)
    for _ in range(max_depth):

        def condition(goes_left: bool) -> Column:
            return F.struct("feature", "threshold", "categories", F.lit(goes_left).alias("goes_left")).cast(step)

        sides = [
            level.where(F.col("left") >= 0).select(
                F.col(child).alias("id"), F.concat("path", F.array(condition(goes_left))).alias("path")
            )
            for child, goes_left in (("left", True), ("right", False))
        ]
        level = sides[0].unionByName(sides[1]).join(nodes, "id").select(*nodes.columns, "path")
        found = found.unionByName(level.where(F.col("left") < 0))
    return found.select("id", "prediction", "n", "path")


def rule_text(path: Column, names: list[str], scales: dict[str, tuple[float, float]] | None = None) -> Column:
    """``IF (a <= 1.00) AND (b > 2.00)``; thresholds in original units when scales are given."""
    name = F.array(*[F.lit(n) for n in names])
    mean = F.array(*[F.lit(float((scales or {}).get(n, (0.0, 1.0))[0])) for n in names])
    scale = F.array(*[F.lit(float((scales or {}).get(n, (0.0, 1.0))[1])) for n in names])

    def text(s: Column) -> Column:
        at = s["feature"]
        value = s["threshold"] * F.get(scale, at) + F.get(mean, at)
        numeric = F.format_string("(%s %s %.2f)", F.get(name, at), F.when(s["goes_left"], "<=").otherwise(">"), value)
        listed = F.array_join(F.transform(s["categories"], lambda c: F.format_string("%.0f", c)), ",")
        nominal = F.format_string(
            "(%s %s {%s})", F.get(name, at), F.when(s["goes_left"], "in").otherwise("not in"), listed
        )
        return F.when(s["threshold"].isNotNull(), numeric).otherwise(nominal)

    return F.concat(F.lit("IF "), F.array_join(F.transform(path, text), " AND "))


def extract_rules(
    nodes: DataFrame,
    names: list[str],
    *,
    n_rules: int = 5,
    min_rows: int = 50,
    max_depth: int = 4,
    scales: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """(id, rule, prediction, n, path): the first well-supported leaves, left to right."""
    leaves = leaf_paths(nodes, max_depth).where(F.col("n") > min_rows).orderBy("id").limit(n_rules)
    return leaves.select("id", rule_text(F.col("path"), names, scales).alias("rule"), "prediction", "n", "path")


def apply_rules(df: DataFrame, rules: DataFrame, target: str, features: str = "features") -> DataFrame:
    """(id, support, positive_rate) of each rule over a whole table, in one aggregate.

    There are at most ``2 ** max_depth`` rules, each a plain predicate on the vector.
    """
    listed = rules.select("id", "path").collect()
    x = df.select(F.col(target).cast("int").alias("_y"), vector_to_array(features).alias("_x"))

    def holds(path: list) -> Column:
        test = F.lit(True)
        for s in path:
            value = F.get(F.col("_x"), F.lit(s["feature"]))
            left = value <= s["threshold"] if s["threshold"] is not None else value.isin(list(s["categories"]))
            test = test & (left if s["goes_left"] else ~left)
        return test

    if not listed:
        return df.sparkSession.createDataFrame([], "id int, support long, positive_rate double")
    sums = []
    for i, r in enumerate(listed):
        sums.append(F.count(F.when(holds(r["path"]), 1)).alias(f"n{i}"))
        sums.append(F.avg(F.when(holds(r["path"]), F.col("_y").cast("double"))).alias(f"r{i}"))
    rows = [
        F.struct(
            F.lit(r["id"]).alias("id"), F.col(f"n{i}").alias("support"), F.col(f"r{i}").alias("positive_rate")
        )
        for i, r in enumerate(listed)
    ]
    return x.agg(*sums).select(F.inline(F.array(*rows)))
