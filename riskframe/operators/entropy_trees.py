"""A decision tree by information gain that keeps the rate of every leaf.

Spark's own classification trees merge neighbouring leaves of the same class, and with them their rates; its regression
trees keep them but know no entropy.  Here the tree is grown level by level with aggregates: rows carry the bins of
their features, one pass per level counts rows and positives per node, feature and bin, and the best split of each
node is read from running sums over the bins.  Counts are summed in the tasks first, so a level shuffles at most
(nodes x features x bins) rows per task, and rows in finished leaves leave the loop.

The finished nodes are written as a Spark regression tree of the positive rate, which scores, saves and explains
itself like any other.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.prefix import BROADCAST_CELLS, SALTS
from riskframe.session import fresh_path, materialise


def _entropy(positives: Column, rows: Column) -> Column:
    def part(share: Column) -> Column:
        return F.when(share > 0, -share * F.log2(share)).otherwise(0.0)

    share = positives / rows
    return part(share) + part(1 - share)


def _thresholds(rows: DataFrame, width: int, bins: int) -> list[list[float]]:
    """Per feature at most ``bins`` - 1 of its values, ascending, without the largest: ``value <= t`` goes left."""
    probs = [i / bins for i in range(1, bins)]
    marks = rows.select(F.posexplode("_x").alias("feature", "value")).groupBy("feature")
    found = marks.agg(F.percentile_approx("value", probs, 10_000).alias("q"), F.max("value").alias("most"))
    out: list[list[float]] = [[] for _ in range(width)]
    for r in found.collect():
        out[r["feature"]] = [t for t in sorted(set(r["q"])) if t < r["most"]]
    return out


def _best_splits(level: DataFrame) -> DataFrame:
    """(node, feature, bin, n, p, left_n, left_p, gain): the best split of each node with a gain, ties to the first."""
    counted = level.select("node", "y", F.posexplode("bins").alias("feature", "bin")).groupBy("node", "feature", "bin")
    counted = counted.agg(F.count(F.lit(1)).alias("k"), F.sum("y").alias("q"))
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("bin")
    sums = counted.select(
        "node", "feature", "bin",
        F.sum("k").over(upto).alias("left_n"), F.sum("q").over(upto).alias("left_p"),
        F.sum("k").over(whole).alias("n"), F.sum("q").over(whole).alias("p"),
    ).where("left_n < n")
    right_n, right_p = F.col("n") - F.col("left_n"), F.col("p") - F.col("left_p")
    below = (F.col("left_n") * _entropy(F.col("left_p"), F.col("left_n")) + right_n * _entropy(right_p, right_n)) / F.col("n")
    gains = sums.withColumn("gain", _entropy(F.col("p"), F.col("n")) - below).where("gain > 1e-12")
    # A node has at most (features x bins) candidates.
    order = Window.partitionBy("node").orderBy(F.desc(F.round("gain", 12)), "feature", "bin")
    return gains.withColumn("_at", F.row_number().over(order)).where("_at = 1").drop("_at")


def _below(level: DataFrame, splits: DataFrame, n_splits: int) -> DataFrame:
    """(y, bins, node): rows in the nodes of the next level, without those that end in a leaf.

    Rows of few distinct bins take next to no space in files, however many they are, so Spark may not choose by
    size which side is sent to every task: it is the splits, or neither where these are many.
    """
    if n_splits * len(splits.columns) <= BROADCAST_CELLS:
        placed = level.join(F.broadcast(splits), "node")
    else:
        # A node may still hold a third of the rows: these are dealt to several tasks.
        salted = level.withColumn("_salt", F.pmod(F.xxhash64("bins"), F.lit(SALTS)).cast("int"))
        copies = splits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        placed = salted.join(copies.hint("merge"), ["node", "_salt"])
    moved = F.when(F.get("bins", F.col("feature")) <= F.col("cut"), F.col("to_left")).otherwise(F.col("to_right"))
    return placed.select("y", "bins", moved.alias("node")).where("node >= 0")


def grow(
    dataset: DataFrame, features: str, label: str, *, max_depth: int, min_split: int = 2, max_bins: int = 64
) -> DecisionTreeRegressionModel:
    """A tree for a 0/1 label; nodes with fewer than ``min_split`` rows or one class are leaves."""
    spark = dataset.sparkSession
    rows = dataset.select(vector_to_array(features).alias("_x"), F.col(label).cast("int").alias("y"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"), F.max(F.size("_x")).alias("w")).first()
    if not total["n"]:
        raise ValueError("a tree needs rows")
    cuts = _thresholds(rows, total["w"], max_bins)

    def bin_of(j: int) -> Column:
        """Thresholds below the value."""
        value = F.col("_x")[j]
        return F.size(F.filter(F.lit(cuts[j]), lambda t: t < value)) if cuts[j] else F.lit(0)

    bins = [bin_of(j) for j in range(total["w"])]
    level = materialise(rows.select("y", F.array(*bins).alias("bins"), F.lit(0).alias("node")), "tree-rows")

    # The model: one entry per node, as any fitted tree has in the driver.
    nodes: list[dict] = [{"n": total["n"], "p": total["p"], "left": -1, "right": -1, "feature": -1, "threshold": None, "gain": -1.0}]

    def splittable(i: int) -> bool:
        return nodes[i]["n"] >= max(2, min_split) and 0 < nodes[i]["p"] < nodes[i]["n"]

    active = [0] if splittable(0) else []
    for depth in range(max_depth):
        if not active:
            break
        chosen, active = [], []
        for r in _best_splits(level).collect():
            node = nodes[r["node"]]
            node |= {"feature": r["feature"], "threshold": cuts[r["feature"]][r["bin"]], "gain": r["gain"]}
            sides = ((r["left_n"], r["left_p"]), (r["n"] - r["left_n"], r["p"] - r["left_p"]))
            for side, (n, p) in zip(("left", "right"), sides):
                node[side] = len(nodes)
                nodes.append({"n": n, "p": p, "left": -1, "right": -1, "feature": -1, "threshold": None, "gain": -1.0})
            goes_on = [splittable(node[side]) and depth + 1 < max_depth for side in ("left", "right")]
            active += [node[side] for side, on in zip(("left", "right"), goes_on) if on]
            chosen.append((r["node"], r["feature"], r["bin"], node["left"] if goes_on[0] else -1, node["right"] if goes_on[1] else -1))
        if active:
            # One short row per split of this level, each of which stands for at least two rows.
            table = spark.createDataFrame(chosen, "node int, feature int, cut int, to_left int, to_right int")
            level = materialise(_below(level, table, len(chosen)), "tree-rows")
    return _as_model(dataset, features, label, nodes)


def _binary_entropy(p: int, n: int) -> float:
    return float(-sum(x * math.log2(x) for x in (p / n, 1 - p / n) if 0 < x < 1))


def _as_model(dataset: DataFrame, features: str, label: str, nodes: list[dict]) -> DecisionTreeRegressionModel:
    """The nodes in the layout that a saved regression tree has, numbered from the top, left before right."""
    spark = dataset.sparkSession
    number, stack, order = {}, [0], []
    while stack:
        i = stack.pop()
        number[i] = len(order)
        order.append(i)
        if nodes[i]["left"] >= 0:
            stack += [nodes[i]["right"], nodes[i]["left"]]
    # A stump on one row lends its settings file and the layout of its nodes.
    # Plain numbers, as all splits are at thresholds.
    plain = array_to_vector(vector_to_array(features)).alias(features)
    one = dataset.select(plain, F.lit(0.0).alias(label)).limit(1)
    blank = DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=0).fit(one)
    path, target = fresh_path(spark, "blank-tree"), fresh_path(spark, "entropy-tree")
    blank.write().save(path)
    layout = spark.read.parquet(f"{path}/data").schema
    made = []
    for i in order:
        v = nodes[i]
        leaf = v["left"] < 0
        entry = {
            "id": number[i],
            "prediction": v["p"] / v["n"],
            "impurity": _binary_entropy(v["p"], v["n"]),
            "impurityStats": [float(v["n"]), float(v["p"]), float(v["p"])],
            "rawCount": v["n"],
            "gain": float(v["gain"]),
            "leftChild": -1 if leaf else number[v["left"]],
            "rightChild": -1 if leaf else number[v["right"]],
            "split": (-1, [], -1) if leaf else (v["feature"], [float(v["threshold"])], -1),
        }
        made.append(tuple(entry[f.name] for f in layout))
    spark.createDataFrame(made, layout).write.parquet(f"{target}/data")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{target}/metadata")
    return DecisionTreeRegressionModel.load(target)
