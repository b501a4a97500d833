"""Feature stages, model fits, tuning, scoring.

Fits have no SQL, but some have closed forms that SQL can state: a logistic model on
one-hot groups reproduces group rates, a full tree on codes does too, any increasing
score of one feature has that feature's ROC area, and with two features principal
components and the discriminant follow from a 2 x 2 matrix.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import evaluation as E
from riskframe.operators import features, importance, models, perceptron, selection, splits, trees, tuning
from riskframe.plans.bindings import ACCOUNT_ROLES, accounts, table, with_
from riskframe.plans.profiling import SPLIT_SQL
from riskframe.plans.registry import query
from riskframe.roles import Roles
from riskframe.session import fresh_path, materialise
from riskframe.sources import runstore
from riskframe.streaming import scoring

AMOUNT_ONLY = Roles("row_id", "target", continuous=["amount"])
MONTH_ONLY = Roles("row_id", "target", categorical=["month"])
CODES = Roles("row_id", "target", ordinal=["priority"], categorical=["segment"])
MEASURES = Roles("row_id", "target", continuous=["amount", "age"])


def labelled(spark, sf):
    """The labelled table, written once so that repeated fits read it and not its lineage."""
    return materialise(accounts(spark, sf), "accounts")


def by_split(spark, sf):
    base = accounts(spark, sf)
    split = materialise(splits.fit_split(base, "row_id", "target").assign(base), "split")
    return {s: split.where(F.col("split") == s) for s in ("train", "val", "test")}


def slots(df, column, names):
    """Vector slots as columns."""
    array = vector_to_array(column)
    return df.select("row_id", *[F.round(array[i], 6).alias(n) for i, n in enumerate(names)])


# --- feature stages -----------------------------------------------------------------------


@query(
    "ml05_population_scaling",
    with_("accounts")
    + """SELECT row_id, round((amount - avg(amount) OVER ()) / stddev_pop(amount) OVER (), 6) AS amount,
         round((age - avg(age) OVER ()) / stddev_pop(age) OVER (), 6) AS age, 0.0::DOUBLE AS flat FROM accounts""",
)
def ml05(spark, sf):
    base = accounts(spark, sf).withColumn("flat", F.lit(7.0))
    cols = ["amount", "age", "flat"]
    out = [c + features.SCALED for c in cols]
    model = features.PopulationScaler(inputCols=cols, outputCols=out).fit(base)
    return model.transform(base).select("row_id", *[F.round(o, 6).alias(c) for c, o in zip(cols, out)])


@query(
    "ml06_ordinal_passthrough",
    with_("accounts") + "SELECT row_id, priority::DOUBLE AS priority, month::DOUBLE AS month FROM accounts",
)
def ml06(spark, sf):
    base = accounts(spark, sf)
    model = features.build_preprocessor(Roles("row_id", "target", ordinal=["priority", "month"])).fit(base)
    return slots(model.transform(base), "features", ["priority", "month"])


@query(
    "ml07_one_hot_unseen",
    with_("accounts")
    + """SELECT row_id, (segment = 0)::INT::DOUBLE AS s0, (segment = 1)::INT::DOUBLE AS s1,
         (segment = 2)::INT::DOUBLE AS s2 FROM accounts""",
)
def ml07(spark, sf):
    """Segment 3 is not seen in fitting, so its rows are all zeros."""
    base = accounts(spark, sf)
    stage = features.build_preprocessor(Roles("row_id", "target", categorical=["segment"]))
    model = stage.fit(base.where(F.col("segment") != 3))
    return slots(model.transform(base), "features", ["s0", "s1", "s2"])


@query(
    "ml08_preprocessor",
    with_("accounts")
    + f""", {SPLIT_SQL}, j AS (SELECT a.*, s.split FROM accounts a JOIN split s USING (row_id)),
         m AS (SELECT avg(amount) AS ma, stddev_pop(amount) AS sa, avg(age) AS mg, stddev_pop(age) AS sg FROM j
               WHERE split = 'train')
         SELECT row_id, round((amount - ma) / sa, 6) AS amount, round((age - mg) / sg, 6) AS age,
                priority::DOUBLE AS priority, (segment = 0)::INT::DOUBLE AS s0, (segment = 1)::INT::DOUBLE AS s1,
                (segment = 2)::INT::DOUBLE AS s2, (segment = 3)::INT::DOUBLE AS s3 FROM j, m WHERE split = 'val'""",
)
def ml08(spark, sf):
    """Fitted on train rows only, applied to validation rows."""
    parts = by_split(spark, sf)
    roles = Roles("row_id", "target", continuous=["amount", "age"], ordinal=["priority"], categorical=["segment"])
    model = features.build_preprocessor(roles).fit(parts["train"])
    return slots(model.transform(parts["val"]), "features", ["amount", "age", "priority", "s0", "s1", "s2", "s3"])


# Two measures on comparable scales, with their covariance matrix.
PAIR_SQL = """pair AS (SELECT row_id, target, amount / 100000 AS u, age / 10.0::DOUBLE + amount / 200000 AS v FROM accounts)"""


def pair(spark, sf):
    base = accounts(spark, sf).select(
        "row_id", "target", (F.col("amount") / 100000).alias("u"),
        (F.col("age") / 10.0 + F.col("amount") / 200000).alias("v"),
    )
    return VectorAssembler(inputCols=["u", "v"], outputCol="features").transform(base)


EIGEN_SQL = """cov AS (SELECT var_samp(u) AS a, covar_samp(u, v) AS b, var_samp(v) AS d FROM pair),
  eig AS (SELECT (a + d) / 2 + sqrt(((a - d) / 2) ** 2 + b * b) AS l1, (a + d) / 2 - sqrt(((a - d) / 2) ** 2 + b * b) AS l2 FROM cov)"""


@query(
    "ml09_pca_explained_variance",
    with_("accounts")
    + f""", {PAIR_SQL}, {EIGEN_SQL} SELECT 1 AS component, round(l1 / (l1 + l2), 6) AS share, round(l1 / (l1 + l2), 6) AS cumulative
         FROM eig UNION ALL SELECT 2, round(l2 / (l1 + l2), 6), 1.0 FROM eig""",
)
def ml09(spark, sf):
    out = features.explained_variance_table(pair(spark, sf))
    return out.select("component", F.round("share", 6).alias("share"), F.round("cumulative", 6).alias("cumulative"))


@query(
    "ml09_pca_projection",
    with_("accounts")
    + f""", {PAIR_SQL}, {EIGEN_SQL}, m AS (SELECT avg(u) AS mu, avg(v) AS mv FROM pair),
         e AS (SELECT b / sqrt(b * b + (l1 - a) ** 2) AS e1, (l1 - a) / sqrt(b * b + (l1 - a) ** 2) AS e2 FROM cov, eig)
         SELECT row_id, round(abs((u - mu) * e1 + (v - mv) * e2), 5) AS size FROM pair, m, e""",
)
def ml09b(spark, sf):
    """The sign of a component is arbitrary, so its size is compared."""
    data = pair(spark, sf)
    model = Pipeline(stages=features.pca_stages(1)).fit(data)
    out = model.transform(data)
    return out.select("row_id", F.round(F.abs(vector_to_array("reduced")[0]), 5).alias("size"))


@query("ml10_components_for_variance")
def ml10(spark, sf):
    embeddings = table(spark, sf, "embeddings")
    size = len(embeddings.select("embedding").first()[0])
    wide = embeddings.select(*[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(size)])
    data = VectorAssembler(inputCols=wide.columns, outputCol="features").transform(wide).select("features")
    shares = features.explained_variance_table(data)
    reached = [F.min(F.when(F.col("cumulative") >= t, F.col("component"))).alias(f"k{int(t * 100)}") for t in (0.5, 0.85, 0.95)]
    return shares.agg(*reached)


@query(
    "ml10_components_of_pair",
    with_("accounts")
    + f""", {PAIR_SQL}, {EIGEN_SQL} SELECT t AS threshold, CASE WHEN l1 / (l1 + l2) >= t THEN 1 ELSE 2 END AS k
         FROM eig, (VALUES (0.5::DOUBLE), (0.85::DOUBLE), (0.9999::DOUBLE)) v(t)""",
)
def ml10b(spark, sf):
    data = pair(spark, sf)
    rows = [(t, features.components_for_variance(data, t)) for t in (0.5, 0.85, 0.9999)]
    return spark.createDataFrame(rows, "threshold double, k int")


@query(
    "ml11_fisher_projection",
    with_("accounts")
    + f""", {PAIR_SQL}, c AS (SELECT target, count(*) AS n, avg(u) AS mu, avg(v) AS mv, var_pop(u) * count(*) AS a,
           covar_pop(u, v) * count(*) AS b, var_pop(v) * count(*) AS d FROM pair GROUP BY target),
         s AS (SELECT sum(a) / (sum(n) - 2) AS a, sum(b) / (sum(n) - 2) AS b, sum(d) / (sum(n) - 2) AS d,
           max(mu) FILTER (target = 1) - max(mu) FILTER (target = 0) AS du,
           max(mv) FILTER (target = 1) - max(mv) FILTER (target = 0) AS dv,
           sum(n * mu) / sum(n) AS gu, sum(n * mv) / sum(n) AS gv FROM c),
         w AS (SELECT (d * du - b * dv) / (a * d - b * b) AS wu, (a * dv - b * du) / (a * d - b * b) AS wv, * FROM s),
         z AS (SELECT sqrt(wu * wu * a + 2 * wu * wv * b + wv * wv * d) AS norm, * FROM w)
         SELECT row_id, round(((u - gu) * wu + (v - gv) * wv) / norm, 5) AS projection FROM pair, z""",
)
def ml11(spark, sf):
    data = pair(spark, sf)
    model = features.FisherReducer(labelCol="target").fit(data)
    return model.transform(data).select("row_id", F.round(vector_to_array("reduced")[0], 5).alias("projection"))


# --- classifiers --------------------------------------------------------------------------


def fit_check(spark, sf, name, params, roles=MEASURES):
    """(model, n_scored, beats_chance, shares_sum_to_one) of a fit on train, scored on validation."""
    parts = by_split(spark, sf)
    train = parts["train"]
    model = models.build_pipeline(name, roles, n_train=train.count(), params=params).fit(train)
    out = models.score_batch(model, parts["val"], ["row_id", "target"])
    joined = out.select(
        F.lit(name).alias("model"), F.col("target").alias("y"), F.col("probability_positive").alias("score"),
        (F.abs(F.col("probability_positive") + F.col("probability_negative") - 1) < 1e-6).alias("ok"),
    )
    areas = E.roc_auc(joined, ["model"], n_groups=1)
    sums = joined.groupBy("model").agg(F.count(F.lit(1)).alias("n_scored"), F.every("ok").alias("shares_sum_to_one"))
    return sums.join(areas, "model").select(
        "model", "n_scored", (F.col("roc_auc") > 0.7).alias("beats_chance"), "shares_sum_to_one"
    )


def check_sql(name):
    return (
        with_("accounts")
        + f""", {SPLIT_SQL} SELECT '{name}' AS model, count(*) AS n_scored, true AS beats_chance, true AS shares_sum_to_one
              FROM split WHERE split = 'val'"""
    )


@query("ml12_calibrated_margin", check_sql("perceptron"))
def ml12(spark, sf):
    return fit_check(spark, sf, "perceptron", {})


@query(
    "ml12_perceptron_separates",
    with_("accounts") + f", {PAIR_SQL} SELECT row_id, (3 * u + v > 9)::INT AS prediction FROM pair WHERE abs(3 * u + v - 9) > 0.5",
)
def ml12b(spark, sf):
    """Classes on either side of a line, with a gap between them: no row is on the wrong side of the weights."""
    z = 3 * F.col("u") + F.col("v") - 9
    data = pair(spark, sf).where(F.abs(z) > 0.5).withColumn("side", (z > 0).cast("int"))
    weights = perceptron.train(data, "features", "side", "row_id")[0].tolist()
    margin = features.dot(F.col("features"), weights[:-1]) + F.lit(weights[-1])
    return data.select("row_id", (margin > 0).cast("int").alias("prediction"))


MONTH_RATE = """SELECT row_id, round(avg(target) OVER (PARTITION BY month), 3) AS probability FROM accounts"""


@query("ml13_logistic_group_rates", with_("accounts") + MONTH_RATE)
def ml13(spark, sf):
    """Without a penalty, one slot per month makes the fitted probability the month's rate."""
    data = labelled(spark, sf)
    model = models.build_pipeline("logreg", MONTH_ONLY, n_train=10**9, params={"C": 1e3, "max_iter": 200}).fit(data)
    out = models.score_batch(model, data, ["row_id"])
    return out.select("row_id", F.round("probability_positive", 3).alias("probability"))


@query(
    "ml14_tree_group_rates",
    with_("accounts")
    + "SELECT row_id, round(avg(target) OVER (PARTITION BY segment, priority), 6) AS probability FROM accounts",
)
def ml14(spark, sf):
    """A tree grown to the end on two codes returns the rate of each code pair."""
    data = labelled(spark, sf)
    model = models.build_pipeline("dtree", CODES, n_train=1, params={"max_depth": 12}).fit(data)
    out = models.score_batch(model, data, ["row_id"])
    return out.select("row_id", F.round("probability_positive", 6).alias("probability"))


@query(
    "ml14_entropy_tree_rates",
    with_("accounts")
    + "SELECT row_id, round(avg(target) OVER (PARTITION BY segment, priority), 6) AS probability FROM accounts",
)
def ml14b(spark, sf):
    """So does a tree by information gain: leaves of one class are not merged."""
    data = labelled(spark, sf)
    model = models.build_pipeline("dtree", CODES, n_train=1, params={"max_depth": 12, "criterion": "entropy"}).fit(data)
    out = models.score_batch(model, data, ["row_id"])
    return out.select("row_id", F.round("probability_positive", 6).alias("probability"))


def _impurity(criterion: str, p: str, n: str) -> str:
    if criterion == "gini":
        return f"2 * ({p} / {n}) * (1 - {p} / {n})"
    return " + ".join(f"coalesce(-({s}) * log2(nullif({s}, 0)), 0)" for s in (f"{p} / {n}", f"1 - {p} / {n}"))


def _stump_sql(criterion: str) -> str:
    """The best cut of one ordinal by running sums."""
    return f"""SELECT '{criterion}' AS criterion, g.age, round(CASE WHEN g.age <= b.age THEN b.lp / b.ln ELSE (b.p - b.lp) / (b.n - b.ln) END, 6) AS probability
        FROM g, (SELECT * FROM s WHERE ln < n ORDER BY round(ln / n * ({_impurity(criterion, "lp", "ln")})
          + (n - ln) / n * ({_impurity(criterion, "(p - lp)", "(n - ln)")}), 12), age LIMIT 1) b"""


@query(
    "ml14_split_minimum",
    with_("accounts")
    + """, g AS (SELECT age, count(*)::DOUBLE AS k, sum(target)::DOUBLE AS q FROM accounts GROUP BY age),
        s AS (SELECT age, sum(k) OVER (ORDER BY age) AS ln, sum(q) OVER (ORDER BY age) AS lp, sum(k) OVER () AS n, sum(q) OVER () AS p FROM g) """
    + " UNION ALL ".join(f"SELECT * FROM ({_stump_sql(c)})" for c in ("gini", "entropy")),
)
def ml14c(spark, sf):
    """Only the root has as many rows as a split asks for."""
    data = labelled(spark, sf)
    roles = Roles("row_id", "target", continuous=[], ordinal=["age"], categorical=[])
    out = None
    for criterion in ("gini", "entropy"):
        params = {"max_depth": 5, "min_samples_split": data.count(), "criterion": criterion}
        model = models.build_pipeline("dtree", roles, n_train=1, params=params).fit(data)
        part = models.score_batch(model, data, ["age"]).select(F.lit(criterion).alias("criterion"), "age", F.round("probability_positive", 6).alias("probability"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


@query(
    "ag33_overfitting_of_tree",
    with_("accounts")
    + f""", {SPLIT_SQL}, a AS (SELECT age, accounts.target AS y, split FROM accounts JOIN split USING (row_id)),
        g AS (SELECT age, count(*)::DOUBLE AS k, sum(y)::DOUBLE AS q FROM a WHERE split = 'train' GROUP BY age),
        s AS (SELECT age, sum(k) OVER (ORDER BY age) AS ln, sum(q) OVER (ORDER BY age) AS lp, sum(k) OVER () AS n, sum(q) OVER () AS p FROM g),
        b AS (SELECT * FROM s WHERE ln < n ORDER BY round(ln / n * ({_impurity("gini", "lp", "ln")})
          + (n - ln) / n * ({_impurity("gini", "(p - lp)", "(n - ln)")}), 12), age LIMIT 1),
        r AS (SELECT split, (y = (CASE WHEN a.age <= b.age THEN lp / ln ELSE (p - lp) / (n - ln) END > 0.5)::INT)::INT AS ok FROM a, b),
        t AS (SELECT avg(ok) FILTER (split = 'train') AS tr, avg(ok) FILTER (split = 'test') AS te FROM r)
        SELECT round(tr - te, 6) AS gap, CAST(least(ln, n - ln) AS BIGINT) AS min_leaf_rows, CAST(2 AS BIGINT) AS n_leaves,
          CAST((tr > 0.95)::INT + (tr - te > 0.05)::INT + (least(ln, n - ln) < 5)::INT AS INTEGER) AS risk_score,
          tr < 0.85 AS underfitting, abs(tr - te) < 0.02 AS generalises FROM t, b""",
)
def ag33c(spark, sf):
    """Depth, leaves and accuracies of a fitted tree; its split minimum lets the root alone be split."""
    parts = by_split(spark, sf)
    roles = Roles("row_id", "target", continuous=[], ordinal=["age"], categorical=[])
    model = models.build_pipeline("dtree", roles, n_train=1, params={"max_depth": 5, "min_samples_split": parts["train"].count()}).fit(parts["train"])
    tree = model.stages[-1].tree
    stats = trees.tree_stats(trees.node_table(tree, spark), tree.depth)
    out = None
    for name in ("train", "test"):
        right = F.avg((F.col("y") == F.col("prediction")).cast("double")).alias(f"{name}_accuracy")
        part = models.scored(model.transform(parts[name]), roles).agg(right)
        out = part if out is None else out.crossJoin(part)  # one row each
    scored = E.overfitting_score(out.crossJoin(stats))
    return scored.select(F.round("gap", 6).alias("gap"), "min_leaf_rows", "n_leaves", "risk_score", "underfitting", "generalises")


@query("ml15_random_forest", check_sql("rf"))
def ml15(spark, sf):
    return fit_check(spark, sf, "rf", {"n_estimators": 100, "max_depth": 5})


@query("ml16_gradient_boosting", check_sql("gb"))
def ml16(spark, sf):
    return fit_check(spark, sf, "gb", {"n_estimators": 100, "max_depth": 3})


@query("ml18_reduced_logistic")
def ml18(spark, sf):
    parts = by_split(spark, sf)
    roles = ACCOUNT_ROLES
    out = None
    for method, k in (("pca", 3), ("lda", 1)):
        pipeline = models.build_pipeline("logreg", roles, n_train=parts["train"].count(), reduction=(method, k))
        label = F.lit(f"{method}_k{k}").alias("reduction")
        part = models.scored(pipeline.fit(parts["train"]).transform(parts["val"]), roles, label)
        out = part if out is None else out.unionByName(part)
    return E.all_metrics(out, ["reduction"], n_groups=2)


VAL_AREA_SQL = """(SELECT (sum(CASE WHEN target = 1 THEN rk END) - max(np) * (max(np) + 1) / 2.0) / (max(np) * max(nn))::DOUBLE
   FROM (SELECT target, rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0 AS rk,
         sum(target) OVER () AS np, sum(1 - target) OVER () AS nn
         FROM split JOIN (SELECT row_id, amount FROM accounts) USING (row_id) WHERE split = '{0}'))"""


@query(
    "ml18_reduced_one_feature",
    with_("accounts")
    + f""", {SPLIT_SQL} SELECT r AS reduction, round({VAL_AREA_SQL.format("val")}, 6) AS roc_auc FROM (VALUES ('pca_k1'), ('lda_k1')) t(r)""",
)
def ml18b(spark, sf):
    """A projection of one feature keeps its order, so the area is the feature's own."""
    parts = by_split(spark, sf)
    out = None
    for method in ("pca", "lda"):
        pipeline = models.build_pipeline("logreg", AMOUNT_ONLY, n_train=parts["train"].count(), reduction=(method, 1))
        part = models.scored(pipeline.fit(parts["train"]).transform(parts["val"]), AMOUNT_ONLY, F.lit(f"{method}_k1").alias("reduction"))
        out = part if out is None else out.unionByName(part)
    return E.all_metrics(out, ["reduction"], n_groups=2).select("reduction", F.round("roc_auc", 6).alias("roc_auc"))


@query(
    "ml12_perceptron_one_feature",
    with_("accounts")
    + f""", {SPLIT_SQL} SELECT p AS penalty, round({VAL_AREA_SQL.format("val")}, 6) AS roc_auc FROM (VALUES ('elasticnet'), ('l2')) t(p)""",
)
def ml12c(spark, sf):
    """The mean of increasing curves of one feature has the feature's own area, whatever the penalty."""
    parts = by_split(spark, sf)
    out = None
    for penalty in models.model_spec("perceptron").grid["penalty"]:
        pipeline = models.build_pipeline("perceptron", AMOUNT_ONLY, n_train=1, params={"penalty": penalty, "eta0": 0.1})
        scored = pipeline.fit(parts["train"]).transform(parts["val"])
        part = models.scored(scored, AMOUNT_ONLY, F.lit(penalty).alias("penalty"))
        out = part if out is None else out.unionByName(part)
    return E.roc_auc(out, ["penalty"], n_groups=2).select("penalty", F.round("roc_auc", 6).alias("roc_auc"))


# --- validation and search ------------------------------------------------------------------

FOLD5_SQL = """fold AS (SELECT row_id, target, CASE WHEN rn <= n // 5 THEN 0 WHEN rn <= 2 * n // 5 THEN 1
   WHEN rn <= 3 * n // 5 THEN 2 WHEN rn <= 4 * n // 5 THEN 3 ELSE 4 END AS fold FROM
   (SELECT row_id, target, row_number() OVER (PARTITION BY target ORDER BY md5('42:' || row_id)) AS rn,
           count(*) OVER (PARTITION BY target) AS n FROM accounts)),
  auc AS (SELECT fold, (sum(CASE WHEN target = 1 THEN rk END) - max(np) * (max(np) + 1) / 2.0) / (max(np) * max(nn))::DOUBLE AS auc
   FROM (SELECT fold, target, rank() OVER (PARTITION BY fold ORDER BY amount)
           + (count(*) OVER (PARTITION BY fold, amount) - 1) / 2.0 AS rk, sum(target) OVER (PARTITION BY fold) AS np,
           sum(1 - target) OVER (PARTITION BY fold) AS nn FROM fold JOIN (SELECT row_id, amount FROM accounts) USING (row_id))
   GROUP BY fold)"""


@query(
    "ml19_cross_validation",
    with_("accounts") + f""", {FOLD5_SQL} SELECT fold, 'roc_auc' AS metric, round(auc, 6) AS area, true AS in_range FROM auc
         UNION ALL SELECT fold, 'f1_macro', NULL, true FROM auc""",
)
def ml19(spark, sf):
    """One feature, so each fold's area is the feature's own; of macro F1 the range is checked."""
    data = labelled(spark, sf)
    pipeline = models.build_pipeline("logreg", AMOUNT_ONLY, n_train=data.count(), params={"max_iter": 20})
    rows = tuning.cross_validate(data, pipeline, AMOUNT_ONLY, k=5)
    area = F.when(F.col("metric") == "roc_auc", F.round("value", 6))
    return rows.select("fold", "metric", area.alias("area"), F.col("value").between(0, 1).alias("in_range"))


# The penalties of the registered grid.
GRID = {"C": [0.01, 0.1, 1.0, 10.0], "max_iter": [20]}
GRID_SQL = "g(combo, c) AS (VALUES ('C=0.01;max_iter=20', '0.01'), ('C=0.1;max_iter=20', '0.1'), ('C=1.0;max_iter=20', '1.0'), ('C=10.0;max_iter=20', '10.0'))"


@query(
    "ml20_grid_search",
    with_("accounts")
    + f""", {FOLD5_SQL}, {GRID_SQL}
         SELECT combo, c AS "C", '20' AS max_iter, (SELECT round(avg(auc), 6) FROM auc) AS score FROM g""",
)
def ml20(spark, sf):
    _, _, results = tuning.search(labelled(spark, sf), "logreg", AMOUNT_ONLY, k=5, grid=GRID)
    return results.withColumn("score", F.round("score", 6))


@query("ml20_grid_search_by_f1")
def ml20b(spark, sf):
    _, best, results = tuning.search(
        labelled(spark, sf), "dtree", MEASURES, k=5, metric="f1_macro", grid={"max_depth": [1, 3], "criterion": ["gini"]}
    )
    return results.withColumn("best", F.col("combo") == models.params_text(best))


@query("ml21_random_search")
def ml21(spark, sf):
    grid = {"max_depth": [2, 3, 4], "n_estimators": [3, 5], "max_features": ["sqrt", "log2"]}
    _, best, results = tuning.search(labelled(spark, sf), "rf", MEASURES, k=5, n_iter=6, grid=grid)
    return results.withColumn("best", F.col("combo") == models.params_text(best))


def run_of(spark, sf, **settings):
    parts = by_split(spark, sf)
    return tuning.train_and_evaluate(
        "logreg", parts["train"], parts["val"], AMOUNT_ONLY, k=5, params={"max_iter": 20, "C": 10.0}, **settings
    )[1], parts


def stored_runs(spark, sf):
    """A trained run in the store, the same run with a changed area, and the split it was trained on."""
    record, parts = run_of(spark, sf)
    path = fresh_path(spark, "runs")
    about = {"experiment": "exp0", "start_time": 1, "data_digest": "d" * 64, "code_digest": "c" * 40}
    tuning.log_run(tuning.run_frame(spark, record, run_id="run-1", **about), path)
    changed = {**record, "metrics": {**record["metrics"], "roc_auc": record["metrics"]["roc_auc"] - 0.01}}
    tuning.log_run(tuning.run_frame(spark, changed, run_id="run-2", **about), path)
    return runstore.read_runs(spark, path), parts


@query(
    "ml22_training_run",
    with_("accounts")
    + f""", {SPLIT_SQL} SELECT 'run-1' AS run_id, 'baseline__logreg__numstd_catoh__none__none__seed42__datadddddddd__codeccccccc' AS run_name,
         'logreg' AS model_name, 'linear' AS model_family, 'baseline' AS stage, 'none' AS search_type,
         CAST(count(*) FILTER (split = 'train') AS VARCHAR) AS n_train, CAST(count(*) FILTER (split = 'val') AS VARCHAR) AS n_val,
         '10.0' AS c, round({VAL_AREA_SQL.format("val")}, 6) AS roc_auc, CAST(11 AS INTEGER) AS n_metrics,
         CAST(14 AS INTEGER) AS n_tags, CAST(12 AS INTEGER) AS n_params, true AS timed FROM split""",
)
def ml22(spark, sf):
    """A run as it is read back from the store."""
    runs, _ = stored_runs(spark, sf)
    params, tags, metrics = F.col("params"), F.col("tags"), F.col("metrics")
    return runs.where(F.col("run_id") == "run-1").select(
        "run_id", "run_name", params["model_name"].alias("model_name"), tags["model_family"].alias("model_family"), "stage",
        tags["search_type"].alias("search_type"), params["n_train"].alias("n_train"), params["n_val"].alias("n_val"),
        params["clf__C"].alias("c"), F.round(metrics["roc_auc"], 6).alias("roc_auc"), F.size("metrics").alias("n_metrics"),
        F.size("tags").alias("n_tags"), F.size("params").alias("n_params"),
        ((metrics["inference_latency_ms"] > 0) & (metrics["training_time_s"] > 0)).alias("timed"),
    )


@query(
    "ml23_reduction_sweep",
    """SELECT model_name, method AS dimred_method, k AS dimred_n_components, CASE WHEN method = 'none' THEN 'baseline' ELSE 'dimred' END
         AS stage, true AS beats_chance, method = 'pca' AS has_variance FROM (VALUES ('dtree'), ('logreg')) t(model_name),
         (VALUES ('none', '0'), ('pca', '1'), ('pca', '2'), ('lda', '1')) r(method, k)""",
)
def ml23(spark, sf):
    parts = by_split(spark, sf)
    records = tuning.train_sweep(
        ["dtree", "logreg"], [None, ("pca", 1), ("pca", 2), ("lda", 1)], parts["train"], parts["val"], MEASURES, k=2
    )
    rows = [
        (
            r["model_name"], r["dimred_method"], r["dimred_n_components"], r["stage"], r["metrics"]["roc_auc"] > 0.6,
            r["dimred_explained_variance"] != "na",
        )
        for r in records
    ]
    return spark.createDataFrame(
        rows, "model_name string, dimred_method string, dimred_n_components string, stage string, beats_chance boolean, has_variance boolean"
    )


@query(
    "ml28_learning_curve",
    with_("accounts")
    + f""", {FOLD5_SQL} SELECT i / 10.0::DOUBLE AS fraction, 'validation' AS side, round(avg(auc), 6) AS mean,
         round(stddev_pop(auc), 6) AS std, true AS in_range FROM auc, range(1, 11) f(i) GROUP BY i
         UNION ALL SELECT i / 10.0::DOUBLE, 'train', NULL, NULL, true FROM range(1, 11) f(i)""",
)
def ml28(spark, sf):
    """The validation side has the feature's own area; of the training side the range is checked."""
    curve = tuning.learning_curve(labelled(spark, sf), "logreg", AMOUNT_ONLY, k=5, params={"max_iter": 10})
    held = F.col("side") == "validation"
    return curve.select(
        "fraction", "side", F.when(held, F.round("mean", 6)).alias("mean"), F.when(held, F.round("std", 6)).alias("std"),
        F.col("mean").between(0.5, 1).alias("in_range"),
    )


@query(
    "ml29_validation_curve",
    with_("accounts")
    + f""", {FOLD5_SQL} SELECT value, (SELECT round(avg(auc), 6) FROM auc) AS mean_score, CAST(1 AS BIGINT) AS n
         FROM (VALUES ('0.01'), ('0.1'), ('1.0'), ('10.0')) v(value)""",
)
def ml29(spark, sf):
    _, _, results = tuning.search(labelled(spark, sf), "logreg", AMOUNT_ONLY, k=5, grid=GRID)
    return tuning.validation_curve(results, "C").withColumn("mean_score", F.round("mean_score", 6))


@query(
    "ml30_final_evaluation",
    with_("accounts") + f""", {SPLIT_SQL} SELECT 'logreg' AS model, round({VAL_AREA_SQL.format("test")}, 6) AS roc_auc""",
)
def ml30(spark, sf):
    """The cascade's winner in the store, refitted with the settings of its log."""
    runs, parts = stored_runs(spark, sf)
    wide = runs.select(
        "run_id", "experiment", F.col("tags")["model_family"].alias("model_family"),
        *[F.col("metrics")[m].alias(m) for m, _, _ in selection.CASCADE],
    )
    winner = selection.cascade_winner(selection.eligible_runs(wide), ["experiment"]).first()["run_id"]
    _, metrics = tuning.evaluate_winner(runs, winner, parts["train"], parts["val"], parts["test"], AMOUNT_ONLY)
    return metrics.select("model", F.round("roc_auc", 6).alias("roc_auc"))


@query(
    "au01_recomputed_run",
    """SELECT run_id, metric, run_id = 'run-1' OR metric <> 'roc_auc' AS matches FROM (VALUES ('run-1'), ('run-2')) r(run_id),
         (VALUES ('roc_auc'), ('f1_macro'), ('precision_macro'), ('recall_macro'), ('accuracy')) m(metric)""",
)
def au01(spark, sf):
    """Both runs are refitted from their logged parameters; one has a changed area in its log."""
    runs, parts = stored_runs(spark, sf)
    audits = [tuning.audit_run(runs, parts["train"], parts["val"], AMOUNT_ONLY, run_id=r) for r in ("run-1", "run-2")]
    return audits[0].unionByName(audits[1]).select("run_id", "metric", "matches")


# --- trees, importances, scoring ----------------------------------------------------------------


def fitted_tree(spark, sf, depth=4):
    data = labelled(spark, sf)
    model = models.build_pipeline("dtree", MEASURES, n_train=1, params={"max_depth": depth}).fit(data)
    return data, model


@query(
    "ml26_tree_stats",
    with_("accounts") + "SELECT true AS is_binary, true AS within_depth, count(*) AS leaf_rows FROM accounts",
)
def ml26(spark, sf):
    _, model = fitted_tree(spark, sf)
    tree = model.stages[-1].tree
    nodes = trees.node_table(tree, spark)
    stats = trees.tree_stats(nodes, tree.depth)
    leaf_rows = F.round(F.col("mean_leaf_rows") * F.col("n_leaves")).cast("long")
    return stats.select(
        (F.col("n_leaves") == F.col("n_internal") + 1).alias("is_binary"), (F.col("depth") <= 4).alias("within_depth"),
        leaf_rows.alias("leaf_rows"),
    )


@query("ml27_decision_rules")
def ml27(spark, sf):
    data, model = fitted_tree(spark, sf)
    prepared = model.transform(data)
    rules = trees.extract_rules(
        trees.node_table(model.stages[-1].tree, spark), features.vector_names(prepared), scales=model.stages[0].statistics()
    )
    applied = trees.apply_rules(prepared, rules, "target")
    return rules.drop("path").join(applied, "id").select(
        "id", "rule", "prediction", "n", (F.col("support") == F.col("n")).alias("support_matches"),
        F.round("positive_rate", 4).alias("positive_rate"),
    )


@query(
    "io13_importance_export",
    "SELECT 'amount' AS feature, 1.0::DOUBLE AS weight UNION ALL SELECT 'flat', 0.0::DOUBLE",
)
def io13(spark, sf):
    """A feature without variation gets no importance, so the other gets all of it."""
    data = labelled(spark, sf).withColumn("flat", F.lit(1.0))
    roles = Roles("row_id", "target", continuous=["amount"], ordinal=["flat"])
    model = models.build_pipeline("dtree", roles, n_train=1, params={"max_depth": 3}).fit(data)
    path = fresh_path(spark, "importance")
    importance.model_weights(spark, model.stages[-1], ["amount", "flat"]).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "ml24_weight_direction",
    "SELECT * FROM (VALUES ('amount', 'raises', 1), ('age', 'raises', 2)) t(feature, direction, rank)",
)
def ml24(spark, sf):
    data = labelled(spark, sf)
    model = models.build_pipeline("logreg", MEASURES, n_train=data.count(), params={"max_iter": 20}).fit(data)
    weights = importance.model_weights(spark, model.stages[-1], features.vector_names(model.transform(data)))
    ranked = importance.weights_by_prefix(importance.top_features(weights, 15).withColumn("feature", F.concat(F.lit("x_"), "feature")))
    named = importance.risk_direction(ranked.withColumn("feature", F.substring("feature", 3, 100)))
    return named.select("feature", "direction", "rank")


@query("ml24_permutation_importance")
def ml24b(spark, sf):
    data = labelled(spark, sf)
    roles = Roles("row_id", "target", continuous=["amount", "age"], ordinal=["priority"])
    model = models.build_pipeline("logreg", roles, n_train=data.count(), params={"max_iter": 20}).fit(data)
    return importance.permutation_importance(model, data, roles)


def month_model(spark, sf):
    """A stored model of month rates, loaded back."""
    data = labelled(spark, sf)
    path = fresh_path(spark, "model")
    fitted = models.build_pipeline("logreg", MONTH_ONLY, n_train=10**9, params={"C": 1e3, "max_iter": 200}).fit(data)
    fitted.write().save(path)
    return scoring.load_model(path), data


@query(
    "ml31_batch_scoring",
    with_("accounts")
    + """SELECT row_id, CAST(r > 0.5 AS INTEGER) AS prediction, round(r, 3) AS p1, round(1 - r, 3) AS p0
         FROM (SELECT row_id, avg(target) OVER (PARTITION BY month) AS r FROM accounts)""",
)
def ml31(spark, sf):
    model, data = month_model(spark, sf)
    out = models.score_batch(model, data, ["row_id"])
    return out.select(
        "row_id", "prediction", F.round("probability_positive", 3).alias("p1"), F.round("probability_negative", 3).alias("p0")
    )


@query(
    "ss01_stream_scoring",
    with_("accounts")
    + """SELECT CAST(row_id AS VARCHAR) AS line, CASE WHEN row_id % 10 <> 0 THEN round(avg(target) OVER (PARTITION BY month), 3) END
         AS p1, CASE WHEN row_id % 10 = 0 THEN 'not an integer: month' END AS reason FROM accounts""",
)
def ss01(spark, sf):
    """Records as JSON lines; every tenth holds its month as text and is set aside."""
    model, data = month_model(spark, sf)
    source, out, checkpoint = (fresh_path(spark, n) for n in ("records", "scores", "scores-checkpoint"))
    good = F.to_json(F.struct("row_id", "month"))
    bad = F.to_json(F.struct("row_id", F.col("month").cast("string").alias("month")))
    data.select(F.when(F.col("row_id") % 10 == 0, bad).otherwise(good).alias("value")).write.text(source)
    records = spark.readStream.text(source).withColumn("line", F.regexp_extract("value", r'"row_id":(\d+)', 1))
    scoring.score_stream(
        records, column="value", fields=["row_id", "month"], model=model, keep=["line"], out=out, checkpoint=checkpoint
    ).awaitTermination()
    scored = scoring.read_scored(spark, out).select(
        "line", F.round("probability_positive", 3).alias("p1"), F.lit(None).cast("string").alias("reason")
    )
    aside = scoring.read_quarantine(spark, out).select("line", F.lit(None).cast("double").alias("p1"), "reason")
    return scored.unionByName(aside)


