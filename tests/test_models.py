"""Feature stages, classifiers, persistence, trees."""

import hashlib

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import evaluation, features, models, perceptron, splits, trees, tuning
from riskframe.roles import Roles
from riskframe.session import fresh_path
from riskframe.sources import runstore

ROLES = Roles("row_id", "target", continuous=["credit", "age"], ordinal=["delay"], categorical=["sex"])


@pytest.fixture(scope="module")
def labelled(spark):
    """1200 rows whose target follows two features with some noise."""
    i = F.col("id")

    def uniform(k):
        return F.pmod(F.xxhash64(F.lit(k), i), F.lit(1000)) / 1000.0

    base = spark.range(1200).select(
        i.alias("row_id"), (uniform(1) * 1000).alias("credit"), (uniform(2) * 50).alias("age"),
        F.floor(uniform(3) * 4).alias("delay"), (1 + F.floor(uniform(4) * 3)).alias("sex"), uniform(5).alias("noise"),
    )
    signal = F.col("credit") / 1000 + F.col("delay") / 8 + F.col("noise") / 2
    return base.withColumn("target", (signal > 1.0).cast("int")).drop("noise").cache()


def test_registry():
    assert models.list_models() == ["dtree", "gb", "logreg", "perceptron", "rf"]
    with pytest.raises(KeyError):
        models.model_spec("svm")
    sizes = {n: len(models.grid_points(models.model_spec(n).grid)) for n in models.list_models()}
    assert sizes == {"perceptron": 12, "logreg": 4, "dtree": 24, "rf": 24, "gb": 36}
    assert len(models.search_points("gb")) == 30 and len(models.search_points("rf")) == 24
    points = models.random_points(models.model_spec("gb").grid, 30, seed=1)
    assert len({models.params_text(p) for p in points}) == 30
    assert points == models.random_points(models.model_spec("gb").grid, 30, seed=1)


def test_preprocessor_accepts_unseen_codes(labelled):
    model = features.build_preprocessor(ROLES).fit(labelled)
    out = model.transform(labelled.withColumn("sex", F.lit(99)))
    assert out.count() == 1200
    names = features.vector_names(out)
    assert names == ["credit", "age", "delay", "sex_1", "sex_2", "sex_3"]
    tail = out.select(vector_to_array("features").alias("x")).first().x[3:]
    assert list(tail) == [0.0, 0.0, 0.0]


def test_scaler_matches_numpy(labelled):
    model = features.PopulationScaler(inputCols=["age"], outputCols=["z"]).fit(labelled)
    pdf = model.transform(labelled).select("age", "z").toPandas()
    assert np.allclose(pdf.z, (pdf.age - pdf.age.mean()) / pdf.age.std(ddof=0))


def test_components_grow_with_threshold(labelled):
    data = features.build_preprocessor(ROLES).fit(labelled).transform(labelled)
    ks = [features.components_for_variance(data, t) for t in (0.1, 0.5, 0.9, 1.1)]
    assert ks == sorted(ks) and 1 <= ks[0] and ks[-1] == 6


def test_unknown_reduction():
    with pytest.raises(ValueError):
        features.reduction_stages("umap", 2, label_col="target")
    with pytest.raises(ValueError):
        features.reduction_stages("lda", 2, label_col="target")


def test_fisher_matches_numpy_with_complete_one_hot(labelled):
    data = features.build_preprocessor(ROLES).fit(labelled).transform(labelled)
    model = features.FisherReducer(labelCol="target").fit(data)
    pdf = model.transform(data).select(
        "target", vector_to_array("features").alias("x"), vector_to_array("reduced")[0].alias("z")
    ).toPandas()
    x, y = np.stack(pdf.x.to_numpy()), pdf.target.to_numpy()
    within = sum(np.cov(x[y == c].T, bias=True) * (y == c).sum() for c in (0, 1)) / (len(y) - 2)
    w = np.linalg.pinv(within, rcond=1e-10, hermitian=True) @ (x[y == 1].mean(0) - x[y == 0].mean(0))
    w /= np.sqrt(w @ within @ w)
    assert np.allclose(pdf.z, (x - x.mean(0)) @ w, atol=1e-6)


def test_linear_models_agree_on_one_discriminant(labelled):
    """Any increasing score of one component has the component's area."""
    found = []
    for name, params in (("logreg", {"max_iter": 20}), ("perceptron", {"max_iter": 5})):
        pipeline = models.build_pipeline(name, ROLES, n_train=1200, params=params, reduction=("lda", 1))
        out = models.scored(pipeline.fit(labelled).transform(labelled), ROLES, F.lit(name).alias("model"))
        found.append(evaluation.roc_auc(out, ["model"], n_groups=1).first().roc_auc)
    assert found[0] == pytest.approx(found[1], abs=1e-6) and found[0] > 0.8


def test_perceptron_steps_match_plain_code(spark, labelled, monkeypatch):
    """One shard, no penalty: a mini-batch of one row is the perceptron rule, row by row."""
    monkeypatch.setattr(perceptron, "BATCH_ROWS", 1)
    data = features.build_preprocessor(ROLES).fit(labelled).transform(labelled)
    settings = perceptron.Settings(max_iter=1, eta0=0.5)
    # The rule is written out here; rows come in the order that the shard has.
    rows = perceptron.shards(data, "features", "target", "row_id").collect()
    assert len({r.shard for r in rows}) == 1 and len(rows) == 1200
    w, total = np.zeros(len(rows[0].x) + 1), np.zeros(len(rows[0].x) + 1)
    for r in rows:
        x = np.array([*r.x, 1.0])
        if r.y * (w @ x) <= 0:
            w = w + 0.5 * r.y * x
        total += w
    start, blind = np.zeros((1, len(w))), np.array([-2])
    frame = perceptron.shards(data, "features", "target", "row_id").toPandas()
    learner = perceptron._Learner(start, blind, settings)
    learner.read(np.column_stack([np.stack(frame.x), np.ones(len(frame))]), frame.y.to_numpy(), frame.fold.to_numpy())
    row = learner.row()
    assert np.allclose(np.array(row["ends"][0]) / 1200, w) and np.allclose(np.array(row["means"][0]) / 1200, total / 1200)


def test_perceptron_mixes_shards(spark, labelled, monkeypatch):
    """Several shards in any number of files: the mix is the mean of the shards' own ends, by rows."""
    monkeypatch.setattr(perceptron, "SHARD_ROWS", 300)
    data = features.build_preprocessor(ROLES).fit(labelled).transform(labelled)
    rows = perceptron.shards(data, "features", "target", "row_id")
    settings = perceptron.Settings(eta0=0.1, penalty="elasticnet")
    start, blind = np.zeros((1, 7)), np.array([-2])
    totals = perceptron._epoch(rows, start, blind, settings)
    expected = np.zeros(7)
    pdf = rows.toPandas()
    assert pdf["shard"].nunique() == 4
    for _, part in pdf.groupby("shard"):
        learner = perceptron._Learner(start, blind, settings)
        learner.read(np.column_stack([np.stack(part.x), np.ones(len(part))]), part.y.to_numpy(), part.fold.to_numpy())
        expected += np.array(learner.row()["ends"][0])
    assert np.allclose(totals["ends"][0], expected) and totals["rows"][0, 0] == 1200


def test_perceptron_members_do_not_see_their_fold(spark, labelled):
    data = features.build_preprocessor(ROLES).fit(labelled).transform(labelled).withColumn("part", F.col("row_id") % 3)
    both = perceptron.train(data, "features", "target", "row_id", fold="part", members=3)
    # Labels of a member's own fold do not matter to it, those of the others do.
    turned = data.withColumn("target", F.when(F.col("part") == 0, 1 - F.col("target")).otherwise(F.col("target")))
    other = perceptron.train(turned, "features", "target", "row_id", fold="part", members=3)
    assert np.allclose(both[0], other[0]) and not np.allclose(both[1], other[1])


def test_perceptron_edges(spark, labelled):
    data = features.build_preprocessor(ROLES).fit(labelled).transform(labelled)
    empty = perceptron.train(data.limit(0), "features", "target", "row_id")
    assert empty.shape == (1, 1) and not empty.any()
    unknown = data.withColumn("target", F.when(F.col("row_id") < 600, F.col("target")))
    known = data.where("row_id < 600")
    assert np.allclose(
        perceptron.train(unknown, "features", "target", "row_id"), perceptron.train(known, "features", "target", "row_id")
    )
    one = perceptron.train(data.withColumn("target", F.lit(1)), "features", "target", "row_id")[0]
    margins = data.select(features.dot(F.col("features"), one[:-1].tolist()).alias("m"))
    assert margins.agg(F.min("m")).first()[0] + one[-1] > 0
    with pytest.raises(ValueError):
        perceptron.Settings(penalty="l3")


def test_perceptron_area_is_near_the_margin_classifiers(labelled):
    data = features.build_preprocessor(ROLES).fit(labelled).transform(labelled)
    areas = []
    for kind in (models.CalibratedPerceptron, models.CalibratedMarginClassifier):
        model = kind(labelCol="target", keyCol="row_id").fit(data)
        out = models.scored(model.transform(data), ROLES, F.lit("m").alias("model"))
        areas.append(evaluation.roc_auc(out, ["model"], n_groups=1).first().roc_auc)
    assert areas[0] > areas[1] - 0.01


@pytest.mark.parametrize(
    "name, params",
    [("perceptron", {"max_iter": 5}), ("logreg", {}), ("dtree", {"max_depth": 4}),
     ("dtree", {"max_depth": 3, "criterion": "entropy"}), ("rf", {"n_estimators": 4, "max_depth": 4}),
     ("gb", {"n_estimators": 3})],
)
def test_persistence_keeps_scores(spark, labelled, name, params):
    model = models.build_pipeline(name, ROLES, n_train=1200, params=params).fit(labelled)
    path = fresh_path(spark, "model")
    model.write().save(path)
    back = PipelineModel.load(path)
    a = models.score_batch(model, labelled, ["row_id"])
    b = models.score_batch(back, labelled, ["row_id"])
    assert a.exceptAll(b).isEmpty()
    sums = a.agg(F.max(F.abs(F.col("probability_positive") + F.col("probability_negative") - 1)).alias("gap")).first()
    assert sums.gap < 1e-6


def test_fits_are_fresh(labelled):
    one = models.build_pipeline("dtree", ROLES, n_train=1, params={"max_depth": 2})
    two = models.build_pipeline("dtree", ROLES, n_train=1)
    assert one.getStages()[-1] is not two.getStages()[-1]


def test_tree_rules_cover_their_rows(spark, labelled):
    prepared = features.build_preprocessor(ROLES).fit(labelled)
    data = prepared.transform(labelled)
    tree = models.model_spec("dtree").make(ROLES, 1, "features", 42, max_depth=3).fit(data)
    nodes = trees.node_table(tree.tree, spark)
    stats = trees.tree_stats(nodes, tree.depth).first()
    assert stats.n_leaves == stats.n_internal + 1 and stats.depth == 3
    rules = trees.extract_rules(nodes, features.vector_names(data), n_rules=8, min_rows=0)
    applied = {r.id: r for r in trees.apply_rules(data, rules, "target").collect()}
    listed = rules.collect()
    assert len(listed) == stats.n_leaves
    for r in listed:
        assert applied[r.id].support == r.n
        assert applied[r.id].positive_rate == pytest.approx(r.prediction, abs=1e-9)
        assert r.rule.startswith("IF (")
    assert sum(r.n for r in listed) == 1200


def test_cross_validation_uses_every_row_once(labelled):
    from riskframe.operators.splits import assign_folds, fit_folds

    folded = assign_folds(labelled, fit_folds(labelled, "row_id", "target", k=3))
    pipeline = models.build_pipeline("logreg", ROLES, n_train=800)
    predictions = tuning.fold_predictions(folded, pipeline, ROLES, 3)
    assert predictions.count() == predictions.select("key").distinct().count() == 1200
    rows = tuning.fold_metrics(predictions).collect()
    assert len(rows) == 6 and all(0 < r.value <= 1 for r in rows)


def test_search_returns_the_best(labelled):
    model, best, table = tuning.search(
        labelled, "dtree", ROLES, k=2, grid={"max_depth": [1, 4], "criterion": ["gini"]}
    )
    scores = {r.combo: r.score for r in table.collect()}
    assert models.params_text(best) == max(scores, key=scores.get)
    assert isinstance(model, PipelineModel) and model.stages[-1].depth == best["max_depth"]


def test_audit_finds_a_changed_log(labelled, tmp_path):
    train, val = labelled.where("row_id % 4 <> 0"), labelled.where("row_id % 4 = 0")
    _, record = tuning.train_and_evaluate("logreg", train, val, ROLES, k=2, params={"max_iter": 10})
    assert record["metrics"]["roc_auc"] > 0.8 and record["search_type"] == "none"
    spark, path = labelled.sparkSession, str(tmp_path / "runs")
    about = {"experiment": "e", "start_time": 1, "data_digest": "d" * 64, "code_digest": "c" * 40}
    tuning.log_run(tuning.run_frame(spark, record, run_id="good", **about), path)
    changed = {**record, "metrics": {**record["metrics"], "accuracy": 0.9999}}
    tuning.log_run(tuning.run_frame(spark, changed, run_id="bad", **about), path)
    runs = runstore.read_runs(spark, path)
    assert tuning.logged_settings(runs, "good") == {"name": "logreg", "seed": 42, "reduction": None, "params": {"max_iter": 10}}
    assert all(r.matches for r in tuning.audit_run(runs, train, val, ROLES, run_id="good").collect())
    assert [r.metric for r in tuning.audit_run(runs, train, val, ROLES, run_id="bad").collect() if not r.matches] == ["accuracy"]
    incomplete = {k: v for k, v in record.items() if k != "n_val"}
    with pytest.raises(ValueError, match="n_val"):
        tuning.log_run(tuning.run_frame(spark, incomplete, run_id="x", **about), path)


def test_pca_projection_is_centred(labelled):
    data = features.build_preprocessor(ROLES).fit(labelled).transform(labelled)
    model = Pipeline(stages=features.pca_stages(2)).fit(data)
    out = model.transform(data).select(F.avg(vector_to_array("reduced")[0]).alias("m")).first()
    assert abs(out.m) < 1e-9
    shares = features.explained_variance(model)
    assert 0 < sum(shares) <= 1 and shares == sorted(shares, reverse=True)


# --- split minimum and information gain ------------------------------------------------------


def by_hand(rows, names, criterion, max_depth, min_split):
    """Rates of rows (x..., y) from a tree grown as stated: best gain first, ties to the first feature and value."""

    def impurity(ys):
        p = sum(ys) / len(ys)
        if criterion == "gini":
            return 2 * p * (1 - p)
        return -sum(s * np.log2(s) for s in (p, 1 - p) if s > 0)

    def grow(part, depth):
        ys = [r[-1] for r in part]
        rate = sum(ys) / len(ys)
        if depth == max_depth or len(part) < max(2, min_split) or rate in (0, 1):
            return {r[0]: rate for r in part}
        options = []
        for j in range(len(names)):
            for t in sorted({r[1 + j] for r in part})[:-1]:
                left = [r for r in part if r[1 + j] <= t]
                right = [r for r in part if r[1 + j] > t]
                below = (len(left) * impurity([r[-1] for r in left]) + len(right) * impurity([r[-1] for r in right])) / len(part)
                options.append((-round(impurity(ys) - below, 12), j, t, left, right))
        if not options or min(options)[0] > -1e-12:
            return {r[0]: rate for r in part}
        _, _, _, left, right = min(options, key=lambda o: o[:3])
        return grow(left, depth + 1) | grow(right, depth + 1)

    return grow(rows, 0)


@pytest.mark.parametrize("criterion, max_depth, min_split", [("entropy", 4, 2), ("entropy", 30, 60), ("gini", 30, 60), ("gini", 30, 200), ("entropy", 2, 500)])
def test_trees_split_as_by_hand(spark, criterion, max_depth, min_split):
    draw = np.random.default_rng(17)
    rows = [(i, int(draw.integers(0, 7)), int(draw.integers(0, 5)), 0) for i in range(700)]
    rows = [(i, a, b, int(draw.random() < (0.1 + 0.1 * a if b < 3 else 0.6 - 0.07 * a))) for i, a, b, _ in rows]
    df = spark.createDataFrame(rows, "row_id long, a int, b int, target int")
    roles = Roles("row_id", "target", continuous=[], ordinal=["a", "b"], categorical=[])
    params = {"max_depth": max_depth if max_depth < 30 else None, "min_samples_split": min_split, "criterion": criterion}
    model = models.build_pipeline("dtree", roles, n_train=1, params=params).fit(df)
    got = {r["row_id"]: r["probability_positive"] for r in models.score_batch(model, df, ["row_id"]).collect()}
    want = by_hand(rows, ["a", "b"], criterion, max_depth, min_split)
    assert got == pytest.approx(want, abs=1e-9)
    path = fresh_path(spark, "model")
    model.write().save(path)
    assert models.score_batch(model, df, ["row_id"]).exceptAll(models.score_batch(PipelineModel.load(path), df, ["row_id"])).isEmpty()


def test_forest_nodes_respect_the_split_minimum(spark, labelled):
    params = {"n_estimators": 3, "max_depth": 8, "min_samples_split": 150}
    model = models.build_pipeline("rf", ROLES, n_train=1200, params=params).fit(labelled).stages[-1]
    path = fresh_path(spark, "forest")
    model.tree.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    assert nodes.where("leftChild >= 0").agg(F.min("rawCount")).first()[0] >= 150
    assert nodes.groupBy("treeID").agg(F.max("id") + 1 == F.count("*")).where("NOT ((max(id) + 1) = count(1))").count() == 0
    assert nodes.where("leftChild < 0 AND rawCount < 75").count() > 0 or nodes.where("leftChild < 0").count() > 3


def test_entropy_tree_without_a_split(spark):
    df = spark.createDataFrame([(i, 1, 1) for i in range(9)], "row_id long, a int, target int")
    roles = Roles("row_id", "target", continuous=[], ordinal=["a"], categorical=[])
    for target in (df, df.withColumn("target", (F.col("row_id") % 2).cast("int"))):
        model = models.build_pipeline("dtree", roles, n_train=1, params={"criterion": "entropy"}).fit(target)
        rates = {r["probability_positive"] for r in models.score_batch(model, target, ["row_id"]).collect()}
        assert rates == {target.agg(F.avg("target")).first()[0]}


def test_entropy_tree_sends_no_rows_to_all_tasks(spark):
    """Rows of few distinct bins are small in files; a level's rows must stay where they are."""
    i = F.col("id")
    chance = F.pmod(F.xxhash64(i), F.lit(100)) < 8 * (i % 5) + 7 * (i % 4) + 5
    df = spark.range(200_000).select(i.alias("row_id"), (i % 5).alias("a"), (i % 4).alias("b"), chance.cast("int").alias("target"))
    roles = Roles("row_id", "target", continuous=[], ordinal=["a", "b"], categorical=[])
    spark.conf.set("spark.sql.maxBroadcastTableSize", "4m")
    try:
        model = models.build_pipeline("dtree", roles, n_train=1, params={"criterion": "entropy"}).fit(df)
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    scored = models.score_batch(model, df, ["a", "b", "target"]).groupBy("a", "b")
    for r in scored.agg(F.avg("target").alias("rate"), F.min("probability_positive").alias("lo"), F.max("probability_positive").alias("hi")).collect():
        assert r["lo"] == r["hi"] == pytest.approx(r["rate"], abs=1e-12)


def test_many_splits_move_rows_alike(spark, monkeypatch):
    from riskframe.operators import entropy_trees

    level = spark.range(300).select((F.col("id") % 2).cast("int").alias("y"), F.array((F.col("id") % 7).cast("int")).alias("bins"), (F.col("id") % 3).cast("int").alias("node"))
    splits = spark.createDataFrame([(0, 0, 2, 3, 4), (1, 0, 3, -1, 5)], "node int, feature int, cut int, to_left int, to_right int")
    sent = entropy_trees._below(level, splits, 2)
    monkeypatch.setattr(entropy_trees, "BROADCAST_CELLS", 0)
    dealt = entropy_trees._below(level, splits, 2)
    assert sent.count() == level.where("node = 0 OR node = 1 AND bins[0] > 3").count()
    assert sent.exceptAll(dealt).isEmpty() and dealt.exceptAll(sent).isEmpty()


def test_digests_are_made_once_per_row(spark, labelled, monkeypatch):
    def digests(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("md5(")

    assert digests(splits.assign_folds(labelled, splits.fit_folds(labelled, "row_id", "target", k=5))) == 1
    seen, plain = [], tuning.scored
    monkeypatch.setattr(tuning, "scored", lambda df, *rest: seen.append(df) or plain(df, *rest))
    roles = Roles("row_id", "target", continuous=["credit"])
    pipeline = models.build_pipeline("logreg", roles, n_train=1200, params={"max_iter": 3})
    assert tuning.cross_validate(labelled, pipeline, roles, k=2).count() == 4
    curve = tuning.learning_curve(labelled, "logreg", roles, k=2, fractions=[0.5, 1.0], params={"max_iter": 3})
    assert curve.count() == 4 and len(seen) == 2 + 8
    assert all(digests(df) == 0 for df in seen)


def test_a_sweep_shares_folds_and_vectors(labelled, monkeypatch):
    """Folds are made once and preprocessing is fitted once per reduction and side, whatever the number of models."""
    train, val = labelled.where("row_id % 4 <> 0"), labelled.where("row_id % 4 = 0")
    settings = {"k": 2, "seed": 7, "params": {"max_depth": 3, "max_iter": 5}}
    names, reductions = ["dtree", "logreg"], [None, ("pca", 2)]
    alone = [
        tuning.train_and_evaluate(n, train, val, ROLES, stage="dimred" if r else "baseline", reduction=r, **settings)[1]
        for r in reductions for n in names
    ]
    calls, folds, scaler = [], tuning.fit_folds, features.PopulationScaler._fit
    monkeypatch.setattr(tuning, "fit_folds", lambda *a, **k: calls.append("folds") or folds(*a, **k))
    monkeypatch.setattr(features.PopulationScaler, "_fit", lambda self, df: calls.append("scaler") or scaler(self, df))
    swept = tuning.train_sweep(names, reductions, train, val, ROLES, **settings)
    assert calls.count("folds") == 1 and calls.count("scaler") == len(reductions) * 3
    timed = {"training_time_s", "inference_latency_ms"}
    for a, b in zip(alone, swept, strict=True):
        assert a.keys() == b.keys() and a["metrics"].keys() == b["metrics"].keys()
        assert all(a[key] == b[key] for key in a if key not in ("metrics", "dimred_explained_variance"))
        assert all(a["metrics"][m] == pytest.approx(b["metrics"][m], abs=1e-6) for m in a["metrics"] if m not in timed)
        assert b["metrics"]["training_time_s"] > 0
        if b["dimred_method"] == "pca":
            assert float(a["dimred_explained_variance"]) == pytest.approx(float(b["dimred_explained_variance"]))


def test_a_tuned_run_of_shared_vectors(labelled):
    roles = Roles("row_id", "target", continuous=["credit"])
    train, val = labelled.where("row_id % 4 <> 0"), labelled.where("row_id % 4 = 0")
    settings = {"k": 2, "tune": True, "grid": {"max_depth": [1, 3], "criterion": ["gini"]}}
    _, alone = tuning.train_and_evaluate("dtree", train, val, roles, **settings)
    (swept,) = tuning.train_sweep(["dtree"], [None], train, val, roles, **settings)
    assert swept["params"] == alone["params"] and swept["search_type"] == alone["search_type"]
    assert swept["metrics"]["roc_auc"] == pytest.approx(alone["metrics"]["roc_auc"], abs=1e-6)


def test_a_learning_curve_scores_rows_once_for_all_models_of_a_fold(labelled, monkeypatch):
    """Equal to fits, scorings and areas made one by one; parts under all folds are found in the same passes."""
    fractions, k, params = [0.3, 1.0], 3, {"max_iter": 4}
    passes, areas = [], tuning.evaluation.roc_areas
    monkeypatch.setattr(tuning.evaluation, "roc_areas", lambda *a, **o: passes.append(a) or areas(*a, **o))
    found = {
        (r["fraction"], r["side"]): (r["mean"], r["std"])
        for r in tuning.learning_curve(labelled, "logreg", ROLES, fractions=fractions, k=k, params=params).collect()
    }
    assert len(passes) == 2 * k
    folded = tuning.folded_rows(labelled, ROLES, k=k, seed=42)
    each = {}
    for i in range(k):
        others, held = folded.where(F.col("fold") != i), folded.where(F.col("fold") == i)
        part = splits.fit_fractions(others, "row_id", "target", fractions, seed=43).assign(others, "part")
        for j, f in enumerate(fractions):
            some = part.where(F.col("part").isin(*[str(p) for p in range(j + 1)]))
            n = max(1, int(folded.count() * f * (k - 1) / k))
            model = models.build_pipeline("logreg", ROLES, n_train=n, params=params).fit(some)
            for side, rows in (("train", some), ("validation", held)):
                scores = models.scored(model.transform(rows), ROLES, F.lit(0).alias("g"))
                each.setdefault((f, side), []).append(evaluation.roc_auc(scores, ["g"], n_groups=1).first()["roc_auc"])
    assert found.keys() == each.keys()
    for at, values in each.items():
        assert found[at] == pytest.approx((np.mean(values), np.std(values)), abs=1e-9)


@pytest.mark.parametrize("seed", [43, 7])
def test_fractions_of_all_folds_at_once(labelled, seed):
    """The cuts of every fold's other rows, with classes and keys that are missing or come twice."""
    odd = labelled.select(
        F.when(F.col("row_id") % 50 == 0, None).when(F.col("row_id") % 7 == 0, 7).otherwise(F.col("row_id")).alias("row_id"),
        F.when(F.col("row_id") % 11 == 0, None).otherwise(F.col("target")).alias("target"),
        F.when(F.col("row_id") % 13 != 0, (F.col("row_id") % 3).cast("int")).alias("fold"),
    )
    fractions = [0.001, 0.3, 0.7, 1.0]
    found = splits.fit_fold_fractions(odd, "row_id", "target", fractions, "fold", 3, seed=seed, prefix_digits=2)
    for i, cuts in enumerate(found):
        alone = splits.fit_fractions(odd.where(F.col("fold") != i), "row_id", "target", fractions, seed=seed, prefix_digits=2)
        assert cuts == alone


def test_assigning_by_few_and_by_many_classes(spark, labelled, monkeypatch):
    """A row is in the first part whose end is not below its digest, whichever way the ends reach it."""
    odd = labelled.select(
        F.when(F.col("row_id") % 50 == 0, None).otherwise(F.col("row_id")).alias("row_id"),
        F.when(F.col("row_id") % 11 == 0, None).otherwise(F.col("row_id") % 4).alias("label"),
    )
    cuts = [splits.Cuts("row_id", "label", s, ["a", "b", "c"], {0: ["", "8"], 1: ["4", "4"], None: ["c", "1"]}) for s in (1, 1, 2)]
    columns = ["p", "q", "r"]

    def named(row, c):
        if row.label not in c.boundaries:
            return None
        digest = None if row.row_id is None else hashlib.md5(f"{c.seed}:{row.row_id}".encode()).hexdigest()
        return next((n for n, e in zip(c.names, c.boundaries[row.label]) if digest is not None and digest <= e), c.names[-1])

    few = splits.assign_all(odd, cuts, columns)
    assert few._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 2
    monkeypatch.setattr(splits, "INLINE_CLASSES", 2)
    for rows in (few.collect(), splits.assign_all(odd, cuts, columns).collect()):
        assert len(rows) == odd.count() and rows[0].__fields__ == ["row_id", "label", *columns]
        assert all(row[c] == named(row, cut) for row in rows for c, cut in zip(columns, cuts))


@pytest.mark.parametrize("bucket", [1 << 20, 40])
def test_areas_of_an_array_of_scores(spark, monkeypatch, bucket):
    """Place by place what ``roc_auc`` gives: tied, missing, infinite and NaN scores, missing labels, one class, no rows."""
    monkeypatch.setattr(evaluation, "BUCKET_SCORES", bucket)
    monkeypatch.setattr(evaluation, "RUN_ROWS", 64)
    monkeypatch.setattr(evaluation, "BORDER_ROWS", 8)
    i = F.col("id")
    h = F.pmod(F.xxhash64(i), F.lit(1000)) / 1000.0
    y = F.when(i % 17 == 0, None).otherwise((h + F.pmod(F.xxhash64(i, F.lit(1)), F.lit(100)) / 100.0 > 1.0).cast("int"))
    places = [
        h,
        F.round(h, 1),
        F.when(i % 3 == 0, h),
        F.when(i % 5 == 0, float("nan")).when(i % 5 == 1, float("inf")).when(i % 5 == 2, -0.0).when(i % 5 == 3, 0.0).otherwise(-h),
        F.when(F.col("y") == 1, h),
        F.lit(None).cast("double"),
        F.lit(0.25),
    ]
    df = spark.range(900).withColumn("y", y).select(i.alias("key"), "y", F.array(*places).alias("scores"))
    found = {r["at"]: r["roc_auc"] for r in evaluation.roc_areas(df, len(places), lambda rows: rows, "key").collect()}
    long = df.select("y", F.posexplode("scores").alias("at", "score"))
    plain = {r["at"]: r["roc_auc"] for r in evaluation.roc_auc(long, ["at"], n_groups=len(places)).collect()}
    assert found == plain and 5 not in found and found[4] is None and found[6] == 0.5
