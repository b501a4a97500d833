"""Cross-validation, search, learning curves, training runs, refits and audits."""

from __future__ import annotations

import platform
import time
from functools import partial, reduce
from multiprocessing.pool import AsyncResult, ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.expressions import run_name, typed_param
from riskframe.operators import contracts, evaluation, selection
from riskframe.operators.features import preprocessor_stages, reduction_stages
from riskframe.operators.models import (
    build_pipeline,
    model_spec,
    params_text,
    scored,
    search_points,
)
from riskframe.operators.splits import assign_all, assign_folds, fit_fold_fractions, fit_folds
from riskframe.roles import Roles
from riskframe.session import materialise
from riskframe.sources import runstore

METRICS = ["roc_auc", "f1_macro", "precision_macro", "recall_macro", "accuracy"]
FOLD_THREADS = 4
# Fits and scorings of a learning curve that run side by side.
CURVE_THREADS = (6, 2)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- cross-validation ---------------------------------------------------------------


def fold_predictions(folded: DataFrame, pipeline: Pipeline, roles: Roles, k: int, fold: str = "fold") -> DataFrame:
    """(fold, key, y, score, prediction): every row scored by the model that did not see it."""

    def part(i: int) -> DataFrame:
        model = pipeline.fit(folded.where(F.col(fold) != i))
        return scored(model.transform(folded.where(F.col(fold) == i)), roles, F.lit(i).alias("fold"))

    # Folds are independent fits; Spark interleaves their jobs.
    with ThreadPool(min(k, FOLD_THREADS)) as pool:
        return _union(pool.map(inheritable_thread_target(folded.sparkSession)(part), range(k)))


def folded_rows(df: DataFrame, roles: Roles, *, k: int, seed: int, prefix_digits: int = 4) -> DataFrame:
    """The rows with their fold, written once: every pass of a fit would make the digests of all rows again."""
    cuts = fit_folds(df, roles.key, roles.target, k=k, seed=seed, prefix_digits=prefix_digits)
    return materialise(assign_folds(df, cuts), "folds")


def _prepared(
    folded: DataFrame, seen: DataFrame, roles: Roles, reduction: tuple[str, int] | None
) -> tuple[PipelineModel, DataFrame]:
    """Preprocessing fitted on ``seen``, and the vectors of all folded rows under it, written once."""
    stages, column = preprocessor_stages(roles, "features"), "features"
    if reduction is not None:
        stages += reduction_stages(*reduction, label_col=roles.target, input_col="features", output_col="reduced")
        column = "reduced"
    model = Pipeline(stages=stages).fit(seen)
    return model, materialise(model.transform(folded).select(roles.key, roles.target, "fold", column), "prepared")


class PreparedFolds:
    """Vectors of every row under the preprocessing of each fold's training side, written once.

    Preprocessing depends on the fold and not on the classifier or its settings, so it is fitted ``k`` times whatever
    their number, and a fit reads finished vectors.
    """

    def __init__(self, folded: DataFrame, roles: Roles, k: int, reduction: tuple[str, int] | None = None):
        self.roles, self.k = roles, k
        self.column = "features" if reduction is None else "reduced"

        def prepared(i: int) -> DataFrame:
            return _prepared(folded, folded.where(F.col("fold") != i), roles, reduction)[1]

        with ThreadPool(min(k, FOLD_THREADS)) as pool:
            self.tables = pool.map(inheritable_thread_target(folded.sparkSession)(prepared), range(k))

    def predictions(self, classifier: Estimator, threads: int = 1) -> DataFrame:
        """(fold, key, y, score, prediction) of one classifier over all folds."""

        def part(i: int) -> DataFrame:
            table = self.tables[i]
            model = classifier.fit(table.where(F.col("fold") != i))
            return scored(model.transform(table.where(F.col("fold") == i)), self.roles, F.lit(i).alias("fold"))

        with ThreadPool(min(self.k, threads)) as pool:
            return _union(pool.map(inheritable_thread_target(self.tables[0].sparkSession)(part), range(self.k)))


class PreparedTraining:
    """Training rows as vectors, under the preprocessing of all of them and of each fold.

    No classifier changes them, so all models of a sweep read the same.  ``seconds`` is the time for fitting the
    preprocessing of all rows and writing their vectors.
    """

    def __init__(self, folded: DataFrame, roles: Roles, k: int, reduction: tuple[str, int] | None = None):
        started = time.perf_counter()
        self.model, self.rows = _prepared(folded, folded, roles, reduction)
        self.seconds = time.perf_counter() - started
        self.folds = PreparedFolds(folded, roles, k, reduction)

    def fit(self, pipeline: Pipeline) -> PipelineModel:
        """The fitted pipeline; only its classifier is fitted here."""
        return PipelineModel([*self.model.stages, pipeline.getStages()[-1].fit(self.rows)])


def fold_metrics(predictions: DataFrame, group: list[str] | None = None, n_groups: int | None = None) -> DataFrame:
    """(group..., fold, metric, value) for ROC-AUC and macro F1, all folds in one job."""
    keys = [*(group or []), "fold"]
    wide = evaluation.all_metrics(predictions, keys, n_groups=n_groups)
    return evaluation.to_metric_rows(wide, keys, ["roc_auc", "f1_macro"])


def cross_validate(
    df: DataFrame,
    pipeline: Pipeline,
    roles: Roles,
    *,
    k: int = 5,
    seed: int = 42,
    prefix_digits: int = 4,
    prepared: PreparedFolds | None = None,
) -> DataFrame:
    """(fold, metric, value) of stratified k-fold cross-validation with two scorers.

    Folds that were ``prepared`` with the pipeline's preprocessing are not made again.
    """
    if prepared is not None:
        predictions = prepared.predictions(pipeline.getStages()[-1], FOLD_THREADS)
    else:
        folded = folded_rows(df, roles, k=k, seed=seed, prefix_digits=prefix_digits)
        predictions = fold_predictions(folded, pipeline, roles, k)
    return fold_metrics(predictions, n_groups=k)


# --- search -------------------------------------------------------------------------


def search(
    df: DataFrame,
    name: str,
    roles: Roles,
    *,
    k: int = 5,
    seed: int = 42,
    n_iter: int = 30,
    grid: dict[str, list] | None = None,
    metric: str = "roc_auc",
    parallelism: int = 4,
    reduction: tuple[str, int] | None = None,
    prepared: PreparedTraining | None = None,
) -> tuple[PipelineModel, dict, DataFrame]:
    """Best model refitted on all rows, its settings, and (combo, settings..., score).

    Every combination is scored by the mean of the metric over the stratified folds, on vectors prepared
    once per fold.  Combinations run side by side on driver threads.
    (``CrossValidator`` would pass the fold column through a Python function per row.)
    """
    if metric not in ("roc_auc", "f1_macro"):
        raise ValueError("search by 'roc_auc' or 'f1_macro'")
    n_train = df.count()
    points = search_points(name, n_iter=n_iter, seed=seed, grid=grid)
    if prepared is None:
        folded = folded_rows(df, roles, k=k, seed=seed)
        folds = PreparedFolds(folded, roles, k, reduction)
    else:
        folds = prepared.folds

    def pipeline(p: dict) -> Pipeline:
        return build_pipeline(name, roles, n_train=n_train, seed=seed, params=p, reduction=reduction)

    def score(p: dict) -> float:
        classifier = model_spec(name).make(roles, n_train, folds.column, seed, **p)
        rows = fold_metrics(folds.predictions(classifier), n_groups=k)
        value = rows.where(F.col("metric") == metric).agg(F.avg("value").alias("score")).first()["score"]
        return float("-inf") if value is None else float(value)

    with ThreadPool(max(1, min(parallelism, len(points)))) as pool:
        scores = pool.map(inheritable_thread_target(df.sparkSession)(score), points)
    best = max(range(len(points)), key=lambda i: scores[i])
    refit = pipeline(points[best])
    best_model = refit.fit(folded) if prepared is None else prepared.fit(refit)
    names = sorted({k_ for p in points for k_ in p})
    table = df.sparkSession.createDataFrame(
        [
            (params_text(p), *[None if p.get(c) is None else str(p[c]) for c in names], float(s))
            for p, s in zip(points, scores)
        ],
        ", ".join(["combo string", *[f"{c} string" for c in names], "score double"]),
    )
    return best_model, points[best], table


# --- curves -------------------------------------------------------------------------


def learning_curve(
    df: DataFrame,
    name: str,
    roles: Roles,
    *,
    fractions: list[float] | None = None,
    k: int = 5,
    seed: int = 42,
    params: dict | None = None,
) -> DataFrame:
    """(fraction, side, mean, std): ROC-AUC on the training part and on the held-out fold.

    Training parts are nested: each fraction contains the smaller ones.
    """
    fractions = fractions or [i / 10 for i in range(1, 11)]
    folded = folded_rows(df, roles, k=k, seed=seed)
    n_train = folded.count()
    cuts = fit_fold_fractions(folded, roles.key, roles.target, fractions, "fold", k, seed=seed + 1)
    # The part of every row under each fold, written once: every pass of a fit would make the digests again.
    ranked = assign_all(folded, cuts, [f"_part{i}" for i in range(k)])
    number = [F.when(F.col(f"_part{i}") != "unused", F.col(f"_part{i}")).cast("int").alias(f"_part{i}") for i in range(k)]
    ranked = materialise(ranked.select(*folded.columns, *number), "parts")
    sides = [(ranked.where(F.col("fold") != i), ranked.where(F.col("fold") == i)) for i in range(k)]

    def model_of(i: int, j: int) -> PipelineModel:
        n = max(1, int(n_train * fractions[j] * (k - 1) / k))
        some = sides[i][0].where(F.col(f"_part{i}") <= j)
        return build_pipeline(name, roles, n_train=n, seed=seed, params=params).fit(some)

    def areas_of(i: int, fitted: list[AsyncResult]) -> DataFrame:
        """(fraction, side, fold, roc_auc): all models of a fold score its rows in one pass per side."""
        part, parts = F.col(f"_part{i}"), []

        def scores(rows: DataFrame, side: str) -> DataFrame:
            for j, model in enumerate(fitted):
                seen = part <= j if side == "train" else F.lit(True)
                rows = _with_score(rows, model.get(), roles, f"_score{j}", seen)
            listed = F.array(*[f"_score{j}" for j in range(len(fractions))]).alias("scores")
            return rows.select(F.col(roles.target).cast("int").alias("y"), listed)

        for side, rows in (("train", sides[i][0].where(part.isNotNull())), ("validation", sides[i][1])):
            areas = evaluation.roc_areas(rows, len(fractions), partial(scores, side=side), roles.key)
            fraction = F.get(F.array(*[F.lit(float(f)) for f in fractions]), F.col("at")).alias("fraction")
            parts.append(areas.select(fraction, F.lit(side).alias("side"), F.lit(i).alias("fold"), "roc_auc"))
        return materialise(_union(parts), "curve")

    # Fits are independent; the models of a fold score while those of the next are fitted.
    run = inheritable_thread_target(df.sparkSession)
    with ThreadPool(CURVE_THREADS[0]) as fits, ThreadPool(CURVE_THREADS[1]) as scorings:
        models = [[fits.apply_async(run(model_of), (i, j)) for j in range(len(fractions))] for i in range(k)]
        areas = _union(scorings.starmap(run(areas_of), enumerate(models), 1))
    return areas.groupBy("fraction", "side").agg(
        F.avg("roc_auc").alias("mean"), F.stddev_pop("roc_auc").alias("std")
    )


def _with_score(df: DataFrame, model: PipelineModel, roles: Roles, name: str, where: Column) -> DataFrame:
    """``df`` and the model's score of the rows ``where`` it is asked for, null elsewhere."""
    kept = [F.col(f"`{c}`").alias(f"_kept{n}") for n, c in enumerate(df.columns)]
    score = F.when(F.col("_where"), F.col("score")).alias(name)
    out = scored(model.transform(df), roles, where.alias("_where"), *kept)
    return out.select(*[F.col(f"_kept{n}").alias(c) for n, c in enumerate(df.columns)], score)


def validation_curve(results: DataFrame, param: str) -> DataFrame:
    """(value, mean_score, n) of a search result by one setting."""
    return selection.mean_score_by_param(results, param)


# --- training runs ------------------------------------------------------------------


def train_and_evaluate(
    name: str,
    train: DataFrame,
    val: DataFrame,
    roles: Roles,
    *,
    stage: str = "baseline",
    tune: bool = False,
    reduction: tuple[str, int] | None = None,
    k: int = 5,
    seed: int = 42,
    params: dict | None = None,
    grid: dict[str, list] | None = None,
    n_iter: int = 30,
    parallelism: int = 4,
    prepared: PreparedTraining | None = None,
) -> tuple[PipelineModel, dict]:
    """Cross-validate, optionally search, fit, score validation; returns model and run record.

    The cross-validation figures are those of the settings that are finally fitted; for a
    tuned run the figures before tuning are kept as ``cv_untuned_*``.  ``prepared`` holds the training rows
    under the same folds and reduction; the time of its preprocessing counts as training time.
    """
    n_train = train.count()
    pipeline = build_pipeline(name, roles, n_train=n_train, seed=seed, params=params, reduction=reduction)

    def cv_summary(p: Pipeline) -> dict[str, float]:
        folds = None if prepared is None else prepared.folds
        by_fold = cross_validate(train, p, roles, k=k, seed=seed, prepared=folds)
        rows = evaluation.fold_summary(by_fold.withColumn("g", F.lit(0)), ["g"])
        found = {r["metric"]: (r["mean"], r["std"]) for r in rows.collect()}
        return {
            "cv_roc_auc_mean": found["roc_auc"][0],
            "cv_roc_auc_std": found["roc_auc"][1],
            "cv_f1_mean": found["f1_macro"][0],
            "cv_f1_std": found["f1_macro"][1],
        }

    metrics: dict[str, float] = {}
    chosen = dict(params or {})
    started = time.perf_counter()
    if tune:
        metrics.update({k_.replace("cv_", "cv_untuned_", 1): v for k_, v in cv_summary(pipeline).items()})
        started = time.perf_counter()
        model, chosen, _ = search(
            train, name, roles, k=k, seed=seed, n_iter=n_iter, grid=grid, parallelism=parallelism, reduction=reduction,
            prepared=prepared,
        )
        pipeline = build_pipeline(name, roles, n_train=n_train, seed=seed, params=chosen, reduction=reduction)
    else:
        model = pipeline.fit(train) if prepared is None else prepared.fit(pipeline)
    metrics["training_time_s"] = time.perf_counter() - started + (0.0 if prepared is None else prepared.seconds)
    metrics.update(cv_summary(pipeline))

    predictions = scored(model.transform(val), roles, F.lit(name).alias("model"))
    n_val = val.count()
    # Scoring alone is timed: nothing is aggregated or kept.
    started = time.perf_counter()
    predictions.write.format("noop").mode("overwrite").save()
    metrics["inference_latency_ms"] = (time.perf_counter() - started) * 1000.0 / max(n_val, 1)
    row = evaluation.all_metrics(predictions, ["model"], n_groups=1).first()
    metrics.update({m: row[m] for m in METRICS})

    method, size = reduction or ("none", 0)
    shares = [float(v) for s in model.stages if hasattr(s, "explainedVariance") for v in s.explainedVariance.toArray()]
    record = {
        "model_name": name,
        "model_family": model_spec(name).family,
        "stage": stage,
        "search_type": model_spec(name).search if tune else "none",
        "dimred_method": method,
        "dimred_n_components": str(size),
        "dimred_explained_variance": str(sum(shares)) if shares else "na",
        "n_train": n_train,
        "n_val": n_val,
        "seed": seed,
        "cv_folds": k,
        "params": {k_: str(v) for k_, v in chosen.items()},
        "metrics": {m: float(v) for m, v in metrics.items() if v is not None},
    }
    return model, record


def run_frame(
    spark: SparkSession,
    record: dict,
    *,
    run_id: str,
    experiment: str,
    start_time: int,
    data_digest: str,
    code_digest: str,
    preproc: str = "numstd_catoh",
    project_part: str = "part_3",
    baseline_run_id: str = "",
) -> DataFrame:
    """One row (run_id, experiment, run_name, start_time, params, tags, metrics) of a training run."""
    method, size = record["dimred_method"], record["dimred_n_components"]
    reduced = "none" if method == "none" else f"{method}_k{size}"
    lit = {k: F.lit(str(v)) for k, v in record.items() if not isinstance(v, dict)}
    name = run_name(
        lit["stage"], lit["model_name"], F.lit(preproc), F.lit(reduced), lit["search_type"], lit["seed"],
        F.lit(data_digest[:8]), F.lit(code_digest[:7]),
    )
    maps = runstore.run_record(
        name,
        tags={
            "model_family": lit["model_family"],
            "git_commit": F.lit(code_digest),
            "dataset_fingerprint": F.lit(data_digest),
            "compute_profile_s": F.lit(str(record["metrics"]["training_time_s"])),
            "project_part": F.lit(project_part),
            "framework": F.lit(f"spark {spark.version}"),
            "python_version": F.lit(platform.python_version()),
            "os_platform": F.lit(platform.platform()),
            "dimred_method": F.lit(method),
            "dimred_n_components": F.lit(size),
            "dimred_explained_variance": lit["dimred_explained_variance"],
            "baseline_run_id": F.lit(baseline_run_id),
        },
        metrics={m: F.lit(v) for m, v in record["metrics"].items()},
        params={
            "scoring_primary": F.lit("roc_auc"),
            "split_strategy": F.lit("stratified_70_15_15"),
            **{p: lit[p] for p in runstore.PARAMS if p in lit},
        },
        clf_params={k: F.lit(v) for k, v in record["params"].items()},
    )
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(experiment).alias("experiment"),
        name.alias("run_name"),
        F.lit(start_time).cast("long").alias("start_time"),
        *maps,
    )


def log_run(run: DataFrame, path: str) -> None:
    """Append a run to the store; a run without all required parameters is refused."""
    missing = contracts.missing_param_keys(run, runstore.PARAMS).limit(1).collect()
    if missing:
        raise ValueError(f"run {missing[0]['run_id']} lacks {missing[0]['missing']}")
    runstore.append_runs(run, path)


def logged_settings(runs: DataFrame, run_id: str) -> dict:
    """What a run logged, read back from its texts: model, seed, reduction and typed classifier settings."""
    params = runstore.explode_map(runs.where(F.col("run_id") == run_id), "params")
    rows = params.select("key", "value", typed_param(F.col("value")).alias("p")).select("key", "value", "p.*").collect()
    if not rows:
        raise ValueError(f"no run {run_id!r} in the store")
    text = {r["key"]: r["value"] for r in rows}
    typed = {
        r["key"].removeprefix("clf__"): {"bool": r["as_bool"], "int": r["as_long"], "float": r["as_double"], "string": r["as_string"]}.get(r["kind"])
        for r in rows
        if r["key"].startswith("clf__")
    }
    method, size = text.get("dimred_method", "none"), int(text.get("dimred_n_components", "0"))
    return {
        "name": text["model_name"],
        "seed": int(text.get("seed", "42")),
        "reduction": (method, size) if method != "none" and size else None,
        "params": typed,
    }


def train_sweep(
    names: list[str],
    reductions: list[tuple[str, int] | None],
    train: DataFrame,
    val: DataFrame,
    roles: Roles,
    *,
    k: int = 5,
    seed: int = 42,
    **settings,
) -> list[dict]:
    """A run record per model and reduction; all runs share their folds, those of a reduction their vectors."""
    folded = folded_rows(train, roles, k=k, seed=seed)
    out = []
    for reduction in reductions:
        stage = "baseline" if reduction is None else "dimred"
        shared = {"k": k, "seed": seed, "prepared": PreparedTraining(folded, roles, k, reduction)}
        for name in names:
            out.append(train_and_evaluate(name, train, val, roles, stage=stage, reduction=reduction, **shared, **settings)[1])
    return out


def final_evaluation(
    name: str,
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    roles: Roles,
    *,
    params: dict | None = None,
    reduction: tuple[str, int] | None = None,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Refit on train and validation with given settings; one test evaluation."""
    both = train.unionByName(val)
    pipeline = build_pipeline(name, roles, n_train=both.count(), seed=seed, params=params, reduction=reduction)
    model = pipeline.fit(both)
    predictions = scored(model.transform(test), roles, F.lit(name).alias("model"))
    return model, evaluation.all_metrics(predictions, ["model"], n_groups=1)


def evaluate_winner(
    runs: DataFrame, run_id: str, train: DataFrame, val: DataFrame, test: DataFrame, roles: Roles
) -> tuple[PipelineModel, DataFrame]:
    """The final model of a stored run: settings from its log, refit, one test evaluation."""
    logged = logged_settings(runs, run_id)
    return final_evaluation(logged.pop("name"), train, val, test, roles, **logged)


# --- audit --------------------------------------------------------------------------


def audit_run(
    runs: DataFrame,
    train: DataFrame,
    val: DataFrame,
    roles: Roles,
    *,
    run_id: str,
    tolerance: float = 1e-4,
) -> DataFrame:
    """(run_id, metric, logged, recomputed, diff, matches): refit a run from its logged parameters and
    compare its logged metrics."""
    logged = logged_settings(runs, run_id)
    pipeline = build_pipeline(
        logged["name"], roles, n_train=train.count(), seed=logged["seed"], params=logged["params"],
        reduction=logged["reduction"],
    )
    predictions = scored(pipeline.fit(train).transform(val), roles, F.lit(run_id).alias("run_id"))
    recomputed = evaluation.to_metric_rows(
        evaluation.all_metrics(predictions, ["run_id"], n_groups=1), ["run_id"], METRICS
    )
    stored = runstore.explode_map(runs.where(F.col("run_id") == run_id), "metrics")
    metrics = stored.select("run_id", F.col("key").alias("metric"), "value").where(F.col("metric").isin(METRICS))
    return selection.metric_mismatches(metrics, recomputed, tolerance)
