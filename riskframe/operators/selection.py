"""Choosing among experiment runs: cascade, ranked reports, audits of logged metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.expressions import contains, family_rank, fixed_point, metric_or, reduction_label
from riskframe.operators.prefix import ranked

TIE_DELTA = 1e-4

# Criteria of the cascade in order: column, direction, value of a missing metric.
CASCADE = [
    ("roc_auc", "max", 0.0),
    ("cv_roc_auc_std", "min", float("inf")),
    ("inference_latency_ms", "min", float("inf")),
    ("training_time_s", "min", float("inf")),
]


def eligible_runs(runs: DataFrame) -> DataFrame:
    """Runs with a training time and an AUC."""
    return runs.where(F.col("training_time_s").isNotNull() & F.col("roc_auc").isNotNull())


def _within(value: Column, best: Column) -> Column:
    # Two infinities tie; their difference would be NaN.
    return (value == best) | (F.abs(value - best) <= TIE_DELTA)


def cascade_winner(runs: DataFrame, group: list[str]) -> DataFrame:
    """(group, run_id, decision_step, reason, n_candidates): winner of the tolerance cascade.

    ``reason`` names the criterion of the deciding step and the winner's value.

    Every step keeps the runs within ``TIE_DELTA`` of the best survivor; the first step
    with a single survivor decides, otherwise the simplest family and then the lowest
    run id.  Between steps only one row per group is carried (the best values so far),
    so a group with any number of runs is never gathered in one task.
    """
    values = {c: metric_or(F.col(c), default) for c, _, default in CASCADE}
    rows = runs.select(
        *group,
        "run_id",
        *[v.alias(c) for c, v in values.items()],
        family_rank(F.col("model_family")).alias("_rank"),
    )
    survives: Column = F.lit(True)
    state: DataFrame | None = None
    carried: list[str] = []
    for i, (name, direction, _) in enumerate(CASCADE, 1):
        pick = F.max if direction == "max" else F.min
        joined = rows if state is None else rows.join(state, group).where(survives)
        state = joined.groupBy(*group).agg(
            *[F.max(c).alias(c) for c in carried],
            F.count(F.lit(1)).alias(f"_n{i - 1}"),
            pick(name).alias(f"_best{i}"),
        )
        carried += [f"_n{i - 1}", f"_best{i}"]
        survives = survives & _within(F.col(name), F.col(f"_best{i}"))
    last = len(CASCADE)
    final = rows.join(state, group).where(survives)
    final = final.groupBy(*group).agg(
        *[F.max(c).alias(c) for c in carried],
        F.count(F.lit(1)).alias(f"_n{last}"),
        F.min(F.struct("_rank", "run_id", *values)).alias("_first"),
    )
    step = F.lit(last + 1)
    for i in range(last, 0, -1):
        step = F.when(F.col(f"_n{i}") == 1, F.lit(i)).otherwise(step)
    reason = F.concat(F.lit("model_family rank "), F.col("_first._rank").cast("string"))
    for i, (name, _, _) in reversed(list(enumerate(CASCADE, 1))):
        text = F.concat(F.lit(f"{name} "), fixed_point(F.col(f"_first.{name}"), 6))
        reason = F.when(step == i, text).otherwise(reason)
    return final.select(
        *group,
        F.col("_first.run_id").alias("run_id"),
        step.alias("decision_step"),
        reason.alias("reason"),
        F.col("_n0").alias("n_candidates"),
    )


def selection_order() -> list[Column]:
    """Six keys: AUC down, then CV spread, latency, training time, complexity, run id up."""
    return [
        F.desc_nulls_last("roc_auc"),
        metric_or(F.col("cv_roc_auc_std")).asc(),
        metric_or(F.col("inference_latency_ms")).asc(),
        metric_or(F.col("training_time_s")).asc(),
        family_rank(F.col("model_family")).asc(),
        F.col("run_id").asc(),
    ]


def top_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The first n runs of the whole table in selection order."""
    return runs.orderBy(*selection_order()).limit(n)


def ordered_runs(runs: DataFrame) -> DataFrame:
    """All runs in selection order."""
    return runs.orderBy(*selection_order())


def ranked_report(runs: DataFrame, group: list[str], max_rows: int | None = None) -> DataFrame:
    """(rank, ...) of every run in its group, or of the first ``max_rows`` where a caller wants a top list.

    For a top list the rank filter lets Spark cut each task's rows before the shuffle; the whole order is
    ranked by ranges, so a group with a large share of the runs does not go to one task either.
    """
    if max_rows is None:
        return ranked(runs, group, selection_order())
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*selection_order()))
    return runs.withColumn("rank", rank).where(F.col("rank") <= max_rows)


def report_columns(ranked: DataFrame, group: list[str]) -> DataFrame:
    """Columns of the consolidated report: short id, reduction label, four metrics."""
    return ranked.select(
        *group,
        "rank",
        F.substring("run_id", 1, 8).alias("run_id_short"),
        "stage",
        "model_family",
        reduction_label(F.col("dimred_method"), F.col("dimred_n_components"), none="-").alias("dimred"),
        F.round("roc_auc", 6).alias("roc_auc"),
        F.round("cv_roc_auc_std", 6).alias("cv_roc_auc_std"),
        F.round("inference_latency_ms", 3).alias("latency_ms"),
        F.round("training_time_s", 3).alias("train_s"),
    )


def enrich_runs(runs: DataFrame, extra: DataFrame) -> DataFrame:
    """Left join by run name with defaults where a run has no extra row: every run once.

    ``extra``: (run_name, start_time, run_id, model_name, dimred_method, dimred_n_components,
    explained_variance); of rows that share a name the one that started last counts, then the largest id.
    """
    defaults = {
        "model_name": "",
        "dimred_method": "none",
        "dimred_n_components": "0",
        "explained_variance": "na",
    }
    latest = extra.groupBy("run_name").agg(F.max("start_time").alias("_last"))
    newest = extra.join(latest, "run_name").where(F.col("start_time").eqNullSafe(F.col("_last")))
    # What is left per name are ties, a few rows.
    one = newest.groupBy("run_name").agg(F.max(F.struct("run_id", *defaults)).alias("_row"))
    renamed = one.select("run_name", *[F.col(f"_row.{c}").alias(f"_{c}") for c in defaults])
    kept = [c for c in runs.columns if c not in defaults]
    filled = [F.coalesce(F.col(f"_{c}"), F.lit(d)).alias(c) for c, d in defaults.items()]
    return runs.select(*kept).join(renamed, "run_name", "left").select(*kept, *filled)


def latest_baseline(runs: DataFrame) -> DataFrame:
    """(model_name, run_id) of the most recent baseline run per model."""
    base = runs.where(F.col("stage") == "baseline").select("model_name", "start_time", "run_id")
    # A time is a number, so its maximum is a hash aggregate; only ties are left to compare by id.
    last = base.groupBy("model_name").agg(F.max("start_time").alias("_last"))
    newest = base.join(last, "model_name").where(F.col("start_time") == F.col("_last"))
    return newest.groupBy("model_name").agg(F.max("run_id").alias("run_id"))


def attach_baseline(runs: DataFrame) -> DataFrame:
    """Every run with the id of its model's latest baseline, "" when there is none."""
    base = latest_baseline(runs).select("model_name", F.col("run_id").alias("_base"))
    return runs.join(base, "model_name", "left").withColumn(
        "baseline_run_id", F.coalesce("_base", F.lit(""))
    ).drop("_base")


def reduction_pivot(runs: DataFrame, configs: list[str], models: list[str] | None = None) -> DataFrame:
    """(model, none, <config>...): AUC text per reduction, "n/a" when no run has it.

    Among several runs of one cell the one that comes first in AUC order counts.
    """

    def when_config(config: str) -> Column:
        hit = (F.col("stage") == "dimred") & contains(F.col("run_name"), f"__{config}__")
        best = F.max(F.when(hit, F.col("roc_auc")))
        return F.coalesce(fixed_point(best), F.lit("n/a")).alias(config)

    plain = F.max(F.when(F.col("stage") == "baseline", F.col("roc_auc")))
    out = runs if models is None else runs.where(F.col("model_name").isin(models))
    return out.groupBy(F.col("model_name").alias("model")).agg(
        F.coalesce(fixed_point(plain), F.lit("n/a")).alias("none"),
        *[when_config(c) for c in configs],
    )


def winner_params(winners: DataFrame, params: DataFrame) -> DataFrame:
    """(run_id, key, value) of the selected runs."""
    return params.join(winners.select("run_id").distinct(), "run_id", "left_semi")


def mean_score_by_param(results: DataFrame, param: str, score: str = "score") -> DataFrame:
    """(value, mean_score, n): marginal mean per parameter value, null shown as ``None``."""
    value = F.coalesce(F.col(param).cast("string"), F.lit("None")).alias("value")
    return results.groupBy(value).agg(F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("n"))


def top_combinations(results: DataFrame, n: int = 10, score: str = "score", tie: str = "combo") -> DataFrame:
    return results.orderBy(F.desc_nulls_last(score), tie).limit(n)


def metric_mismatches(logged: DataFrame, recomputed: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """(run_id, metric, logged, recomputed, diff, matches); metrics never logged are skipped."""
    both = logged.select("run_id", "metric", F.col("value").alias("logged")).join(
        recomputed.select("run_id", "metric", F.col("value").alias("recomputed")), ["run_id", "metric"]
    )
    both = both.withColumn("diff", F.abs(F.col("logged") - F.col("recomputed")))
    return both.withColumn("matches", F.col("diff") <= F.lit(float(tolerance)))


def require_matching(audit: DataFrame) -> None:
    """Fail when a recomputed metric differs from its log."""
    bad = audit.where(~F.col("matches")).limit(5).collect()
    if bad:
        raise ValueError(
            "logged metrics differ: " + "; ".join(f"{r['run_id']} {r['metric']} by {r['diff']:.2e}" for r in bad)
        )


def weighted_selection(runs: DataFrame, group: list[str], weights: dict[str, float], lower_is_better: list[str]) -> DataFrame:
    """(group, run_id, selection_score): min-max scaled metrics, weighted.

    The extremes are one aggregate row per group joined back, not a window over all runs.
    """
    span = runs.groupBy(*group).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in weights], *[F.max(c).alias(f"_hi_{c}") for c in weights]
    )
    joined = runs.join(span, group)
    score = F.lit(0.0)
    for c, w in weights.items():
        scaled = F.coalesce(
            F.try_divide(F.col(c) - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}")), F.lit(0.0)
        )
        score = score + F.lit(float(w)) * ((1.0 - scaled) if c in lower_is_better else scaled)
    return joined.select(*group, "run_id", score.alias("selection_score"))
