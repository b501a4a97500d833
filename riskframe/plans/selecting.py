"""Experiment-run reports, selection, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.significance import is_degraded, is_significant
from riskframe.operators import importance, selection
from riskframe.operators.splits import sample_rows
from riskframe.plans.bindings import CONFIGS, RUN_CTES, run_heads, run_metrics, table, wide_runs, with_
from riskframe.plans.io_contracts import run_rows
from riskframe.plans.registry import query
from riskframe.session import materialise
from riskframe.sources import artifacts, runstore

RANK_SQL = "CASE coalesce(model_family, 'ensemble') WHEN 'linear' THEN 0 WHEN 'tree' THEN 1 WHEN 'ensemble' THEN 2 ELSE 99 END"
ORDER_SQL = f"""roc_auc DESC NULLS LAST, coalesce(cv_roc_auc_std, 'infinity'::DOUBLE),
   coalesce(inference_latency_ms, 'infinity'::DOUBLE), coalesce(training_time_s, 'infinity'::DOUBLE), {RANK_SQL}, run_id"""

# The cascade as five filters in a row, each against the best survivor of its experiment.
CASCADE_SQL = f"""e AS (SELECT *, {RANK_SQL} AS rnk FROM runs WHERE training_time_s IS NOT NULL AND roc_auc IS NOT NULL),
 s1 AS (SELECT *, count(*) OVER (PARTITION BY experiment) AS n1 FROM (SELECT *, max(roc_auc) OVER (PARTITION BY experiment)
        AS b, count(*) OVER (PARTITION BY experiment) AS n0 FROM e) WHERE abs(roc_auc - b) <= 1e-4::DOUBLE),
 s2 AS (SELECT *, count(*) OVER (PARTITION BY experiment) AS n2 FROM (SELECT *, min(cv_roc_auc_std)
        OVER (PARTITION BY experiment) AS b2 FROM s1) WHERE abs(cv_roc_auc_std - b2) <= 1e-4::DOUBLE),
 s3 AS (SELECT *, count(*) OVER (PARTITION BY experiment) AS n3 FROM (SELECT *, min(inference_latency_ms)
        OVER (PARTITION BY experiment) AS b3 FROM s2) WHERE abs(inference_latency_ms - b3) <= 1e-4::DOUBLE),
 s4 AS (SELECT *, count(*) OVER (PARTITION BY experiment) AS n4 FROM (SELECT *, min(training_time_s)
        OVER (PARTITION BY experiment) AS b4 FROM s3) WHERE abs(training_time_s - b4) <= 1e-4::DOUBLE),
 winners AS (SELECT experiment, arg_min(run_id, (rnk, run_id)) AS run_id, CAST(CASE WHEN any_value(n1) = 1 THEN 1
        WHEN any_value(n2) = 1 THEN 2 WHEN any_value(n3) = 1 THEN 3 WHEN any_value(n4) = 1 THEN 4 ELSE 5 END AS INTEGER)
        AS decision_step, any_value(n0) AS n_candidates FROM s4 GROUP BY experiment),
 reasoned AS (SELECT w.*, CASE decision_step WHEN 1 THEN 'roc_auc ' || printf('%.6f', e.roc_auc)
        WHEN 2 THEN 'cv_roc_auc_std ' || printf('%.6f', e.cv_roc_auc_std)
        WHEN 3 THEN 'inference_latency_ms ' || printf('%.6f', e.inference_latency_ms)
        WHEN 4 THEN 'training_time_s ' || printf('%.6f', e.training_time_s) ELSE 'model_family rank ' || rnk END AS reason
        FROM winners w JOIN e USING (experiment, run_id))"""


def winners(spark, sf):
    runs = materialise(selection.eligible_runs(wide_runs(spark, sf)), "runs")
    return selection.cascade_winner(runs, ["experiment"])


@query("se01_cascade_winner", with_(*RUN_CTES) + f", {CASCADE_SQL} SELECT * FROM reasoned")
def se01(spark, sf):
    return winners(spark, sf)


# Metrics cut to few distinct values, so that the late steps decide.
TIED_SQL = """tied AS (SELECT run_id, experiment, model_family, floor(roc_auc * 20 + 0.5) / 20 AS roc_auc,
   floor(cv_roc_auc_std * 100 + 0.5) / 100 AS cv_roc_auc_std, floor(inference_latency_ms * 20 + 0.5) / 20 AS inference_latency_ms,
   floor(training_time_s / 100) AS training_time_s FROM runs)"""


@query(
    "se01_cascade_ties",
    with_(*RUN_CTES) + f", {TIED_SQL}, {CASCADE_SQL.replace('FROM runs', 'FROM tied')} SELECT * FROM reasoned",
)
def se01b(spark, sf):
    tied = wide_runs(spark, sf).select(
        "run_id", "experiment", "model_family",
        (F.floor(F.col("roc_auc") * 20 + 0.5) / 20).alias("roc_auc"),
        (F.floor(F.col("cv_roc_auc_std") * 100 + 0.5) / 100).alias("cv_roc_auc_std"),
        (F.floor(F.col("inference_latency_ms") * 20 + 0.5) / 20).alias("inference_latency_ms"),
        F.floor(F.col("training_time_s") / 100).cast("double").alias("training_time_s"),
    )
    runs = materialise(selection.eligible_runs(tied), "runs")
    return selection.cascade_winner(runs, ["experiment"])


@query(
    "se02_eligible_runs",
    with_(*RUN_CTES) + "SELECT run_id, roc_auc, training_time_s FROM runs WHERE training_time_s IS NOT NULL AND roc_auc IS NOT NULL",
)
def se02(spark, sf):
    return selection.eligible_runs(wide_runs(spark, sf)).select("run_id", "roc_auc", "training_time_s")


@query(
    "se03_consolidated_report",
    with_(*RUN_CTES)
    + f"""SELECT experiment, CAST(row_number() OVER (PARTITION BY experiment ORDER BY {ORDER_SQL}) AS INTEGER) AS rank,
         substr(run_id, 1, 8) AS run_id_short, stage, model_family, CASE WHEN dimred_method = 'none' THEN '-' ELSE
         dimred_method || '_k' || dimred_n_components END AS dimred, roc_auc, cv_roc_auc_std,
         round(inference_latency_ms, 3) AS latency_ms, training_time_s AS train_s FROM runs""",
)
def se03(spark, sf):
    ranked = selection.ranked_report(wide_runs(spark, sf), ["experiment"])
    return selection.report_columns(ranked, ["experiment"])


@query(
    "se04_stage_comparison",
    with_(*RUN_CTES)
    + """, b AS (SELECT run_name, model_family, roc_auc, row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, run_name) AS rn
                 FROM runs WHERE stage = 'baseline')
         SELECT 1 AS position, '| run_name | model_family | roc_auc |' AS line UNION ALL SELECT 2, '|---|---|---|'
         UNION ALL SELECT CAST(rn + 2 AS INTEGER), '| ' || run_name || ' | ' || model_family || ' | '
         || printf('%.4f', roc_auc) || ' |' FROM b""",
)
def se04(spark, sf):
    runs = wide_runs(spark, sf).where(F.col("stage") == "baseline").select("run_name", "model_family", "roc_auc")
    return artifacts.markdown_table(runs, [F.desc_nulls_last("roc_auc"), F.asc("run_name")])


@query(
    "jn03_enrich_runs",
    with_(*RUN_CTES)
    + """SELECT run_id, CASE WHEN stage = 'dimred' THEN model_name ELSE '' END AS model_name, dimred_method,
         dimred_n_components, CASE WHEN dimred_method = 'pca' THEN '0.9' ELSE 'na' END AS explained_variance FROM runs""",
)
def jn03(spark, sf):
    heads = run_heads(spark, sf)
    extra = heads.where(F.col("stage") == "dimred").select(
        "run_name", "start_time", "run_id", "model_name", "dimred_method", "dimred_n_components",
        F.when(F.col("dimred_method") == "pca", "0.9").alias("explained_variance"),
    )
    return selection.enrich_runs(heads.select("run_id", "run_name"), extra).drop("run_name")


@query(
    "jn03_repeated_run_names",
    with_("run_heads")
    + """, named AS (SELECT run_id, start_time, model_name, 'name' || suppkey % 7 AS run_name FROM run_heads),
         last AS (SELECT run_name, arg_max(model_name, (start_time, run_id)) AS model_name FROM named GROUP BY run_name)
         SELECT run_id, last.model_name, 'none' AS dimred_method FROM named JOIN last USING (run_name)""",
)
def jn03b(spark, sf):
    """Seven names for all runs: every run stays one row and gets the values of the latest run of its name."""
    name = F.concat(F.lit("name"), (F.col("suppkey") % 7).cast("string"))
    named = run_heads(spark, sf).withColumn("run_name", name)
    extra = named.select(
        "run_name", "start_time", "run_id", "model_name", F.lit("none").alias("dimred_method"),
        F.lit("0").alias("dimred_n_components"), F.lit("na").alias("explained_variance"),
    )
    return selection.enrich_runs(named.select("run_id", "run_name"), extra).select("run_id", "model_name", "dimred_method")


@query(
    "jn04_latest_baseline",
    with_("run_heads")
    + """, h AS (SELECT run_id, stage, start_time, CASE WHEN stage <> 'baseline' AND suppkey % 7 = 0 THEN 'svm' ELSE model_name END
                 AS model_name FROM run_heads),
         b AS (SELECT model_name, arg_max(run_id, (start_time, run_id)) AS base FROM h WHERE stage = 'baseline' GROUP BY model_name)
         SELECT run_id, h.model_name, coalesce(base, '') AS baseline_run_id FROM h LEFT JOIN b USING (model_name)""",
)
def jn04(spark, sf):
    """One model has no baseline run."""
    other = (F.col("stage") != "baseline") & (F.col("suppkey") % 7 == 0)
    heads = run_heads(spark, sf).withColumn("model_name", F.when(other, "svm").otherwise(F.col("model_name")))
    return selection.attach_baseline(heads).select("run_id", "model_name", "baseline_run_id")


AUDIT_SQL = """audit AS (SELECT run_id, 'roc_auc' AS metric, roc_auc AS logged, roc_auc + (suppkey % 7) * 3e-5::DOUBLE AS recomputed
   FROM runs UNION ALL SELECT run_id, 'training_time_s', training_time_s, training_time_s FROM runs
   WHERE training_time_s IS NOT NULL)"""


def audit(spark, sf):
    runs = wide_runs(spark, sf)

    def rows(auc):
        both = F.array(
            F.struct(F.lit("roc_auc").alias("metric"), auc.alias("value")),
            F.struct(F.lit("training_time_s").alias("metric"), F.col("training_time_s").alias("value")),
        )
        return runs.select("run_id", F.inline(both)).where(F.col("value").isNotNull())

    return selection.metric_mismatches(rows(F.col("roc_auc")), rows(F.col("roc_auc") + (F.col("suppkey") % 7) * 3e-5))


@query(
    "jn06_metric_audit",
    with_(*RUN_CTES)
    + f""", {AUDIT_SQL} SELECT run_id, metric, logged, round(abs(logged - recomputed), 7) AS diff,
         abs(logged - recomputed) <= 1e-4::DOUBLE AS matches FROM audit""",
)
def jn06(spark, sf):
    return audit(spark, sf).select("run_id", "metric", "logged", F.round("diff", 7).alias("diff"), "matches")


@query(
    "jn09_winner_params",
    with_(*RUN_CTES)
    + f""", {CASCADE_SQL} SELECT run_id, 'clf__max_depth' AS key, CAST(suppkey % 4 AS VARCHAR) AS value FROM runs JOIN winners
         USING (run_id) UNION ALL SELECT run_id, 'model_name', model_name FROM runs JOIN winners USING (run_id)
         UNION ALL SELECT run_id, 'seed', '42' FROM winners UNION ALL SELECT run_id, 'cv_folds', '5' FROM winners""",
)
def jn09(spark, sf):
    params = runstore.explode_map(run_rows(spark, sf), "params")
    return selection.winner_params(winners(spark, sf), params)


RESULT_SQL = """results AS (SELECT md5(CAST(s_suppkey AS VARCHAR)) AS combo, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey % 4 END
   AS max_depth, s_acctbal / 10000 AS score FROM supplier)"""


def search_results(spark, sf):
    depth = F.col("s_suppkey") % 4
    return table(spark, sf, "supplier").select(
        F.md5(F.col("s_suppkey").cast("string")).alias("combo"),
        F.when(depth > 0, depth).alias("max_depth"),
        (F.col("s_acctbal") / 10000).alias("score"),
    )


@query(
    "ag36_mean_score_by_param",
    f"""WITH {RESULT_SQL} SELECT coalesce(CAST(max_depth AS VARCHAR), 'None') AS value, round(avg(score), 6) AS mean_score,
        count(*) AS n FROM results GROUP BY 1""",
)
def ag36(spark, sf):
    out = selection.mean_score_by_param(search_results(spark, sf), "max_depth")
    return out.withColumn("mean_score", F.round("mean_score", 6))


@query(
    "ag37_reduction_pivot",
    with_(*RUN_CTES)
    + "SELECT model_name AS model, coalesce(printf('%.4f', max(roc_auc) FILTER (stage = 'baseline')), 'n/a') AS none, "
    + ", ".join(
        f"coalesce(printf('%.4f', max(roc_auc) FILTER (stage = 'dimred' AND run_name LIKE '%\\_\\_{c}\\_\\_%' ESCAPE '\\')), 'n/a') AS {c}"
        for c in [*CONFIGS, "pca_k99"]
    )
    + " FROM runs GROUP BY model_name",
)
def ag37(spark, sf):
    return selection.reduction_pivot(wide_runs(spark, sf), [*CONFIGS, "pca_k99"])


# Weights per part type and size class stand in for a model's weight table.
WEIGHT_SQL = """weights AS (SELECT lower(p_type) || '_' || (p_size % 9) AS feature,
   round(CAST(sum(CAST(p_retailprice * CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE -1 END AS DECIMAL(18,2))) AS DOUBLE) / 1000, 4)
   AS weight FROM part GROUP BY 1)"""


def weights(spark, sf):
    sign = F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(-1)
    feature = F.concat(F.lower("p_type"), F.lit("_"), (F.col("p_size") % 9).cast("string"))
    total = F.sum((F.col("p_retailprice") * sign).cast("decimal(18,2)")).cast("double")
    return table(spark, sf, "part").groupBy(feature.alias("feature")).agg(F.round(total / 1000, 4).alias("weight"))


@query(
    "ag39_weights_by_prefix",
    f"""WITH {WEIGHT_SQL} SELECT prefix, CAST(rank AS INTEGER) AS rank, feature, weight FROM (SELECT
        regexp_extract(feature, '^([a-z]+)', 1) AS prefix, feature, weight, row_number() OVER (PARTITION BY
        regexp_extract(feature, '^([a-z]+)', 1) ORDER BY abs(weight) DESC, feature) AS rank FROM weights)
        WHERE prefix <> 'economy' OR rank <= 3""",
)
def ag39(spark, sf):
    return importance.weights_by_prefix(weights(spark, sf), {"economy": 3})


@query(
    "tk04_top_features",
    f"""WITH {WEIGHT_SQL} SELECT feature, weight, CASE WHEN weight > 0 THEN 'raises' WHEN weight < 0 THEN 'lowers' ELSE 'none'
        END AS direction FROM weights ORDER BY abs(weight) DESC, feature LIMIT 15""",
)
def tk04(spark, sf):
    return importance.top_features(importance.risk_direction(weights(spark, sf)), 15)


@query(
    "tk04_shared_top_features",
    f"""WITH {WEIGHT_SQL}, o AS (SELECT feature, abs(weight) / 2 + length(feature) AS weight FROM weights),
        a AS (SELECT feature, weight FROM weights ORDER BY abs(weight) DESC, feature LIMIT 10),
        b AS (SELECT feature, weight FROM o ORDER BY abs(weight) DESC, feature LIMIT 10)
        SELECT feature, a.weight AS first_weight, b.weight AS second_weight FROM a JOIN b USING (feature)""",
)
def tk04b(spark, sf):
    first = weights(spark, sf)
    second = first.withColumn("weight", F.abs("weight") / 2 + F.length("feature"))
    return importance.shared_top(first, second, 10)


@query(
    "ex04_importance_consensus",
    f"""WITH {WEIGHT_SQL}, m AS (SELECT 'a' AS model, feature, weight FROM weights UNION ALL
          SELECT 'b', feature, abs(weight) / 2 + length(feature) FROM weights),
        r AS (SELECT feature, rank() OVER (PARTITION BY model ORDER BY abs(weight) DESC, feature) AS rk FROM m)
        SELECT feature, count(*) AS n_models, avg(rk) AS mean_rank FROM r GROUP BY feature""",
)
def ex04(spark, sf):
    first = weights(spark, sf)
    second = first.withColumn("weight", F.abs("weight") / 2 + F.length("feature"))
    both = first.withColumn("model", F.lit("a")).unionByName(second.withColumn("model", F.lit("b")))
    return importance.consensus(both)


@query(
    "tk01_runs_by_auc",
    with_(*RUN_CTES) + "SELECT run_id, roc_auc FROM runs ORDER BY roc_auc DESC NULLS LAST, run_id",
)
def tk01(spark, sf):
    return wide_runs(spark, sf).orderBy(F.desc_nulls_last("roc_auc"), "run_id").select("run_id", "roc_auc")


@query("tk02_six_key_order", with_(*RUN_CTES) + f"SELECT run_id, roc_auc FROM runs ORDER BY {ORDER_SQL}")
def tk02(spark, sf):
    return selection.ordered_runs(wide_runs(spark, sf)).select("run_id", "roc_auc")


@query(
    "tk03_top_combinations",
    f"WITH {RESULT_SQL} SELECT combo, max_depth, score FROM results ORDER BY score DESC, combo LIMIT 10",
)
def tk03(spark, sf):
    return selection.top_combinations(search_results(spark, sf), 10)


@query("tk05_top_candidates", with_(*RUN_CTES) + f"""SELECT run_id FROM runs WHERE training_time_s IS NOT NULL AND
         roc_auc IS NOT NULL ORDER BY {ORDER_SQL} LIMIT 5""")
def tk05(spark, sf):
    return selection.top_runs(selection.eligible_runs(wide_runs(spark, sf)), 5).select("run_id")


@query(
    "wn01_report_rank",
    with_(*RUN_CTES)
    + f"""SELECT run_id, experiment, rank FROM (SELECT run_id, experiment, CAST(row_number() OVER (PARTITION BY experiment
         ORDER BY {ORDER_SQL}) AS INTEGER) AS rank FROM runs)""",
)
def wn01(spark, sf):
    return selection.ranked_report(wide_runs(spark, sf), ["experiment"]).select("run_id", "experiment", "rank")


@query(
    "wn04_tolerant_extremum",
    with_(*RUN_CTES)
    + """SELECT experiment, run_id, roc_auc FROM (SELECT *, max(roc_auc) OVER (PARTITION BY experiment) AS best FROM runs)
         WHERE best - roc_auc <= 0.004""",
)
def wn04(spark, sf):
    runs = wide_runs(spark, sf)
    best = runs.groupBy("experiment").agg(F.max("roc_auc").alias("best"))
    near = runs.join(best, "experiment").where(F.col("best") - F.col("roc_auc") <= 0.004)
    return near.select("experiment", "run_id", "roc_auc")


@query(
    "wn05_latest_metric",
    with_("per_supplier_year", "run_metrics")
    + "SELECT run_id, key, arg_max(value, (ts, step)) AS value FROM run_metrics GROUP BY run_id, key",
)
def wn05(spark, sf):
    return runstore.last_values(run_metrics(spark, sf))


@query(
    "au02_audit_sample",
    with_(*RUN_CTES)
    + f""", {AUDIT_SQL}, pick AS (SELECT run_id FROM runs WHERE training_time_s IS NOT NULL ORDER BY md5('42:' || run_id), run_id
         LIMIT 3) SELECT run_id, metric, abs(logged - recomputed) <= 1e-4::DOUBLE AS matches FROM audit JOIN pick USING (run_id)""",
)
def au02(spark, sf):
    eligible = selection.eligible_runs(wide_runs(spark, sf)).select("run_id")
    picked = sample_rows(eligible, "run_id", 3)
    return audit(spark, sf).join(picked, "run_id", "left_semi").select("run_id", "metric", "matches")


@query(
    "ex03_weighted_selection",
    with_(*RUN_CTES)
    + """, s AS (SELECT experiment, min(roc_auc) AS l1, max(roc_auc) AS h1, min(cv_roc_auc_std) AS l2, max(cv_roc_auc_std) AS h2
                 FROM runs GROUP BY experiment)
         SELECT experiment, run_id, round(0.7::DOUBLE * ((roc_auc - l1) / (h1 - l1))
                + 0.3::DOUBLE * (1 - (cv_roc_auc_std - l2) / (h2 - l2)), 6) AS selection_score FROM runs JOIN s USING (experiment)""",
)
def ex03(spark, sf):
    out = selection.weighted_selection(
        wide_runs(spark, sf), ["experiment"], {"roc_auc": 0.7, "cv_roc_auc_std": 0.3}, ["cv_roc_auc_std"]
    )
    return out.withColumn("selection_score", F.round("selection_score", 6))


@query(
    "pr08_threshold_alerts",
    with_(*RUN_CTES)
    + """SELECT run_id, inference_latency_ms < 0.04::DOUBLE AS significant,
         roc_auc - cv_roc_auc_mean < -0.005::DOUBLE AS degraded FROM runs""",
)
def pr08(spark, sf):
    return wide_runs(spark, sf).select(
        "run_id",
        is_significant(F.col("inference_latency_ms"), 0.04).alias("significant"),
        is_degraded(F.col("roc_auc") - F.col("cv_roc_auc_mean"), 0.005).alias("degraded"),
    )
