"""Splits, joins, set operations and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import evaluation as E
from riskframe.operators import intervals, splits
from riskframe.operators.prefix import ranked
from riskframe.plans.bindings import MODELS, accounts, scores, table, with_
from riskframe.plans.profiling import SPLIT_SQL
from riskframe.plans.registry import query
from riskframe.session import fresh_path
from riskframe.sources import tables

SCORES = ("accounts", "scores")
CELLS = (*SCORES, "cells")
MACRO = (*CELLS, "classes", "macro")
AREAS = (*SCORES, "areas")
N = len(MODELS)


def split_table(spark, sf):
    base = accounts(spark, sf)
    return splits.fit_split(base, "row_id", "target").assign(base).select("row_id", "split")


# --- splits -----------------------------------------------------------------------------


@query("ml01_stratified_split", with_("accounts") + f", {SPLIT_SQL} SELECT row_id, split FROM split")
def ml01(spark, sf):
    return split_table(spark, sf)


@query(
    "ml02_verify_splits",
    with_("accounts")
    + f""", {SPLIT_SQL}, r(name, ratio) AS (VALUES ('train', 0.70::DOUBLE), ('val', 0.15::DOUBLE), ('test', 0.15::DOUBLE)),
         s AS (SELECT name, ratio, (SELECT count(*) FROM split WHERE split = name) / (SELECT count(*) FROM split)::DOUBLE AS share FROM r)
         SELECT 'disjoint' AS "check", 0.0::DOUBLE AS observed, 0.0::DOUBLE AS expected, true AS passed
         UNION ALL SELECT 'covering', 0.0, 0.0, true
         UNION ALL SELECT 'ratio_' || name, round(share, 6), ratio, abs(share - ratio) <= 0.02 FROM s""",
)
def ml02(spark, sf):
    return splits.verify_splits(
        accounts(spark, sf), split_table(spark, sf), "row_id", {"train": 0.70, "val": 0.15, "test": 0.15}
    )


@query(
    "ml03_two_way_split",
    with_("accounts")
    + """SELECT row_id, CASE WHEN row_number() OVER (PARTITION BY target ORDER BY md5('42:' || row_id))
         <= floor(count(*) OVER (PARTITION BY target) * 0.3::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split
         FROM accounts""",
)
def ml03(spark, sf):
    base = accounts(spark, sf)
    return splits.fit_two_way(base, "row_id", "target", test=0.30).assign(base).select("row_id", "split")


@query(
    "ml04_stratified_folds",
    with_("accounts")
    + """SELECT row_id, CASE WHEN rn <= n // 5 THEN 0 WHEN rn <= 2 * n // 5 THEN 1 WHEN rn <= 3 * n // 5 THEN 2
                WHEN rn <= 4 * n // 5 THEN 3 ELSE 4 END AS fold FROM
         (SELECT row_id, row_number() OVER (PARTITION BY target ORDER BY md5('42:' || row_id)) AS rn,
                 count(*) OVER (PARTITION BY target) AS n FROM accounts)""",
)
def ml04(spark, sf):
    base = accounts(spark, sf)
    folds = splits.fit_folds(base, "row_id", "target", k=5)
    return splits.assign_folds(base, folds).select("row_id", "fold")


@query(
    "io07_split_artifact",
    with_("accounts")
    + f""", {SPLIT_SQL} SELECT 42 AS seed, 'abcdef0123456789' AS digest, 'abcdef01' AS short_digest,
         count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val,
         count(*) FILTER (split = 'test') AS n_test, '2024-01-01T00:00:00+00:00' AS generated_at FROM split""",
)
def io07b(spark, sf):
    path = fresh_path(spark, "splits")
    tables.write_splits(split_table(spark, sf), path)
    return splits.split_metadata(
        tables.read_splits(spark, path, include_test=True), seed=42, digest_hex="abcdef0123456789",
        generated_at="2024-01-01T00:00:00+00:00",
    )


# --- joins and sets ---------------------------------------------------------------------


@query(
    "jn01_attach_splits",
    with_("accounts") + f""", {SPLIT_SQL} SELECT a.row_id, a.amount, s.split FROM accounts a JOIN split s USING (row_id)""",
)
def jn01(spark, sf):
    path = fresh_path(spark, "splits")
    tables.write_splits(split_table(spark, sf), path)
    base = accounts(spark, sf).select("row_id", "amount")
    return splits.attach_splits(base, tables.read_splits(spark, path, include_test=True), "row_id", include_test=True)


@query(
    "jn02_guarded_test_split",
    with_("accounts")
    + f""", {SPLIT_SQL} SELECT a.row_id, a.amount, s.split FROM accounts a JOIN split s USING (row_id)
         WHERE s.split <> 'test'""",
)
def jn02(spark, sf):
    path = fresh_path(spark, "splits")
    tables.write_splits(split_table(spark, sf), path)
    base = accounts(spark, sf).select("row_id", "amount")
    return splits.attach_splits(base, tables.read_splits(spark, path), "row_id")


METRIC_ROWS = """rows AS (SELECT model, 'roc_auc' AS metric, roc_auc AS value FROM areas
   UNION ALL SELECT model, 'f1_macro', f1_macro FROM macro UNION ALL SELECT model, 'accuracy', accuracy FROM macro)"""


def metric_rows(spark, sf):
    wide = E.all_metrics(scores(spark, sf), ["model"], n_groups=N)
    return E.to_metric_rows(wide, ["model"], ["roc_auc", "f1_macro", "accuracy"])


@query(
    "jn08_gain_over_baseline",
    with_(*MACRO, "areas")
    + f""", {METRIC_ROWS} SELECT r.model, r.metric, round(r.value, 6) AS value, round(100.0::DOUBLE * (r.value - b.value), 4)
         AS gain_pp FROM rows r JOIN rows b ON b.metric = r.metric AND b.model = 'month_rule'""",
)
def jn08(spark, sf):
    out = E.gain_over(metric_rows(spark, sf), "month_rule")
    return out.select("model", "metric", F.round("value", 6).alias("value"), F.round("gain_pp", 4).alias("gain_pp"))


@query(
    "st01_union_tables",
    """SELECT c_custkey AS key, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def st01(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
    )
    return customer.unionByName(supplier, allowMissingColumns=True)


def leaky_splits(spark, sf):
    """The split table with some rows repeated in another split and some rows lost."""
    good = split_table(spark, sf)
    again = good.where((F.col("row_id") % 500 == 0) & (F.col("split") == "train")).withColumn("split", F.lit("val"))
    return good.where(F.col("row_id") % 700 != 1).unionByName(again)


@query(
    "st02_split_overlap",
    with_("accounts")
    + f""", {SPLIT_SQL} SELECT row_id, 'train' AS first_split, 'val' AS last_split FROM split
         WHERE row_id % 500 = 0 AND split = 'train' AND row_id % 700 <> 1""",
)
def st02(spark, sf):
    return splits.split_overlap(leaky_splits(spark, sf), "row_id")


@query(
    "st03_split_coverage",
    with_("accounts") + "SELECT row_id, 'missing' AS problem FROM accounts WHERE row_id % 700 = 1",
)
def st03(spark, sf):
    return splits.split_coverage(accounts(spark, sf), leaky_splits(spark, sf), "row_id")


@query(
    "st04_set_difference",
    "SELECT DISTINCT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
)
def st04(spark, sf):
    seen = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")).distinct()
    rich = table(spark, sf, "supplier").where(F.col("s_acctbal") > 5000).select(F.col("s_nationkey").alias("nation"))
    return seen.join(rich, "nation", "left_anti")


# --- metrics of scored tables --------------------------------------------------------------


@query("ag23_confusion", with_(*CELLS) + "SELECT * FROM cells")
def ag23(spark, sf):
    return E.confusion(scores(spark, sf), ["model"])


@query(
    "ag24_binary_metrics",
    with_(*CELLS, "classes")
    + """SELECT model, round((tn + tp) / (tn + fp + fn + tp)::DOUBLE, 6) AS accuracy, round(p, 6) AS precision,
         round(r, 6) AS recall, round(f, 6) AS f1 FROM cells JOIN classes USING (model) WHERE label = 1""",
)
def ag24(spark, sf):
    out = E.binary_metrics(E.confusion(scores(spark, sf), ["model"]))
    return out.select("model", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query(
    "ag25_macro_metrics",
    with_(*MACRO)
    + """SELECT model, round(accuracy, 6) AS accuracy, round(precision_macro, 6) AS precision_macro,
         round(recall_macro, 6) AS recall_macro, round(f1_macro, 6) AS f1_macro FROM macro""",
)
def ag25(spark, sf):
    out = E.macro_metrics(E.confusion(scores(spark, sf), ["model"]), ["model"])
    return out.select(
        "model", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision_macro", "recall_macro", "f1_macro")]
    )


@query(
    "ag26_class_report",
    with_(*CELLS, "classes")
    + """SELECT model, CAST(label AS VARCHAR) AS row, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
                CAST(support AS BIGINT) AS support FROM classes
         UNION ALL SELECT model, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT)
         FROM classes GROUP BY model
         UNION ALL SELECT model, 'weighted avg', round(sum(p * support) / sum(support), 6),
                round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
                CAST(sum(support) AS BIGINT) FROM classes GROUP BY model""",
)
def ag26(spark, sf):
    out = E.class_report(E.confusion(scores(spark, sf), ["model"]), ["model"])
    return out.select("model", "row", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("ag27_roc_auc", with_(*AREAS) + "SELECT model, round(roc_auc, 8) AS roc_auc FROM areas")
def ag27(spark, sf):
    return E.roc_auc(scores(spark, sf), ["model"], n_groups=N).withColumn("roc_auc", F.round("roc_auc", 8))


POINTS = """points AS (SELECT model, score AS threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos,
   sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn
   FROM (SELECT model, score, sum(y) AS pos, sum(1 - y) AS neg FROM scores GROUP BY model, score)
   WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""


@query(
    "ag28_roc_curve",
    with_(*SCORES)
    + f", {POINTS} SELECT model, threshold, round(fp / nn::DOUBLE, 8) AS fpr, round(tp / np::DOUBLE, 8) AS tpr FROM points "
    "UNION ALL SELECT DISTINCT model, 'infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM points",
)
def ag28(spark, sf):
    out = E.roc_curve(scores(spark, sf), ["model"], n_groups=N)
    return out.select("model", "threshold", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


@query(
    "ag28_roc_corners",
    with_(*SCORES)
    + """, steps AS (SELECT model, score, sum(y) AS pos, sum(1 - y) AS neg FROM scores GROUP BY model, score),
         near AS (SELECT model, score AS threshold, pos, neg, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp,
           sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn, lag(pos) OVER d AS above,
           lead(pos) OVER d AS next_pos, lead(neg) OVER d AS next_neg
           FROM steps WINDOW d AS (PARTITION BY model ORDER BY score DESC))
         SELECT model, threshold, round(fp / nn::DOUBLE, 8) AS fpr, round(tp / np::DOUBLE, 8) AS tpr FROM near
         WHERE above IS NULL OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
         UNION ALL SELECT DISTINCT model, 'infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM near""",
)
def ag28c(spark, sf):
    out = E.roc_corners(scores(spark, sf), ["model"], n_groups=N)
    return out.select("model", "threshold", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


@query(
    "ag28_auc_ranking",
    with_(*AREAS)
    + """SELECT model, round(roc_auc, 6) AS roc_auc, CAST(row_number() OVER (ORDER BY roc_auc DESC, model) AS INTEGER) AS rank
         FROM areas""",
)
def ag28b(spark, sf):
    """Models by AUC."""
    areas = E.roc_auc(scores(spark, sf), ["model"], n_groups=N)
    return ranked(areas, [], [F.desc("roc_auc"), F.asc("model")]).withColumn("roc_auc", F.round("roc_auc", 6))


@query(
    "ag29_precision_recall_curve",
    with_(*SCORES)
    + f""", {POINTS} SELECT model, threshold, round(tp / (tp + fp)::DOUBLE, 8) AS precision,
         round(tp / np::DOUBLE, 8) AS recall FROM points
         UNION ALL SELECT DISTINCT model, 'infinity'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM points""",
)
def ag29(spark, sf):
    out = E.precision_recall_curve(scores(spark, sf), ["model"], n_groups=N)
    return out.select("model", "threshold", F.round("precision", 8).alias("precision"), F.round("recall", 8).alias("recall"))


@query(
    "ag29_average_precision",
    with_(*SCORES)
    + f""", {POINTS} SELECT model, round(sum((pos / np::DOUBLE) * (tp / (tp + fp)::DOUBLE)), 6) AS average_precision
         FROM points GROUP BY model""",
)
def ag29b(spark, sf):
    out = E.average_precision(scores(spark, sf), ["model"], n_groups=N)
    return out.withColumn("average_precision", F.round("average_precision", 6))


@query(
    "ag30_comparison_table",
    with_(*MACRO, "areas")
    + """SELECT model, round(roc_auc, 4) AS roc_auc, round(f1_macro, 4) AS f1_macro, round(precision_macro, 4) AS precision_macro,
         round(recall_macro, 4) AS recall_macro, round(accuracy, 4) AS accuracy FROM macro JOIN areas USING (model)""",
)
def ag30(spark, sf):
    wide = E.all_metrics(scores(spark, sf), ["model"], n_groups=N)
    return E.comparison_table(wide, ["model"], ["roc_auc", "f1_macro", "precision_macro", "recall_macro", "accuracy"])


@query(
    "ag31_best_per_metric",
    with_(*MACRO, "areas")
    + f""", {METRIC_ROWS} SELECT metric, arg_max(model, (value, model)) AS best_model, round(max(value), 6) AS best_value
         FROM rows GROUP BY metric""",
)
def ag31(spark, sf):
    return E.best_per_metric(metric_rows(spark, sf)).withColumn("best_value", F.round("best_value", 6))


NAIVE_SQL = f""", {SPLIT_SQL}, rate AS (SELECT avg(target)::DOUBLE AS r, mode(target) AS m FROM split WHERE split = 'train'),
   rest AS (SELECT target, CASE WHEN ('0x' || substr(md5('5:' || row_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < r
            THEN 1 ELSE 0 END AS guess, m FROM split, rate WHERE split <> 'train')"""


def naive(spark, sf):
    base = accounts(spark, sf)
    split = splits.fit_split(base, "row_id", "target").assign(base).withColumn("is_train", F.col("split") == "train")
    return E.naive_baselines(split, "row_id", "target", train="is_train", seed=5)


@query(
    "ag32_naive_baselines",
    with_("accounts")
    + NAIVE_SQL
    + """ SELECT 'majority' AS baseline, round(avg(CASE WHEN target = m THEN 1 ELSE 0 END), 6) AS accuracy, count(*) AS n FROM rest
         UNION ALL SELECT 'random', round(avg(CASE WHEN target = guess THEN 1 ELSE 0 END), 6), count(*) FROM rest""",
)
def ag32(spark, sf):
    return naive(spark, sf).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "ag32_lift_over_baselines",
    with_("accounts")
    + NAIVE_SQL
    + """ SELECT 'majority' AS baseline, round(avg(CASE WHEN target = m THEN 1 ELSE 0 END), 6) AS accuracy,
              round(100.0::DOUBLE * (0.9 - avg(CASE WHEN target = m THEN 1 ELSE 0 END)), 2) AS lift_pct FROM rest
         UNION ALL SELECT 'random', round(avg(CASE WHEN target = guess THEN 1 ELSE 0 END), 6),
              round(100.0::DOUBLE * (0.9 - avg(CASE WHEN target = guess THEN 1 ELSE 0 END)), 2) FROM rest""",
)
def ag32b(spark, sf):
    lifted = E.lift_over_baselines(naive(spark, sf), F.lit(0.9))
    return lifted.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "ag33_overfitting_score",
    with_(*SCORES)
    + f""", {SPLIT_SQL}, acc AS (SELECT model,
           avg(CASE WHEN y = prediction THEN 1 ELSE 0 END) FILTER (split = 'train') AS tr,
           avg(CASE WHEN y = prediction THEN 1 ELSE 0 END) FILTER (split = 'test') AS te
           FROM scores JOIN split ON row_id = key GROUP BY model)
         SELECT model, round(tr - te, 6) AS gap, CAST((tr > 0.95)::INT + (tr - te > 0.05)::INT + 1 + 1 + 0 AS INTEGER)
                AS risk_score, tr < 0.85 AS underfitting, abs(tr - te) < 0.02 AS generalises,
                (tr > 0.95)::INT + (tr - te > 0.05)::INT + 2 >= 3 AS high_risk FROM acc""",
)
def ag33(spark, sf):
    split = split_table(spark, sf).withColumnRenamed("row_id", "key")
    right = (F.col("y") == F.col("prediction")).cast("double")
    metrics = scores(spark, sf).join(split, "key").groupBy("model").agg(
        F.avg(F.when(F.col("split") == "train", right)).alias("train_accuracy"),
        F.avg(F.when(F.col("split") == "test", right)).alias("test_accuracy"),
        F.lit(25).alias("depth"),
        F.lit(2).alias("min_leaf_rows"),
        F.lit(800).alias("n_leaves"),
    )
    return E.overfitting_score(metrics).select(
        "model", F.round("gap", 6).alias("gap"), "risk_score", "underfitting", "generalises", "high_risk"
    )


@query(
    "ag33_low_recall",
    with_(*CELLS)
    + "SELECT model, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall, tp / nullif(tp + fn, 0)::DOUBLE < 0.5 AS low_recall FROM cells",
)
def ag33b(spark, sf):
    out = E.low_recall(E.confusion(scores(spark, sf), ["model"]))
    return out.select("model", F.round("recall", 6).alias("recall"), "low_recall")


@query(
    "ag34_error_economics",
    with_(*CELLS)
    + """SELECT model, fn, fp, round(fp / nullif(fn, 0)::DOUBLE, 6) AS fp_per_fn, tp AS detected,
         round(fn * 30000.0::DOUBLE / (tn + fp + fn + tp)) AS portfolio_missed,
         round(fp * 30000.0::DOUBLE / (tn + fp + fn + tp)) AS portfolio_alarms FROM cells""",
)
def ag34(spark, sf):
    out = E.error_economics(E.confusion(scores(spark, sf), ["model"]), portfolio=30000)
    return out.select(
        "model", "fn", "fp", F.round("fp_per_fn", 6).alias("fp_per_fn"), "detected", "portfolio_missed", "portfolio_alarms"
    )


def fold_rows(spark, sf):
    """Accuracy and AUC of every scorer on each of five folds."""
    base = accounts(spark, sf)
    folds = splits.assign_folds(base, splits.fit_folds(base, "row_id", "target", k=5))
    joined = scores(spark, sf).join(folds.select(F.col("row_id").alias("key"), "fold"), "key")
    wide = E.all_metrics(joined, ["model", "fold"], n_groups=5 * N)
    return E.to_metric_rows(wide, ["model", "fold"], ["roc_auc", "accuracy"])


@query(
    "ag35_fold_summary",
    with_(*SCORES)
    + """, fold AS (SELECT row_id, CASE WHEN rn <= n // 5 THEN 0 WHEN rn <= 2 * n // 5 THEN 1 WHEN rn <= 3 * n // 5 THEN 2
                WHEN rn <= 4 * n // 5 THEN 3 ELSE 4 END AS fold FROM
         (SELECT row_id, row_number() OVER (PARTITION BY target ORDER BY md5('42:' || row_id)) AS rn,
                 count(*) OVER (PARTITION BY target) AS n FROM accounts)),
         j AS (SELECT model, fold, y, score, prediction FROM scores JOIN fold ON key = row_id),
         m AS (SELECT model, fold, 'accuracy' AS metric, avg(CASE WHEN y = prediction THEN 1 ELSE 0 END)::DOUBLE AS value
               FROM j GROUP BY model, fold
               UNION ALL SELECT model, fold, 'roc_auc', (sum(CASE WHEN y = 1 THEN rk END) - max(np) * (max(np) + 1) / 2.0)
                 / (max(np) * max(nn))::DOUBLE FROM (SELECT model, fold, y,
                   rank() OVER (PARTITION BY model, fold ORDER BY score)
                     + (count(*) OVER (PARTITION BY model, fold, score) - 1) / 2.0 AS rk,
                   sum(y) OVER (PARTITION BY model, fold) AS np, sum(1 - y) OVER (PARTITION BY model, fold) AS nn FROM j)
               GROUP BY model, fold)
         SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
                round(avg(value) - 2 * stddev_pop(value), 6) AS low, round(avg(value) + 2 * stddev_pop(value), 6) AS high
         FROM m GROUP BY model, metric""",
)
def ag35(spark, sf):
    out = E.fold_summary(fold_rows(spark, sf), ["model"])
    return out.select("model", "metric", *[F.round(c, 6).alias(c) for c in ("mean", "std", "low", "high")])


@query(
    "jn07_validation_test_delta",
    with_(*SCORES)
    + f""", {SPLIT_SQL}, acc AS (SELECT avg(CASE WHEN y = prediction THEN 1 ELSE 0 END) FILTER (split = 'val') AS v,
           avg(CASE WHEN y = prediction THEN 1 ELSE 0 END) FILTER (split = 'test') AS t, model
           FROM scores JOIN split ON row_id = key GROUP BY model)
         SELECT model AS metric, round(v, 6) AS before, round(t, 6) AS after, round(t - v, 6) AS delta FROM acc""",
)
def jn07(spark, sf):
    split = split_table(spark, sf).withColumnRenamed("row_id", "key")
    right = (F.col("y") == F.col("prediction")).cast("double")
    joined = scores(spark, sf).join(split, "key").withColumn("metric", F.col("model"))

    def side(name):
        return joined.where(F.col("split") == name).groupBy("metric").agg(F.avg(right).alias("value"))

    out = E.metric_delta(side("val"), side("test"))
    return out.select("metric", *[F.round(c, 6).alias(c) for c in ("before", "after", "delta")])


# --- thresholds, paired tests, intervals ------------------------------------------------------

COSTS = f"""{POINTS}, costs AS (SELECT model, threshold, CAST(np - tp AS BIGINT) AS fn, CAST(fp AS BIGINT) AS fp,
   (np - tp) * 5.0::DOUBLE + fp * 1.0::DOUBLE AS cost FROM points
   UNION ALL SELECT DISTINCT model, 'infinity'::DOUBLE, CAST(np AS BIGINT), CAST(0 AS BIGINT), np * 5.0::DOUBLE FROM points)"""


@query("ex01_threshold_costs", with_(*SCORES) + f", {COSTS} SELECT * FROM costs")
def ex01(spark, sf):
    return E.threshold_costs(scores(spark, sf), ["model"], cost_fn=5, cost_fp=1, n_groups=N)


@query(
    "ex01_cheapest_threshold",
    with_(*SCORES)
    + f", {COSTS} SELECT model, arg_min(threshold, (cost, threshold)) AS threshold, min(cost) AS cost FROM costs GROUP BY model",
)
def ex01b(spark, sf):
    costs = E.threshold_costs(scores(spark, sf), ["model"], cost_fn=5, cost_fp=1, n_groups=N)
    return E.cheapest_threshold(costs, ["model"])


@query(
    "ex02_mcnemar",
    with_(*SCORES)
    + """, p AS (SELECT a.y, a.prediction AS p1, b.prediction AS p2 FROM scores a JOIN scores b USING (key)
         WHERE a.model = 'amount_rule' AND b.model = 'month_rule'),
         c AS (SELECT count(*) FILTER (p1 = y AND p2 <> y) AS b, count(*) FILTER (p1 <> y AND p2 = y) AS c FROM p)
         SELECT b AS only_first, c AS only_second,
                round(greatest(abs(b - c) - 1, 0)::DOUBLE ** 2 / nullif(b + c, 0), 6) AS statistic FROM c""",
)
def ex02(spark, sf):
    s = scores(spark, sf)
    first = s.where(F.col("model") == "amount_rule").select("key", "y", F.col("prediction").alias("p1"))
    second = s.where(F.col("model") == "month_rule").select("key", F.col("prediction").alias("p2"))
    out = E.mcnemar(first.join(second, "key"), "y", "p1", "p2")
    return out.select("only_first", "only_second", F.round("statistic", 6).alias("statistic"))


@query("ex02_bootstrap_interval")
def ex02b(spark, sf):
    """Accuracy, from 1,000 samples of all rows."""
    found = intervals.bootstrap_intervals(scores(spark, sf), ["model"])
    return found.where(F.col("metric") == "accuracy").select("model", "low", "median", "high")


@query("ex02_metric_bootstrap")
def ex02c(spark, sf):
    return intervals.bootstrap_intervals(scores(spark, sf), ["model"])


# Placements of every row among the rows of the other class, ties half.
PLACED = """folded AS (SELECT model, score, sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS q FROM scores GROUP BY model, score),
  below AS (SELECT *, coalesce(sum(q) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS qb,
            coalesce(sum(p) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS pa,
            sum(p) OVER (PARTITION BY model) AS np, sum(q) OVER (PARTITION BY model) AS nq FROM folded),
  placed AS (SELECT s.key, s.model, s.y, CASE WHEN s.y = 1 THEN (qb + q / 2) / nq ELSE (pa + p / 2) / np END AS v
             FROM scores s JOIN below b ON s.model = b.model AND s.score = b.score)"""
Z95 = intervals.quantile_of_normal(0.95)


@query(
    "ex02_auc_interval",
    with_(*AREAS)
    + f""", {PLACED}, e AS (SELECT model, sqrt(var_samp(v) FILTER (y = 1) / count(*) FILTER (y = 1)
             + var_samp(v) FILTER (y = 0) / count(*) FILTER (y = 0)) AS se FROM placed GROUP BY model)
        SELECT model, round(roc_auc, 8) AS roc_auc, round(se, 8) AS std_error, round(greatest(roc_auc - {Z95!r}::DOUBLE * se, 0.0::DOUBLE), 8) AS low,
               round(least(roc_auc + {Z95!r}::DOUBLE * se, 1.0::DOUBLE), 8) AS high FROM areas JOIN e USING (model)""",
)
def ex02d(spark, sf):
    out = intervals.auc_intervals(scores(spark, sf), ["model"], n_groups=N)
    return out.select("model", *[F.round(c, 8).alias(c) for c in ("roc_auc", "std_error", "low", "high")])


@query(
    "ex02_auc_difference",
    with_(*AREAS)
    + f""", {PLACED}, w AS (SELECT a.model AS first, b.model AS second, a.y, a.v - b.v AS d
             FROM placed a JOIN placed b ON a.key = b.key AND a.model < b.model),
        e AS (SELECT first, second, sqrt(var_samp(d) FILTER (y = 1) / count(*) FILTER (y = 1)
             + var_samp(d) FILTER (y = 0) / count(*) FILTER (y = 0)) AS se FROM w GROUP BY first, second),
        t AS (SELECT first, second, x.roc_auc AS auc_first, z.roc_auc AS auc_second, x.roc_auc - z.roc_auc AS d, se
              FROM e JOIN areas x ON x.model = first JOIN areas z ON z.model = second)
        SELECT first, second, round(auc_first, 8) AS auc_first, round(auc_second, 8) AS auc_second, round(d, 8) AS difference,
               round(se, 8) AS std_error, round(d - {Z95!r}::DOUBLE * se, 8) AS low, round(d + {Z95!r}::DOUBLE * se, 8) AS high,
               round(d / se, 4) AS z FROM t""",
)
def ex02e(spark, sf):
    out = intervals.auc_differences(scores(spark, sf), "key", MODELS)
    eight = ("auc_first", "auc_second", "difference", "std_error", "low", "high")
    return out.select("first", "second", *[F.round(c, 8).alias(c) for c in eight], F.round("z", 4).alias("z"))


@query(
    "ex02_f1_interval",
    with_(*CELLS)
    + f""", s AS (SELECT model, tn / n AS tn, tp / n AS tp, e / n AS e, n FROM (
          SELECT model, tn::DOUBLE AS tn, tp::DOUBLE AS tp, (fp + fn)::DOUBLE AS e, (tn + fp + fn + tp)::DOUBLE AS n FROM cells)),
        g AS (SELECT *, 2 * e / (2 * tp + e) ** 2 AS g1, -2 * tp / (2 * tp + e) ** 2 AS h1,
              2 * e / (2 * tn + e) ** 2 AS g0, -2 * tn / (2 * tn + e) ** 2 AS h0 FROM s),
        r AS (SELECT model, 'f1' AS metric, 2 * tp / (2 * tp + e) AS v,
                sqrt((tp * g1 ** 2 + e * h1 ** 2 - (tp * g1 + e * h1) ** 2) / n) AS se FROM g
              UNION ALL SELECT model, 'f1_macro', tp / (2 * tp + e) + tn / (2 * tn + e),
                sqrt((tp * (g1 / 2) ** 2 + tn * (g0 / 2) ** 2 + e * ((h1 + h0) / 2) ** 2
                  - (tp * g1 / 2 + tn * g0 / 2 + e * (h1 + h0) / 2) ** 2) / n) FROM g)
        SELECT model, metric, round(v, 8) AS value, round(se, 8) AS std_error, round(greatest(v - {Z95!r}::DOUBLE * se, 0.0::DOUBLE), 8) AS low,
               round(least(v + {Z95!r}::DOUBLE * se, 1.0::DOUBLE), 8) AS high FROM r""",
)
def ex02f(spark, sf):
    out = intervals.f1_intervals(E.confusion(scores(spark, sf), ["model"]), ["model"])
    return out.select("model", "metric", *[F.round(c, 8).alias(c) for c in ("value", "std_error", "low", "high")])
