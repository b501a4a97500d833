"""Operators against brute force, edge cases and invariants."""

import collections
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.functions import expressions as X
from riskframe.functions.significance import chi2_p_value, erfc, ks_p_value
from riskframe.operators import contracts, drift, evaluation, importance, prefix, profile, selection, splits
from riskframe.operators.prefix import average_ranks, exact_quantiles, prefix_counts, to_long
from riskframe.roles import Roles
from riskframe.sources import artifacts

# --- cumulative counts ----------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """3 groups; a third of all rows share one value; the rest has a long tail."""
    rng = np.random.default_rng(1)
    n = 6000
    value = np.where(rng.random(n) < 1 / 3, 7.0, np.round(np.exp(rng.normal(0, 3, n)), 4))
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], n, p=[0.9, 0.09, 0.01]), "value": value})
    pdf.loc[::97, "value"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("value", F.nanvl("value", F.lit(None).cast("double")))


def test_average_ranks(skewed):
    pdf, df = skewed
    got = {(r.g, r.value): r.avg_rank for r in average_ranks(df, ["g"], "value").collect()}
    clean = pdf.dropna()
    clean = clean.assign(rank=clean.groupby("g")["value"].rank(method="average"))
    want = {(g, v): r for g, v, r in clean.itertuples(index=False)}
    assert got == want


def test_quantiles(skewed):
    pdf, df = skewed
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = exact_quantiles(df, ["g"], "value", probs).collect()
    clean = pdf.dropna()
    for r in got:
        values = clean.loc[clean.g == r.g, "value"].to_numpy()
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_prefix_is_layout_independent(skewed):
    _, df = skewed
    a = prefix_counts(df, ["g"], "value", {"n": F.lit(1)}, n_groups=3)
    b = prefix_counts(df.repartition(13, "value"), ["g"], "value", {"n": F.lit(1)}, buckets=256)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_prefix_of_one_value(spark):
    df = spark.range(1000).select(F.lit("x").alias("g"), F.lit(3.0).alias("value"))
    row = prefix_counts(df, ["g"], "value", {"n": F.lit(1)}).first()
    assert (row.n, row.n_before, row.n_total) == (1000, 0, 1000)


def test_sketch_is_close(skewed):
    _, df = skewed
    exact = profile.quartiles(df, ["value"]).first()
    rough = profile.quartiles(df, ["value"], approximate=True).first()
    assert rough.q1 == pytest.approx(exact.q1, rel=0.02)
    assert rough.q3 == pytest.approx(exact.q3, rel=0.02)


# --- splits ----------------------------------------------------------------------------


def test_split_ratios_are_checked(customers):
    with pytest.raises(ValueError):
        splits.fit_split(customers, "row_id", "target", train=0.8, val=0.1, test=0.2)
    with pytest.raises(ValueError):
        splits.fit_split(customers, "row_id", "target", train=1.2, val=-0.1, test=-0.1)


def test_split_sizes_and_repeatability(customers):
    cuts = splits.fit_split(customers, "row_id", "target")
    again = splits.fit_split(customers.repartition(11), "row_id", "target", prefix_digits=1)
    assert cuts.boundaries == again.boundaries
    assert splits.fit_split(customers, "row_id", "target", seed=7).boundaries != cuts.boundaries
    sizes = {(r.target, r.split): r["count"] for r in cuts.assign(customers).groupBy("target", "split").count().collect()}
    assert sizes == {(0, "train"): 280, (0, "val"): 60, (0, "test"): 60, (1, "train"): 70, (1, "val"): 15, (1, "test"): 15}


def test_split_with_nothing_to_validate(customers):
    cuts = splits.fit_split(customers, "row_id", "target", train=0.9, val=0.0, test=0.1)
    found = {r.split: r["count"] for r in cuts.assign(customers).groupBy("split").count().collect()}
    assert found == {"train": 450, "test": 50}


def test_folds_cover_and_balance(customers):
    folds = splits.assign_folds(customers, splits.fit_folds(customers, "row_id", "target", k=7))
    sizes = folds.groupBy("target", "fold").count().toPandas()
    assert sizes["count"].sum() == 500
    assert (sizes.groupby("target")["count"].agg(lambda s: s.max() - s.min()) <= 1).all()


def test_fractions_are_nested(customers):
    cuts = splits.fit_fractions(customers, "row_id", "target", [0.1, 0.5, 1.0])
    parts = cuts.assign(customers, "part").groupBy("part").count().collect()
    assert {r.part: r["count"] for r in parts} == {"0": 50, "1": 200, "2": 250}


def test_sample_is_fixed_by_seed(customers):
    a = [r.row_id for r in splits.sample_rows(customers, "row_id", 5, seed=1).collect()]
    b = [r.row_id for r in splits.sample_rows(customers.repartition(9), "row_id", 5, seed=1).collect()]
    assert a == b and len(splits.sample_rows(customers.limit(2), "row_id", 5).collect()) == 2


def test_verify_reports_broken_splits(customers):
    split = splits.fit_split(customers, "row_id", "target").assign(customers).select("row_id", "split")
    broken = split.where("row_id <> 3").unionByName(split.where("row_id = 4").withColumn("split", F.lit("other")))
    ratios = {"train": 0.7, "val": 0.15, "test": 0.15}
    verdict = {r.check: r.passed for r in splits.verify_splits(customers, broken, "row_id", ratios).collect()}
    assert not verdict["disjoint"] and not verdict["covering"]
    assert all(r.passed for r in splits.verify_splits(customers, split, "row_id", ratios).collect())


# --- contracts ---------------------------------------------------------------------------


def test_contract_first_failure_wins(customers):
    contract = contracts.Contract(target="target", n_columns=6, n_rows=500, allowed={"sex": [1]})
    warnings = contract.enforce(customers)
    assert warnings == ["sex: 1 codes outside the domain, 2..2"]
    with pytest.raises(ValueError, match="row_count"):
        contract.enforce(customers.unionByName(customers.limit(1)))
    free = contracts.Contract(target="target", n_columns=6)
    with pytest.raises(ValueError, match="no_duplicates"):
        free.enforce(customers.unionByName(customers.where("row_id = 3")))
    with pytest.raises(ValueError, match="no_missing"):
        free.enforce(customers.withColumn("age", F.when(F.col("row_id") != 9, F.col("age"))))
    with pytest.raises(ValueError, match="column_count"):
        free.enforce(customers.drop("target"))


def test_duplicates_of_an_empty_table(customers):
    row = contracts.duplicate_count(customers.where("false")).first()
    assert (row.n_rows, row.n_duplicate_rows, row.duplicate_ratio) == (0, 0, 0.0)


def test_duplicates_are_counted_in_full(spark):
    rows = [(1, None), (1, None), (None, 1), (2, 2), (2, 2), (2, 2), (3, 3)]
    df = spark.createDataFrame(rows, "a int, b int")
    few = contracts.duplicate_count(df).first()
    assert (few.n_rows, few.n_duplicate_rows, few.duplicate_ratio) == (7, 3, round(3 / 7, 6))


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert contracts.missing_counts(df).first().n_missing == 2


@pytest.mark.parametrize(
    "text, reason",
    [
        ('{"a": 1, "b": -2}', None),
        ('{"a": 1}', "missing: b"),
        ('{"a": "1", "b": 2}', "not an integer: a"),
        ('{"a": 1.5, "b": true}', "not an integer: a,b"),
        ('{"a": null, "b": 2}', "not an integer: a"),
        ("[1, 2]", "not a JSON object"),
        ("", "not a JSON object"),
        (None, "not a JSON object"),
    ],
)
def test_strict_records(spark, text, reason):
    df = spark.createDataFrame([(text,)], "value string")
    assert contracts.validate_json_records(df, "value", ["a", "b"]).first().reason == reason


def test_empty_batch(customers):
    with pytest.raises(ValueError):
        contracts.require_rows(customers.where("false"))


# --- profiling ---------------------------------------------------------------------------


def test_minority_tie_takes_smallest_label(spark):
    df = spark.createDataFrame([(1,), (0,), (2,), (2,)], "y int")
    assert [r.label for r in profile.class_balance(df, "y").where("is_minority").collect()] == [0]


def test_constant_feature_has_no_correlation(customers):
    df = customers.withColumn("flat", F.lit(4))
    found = {r.feature: r["corr"] for r in profile.target_correlation(df, "target", ["flat", "age"]).collect()}
    assert found["flat"] is None and found["age"] is not None
    found = {r.feature: r["corr"] for r in profile.target_spearman(df, "target", ["flat", "age"]).collect()}
    assert found["flat"] is None


def test_spearman_against_pandas(customers):
    pdf = customers.toPandas()
    for r in profile.target_spearman(customers, "target", ["age", "delay", "credit"]).collect():
        want = pdf[r.feature].rank().corr(pdf["target"].rank())
        assert r["corr"] == pytest.approx(want, abs=1e-12)


def test_histogram_of_constant(spark):
    df = spark.range(10).select(F.lit(2.0).alias("x"))
    rows = profile.equal_width_histogram(df, ["x"], bins=5).collect()
    assert [(r.bin, r.n) for r in rows] == [(1, 10)]


def test_describe_against_pandas(customers):
    pdf = customers.toPandas()[["age", "credit"]].describe()
    for r in profile.describe(customers, ["age", "credit"]).collect():
        want = pdf[r.feature]
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("q1", "25%"), ("median", "50%"), ("q3", "75%")):
            assert r[mine] == pytest.approx(want[theirs], rel=1e-9)


# --- evaluation -----------------------------------------------------------------------------


def scored(spark, rows):
    return spark.createDataFrame([("m", *r) for r in rows], "model string, y int, score double, prediction int")


def test_auc_against_pairs_and_monotone_maps(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), rng.randint(0, 9) / 10, 0) for _ in range(300)]
    pos = [s for y, s, _ in rows if y]
    neg = [s for y, s, _ in rows if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    df = scored(spark, rows)
    assert evaluation.roc_auc(df, ["model"]).first().roc_auc == pytest.approx(want, abs=1e-12)
    mapped = df.withColumn("score", F.exp(F.col("score") * 5) - 100)
    assert evaluation.roc_auc(mapped, ["model"]).first().roc_auc == pytest.approx(want, abs=1e-12)


def test_one_class_has_no_auc(spark):
    assert evaluation.roc_auc(scored(spark, [(1, 0.1, 0), (1, 0.2, 1)]), ["model"]).first().roc_auc is None


def test_macro_metrics_without_positive_predictions(spark):
    cells = evaluation.confusion(scored(spark, [(1, 0.1, 0), (0, 0.2, 0), (0, 0.3, 0)]), ["model"])
    row = evaluation.macro_metrics(cells, ["model"]).first()
    assert row.precision_macro == pytest.approx((2 / 3) / 2)
    assert row.recall_macro == pytest.approx(0.5)
    assert row.f1_macro == pytest.approx(0.8 / 2)


def test_macro_metrics_over_the_only_class_seen(spark):
    cells = evaluation.confusion(scored(spark, [(0, 0.1, 0), (0, 0.2, 0)]), ["model"])
    assert evaluation.macro_metrics(cells, ["model"]).first().f1_macro == pytest.approx(1.0)


def test_bootstrap_brackets_the_accuracy(spark):
    df = spark.range(2000).select(
        F.lit("m").alias("model"), "id", F.lit(1).alias("y"), (F.col("id") % 10 != 0).cast("int").alias("prediction")
    )
    row = evaluation.bootstrap_accuracy(df, "id", ["model"], replicates=60).first()
    assert row.low < 0.9 < row.high and row.high - row.low < 0.05


def test_threshold_cost_by_brute_force(spark):
    rows = [(1, 0.9, 0), (0, 0.8, 0), (1, 0.4, 0), (0, 0.2, 0), (0, 0.1, 0)]
    costs = evaluation.threshold_costs(scored(spark, rows), ["model"], cost_fn=5, cost_fp=1)
    for r in costs.collect():
        fn = sum(1 for y, s, _ in rows if y and s < r.threshold)
        fp = sum(1 for y, s, _ in rows if not y and s >= r.threshold)
        assert (r.fn, r.fp, r.cost) == (fn, fp, 5 * fn + fp)
    assert evaluation.cheapest_threshold(costs, ["model"]).first().threshold == 0.4


# --- drift --------------------------------------------------------------------------------------

CONT, CAT = ["x1", "x2"], ["c1", "c2"]
DRIFT = Roles("row_id", "y", continuous=CONT, categorical=CAT)


def drift_table(spark, n, shift=0, salt=0):
    i = F.col("id")

    def uniform(k):
        return F.pmod(F.xxhash64(F.lit(salt), F.lit(k), i), F.lit(20_000))

    return spark.range(n).select(
        i.alias("row_id"),
        *[(40_000 + shift + uniform(k)).alias(c) for k, c in enumerate(CONT)],
        *[(uniform(k + 10) % 4).alias(c) for k, c in enumerate(CAT)],
    )


def test_identical_tables_do_not_drift(spark):
    rows = drift.data_drift(drift_table(spark, 500), drift_table(spark, 500), DRIFT).collect()
    assert len(rows) == 4 and not any(r.drift_detected for r in rows)
    assert all(r.statistic == pytest.approx(0, abs=1e-9) and r.p_value == 1.0 for r in rows if r.test == "ks")


def test_shift_is_detected(spark):
    rows = drift.data_drift(drift_table(spark, 500), drift_table(spark, 500, shift=500_000), DRIFT).collect()
    assert {r.feature for r in rows if r.drift_detected} >= set(CONT)


def test_absent_columns_are_skipped(spark):
    rows = drift.data_drift(drift_table(spark, 100), drift_table(spark, 100).drop("x2", "c1", "c2"), DRIFT).collect()
    assert [r.feature for r in rows] == ["x1"]


def test_more_alpha_more_flags(spark):
    a, b = drift_table(spark, 400), drift_table(spark, 400, salt=5)
    low = drift.drift_summary(drift.data_drift(a, b, DRIFT, alpha=1e-10)).first().n_drifted
    high = drift.drift_summary(drift.data_drift(a, b, DRIFT, alpha=1.0)).first().n_drifted
    assert low == 0 and high == 4


def test_empty_side(spark):
    a = drift_table(spark, 50)
    rows = {r.feature: r for r in drift.data_drift(a, a.where("false"), DRIFT).collect()}
    assert rows["x1"].statistic is None and rows["x1"].p_value is None
    assert (rows["c1"].statistic, rows["c1"].p_value) == (0.0, 1.0)


def chi2_brute(table):
    table = np.array(table, dtype=float)
    want = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    gap = np.abs(table - want)
    if table.shape[1] == 2:
        gap = gap - np.minimum(0.5, gap)
    return float((gap**2 / want).sum())


@pytest.mark.parametrize("table", [[[10, 20], [30, 40]], [[5, 5], [6, 5]], [[10, 20, 5], [3, 0, 9]], [[7], [9]]])
def test_chi2_against_expected_counts(spark, table):
    rows = [("f", str(i), a, b) for i, (a, b) in enumerate(zip(*table))]
    counts = spark.createDataFrame(rows, "feature string, value string, ref long, cur long")
    got = drift.chi2_statistics(counts, ["feature"]).first()
    assert got.statistic == pytest.approx(chi2_brute(table) if len(rows) > 1 else 0.0, rel=1e-9)


def test_windows_against_one_reference(spark):
    """Per-window results equal a separate two-sample comparison with each window."""
    ref, cur = drift_table(spark, 700), drift_table(spark, 300, shift=900, salt=2)
    cur = cur.withColumn("w", F.col("row_id") % 3).withColumn("c1", F.when(F.col("w") == 1, 9).otherwise(F.col("c1")))
    got = drift.histogram_drift(
        drift.feature_histogram(ref, [*CONT, *CAT]), drift.feature_histogram(cur, [*CONT, *CAT], ["w"]), ["w"], CONT, CAT
    ).collect()
    assert len(got) == 12
    for w in range(3):
        want = {r.feature: r for r in drift.data_drift(ref, cur.where(F.col("w") == w), DRIFT).collect()}
        for r in got:
            if r.w == w:
                assert r.statistic == pytest.approx(want[r.feature].statistic, rel=1e-9)
                assert r.p_value == pytest.approx(want[r.feature].p_value, rel=1e-6, abs=1e-12)


def test_model_drift_rules(spark):
    base = spark.createDataFrame([("a", 0.77), ("b", 0.77), ("c", 0.77), ("d", 0.70)], "model string, roc_auc double")
    now = spark.createDataFrame([("a", 0.70), ("b", 0.73), ("d", 0.80)], "model string, roc_auc double")
    rows = {r.model: r for r in drift.model_drift(base, now).collect()}
    assert {m for m, r in rows.items() if r.drift_detected} == {"a"}
    assert rows["a"].delta_roc_auc == -0.07 and rows["c"].delta_roc_auc == 0.0
    strict = drift.model_drift(base, now, threshold=0.02).collect()
    assert {r.model for r in strict if r.drift_detected} == {"a", "b"}


def test_tails(spark):
    rows = [(0.0,), (0.3,), (1.0,), (2.9,), (3.1,), (6.0,)]
    for z, got in spark.createDataFrame(rows, "z double").select("z", erfc(F.col("z"))).collect():
        assert got == pytest.approx(math.erfc(z), rel=1e-8)
    # Upper five-percent points of the chi-square distribution.
    points = [(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251179, 3), (9.487729036781154, 4),
              (11.070497693516351, 5), (124.34211340400407, 100)]
    for r in spark.createDataFrame(points, "x double, d long").select(chi2_p_value(F.col("x"), F.col("d")).alias("p")).collect():
        assert r.p == pytest.approx(0.05, rel=1e-9)
    p = spark.range(1).select(ks_p_value(F.lit(1.0), F.lit(500), F.lit(500)).alias("p")).first().p
    assert 0 <= p < 1e-12


# --- selection -----------------------------------------------------------------------------------


def cascade_brute(runs):
    left, steps = list(runs), ["roc_auc", "cv_roc_auc_std", "inference_latency_ms", "training_time_s"]
    for i, name in enumerate(steps, 1):
        default = 0.0 if i == 1 else math.inf
        values = [default if r[name] is None else r[name] for r in left]
        best = max(values) if i == 1 else min(values)
        left = [r for r, v in zip(left, values) if v == best or abs(v - best) <= 1e-4]
        if len(left) == 1:
            return left[0]["run_id"], i
    rank = {"linear": 0, "tree": 1, "ensemble": 2}
    return min(left, key=lambda r: (rank.get(r["model_family"], 99), r["run_id"]))["run_id"], 5


@pytest.mark.parametrize("seed", range(4))
def test_cascade_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def maybe(v):
        return None if rng.random() < 0.1 else v

    rows = []
    for i in range(150):
        rows.append(
            (f"e{i % 6 if i % 2 else 0}", f"r{rng.random():.8f}", rng.choice(["linear", "tree", "ensemble", "other"]),
             maybe(rng.choice([0.7, 0.70005, 0.7002])), maybe(rng.choice([0.01, 0.01005])),
             maybe(rng.choice([0.002, 0.00205])), maybe(rng.choice([1.0, 1.00005, 2.0])))
        )
    names = ["e", "run_id", "model_family", "roc_auc", "cv_roc_auc_std", "inference_latency_ms", "training_time_s"]
    df = spark.createDataFrame(
        rows, "e string, run_id string, model_family string, roc_auc double, cv_roc_auc_std double, "
        "inference_latency_ms double, training_time_s double"
    )
    want = {}
    for e in {r[0] for r in rows}:
        want[e] = cascade_brute([dict(zip(names, r)) for r in rows if r[0] == e])
    got = {r.e: (r.run_id, r.decision_step) for r in selection.cascade_winner(df.repartition(5), ["e"]).collect()}
    assert got == want


def test_audit_tolerance(spark):
    logged = spark.createDataFrame([("a", "roc_auc", 0.7), ("a", "f1", 0.6)], "run_id string, metric string, value double")
    close = logged.withColumn("value", F.col("value") + 5e-5)
    selection.require_matching(selection.metric_mismatches(logged, close))
    with pytest.raises(ValueError, match="f1"):
        far = logged.withColumn("value", F.when(F.col("metric") == "f1", 0.9999).otherwise(F.col("value")))
        selection.require_matching(selection.metric_mismatches(logged, far))


def test_reports_hold_every_run(spark):
    metric = F.xxhash64("id") % 50 / 100.0
    runs = spark.range(1500).select(
        F.md5(F.col("id").cast("string")).alias("run_id"), F.lit("x").alias("experiment"), metric.alias("roc_auc"),
        F.lit(0.1).alias("cv_roc_auc_std"), F.lit(1.0).alias("inference_latency_ms"), F.lit(1.0).alias("training_time_s"),
        F.lit("tree").alias("model_family"),
    )
    report = selection.ranked_report(runs, ["experiment"]).orderBy("rank").collect()
    assert [r["rank"] for r in report] == list(range(1, 1501))
    assert [r["run_id"] for r in report] == [r["run_id"] for r in selection.ordered_runs(runs).collect()]
    top = selection.ranked_report(runs, ["experiment"], max_rows=7).orderBy("rank").collect()
    assert [r["run_id"] for r in top] == [r["run_id"] for r in report[:7]]
    table = artifacts.markdown_table(runs.select("run_id"), [F.asc("run_id")])
    assert [r["position"] for r in table.orderBy("position").collect()] == list(range(1, 1503))


def test_every_outlier_column_is_reported(spark):
    value = F.when(F.col("id") == 0, 1000.0).otherwise((F.col("id") % 10).cast("double"))
    wide = spark.range(200).select(*[value.alias(f"c{i:02d}") for i in range(25)])
    found = profile.outlier_counts(wide, wide.columns)
    assert found.count() == 25 and {r["n_outliers"] for r in found.collect()} == {1}


def test_ranks_of_null_groups_and_ties(spark):
    rows = [(None, 3), ("a", 1), (None, 1), ("a", 1), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = sorted((r["g"] or "", r["place"], r["v"]) for r in prefix.ranked(df, ["g"], [F.asc_nulls_last("v")], "place").collect())
    assert [(g, p) for g, p, _ in got] == [("", 1), ("", 2), ("a", 1), ("a", 2), ("a", 3)]
    assert got[-1][2] is None


def test_quantiles_keep_the_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in prefix.exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_other_labels_fail_instead_of_vanishing(spark):
    df = spark.createDataFrame([("m", 1, 1), ("m", 2, 0)], "model string, y int, prediction int")
    with pytest.raises(Exception, match="not a 0/1 label"):
        evaluation.confusion(df, ["model"]).collect()


def test_many_classes_are_joined(spark, monkeypatch):
    df = spark.range(600).select(F.col("id").alias("row_id"), (F.col("id") % 30).alias("label"))
    cuts = splits.fit_split(df, "row_id", "label")
    inline = {r["row_id"]: r["split"] for r in cuts.assign(df).collect()}
    monkeypatch.setattr(splits, "INLINE_CLASSES", 3)
    joined = {r["row_id"]: r["split"] for r in cuts.assign(df).collect()}
    assert inline == joined and len(set(inline.values())) == 3


def test_histogram_operators_scan_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 37).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y")).write.parquet(path)
    df = spark.read.parquet(path)
    for frame in (profile.quartiles(df, ["x"]), profile.target_spearman(df, "y", ["x"]), profile.five_numbers_by_class(df, "y", ["x"])):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("FileScan parquet") - final.count("ReusedExchange") <= 1, final


def test_exact_ks_probability_by_all_orders():
    import itertools

    from riskframe.functions.significance import ks_exact_probability

    for m, n in ((3, 4), (5, 5), (2, 6)):
        gaps = []
        for firsts in itertools.combinations(range(m + n), m):
            i = j = worst = 0
            for at in range(m + n):
                i, j = (i + 1, j) if at in firsts else (i, j + 1)
                worst = max(worst, abs(i * n - j * m))
            gaps.append(worst)
        for distance in sorted(set(gaps)):
            want = sum(g >= distance for g in gaps) / len(gaps)
            assert ks_exact_probability(distance, m, n) == pytest.approx(want)


# --- expressions -------------------------------------------------------------------------------


def test_run_name_round_trip(spark):
    name = X.run_name(*[F.lit(v) for v in ("tune", "rf", "numstd_catoh", "none", "random", 42, "0a1b2c3d", "1f2e3d4")])
    row = spark.range(1).select(name.alias("n")).select("n", X.run_stage(F.col("n")).alias("s"), X.run_search(F.col("n")).alias("t")).first()
    assert row.n == "tune__rf__numstd_catoh__none__random__seed42__data0a1b2c3d__code1f2e3d4"
    assert (row.s, row.t) == ("tune", "random")


@pytest.mark.parametrize(
    "text, kind",
    [("42", "int"), ("0.1", "float"), ("None", "null"), (None, "null"), ("True", "bool"), ("-3", "int"), ("1e-3", "float"),
     ("sqrt", "string"), ("", "string"), ("true", "bool"), ("FALSE", "bool"), ("1d", "string"), ("2f", "string"), ("inf", "float")],
)
def test_typed_param(spark, text, kind):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(X.typed_param(F.col("v")).alias("p")).first().p.kind == kind


def test_half_even(spark):
    rows = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double").select(X.half_even(F.col("x"), 2)).collect()
    assert [r[0] for r in rows] == [0.12, 0.38, 2.5]


# --- roles and importance ------------------------------------------------------------------------


def test_roles_do_not_overlap():
    with pytest.raises(ValueError):
        Roles("k", "y", continuous=["a"], categorical=["a"])
    with pytest.raises(ValueError):
        Roles("k", "y", continuous=["y"])


def test_shuffle_keeps_the_values(customers):
    out = importance.shuffle_column(customers, "row_id", "credit", buckets=4)
    assert out.columns == customers.columns and out.count() == 500
    assert out.select("credit").exceptAll(customers.select("credit")).isEmpty()
    assert out.drop("credit").exceptAll(customers.drop("credit")).isEmpty()
    moved = out.alias("a").join(customers.alias("b"), "row_id").where("a.credit <> b.credit").count()
    assert moved > 400
    again = importance.shuffle_column(customers.repartition(6), "row_id", "credit", buckets=4)
    assert again.exceptAll(out).isEmpty()


def test_to_long_keeps_order_of_features(customers):
    assert to_long(customers, ["age", "credit"], ["row_id"]).columns == ["row_id", "feature", "value"]


def test_roc_corners_across_buckets(spark):
    draw = random.Random(5)
    rows = [(g, int(draw.random() < s / 90), float(s)) for g in (None, "b") for s in [draw.randrange(90) for _ in range(400)]]
    rows += [("one", 1, 0.5), ("two", 1, 0.5), ("two", 0, 0.25)]
    df = spark.createDataFrame(rows, "model string, y int, score double")
    got = {(r.model, r.threshold) for r in evaluation.roc_corners(df, ["model"]).collect()}
    want = set()
    for g in {r[0] for r in rows}:
        steps = collections.defaultdict(lambda: [0, 0])
        for _, y, s in (r for r in rows if r[0] == g):
            steps[s][y] += 1
        order = sorted(steps, reverse=True)
        want |= {(g, s) for i, s in enumerate(order) if i in (0, len(order) - 1) or steps[s] != steps[order[i + 1]]}
        want.add((g, float("inf")))
    assert got == want
