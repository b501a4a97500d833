"""Intervals of metrics, correlations of many columns, drift from sketches."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import correlation, evaluation, intervals, profile
from riskframe.session import fresh_path
from riskframe.streaming import drift as stream_drift


def scored_rows(n, seed, ties):
    draw = random.Random(seed)
    rows = []
    for key in range(n):
        y = int(draw.random() < 0.3)
        a = draw.gauss(0.6 * y, 1)
        rows.append((key, "a", y, round(a, 1) if ties else a))
        rows.append((key, "b", y, draw.gauss(0.4 * y, 1) + 0.5 * a))
    return rows


def placements(rows, model):
    """Per key: the share of the other class it outranks, by comparing all pairs."""
    mine = [(k, y, s) for k, m, y, s in rows if m == model]
    other = {y: [s for _, z, s in mine if z != y] for y in (0, 1)}
    beats = {1: lambda s, t: (s > t) + (s == t) / 2, 0: lambda s, t: (s < t) + (s == t) / 2}
    return {k: (y, sum(beats[y](s, t) for t in other[y]) / len(other[y])) for k, y, s in mine}


def delong(values):
    area = np.mean([v for y, v in values if y])
    return area, math.sqrt(sum(np.var([v for z, v in values if z == y], ddof=1) / sum(z == y for z, _ in values) for y in (0, 1)))


@pytest.mark.parametrize("ties", [True, False])
def test_areas_and_their_differences_against_all_pairs(spark, ties):
    rows = scored_rows(180, 4, ties)
    df = spark.createDataFrame(rows, "key long, model string, y int, score double").repartition(5)
    got = {r["model"]: r for r in intervals.auc_intervals(df, ["model"]).collect()}
    placed = {m: placements(rows, m) for m in "ab"}
    for m in "ab":
        area, error = delong(list(placed[m].values()))
        assert math.isclose(got[m]["roc_auc"], area, rel_tol=1e-12) and math.isclose(got[m]["std_error"], error, rel_tol=1e-9)
        assert math.isclose(got[m]["high"] - got[m]["roc_auc"], 1.959963984540054 * error, rel_tol=1e-9)
    (pair,) = intervals.auc_differences(df, "key", ["a", "b"]).collect()
    gap, error = delong([(y, v - placed["b"][k][1]) for k, (y, v) in placed["a"].items()])
    assert math.isclose(pair["difference"], gap, abs_tol=1e-12) and math.isclose(pair["std_error"], error, rel_tol=1e-9)
    assert math.isclose(pair["p_value"], math.erfc(abs(gap / error) / math.sqrt(2)), abs_tol=1e-6)


def test_areas_without_a_class_or_with_one_row(spark):
    rows = [(1, "one class", 1, 0.2), (2, "one class", 1, 0.9), (1, "single", 1, 0.3), (2, "single", 0, 0.1), (3, "single", 0, 0.5), (4, "single", 0, None)]
    df = spark.createDataFrame(rows, "key long, model string, y int, score double")
    got = {r["model"]: r for r in intervals.auc_intervals(df, ["model"]).collect()}
    assert got["one class"]["roc_auc"] is None and got["one class"]["low"] is None
    assert got["single"]["roc_auc"] == 0.5 and got["single"]["std_error"] is None and got["single"]["high"] is None
    assert intervals.auc_intervals(df.limit(0), ["model"]).count() == 0
    twice = df.unionByName(df.withColumn("model", F.lit("copy")))
    assert all(r["z"] is None for r in intervals.auc_differences(twice.where("model <> 'one class'"), "key", ["single", "copy"]).collect())


def test_equal_models_do_not_differ(spark):
    rows = [r for r in scored_rows(80, 9, True) if r[1] == "a"]
    df = spark.createDataFrame([*rows, *[(k, "b", y, 10 * s) for k, _, y, s in rows]], "key long, model string, y int, score double")
    (pair,) = intervals.auc_differences(df, "key", ["a", "b"]).collect()
    assert pair["difference"] == 0 and pair["std_error"] == 0 and pair["z"] is None and pair["p_value"] is None


def test_f1_interval_is_the_spread_of_the_bootstrap(spark):
    cells = [("a", 700, 60, 40, 200), ("b", 5000, 300, 900, 800), ("no positives", 50, 0, 0, 0), ("nothing", 0, 0, 0, 0)]
    df = spark.createDataFrame(cells, "model string, tn long, fp long, fn long, tp long")
    drawn = intervals.resampled_cells(df, ["model"], replicates=4000).toPandas()
    assert drawn.groupby("model")[["tn", "fp", "fn", "tp"]].sum().sum(axis=1).to_dict() == {m: 4000 * sum(c) for m, *c in cells}
    again = intervals.resampled_cells(df.repartition(3), ["model"], replicates=4000).toPandas()
    keys = ["model", "replicate"]
    assert drawn.sort_values(keys).reset_index(drop=True).equals(again.sort_values(keys).reset_index(drop=True))
    got = {(r["model"], r["metric"]): r for r in intervals.f1_intervals(df, ["model"]).collect()}
    for model in "ab":
        d = drawn[drawn.model == model]
        one = 2 * d.tp / (2 * d.tp + d.fp + d.fn)
        both = (one + 2 * d.tn / (2 * d.tn + d.fp + d.fn)) / 2
        for metric, values in (("f1", one), ("f1_macro", both)):
            assert math.isclose(got[model, metric]["std_error"], values.std(), rel_tol=0.06)
            assert abs(got[model, metric]["value"] - values.mean()) < 0.003
    assert got["no positives", "f1"]["value"] is None and got["nothing", "f1_macro"]["low"] is None


def test_bootstrap_intervals_hold_the_value(spark):
    df = spark.createDataFrame(scored_rows(400, 5, False), "key long, model string, y int, score double")
    df = df.withColumn("prediction", (F.col("score") > 0.4).cast("int"))
    rows = intervals.bootstrap_intervals(df, ["model"], replicates=500).collect()
    assert len(rows) == 14 and all(r["low"] < r["value"] < r["high"] and r["low"] < r["median"] < r["high"] for r in rows)
    rare = evaluation.bootstrap_accuracy(df, "key", ["model"], replicates=300, blocks=None).collect()
    for r in rare:
        (mine,) = [x for x in rows if x["model"] == r["model"] and x["metric"] == "accuracy"]
        assert abs((r["high"] - r["low"]) - (mine["high"] - mine["low"])) < 0.02


# --- correlations ---


def test_blocked_correlations_equal_the_single_aggregate(spark):
    draw = random.Random(6)
    rows = []
    for i in range(300):
        a, b = draw.gauss(0, 1), draw.gauss(1e6, 1)
        rows.append((a, b, a + b / 7 if i % 3 else None, -a, None if i % 5 else a * a, 7.0, float("nan") if i % 2 else b, None, 3.0 if i % 4 else None, float(i)))
    names = [f"x.{i}" for i in range(10)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(4)
    want = {(r[0], r[1]): r[2] for r in profile.pearson_matrix(df, names).collect()}
    # Constant, whatever rounding makes of its standard deviation.
    want |= {pair: None for pair in want if "x.8" in pair}
    for block in (3, 10, 256):
        got = {(r[0], r[1]): r[2] for r in correlation.pearson(df, names, block).collect()}
        assert set(got) == set(want)
        for pair, value in want.items():
            assert (got[pair] is None) == (value is None), pair
            assert value is None or math.isclose(got[pair], value, abs_tol=1e-8), pair
    assert {r["corr"] for r in correlation.pearson(df.limit(0), names, 4).collect()} <= {None}


def test_infinite_values_have_no_correlation(spark):
    inf = float("inf")
    rows = [(1.0, 2.0, None, 1.0), (2.0, 5.0, 1.0, 3.0), (inf, 3.0, None, 2.0), (4.0, 8.0, 6.0, 9.0), (7.0, None, 2.0, -inf)]
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(2)
    for block in (2, 4):
        got = {(r[0], r[1]): r[2] for r in correlation.pearson(df, names, block).collect()}
        assert {pair for pair, v in got.items() if v is not None and math.isnan(v)} == {tuple(p) for p in ("ab", "ba", "ad", "da", "cd", "dc")}
        assert all(got[n, n] == 1.0 for n in names)
        # The infinite value of a stands in a row without c.
        assert got["a", "c"] == pytest.approx(float(np.corrcoef([2, 4, 7], [1, 6, 2])[0, 1]))
        assert got["b", "d"] == pytest.approx(float(np.corrcoef([2, 5, 3, 8], [1, 3, 2, 9])[0, 1]))


def test_a_credit_of_zero_gives_infinite_shares(spark):
    from riskframe.plans import QUERIES

    at = fresh_path(spark, "tables")
    i = F.col("id")
    spark.range(8).select(i.alias("c_custkey"), F.when(i == 3, 0.0).otherwise(100.0 + i).alias("c_acctbal")).write.parquet(f"{at}/customer.parquet")
    spark.range(96).select(
        (i % 8).alias("o_custkey"), (100.0 + i * i % 37).alias("o_totalprice"), F.lit("P").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"),
        F.to_timestamp(F.concat((1995 + F.floor(i / 8) % 6).cast("string"), F.lit("-03-01"))).alias("o_orderdate"),
    ).write.parquet(f"{at}/orders.parquet")
    got = {(r[0], r[1]): r[2] for r in QUERIES["ag12_pearson_matrix_wide"](spark, at).collect()}
    assert len(got) == 48 * 48
    assert math.isnan(got["u1", "b1"]) and got["u1", "u1"] == 1.0 and -1 <= got["b1", "b2"] <= 1


def test_two_thousand_columns(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 2000))
    x[:, 1000:] += x[:, :1000]
    names = [f"c{i}" for i in range(2000)]
    df = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").select(*[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    out = correlation.pearson(df, names).toPandas()
    assert len(out) == 2000 * 2000
    want = np.corrcoef(x.T)
    at = {n: i for i, n in enumerate(names)}
    got = np.zeros((2000, 2000))
    got[out.feature_a.map(at), out.feature_b.map(at)] = out["corr"]
    assert np.abs(got - want).max() < 1e-9


# --- sketches ---


def events(spark, n, distinct, shift=0.0):
    """Ten days of events, 20 features values per day at least, dealt over files."""
    i = F.col("id")
    spread = F.pmod(F.xxhash64(i), F.lit(distinct)) / distinct
    return spark.range(n).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(i * 864_000 / n)).alias("ts"),
        (spread + F.lit(shift)).alias("value"),
        F.when(i % 3 == 0, 5.0).when(i % 7 == 0, F.lit(None)).otherwise(F.round(spread, 1)).alias("tied"),
    )


def run_sketches(spark, tmp_path, name, df, k=256):
    df.repartition(6).write.parquet(f"{tmp_path}/{name}")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}")
    sketches = stream_drift.window_sketches(stream, ["value", "tied"], window="1 day", late="1 hour", k=k)
    query = stream_drift.start_window_histograms(sketches, out=f"{tmp_path}/{name}-out", checkpoint=f"{tmp_path}/{name}-state")
    query.awaitTermination()
    progress = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    return spark.read.schema(sketches.schema).parquet(f"{tmp_path}/{name}-out"), max(p["numRowsTotal"] for p in progress)


def test_sketch_state_does_not_grow_with_rows(spark, tmp_path):
    sizes = {}
    for n in (4_000, 120_000):
        found, state_rows = run_sketches(spark, tmp_path, f"n{n}", events(spark, n, 10**9))
        assert state_rows <= 2 * 10
        rows = found.select("n", F.length("sketch").alias("bytes")).collect()
        assert sum(r["n"] for r in rows) > n
        sizes[n] = max(r["bytes"] for r in rows)
    # Thirty times the rows: two more levels of a few hundred values.
    assert sizes[120_000] < 3 * sizes[4_000] and sizes[120_000] < 3 * 8 * 256 + 1000


def test_sketched_verdicts_equal_exact_ones(spark, tmp_path):
    reference = events(spark, 20_000, 10**9)
    for name, current in {"same": events(spark, 30_000, 10**9), "moved": events(spark, 30_000, 10**9, 0.2), "coarse": events(spark, 30_000, 4)}.items():
        found, _ = run_sketches(spark, tmp_path, name, current, k=2048)
        timed = current.withColumn("window_start", F.window("ts", "1 day")["start"])
        exact = stream_drift.window_drift(reference, stream_drift.feature_histogram(timed, ["value", "tied"], ["window_start"]), ["value", "tied"], [])
        want = {(r["window_start"], r["feature"]): r for r in exact.collect()}
        rows = stream_drift.sketch_drift(reference, found, ["value", "tied"], ["window_start"]).collect()
        assert len(rows) >= 16
        for r in rows:
            w = want[r["window_start"], r["feature"]]
            assert abs(r["statistic"] - w["statistic"]) <= r["error"]
            assert not r["certain"] or r["drift_detected"] == w["drift_detected"]
        assert any(r["certain"] for r in rows)
        if name == "moved":
            assert all(r["drift_detected"] and r["certain"] for r in rows if r["feature"] == "value")
    merged = stream_drift.merge_sketches(found, []).collect()
    assert {r["feature"]: r["n"] for r in merged} == {r["feature"]: r["n"] for r in found.groupBy("feature").agg(F.sum("n").alias("n")).collect()}


def test_marks_cover_the_reference(spark):
    draw = random.Random(2)
    values = [draw.choice([1.0, 2.0, draw.random()]) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    (row,) = stream_drift.reference_marks(df, ["v"], marks=50).collect()
    marks = [(m["value"], m["below"], m["upto"]) for m in row["marks"]]
    assert row["n_ref"] == 5000 and len(marks) <= 51 and marks[-1][2] == 1.0
    for (_, _, upto), (_, below, _) in itertools.pairwise(marks):
        assert below - upto < 1 / 50
    assert {1.0, 2.0} <= {v for v, _, _ in marks}
