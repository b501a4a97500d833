"""Metrics of scored tables.

A scored table is long: (model, y, score, prediction) with y and prediction in {0, 1}.
``group`` names the columns that tell models (or folds, splits, runs) apart.  Label
metrics come from the confusion counts, order metrics from cumulative counts per
distinct score, so neither depends on how many rows share a model or a score.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.prefix import join_groups, prefix_counts
from riskframe.operators.splits import digest
from riskframe.session import ship


def ratio0(numerator: Column, denominator: Column) -> Column:
    """A quotient that is 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def harmonic0(a: Column, b: Column) -> Column:
    return ratio0(2.0 * a * b, a + b)


# --- label metrics ------------------------------------------------------------------


def confusion(df: DataFrame, group: list[str], y: str = "y", prediction: str = "prediction") -> DataFrame:
    """(group, tn, fp, fn, tp) of labels 0 and 1; rows with any other label or prediction fail, as do missing
    ones, instead of vanishing from the counts."""
    usable = F.col(y).isin(0, 1) & F.col(prediction).isin(0, 1)
    message = F.concat(F.lit("not a 0/1 label and prediction: "), F.concat_ws(", ", F.coalesce(F.col(y).cast("string"), F.lit("null")), F.coalesce(F.col(prediction).cast("string"), F.lit("null"))))
    df = df.withColumn(y, F.when(F.coalesce(usable, F.lit(False)), F.col(y)).otherwise(F.raise_error(message).cast("int")))

    def count(a: int, b: int) -> Column:
        return F.count(F.when((F.col(y) == a) & (F.col(prediction) == b), 1))

    return df.groupBy(*group).agg(
        count(0, 0).alias("tn"), count(0, 1).alias("fp"), count(1, 0).alias("fn"), count(1, 1).alias("tp")
    )


def binary_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy and the positive class's precision, recall and F1 next to the confusion cells."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    out = cells.withColumn("accuracy", ratio0(tn + tp, tn + fp + fn + tp))
    out = out.withColumn("precision", ratio0(tp, tp + fp)).withColumn("recall", ratio0(tp, tp + fn))
    return out.withColumn("f1", harmonic0(F.col("precision"), F.col("recall")))


def _per_class(cells: DataFrame, group: list[str]) -> DataFrame:
    """Precision, recall, F1, support for class 0 and 1; a class seen on neither side is left out."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def entry(label: int, hit: Column, other_as_this: Column, this_as_other: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            hit.alias("hit"),
            (hit + other_as_this).alias("claimed"),
            (hit + this_as_other).alias("support"),
            (tn + fp + fn + tp).alias("total"),
        )

    rows = cells.select(*group, F.inline(F.array(entry(0, tn, fn, fp), entry(1, tp, fp, fn))))
    rows = rows.where((F.col("claimed") > 0) | (F.col("support") > 0))
    rows = rows.withColumn("precision", ratio0(F.col("hit"), F.col("claimed")))
    rows = rows.withColumn("recall", ratio0(F.col("hit"), F.col("support")))
    return rows.withColumn("f1", harmonic0(F.col("precision"), F.col("recall")))


def _macro_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Accuracy and macro averages as plain expressions of the four cells."""
    sides = []
    for hit, other_as_this, this_as_other in ((tn, fn, fp), (tp, fp, fn)):
        p, r = ratio0(hit, hit + other_as_this), ratio0(hit, hit + this_as_other)
        seen = F.when(hit + other_as_this + this_as_other > 0, 1.0).otherwise(0.0)
        sides.append((seen, {"precision_macro": p, "recall_macro": r, "f1_macro": harmonic0(p, r)}))
    (seen0, zero), (seen1, one) = sides
    out = {"accuracy": ratio0(tn + tp, tn + fp + fn + tp)}
    for m in zero:
        out[m] = F.try_divide(seen0 * zero[m] + seen1 * one[m], seen0 + seen1)
    return out


def macro_metrics(cells: DataFrame, group: list[str]) -> DataFrame:
    """(group, accuracy, precision_macro, recall_macro, f1_macro) over the classes seen."""
    columns = _macro_columns(*(F.col(c) for c in ("tn", "fp", "fn", "tp")))
    return cells.select(*group, *[c.alias(m) for m, c in columns.items()])


def class_report(cells: DataFrame, group: list[str]) -> DataFrame:
    """(group, row, precision, recall, f1, support): both classes, macro and weighted average."""
    rows = _per_class(cells, group)
    classes = rows.select(*group, F.col("label").cast("string").alias("row"), "precision", "recall", "f1", "support")

    def average(name: str, weight: Column) -> DataFrame:
        return rows.groupBy(*group).agg(
            F.lit(name).alias("row"),
            *[(F.sum(F.col(m) * weight) / F.sum(weight)).alias(m) for m in ("precision", "recall", "f1")],
            F.sum("support").alias("support"),
        )

    return classes.unionByName(average("macro avg", F.lit(1.0))).unionByName(
        average("weighted avg", F.col("support").cast("double"))
    )


# --- order metrics ------------------------------------------------------------------


def score_table(
    df: DataFrame, group: list[str], y: str = "y", score: str = "score", *, n_groups: int | None = None, with_bucket: bool = False
) -> DataFrame:
    """Positives and negatives per distinct score, below it and in total."""
    weights = {
        "pos": F.when(F.col(y) == 1, 1).otherwise(0),
        "neg": F.when(F.col(y) == 0, 1).otherwise(0),
    }
    return prefix_counts(df, group, score, weights, n_groups=n_groups, with_bucket=with_bucket)


def _wins() -> Column:
    """Twice the pairs a score wins; as decimals, so that the sum does not depend on the order."""
    below = 2 * F.col("neg_before") + F.col("neg")
    return F.sum(F.col("pos").cast("decimal(19,0)") * below.cast("decimal(19,0)"))


def _area(wins: Column, positives: Column, negatives: Column) -> Column:
    return F.try_divide(wins.cast("double"), 2.0 * positives.cast("double") * negatives.cast("double"))


def auc_of(table: DataFrame, group: list[str]) -> DataFrame:
    """(group, roc_auc) from a score table; null when one class is absent."""
    out = table.groupBy(*group).agg(
        _wins().alias("_w"), F.max("pos_total").alias("_p"), F.max("neg_total").alias("_n")
    )
    return out.select(*group, _area(F.col("_w"), F.col("_p"), F.col("_n")).alias("roc_auc"))


def roc_auc(
    df: DataFrame, group: list[str], y: str = "y", score: str = "score", *, n_groups: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve; tied scores count one half."""
    return auc_of(score_table(df, group, y, score, n_groups=n_groups), group)


# Rows whose scores a task sorts at a time, and scores of a bucket, about.
RUN_ROWS = 1 << 19
BUCKET_SCORES = 1 << 20
# Sampled rows per bucket that its borders come from.
BORDER_ROWS = 2_048


def _packed(values: np.ndarray) -> tuple[bytes, bytes | None]:
    """Ascending values, and how often each occurs if many are equal; without counts every value counts once."""
    if len(values) < 2:
        return values.tobytes(), None
    # NaN, which sorts last, equals itself here as it does in a ``groupBy``.
    first = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) & ~np.isnan(values[:-1])]))
    if 2 * len(first) > len(values):
        return values.tobytes(), None
    return values[first].tobytes(), np.diff(np.append(first, len(values))).astype(np.int64).tobytes()


def _unpacked(values: list[bytes], counts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending values of several runs, and how many values there are up to each place."""
    runs = [np.frombuffer(v, np.float64) for v in values]
    times = [np.ones(len(r), np.int64) if c is None else np.frombuffer(c, np.int64) for r, c in zip(runs, counts, strict=True)]
    joined, n = np.concatenate([np.zeros(0), *runs]), np.concatenate([np.zeros(0, np.int64), *times])
    if all(c is None for c in counts):
        joined.sort()
    else:
        order = np.argsort(joined)
        joined, n = joined[order], n[order]
    return joined, np.concatenate([[0], np.cumsum(n)])


def _sorted_runs(borders: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted scores of each class, per place in the array of scores and bucket."""

    def pieces(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = np.concatenate([b.column("y").fill_null(-1).to_numpy(zero_copy_only=False) for b in batches])
        flat = pa.concat_arrays([b.column("scores").flatten() for b in batches])
        shape = (len(y), len(borders))
        missing = flat.is_null().to_numpy(zero_copy_only=False).reshape(shape)
        scores = flat.to_numpy(zero_copy_only=False).reshape(shape)
        for at, ends in enumerate(borders):
            column, here = scores[:, at], ~missing[:, at]
            sides = []
            for label in (1, 0):
                values = np.sort(column[here & (y == label)])
                sides.append(np.split(values, np.searchsorted(values, ends, "left")))
            rows = [
                (at, b, *_packed(positive), *_packed(negative))
                for b, (positive, negative) in enumerate(zip(*sides, strict=True))
                if len(positive) or len(negative)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RUNS)], schema=_RUNS)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= RUN_ROWS:
                yield from pieces(held)
                held, n = [], 0
        if n:
            yield from pieces(held)

    return sort


def _bucket_wins(runs: pa.Table) -> pa.Table:
    """Scores of each class in a bucket, and twice the pairs that a positive one wins there."""
    columns = {c: runs.column(c).to_pylist() for c in ("positive", "positives", "negative", "negatives")}
    positive, up_to = _unpacked(columns["positive"], columns["positives"])
    negative, below = _unpacked(columns["negative"], columns["negatives"])
    won = below[np.searchsorted(negative, positive, "left")] + below[np.searchsorted(negative, positive, "right")]
    return pa.Table.from_pydict(
        {
            "at": runs.column("at")[:1], "bucket": runs.column("bucket")[:1], "pos": [int(up_to[-1])],
            "neg": [int(below[-1])], "wins": [int(np.dot(np.diff(up_to), won))],
        },
        schema=_WINS,
    )


_RUNS = pa.schema(
    [
        ("at", pa.int32()), ("bucket", pa.int32()), ("positive", pa.binary()), ("positives", pa.binary()),
        ("negative", pa.binary()), ("negatives", pa.binary()),
    ]
)
_WINS = pa.schema([("at", pa.int32()), ("bucket", pa.int32()), ("pos", pa.int64()), ("neg", pa.int64()), ("wins", pa.int64())])


def roc_areas(rows: DataFrame, width: int, score: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """(at, roc_auc): for each place of an array of ``width`` scores what ``roc_auc`` gives for the scores in that place.

    ``score`` makes (y, scores) of rows.  A row is passed on once for all its scores.  Tasks sort the scores of some rows
    and cut them at borders of buckets; a bucket of each place is joined from its sorted runs, and totals of buckets
    become offsets.  Equal scores of a run are one value and a count.  Results are exact; only borders come from a
    sketch, over rows picked by ``key`` before they are scored.
    """
    ship(rows.sparkSession)
    n = rows.count()
    buckets = max(1, math.ceil(n / BUCKET_SCORES))
    borders: list[np.ndarray] = [np.zeros(0)] * width
    if buckets > 1:
        every = max(1, n // (buckets * BORDER_ROWS))
        picked = score(rows.where(F.pmod(F.xxhash64(f"`{key}`"), F.lit(every)) == 0))
        probs = [i / buckets for i in range(1, buckets)]
        marks = picked.agg(
            *[F.percentile_approx(F.get("scores", F.lit(at)), probs, 4 * buckets).alias(f"m{at}") for at in range(width)]
        ).first()
        borders = [np.unique(np.array(m or [], float)) for m in marks]
    scored = score(rows).select(F.col("y").cast("int").alias("y"), "scores")
    runs = scored.mapInArrow(
        _sorted_runs(borders), "at int, bucket int, positive binary, positives binary, negative binary, negatives binary"
    )
    cells = runs.groupBy("at", "bucket").applyInArrow(_bucket_wins, "at int, bucket int, pos long, neg long, wins long")
    # One row per place and bucket.
    lower = Window.partitionBy("at").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("neg_before", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    across = 2 * F.col("pos").cast("decimal(19,0)") * F.col("neg_before").cast("decimal(18,0)")
    out = cells.groupBy("at").agg(
        F.sum(across + F.col("wins")).alias("_w"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n")
    )
    return out.select("at", _area(F.col("_w"), F.col("_p"), F.col("_n")).alias("roc_auc"))


def curve_points(table: DataFrame, group: list[str], score: str = "score") -> DataFrame:
    """(group, threshold, tp, fp, tpr, fpr, precision, recall) predicting 1 at score >= threshold."""
    out = table.select(
        *group,
        F.col(score).alias("threshold"),
        (F.col("pos_total") - F.col("pos_before")).alias("tp"),
        (F.col("neg_total") - F.col("neg_before")).alias("fp"),
        F.col("pos"),
        F.col("pos_total"),
        F.col("neg_total"),
    )
    out = out.withColumn("tpr", F.try_divide("tp", "pos_total"))
    out = out.withColumn("fpr", F.try_divide("fp", "neg_total"))
    out = out.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp")))
    return out.withColumn("recall", F.col("tpr"))


def roc_curve(
    df: DataFrame, group: list[str], y: str = "y", score: str = "score", *, n_groups: int | None = None
) -> DataFrame:
    """One point per distinct score, and the origin at threshold infinity."""
    points = curve_points(score_table(df, group, y, score, n_groups=n_groups), group, score)
    origin = _anchor(points, group, {"fpr": 0.0, "tpr": 0.0})
    return points.select(*group, "threshold", "fpr", "tpr").unionByName(origin)


def roc_corners(
    df: DataFrame, group: list[str], y: str = "y", score: str = "score", *, n_groups: int | None = None
) -> DataFrame:
    """``roc_curve`` without points on a straight line: a point whose step equals the next one's is left out.

    The first and the last score stay, and so does the area.  A score is compared with the next lower one, which may
    be the highest of an earlier bucket: each bucket hands its highest on.
    """
    table = score_table(df, group, y, score, n_groups=n_groups, with_bucket=True)
    step = F.struct("pos", "neg")
    inside = Window.partitionBy(*group, "_bucket").orderBy(score)
    across = Window.partitionBy(*group).orderBy("_bucket")
    highest = table.groupBy(*group, "_bucket").agg(F.max_by(step, score).alias("_highest"))
    handed = highest.select(*group, "_bucket", F.lag("_highest").over(across).alias("_handed"))
    stepped = join_groups(table.withColumn("_lower", F.lag(step).over(inside)), handed, [*group, "_bucket"])
    lower = F.coalesce("_lower", "_handed")
    first = (F.col("pos_before") + F.col("pos") == F.col("pos_total")) & (F.col("neg_before") + F.col("neg") == F.col("neg_total"))
    points = curve_points(stepped.where(first | lower.isNull() | (lower != step)), group, score)
    origin = _anchor(points, group, {"fpr": 0.0, "tpr": 0.0})
    return points.select(*group, "threshold", "fpr", "tpr").unionByName(origin)


def _anchor(points: DataFrame, group: list[str], values: dict[str, float]) -> DataFrame:
    """The point of each curve at which nobody is positive."""
    return points.groupBy(*group).agg(
        F.lit(float("inf")).alias("threshold"), *[F.lit(v).alias(n) for n, v in values.items()]
    )


def precision_recall_curve(
    df: DataFrame, group: list[str], y: str = "y", score: str = "score", *, n_groups: int | None = None
) -> DataFrame:
    """One point per distinct score, and recall 0 with precision 1 at threshold infinity."""
    points = curve_points(score_table(df, group, y, score, n_groups=n_groups), group, score)
    first = _anchor(points, group, {"precision": 1.0, "recall": 0.0})
    return points.select(*group, "threshold", "precision", "recall").unionByName(first)


def average_precision(
    df: DataFrame, group: list[str], y: str = "y", score: str = "score", *, n_groups: int | None = None
) -> DataFrame:
    """(group, average_precision): precision weighted by the recall each score adds."""
    points = curve_points(score_table(df, group, y, score, n_groups=n_groups), group, score)
    step = F.try_divide(F.col("pos"), F.col("pos_total"))
    return points.groupBy(*group).agg(F.sum(step * F.col("precision")).alias("average_precision"))


def all_metrics(
    df: DataFrame,
    group: list[str],
    y: str = "y",
    score: str = "score",
    prediction: str = "prediction",
    *,
    n_groups: int | None = None,
) -> DataFrame:
    """(group, roc_auc, f1_macro, precision_macro, recall_macro, accuracy) in one pass.

    The confusion cells ride along as weights of the score table, so a table that is
    scored on the fly is scored once.
    """
    said_yes = F.col(prediction) == 1
    weights = {
        "pos": F.when(F.col(y) == 1, 1).otherwise(0),
        "neg": F.when(F.col(y) == 0, 1).otherwise(0),
        "tp": F.when((F.col(y) == 1) & said_yes, 1).otherwise(0),
        "fp": F.when((F.col(y) == 0) & said_yes, 1).otherwise(0),
    }
    table = prefix_counts(df, group, score, weights, n_groups=n_groups)
    sums = table.groupBy(*group).agg(
        _wins().alias("_w"), *[F.max(f"{w}_total").alias(f"_{w}") for w in weights]
    )
    pos, neg, tp, fp = (F.col(f"_{w}") for w in weights)
    labels = _macro_columns(neg - fp, fp, pos - tp, tp)
    named = {"roc_auc": _area(F.col("_w"), pos, neg), **labels}
    order = ["roc_auc", "f1_macro", "precision_macro", "recall_macro", "accuracy"]
    return sums.select(*group, *[named[m].alias(m) for m in order])


# --- comparisons --------------------------------------------------------------------


def to_metric_rows(wide: DataFrame, group: list[str], metrics: list[str]) -> DataFrame:
    """(group, metric, value)."""
    return wide.select(*group, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        group, metrics, "metric", "value"
    )


def comparison_table(wide: DataFrame, group: list[str], metrics: list[str], digits: int = 4) -> DataFrame:
    return wide.select(*group, *[F.round(F.col(m), digits).alias(m) for m in metrics])


def best_per_metric(rows: DataFrame, model: str = "model") -> DataFrame:
    """(metric, best_model, best_value); on equal values the first name wins."""
    order = F.min(F.struct((-F.col("value")).alias("v"), F.col(model).alias("m")))
    best = rows.where(F.col("value").isNotNull()).groupBy("metric").agg(order.alias("b"))
    return best.select("metric", F.col("b.m").alias("best_model"), (-F.col("b.v")).alias("best_value"))


def gain_over(rows: DataFrame, baseline: str, model: str = "model") -> DataFrame:
    """(model, metric, value, gain_pp): percentage points above the baseline's value."""
    base = rows.where(F.col(model) == baseline).groupBy("metric").agg(F.max("value").alias("base"))
    return rows.join(base, "metric", "left").select(
        model, "metric", "value", (100.0 * (F.col("value") - F.col("base"))).alias("gain_pp")
    )


def metric_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(metric, before, after, delta) of two (metric, value) tables."""
    return before.select("metric", F.col("value").alias("before")).join(
        after.select("metric", F.col("value").alias("after")), "metric", "left"
    ).withColumn("delta", F.col("after") - F.col("before"))


def naive_baselines(df: DataFrame, key: str, y: str, *, train: str, seed: int = 42) -> DataFrame:
    """(baseline, accuracy, n): always the majority class, and labels drawn at its training rate.

    ``train`` is a boolean column; both rules are learned there and scored on the rest.
    The random label compares a digest-derived uniform number with the training rate.
    """
    learned = df.where(F.col(train)).agg(
        F.avg(F.col(y).cast("double")).alias("rate"), F.mode(F.col(y), True).alias("majority")
    )
    uniform = F.conv(F.substring(digest(key, seed), 1, 8), 16, 10).cast("double") / float(16**8)
    # A single row by construction.
    rest = df.where(~F.col(train)).crossJoin(F.broadcast(learned))
    guess = F.when(uniform < F.col("rate"), 1).otherwise(0)
    hits = rest.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(y) == F.col("majority"), 1)).alias("majority"),
        F.count(F.when(F.col(y) == guess, 1)).alias("random"),
    )
    rows = [
        F.struct(F.lit(b).alias("baseline"), ratio0(F.col(b), F.col("n")).alias("accuracy"), F.col("n").alias("n"))
        for b in ("majority", "random")
    ]
    return hits.select(F.inline(F.array(*rows)))


def lift_over_baselines(baselines: DataFrame, accuracy: Column) -> DataFrame:
    """(baseline, accuracy, lift_pct) of a model accuracy over each naive baseline."""
    return baselines.select(
        "baseline", "accuracy", F.round(100.0 * (accuracy - F.col("accuracy")), 2).alias("lift_pct")
    )


def overfitting_score(metrics: DataFrame) -> DataFrame:
    """Add the train-test gap, five yes/no risk signs, their sum and the verdicts.

    Needs train_accuracy, test_accuracy, depth, min_leaf_rows, n_leaves.
    """
    gap = F.col("train_accuracy") - F.col("test_accuracy")
    # The bounds of the five signs and of the two verdicts.
    signs = {
        "high_train_accuracy": F.col("train_accuracy") > 0.95,
        "wide_gap": gap > 0.05,
        "deep_tree": F.col("depth") > 20,
        "tiny_leaves": F.col("min_leaf_rows") < 5,
        "many_leaves": F.col("n_leaves") > 1000,
    }
    out = metrics.withColumn("gap", gap)
    for name, sign in signs.items():
        out = out.withColumn(name, sign)
    total = reduce(lambda a, b: a + b, [F.col(s).cast("int") for s in signs])
    out = out.withColumn("risk_score", total)
    out = out.withColumn("underfitting", F.col("train_accuracy") < 0.85)
    out = out.withColumn("generalises", F.abs("gap") < 0.02)
    return out.withColumn("high_risk", F.col("risk_score") >= 3)


def low_recall(cells: DataFrame, bound: float = 0.5) -> DataFrame:
    """Add ``recall`` of the positive class and ``low_recall``: fewer than ``bound`` of the positives are found."""
    out = cells.withColumn("recall", ratio0(F.col("tp"), F.col("tp") + F.col("fn")))
    return out.withColumn("low_recall", F.col("recall") < float(bound))


def error_economics(cells: DataFrame, portfolio: int) -> DataFrame:
    """Missed and false alarms, their ratio, detected positives, and both errors on a portfolio."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    out = cells.withColumn("recall", ratio0(tp, tp + fn))
    out = out.withColumn("fp_per_fn", F.try_divide(fp, fn))
    out = out.withColumn("detected", F.floor((tp + fn) * F.col("recall") + 1e-9))
    out = out.withColumn("portfolio_missed", F.round(F.try_divide(fn * F.lit(float(portfolio)), total)))
    return out.withColumn("portfolio_alarms", F.round(F.try_divide(fp * F.lit(float(portfolio)), total)))


def fold_summary(rows: DataFrame, group: list[str]) -> DataFrame:
    """(group, metric, mean, std, low, high) over folds; population std, mean -+ 2 std."""
    out = rows.groupBy(*group, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    out = out.withColumn("low", F.col("mean") - 2 * F.col("std"))
    return out.withColumn("high", F.col("mean") + 2 * F.col("std"))


# --- thresholds, paired tests, intervals ----------------------------------------------


def threshold_costs(
    df: DataFrame,
    group: list[str],
    *,
    cost_fn: float,
    cost_fp: float,
    y: str = "y",
    score: str = "score",
    n_groups: int | None = None,
) -> DataFrame:
    """(group, threshold, fn, fp, cost) for every distinct score as decision threshold, and for infinity:
    nobody is positive."""
    points = curve_points(score_table(df, group, y, score, n_groups=n_groups), group, score)
    out = points.select(*group, "threshold", (F.col("pos_total") - F.col("tp")).alias("fn"), "fp")
    nobody = points.groupBy(*group).agg(
        F.lit(float("inf")).alias("threshold"), F.max("pos_total").alias("fn"), F.lit(0).cast("long").alias("fp")
    )
    out = out.unionByName(nobody)
    return out.withColumn("cost", F.col("fn") * float(cost_fn) + F.col("fp") * float(cost_fp))


def cheapest_threshold(costs: DataFrame, group: list[str]) -> DataFrame:
    """(group, threshold, cost) of the lowest cost; the lowest threshold on a tie."""
    # Minima of numbers are hash aggregates; of a struct all rows would be sorted.
    best = costs.groupBy(*group).agg(F.min("cost").alias("_best"))
    cheapest = join_groups(costs, best, group).where(F.col("cost") == F.col("_best"))
    return cheapest.groupBy(*group).agg(F.min("threshold").alias("threshold"), F.min("cost").alias("cost"))


def mcnemar(df: DataFrame, y: str, first: str, second: str) -> DataFrame:
    """(only_first, only_second, statistic, p_value): continuity-corrected paired test."""
    from riskframe.functions.significance import chi2_p_value

    right_1, right_2 = F.col(first) == F.col(y), F.col(second) == F.col(y)
    cells = df.agg(
        F.count(F.when(right_1 & ~right_2, 1)).alias("only_first"),
        F.count(F.when(~right_1 & right_2, 1)).alias("only_second"),
    )
    b, c = F.col("only_first"), F.col("only_second")
    gap = F.greatest(F.abs(b - c) - 1, F.lit(0)).cast("double")
    out = cells.withColumn("statistic", F.coalesce(F.try_divide(gap * gap, b + c), F.lit(0.0)))
    return out.withColumn("p_value", chi2_p_value(F.col("statistic"), F.lit(1)))


def poisson_steps() -> list[float]:
    """Cumulative Poisson(1) probabilities as far as 53 random bits can tell them from 1."""
    steps, share, k = [], math.exp(-1.0), 0
    while share > 2.0**-53:
        steps.append(share + (steps[-1] if steps else 0.0))
        k += 1
        share /= k
    return steps


def bootstrap_accuracy(
    df: DataFrame, key: str, group: list[str], *, replicates: int = 100, blocks: int | None = 1000, seed: int = 42,
    y: str = "y", prediction: str = "prediction",
) -> DataFrame:
    """(group, low, median, high): percentile interval of accuracy from a Poisson bootstrap.

    Rows fall into blocks by a hash of their key and are counted once per block; each
    replicate then weighs the blocks, so only ``blocks x replicates`` small rows per
    group are ever drawn.  Random blocks give a ratio the same spread as single rows.  ``blocks=None`` draws a
    weight for every row and replicate instead.
    """
    row_hash = F.xxhash64(F.lit(seed), F.col(key))
    block = (row_hash if blocks is None else F.pmod(row_hash, F.lit(blocks))).alias("_block")
    hit = F.when(F.col(y) == F.col(prediction), 1).otherwise(0)
    cells = df.groupBy(*group, block).agg(F.count(F.lit(1)).alias("_n"), F.sum(hit).alias("_k"))
    drawn = cells.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    bits = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_rep"), F.col("_block")), F.lit(2**53))
    weight = reduce(lambda a, b: a + b, [F.when(F.col("_bits") > int(s * 2**53), 1).otherwise(0) for s in poisson_steps()])
    drawn = drawn.withColumn("_bits", bits).withColumn("_w", weight)
    per = drawn.groupBy(*group, "_rep").agg(
        F.try_divide(F.sum(F.col("_w") * F.col("_k")), F.sum(F.col("_w") * F.col("_n"))).alias("_accuracy")
    )
    # ``replicates`` values per group: a small exact percentile.
    q = per.groupBy(*group).agg(F.percentile("_accuracy", [0.025, 0.5, 0.975]).alias("_q"))
    return q.select(*group, *[F.col("_q")[i].alias(n) for i, n in enumerate(("low", "median", "high"))])
