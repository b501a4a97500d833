"""Confidence intervals of metrics, and differences between models on the same rows.

Areas under the ROC curve get DeLong intervals: the placement of a positive is the share of negatives it outranks
(ties count half), the area is the mean of the placements, and its variance follows from theirs.  Placements depend on
the score alone, so they are sums over the table of distinct scores that the area itself is read from; only the
covariance of two models needs their rows side by side.

F1 and its relatives are functions of the four confusion cells, so rows need not be drawn again: a bootstrap sample of
n rows is one multinomial draw of the cells.  Besides, F1 has a closed form for large samples.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.significance import chi2_p_value
from riskframe.operators.evaluation import _macro_columns, binary_metrics, confusion, score_table
from riskframe.operators.prefix import join_groups
from riskframe.session import materialise, ship

CELLS = ("tn", "fp", "fn", "tp")


def quantile_of_normal(level: float) -> float:
    """How many standard errors an interval of this level reaches to either side."""
    if not 0 < level < 1:
        raise ValueError(f"a level lies between 0 and 1, not {level}")
    return NormalDist().inv_cdf((1 + level) / 2)


def _placements() -> dict[str, Column]:
    """Shares of the other class that a positive outranks, and that outrank a negative; ties count half."""
    above = F.col("pos_total") - F.col("pos_before") - F.col("pos") / 2.0
    return {
        "of_pos": F.try_divide(F.col("neg_before") + F.col("neg") / 2.0, "neg_total"),
        "of_neg": F.try_divide(above, "pos_total"),
    }


def _around(value: Column, error: Column, level: float) -> tuple[Column, Column]:
    """Both ends; a missing error leaves the interval open to 0 and 1."""
    reach = quantile_of_normal(level) * error
    return F.greatest(value - reach, F.lit(0.0)), F.least(value + reach, F.lit(1.0))


def auc_intervals(
    df: DataFrame, group: list[str], y: str = "y", score: str = "score", *, level: float = 0.95, n_groups: int | None = None
) -> DataFrame:
    """(group, roc_auc, std_error, low, high).

    Null where a class is absent; the error is null too where a class has a single row.
    """
    table = score_table(df, group, y, score, n_groups=n_groups).withColumns(_placements())
    sums = table.groupBy(*group).agg(
        *[F.max(f"{w}_total").cast("double").alias(f"_{w}") for w in ("pos", "neg")],
        *[F.sum(F.col(w) * F.col(f"of_{w}")).alias(f"_{w}1") for w in ("pos", "neg")],
        *[F.sum(F.col(w) * F.col(f"of_{w}") * F.col(f"of_{w}")).alias(f"_{w}2") for w in ("pos", "neg")],
    )

    def variance(w: str) -> Column:
        n = F.col(f"_{w}")
        spread = F.greatest(F.col(f"_{w}2") - F.col(f"_{w}1") * F.col(f"_{w}1") / n, F.lit(0.0))
        return F.try_divide(F.try_divide(spread, n - 1), n)

    found = sums.select(
        *group, F.try_divide("_pos1", "_pos").alias("roc_auc"), F.sqrt(variance("pos") + variance("neg")).alias("std_error")
    )
    found = found.withColumn("std_error", F.when(F.col("roc_auc").isNotNull(), F.col("std_error")))
    low, high = _around(F.col("roc_auc"), F.col("std_error"), level)
    known = F.col("std_error").isNotNull()
    return found.withColumns({"low": F.when(known, low), "high": F.when(known, high)})


def auc_differences(
    df: DataFrame,
    key: str,
    models: list[str],
    model: str = "model",
    y: str = "y",
    score: str = "score",
    *,
    level: float = 0.95,
) -> DataFrame:
    """(first, second, auc_first, auc_second, difference, std_error, low, high, z, p_value) of every pair of models.

    Rows (key, model, y, score); keys that one of the models did not score take no part, so both areas are over
    the same rows.  ``z`` and ``p_value`` are null where the models rank all rows alike.
    """
    wide = df.where(F.col(model).isin(models) & F.col(score).isNotNull() & F.col(y).isin(0, 1)).groupBy(F.col(key).alias("_key"))
    wide = wide.agg(F.max(y).alias("_y"), *[F.max(F.when(F.col(model) == m, F.col(score).cast("double"))).alias(f"_s{i}") for i, m in enumerate(models)])
    names = [f"_s{i}" for i in range(len(models))]
    long = materialise(wide.na.drop(subset=names).unpivot(["_key", "_y"], names, "_model", "_score"), "auc-rows")
    table = score_table(long, ["_model"], "_y", "_score", n_groups=len(models)).select("_model", "_score", *[p.alias(n) for n, p in _placements().items()])
    # Written, so that a score which many rows share can be dealt to several tasks.
    table = materialise(table, "auc-placements")
    placed = long.join(table, ["_model", "_score"]).withColumn("_p", F.when(F.col("_y") == 1, F.col("of_pos")).otherwise(F.col("of_neg")))
    rows = placed.groupBy("_key", "_y").agg(*[F.max(F.when(F.col("_model") == n, F.col("_p"))).alias(n) for n in names])
    pairs = list(combinations(range(len(models)), 2))
    # One row per class: means and covariances of the placements.
    moments = rows.groupBy("_y").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.avg(n).alias(f"_m{n}") for n in names],
        *[F.covar_samp(f"_s{i}", f"_s{j}").alias(f"_c{i}_{j}") for i in range(len(models)) for j in range(i, len(models))],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(models[i]).alias("first"),
                F.lit(models[j]).alias("second"),
                F.col(f"_m_s{i}").alias("a"),
                F.col(f"_m_s{j}").alias("b"),
                (F.try_divide(F.col(f"_c{i}_{i}") + F.col(f"_c{j}_{j}") - 2 * F.col(f"_c{i}_{j}"), F.col("_n"))).alias("v"),
            )
            for i, j in pairs
        ]
    )
    per_class = moments.select("_y", F.inline(entries)).groupBy("first", "second")
    found = per_class.agg(
        F.max(F.when(F.col("_y") == 1, F.col("a"))).alias("auc_first"),
        F.max(F.when(F.col("_y") == 1, F.col("b"))).alias("auc_second"),
        F.sum(F.greatest("v", F.lit(0.0))).alias("_v"),
        F.count("v").alias("_classes"),
    ).where(F.col("_classes") == 2)
    difference = F.col("auc_first") - F.col("auc_second")
    found = found.select("first", "second", "auc_first", "auc_second", difference.alias("difference"), F.sqrt("_v").alias("std_error"))
    reach = quantile_of_normal(level) * F.col("std_error")
    z = F.try_divide(F.col("difference"), F.col("std_error"))
    found = found.withColumns({"low": F.col("difference") - reach, "high": F.col("difference") + reach, "z": z})
    return found.withColumn("p_value", F.when(F.col("z").isNotNull(), chi2_p_value(F.col("z") * F.col("z"), F.lit(1))))


def f1_intervals(cells: DataFrame, group: list[str], *, level: float = 0.95) -> DataFrame:
    """(group, metric, value, std_error, low, high) of F1 and macro F1 from confusion cells, for large samples.

    Derivatives of F1 by the shares of the four cells, weighted with their multinomial variance; the mixed terms
    cancel.  Null where F1 has no denominator.
    """
    tn, tp = F.col("tn").cast("double"), F.col("tp").cast("double")
    wrong = (F.col("fp") + F.col("fn")).cast("double")

    def slope(numerator: Column, hits: Column) -> Column:
        return F.try_divide(numerator, (2 * hits + wrong) * (2 * hits + wrong))

    value = {k: F.try_divide(2 * hits, 2 * hits + wrong) for k, hits in (("one", tp), ("zero", tn))}
    one = 4 * (tp * slope(wrong, tp) * slope(wrong, tp) + wrong * slope(tp, tp) * slope(tp, tp))
    lost = slope(tp, tp) + slope(tn, tn)
    both = tp * slope(wrong, tp) * slope(wrong, tp) + tn * slope(wrong, tn) * slope(wrong, tn) + wrong * lost * lost
    rows = F.array(
        F.struct(F.lit("f1").alias("metric"), value["one"].alias("value"), F.sqrt(one).alias("std_error")),
        F.struct(F.lit("f1_macro").alias("metric"), ((value["one"] + value["zero"]) / 2).alias("value"), F.sqrt(both).alias("std_error")),
    )
    found = cells.select(*group, F.inline(rows))
    low, high = _around(F.col("value"), F.col("std_error"), level)
    known = F.col("std_error").isNotNull()
    return found.withColumns({"low": F.when(known, low), "high": F.when(known, high)})


def resampled_cells(cells: DataFrame, group: list[str], replicates: int = 1000, seed: int = 42) -> DataFrame:
    """(group, replicate, tn, fp, fn, tp): confusion cells of ``replicates`` bootstrap samples of the rows.

    Drawn per group from a generator seeded by the group's values, so a repeated task draws the same.
    """
    ship(cells.sparkSession)
    keyed = cells.select(*group, *[F.col(c).cast("long").alias(c) for c in CELLS], F.xxhash64(F.lit(seed), *group).alias("_seed"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = np.array([batch.column(c)[i].as_py() or 0 for c in CELLS], np.int64)
                n = int(counts.sum())
                made = np.random.default_rng(batch.column("_seed")[i].as_py() % 2**64).multinomial(n, counts / max(n, 1), size=replicates) if n else np.zeros((replicates, 4), np.int64)
                row = batch.slice(i, 1).select(group).take(pa.array(np.zeros(replicates, np.int64))) if group else None
                columns = [*(row.columns if row is not None else []), pa.array(np.arange(1, replicates + 1), pa.int32())]
                columns += [pa.array(made[:, k], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(columns, names=[*group, "replicate", *CELLS])

    fields = [keyed.schema[g] for g in group]
    kind = T.StructType([*fields, T.StructField("replicate", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in CELLS]])
    return keyed.mapInArrow(draw, kind)


def bootstrap_intervals(
    df: DataFrame,
    group: list[str],
    y: str = "y",
    prediction: str = "prediction",
    *,
    replicates: int = 1000,
    level: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """(group, metric, value, low, median, high): percentile intervals of all label metrics."""
    metrics = ["accuracy", "precision", "recall", "f1", "precision_macro", "recall_macro", "f1_macro"]

    def measured(cells: DataFrame, keep: list[str]) -> DataFrame:
        macro = _macro_columns(*(F.col(c) for c in CELLS))
        wide = binary_metrics(cells).withColumns({m: macro[m] for m in metrics if m.endswith("_macro")})
        return wide.select(*keep, *metrics).unpivot(keep, metrics, "metric", "value")

    cells = materialise(confusion(df, group, y, prediction), "cells")
    drawn = measured(resampled_cells(cells, group, replicates, seed), [*group, "replicate"])
    ends = [(1 - level) / 2, 0.5, (1 + level) / 2]
    # ``replicates`` values per group and metric: a small exact percentile.
    spread = drawn.groupBy(*group, "metric").agg(F.percentile("value", ends).alias("_q"))
    out = join_groups(measured(cells, group), spread, [*group, "metric"])
    return out.select(*group, "metric", "value", *[F.col("_q")[i].alias(n) for i, n in enumerate(("low", "median", "high"))])
