"""p-values of the drift tests.

Both tails are column expressions over a finished test table of one row per feature.
Spark SQL has no complementary error function, so it is built from array folds here.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_significant(p_value: Column, alpha: float) -> Column:
    """Strictly below alpha; a missing p-value stays missing."""
    return p_value < F.lit(float(alpha))


def is_degraded(delta: Column, threshold: float) -> Column:
    """A change strictly beyond the allowed drop, judged before any rounding."""
    return delta < F.lit(-float(threshold))


def ks_p_value(statistic: Column, n_ref: Column, n_cur: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value with the finite-size correction of the tail argument."""
    n = F.round(n_ref.cast("double") * n_cur / (n_ref + n_cur))
    root = F.sqrt(n) * statistic
    # With fewer than one effective row the correction is undefined.
    lam = root + F.try_divide(F.lit(1.0), 6.0 * F.sqrt(n)) + F.try_divide(root - 1.0, 4.0 * n)
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc
        + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(-2.0 * j * j * lam * lam),
    )
    p = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(2.0 * tail, F.lit(0.0)), F.lit(1.0)))
    return F.when(statistic == 0, F.lit(1.0)).otherwise(p)


def ks_exact_probability(distance: int, m: int, n: int) -> float:
    """P(largest gap >= distance / (m n)) for two samples of m and n from one distribution.

    The merged samples are a random walk from (0, 0) to (m, n); walks that keep both shares closer than the
    distance are followed step by step, all positions of a step at once.
    """
    if distance <= 0:
        return 1.0
    i = np.arange(m + 1)
    inside = np.zeros(m + 1)
    inside[0] = 1.0
    for step in range(1, m + n + 1):
        j = step - i
        left = m + n - step + 1
        from_first = np.zeros(m + 1)
        from_first[1:] = inside[:-1] * (m - i[:-1]) / left
        from_second = inside * np.clip(n - (j - 1), 0, None) / left
        inside = from_first + from_second
        inside[(j < 0) | (j > n) | (np.abs(i * n - j * m) >= distance)] = 0.0
    return float(min(1.0, max(0.0, 1.0 - inside[m])))


@F.pandas_udf(T.DoubleType())
def ks_exact_p_value(statistic: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    """Exact two-sample p-value of finished tests: one row per feature, samples of a bounded size."""
    return pd.Series(
        [
            None if pd.isna(s) or not m or not n else ks_exact_probability(round(s * m * n), int(m), int(n))
            for s, m, n in zip(statistic, n_ref, n_cur)
        ],
        dtype="float64",
    )


def erfc(z: Column) -> Column:
    """Complementary error function of a non-negative column.

    Below 3 a series of positive terms gives ``erf``; above, a continued fraction
    evaluated from its tail gives ``erfc`` without cancellation.
    """
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(70)),
        F.struct(z.alias("total"), z.alias("term")),
        lambda acc, n: F.struct(
            (acc["total"] + acc["term"] * 2.0 * z * z / (2 * n + 1)).alias("total"),
            (acc["term"] * 2.0 * z * z / (2 * n + 1)).alias("term"),
        ),
        lambda acc: acc["total"],
    )
    fraction = F.aggregate(
        F.sequence(F.lit(60), F.lit(1), F.lit(-1)), z, lambda f, k: z + k / (2.0 * f)
    )
    scale = F.exp(-z * z) / math.sqrt(math.pi)
    return F.when(z < 3.0, 1.0 - 2.0 * scale * series).otherwise(scale / fraction)


def chi2_p_value(statistic: Column, dof: Column) -> Column:
    """Upper chi-square tail for a whole number of degrees of freedom; 1 when there are none."""
    half = statistic / 2.0
    odd = dof % 2 == 1
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(1.0))
    first = F.when(odd, 0.5 * F.log(half) - half - math.lgamma(1.5)).otherwise(F.log(half) - half)
    steps = F.when(odd, F.floor((dof + 1) / 2) - 1).otherwise(F.floor(dof / 2) - 1).cast("int")
    start = F.when(odd, erfc(F.sqrt(half))).otherwise(F.exp(-half))
    series = F.aggregate(
        F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
        F.struct(start.alias("total"), first.alias("log_term")),
        lambda acc, i: F.struct(
            (acc["total"] + F.exp(acc["log_term"])).alias("total"),
            (acc["log_term"] + F.log(half) - F.log(i + shift)).alias("log_term"),
        ),
        lambda acc: acc["total"],
    )
    return F.when((dof <= 0) | (statistic <= 0), F.lit(1.0)).otherwise(F.least(series, F.lit(1.0)))
