"""Two-sample drift: Kolmogorov-Smirnov, chi-square, model metrics, retraining rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.significance import chi2_p_value, is_degraded, is_significant, ks_exact_p_value, ks_p_value
from riskframe.operators.prefix import exact_quantiles, number, prefix_counts
from riskframe.roles import Roles
from riskframe.session import ship


def stack_sides(
    reference: DataFrame, current: DataFrame, features: list[str], to_type: str, keep: list[str] | None = None
) -> DataFrame:
    """(keep..., side, feature, value): side 0 is the reference, 1 the current table."""
    keep = keep or []

    def side(df: DataFrame, flag: int) -> DataFrame:
        def cell(c: str) -> Column:
            return number(F.col(f"`{c}`")) if to_type == "double" else F.col(f"`{c}`").cast(to_type)

        wide = df.select(*keep, *[cell(c).alias(c) for c in features])
        return wide.unpivot(keep, features, "feature", "value").withColumn("side", F.lit(flag))

    return side(reference, 0).unionByName(side(current, 1)).where(F.col("value").isNotNull())


def _side_weights() -> dict[str, Column]:
    return {
        "ref": F.when(F.col("side") == 0, 1).otherwise(0),
        "cur": F.when(F.col("side") == 1, 1).otherwise(0),
    }


# Rows per side up to which the p-value is exact; beyond that it is asymptotic.
EXACT_ROWS = 10_000


def ks_statistics(
    stacked: DataFrame,
    group: list[str],
    *,
    n_groups: int | None = None,
    weight: Column | None = None,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """(group, statistic, p_value) of rows (group..., side, value [, weight]).

    Null for a group with an empty side.
    """
    weights = _side_weights()
    if weight is not None:
        weights = {k: w * weight for k, w in weights.items()}
    table = prefix_counts(stacked, group, "value", weights, n_groups=n_groups)
    gap = F.abs(
        F.try_divide(F.col("ref_before") + F.col("ref"), F.col("ref_total"))
        - F.try_divide(F.col("cur_before") + F.col("cur"), F.col("cur_total"))
    )
    out = table.groupBy(*group).agg(
        F.max(gap).alias("statistic"), F.max("ref_total").alias("n_ref"), F.max("cur_total").alias("n_cur")
    )
    return _with_ks_p_value(out, exact_rows).select(*group, "statistic", "p_value")


def _with_ks_p_value(tests: DataFrame, exact_rows: int) -> DataFrame:
    """Add ``p_value`` to (statistic, n_ref, n_cur): exact up to ``exact_rows`` per side, else asymptotic."""
    sizes = (F.col("statistic"), F.col("n_ref"), F.col("n_cur"))
    p = F.when(F.col("statistic").isNotNull(), ks_p_value(*sizes))
    if exact_rows:
        ship(tests.sparkSession)
        few = F.greatest("n_ref", "n_cur") <= exact_rows
        # Larger tests are not handed to the exact form at all.
        tests = tests.withColumn("_exact", ks_exact_p_value(*[F.when(few, c) for c in sizes]))
        p = F.coalesce(F.nanvl("_exact", F.lit(None).cast("double")), p)
    return tests.withColumn("p_value", p)


def ks_drift(reference: DataFrame, current: DataFrame, features: list[str], *, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """(feature, statistic, p_value), all continuous features in one shuffle."""
    stacked = stack_sides(reference, current, features, "double")
    return ks_statistics(stacked, ["feature"], n_groups=len(features), exact_rows=exact_rows)


def category_counts(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value, ref, cur): aligned counts, 0 where a side lacks the category."""
    stacked = stack_sides(reference, current, features, "string")
    return stacked.groupBy("feature", "value").agg(*[F.sum(w).alias(n) for n, w in _side_weights().items()])


def _chi2_columns(ref_total: Column, cur_total: Column, k: Column, part: Column, first_ref: Column, first_cur: Column):
    """(statistic, dof) from sums over categories.

    ``part`` is the sum of ref^2 / (ref + cur).  In a 2 x 2 table every cell deviates by
    the same amount, so one category stands for both; each deviation is moved half a
    count towards zero.  A single category or an empty side gives (0, 0).
    """
    r, c = ref_total.cast("double"), cur_total.cast("double")
    n = r + c
    degenerate = (k < 2) | (r == 0) | (c == 0)
    plain = F.try_divide(n * n, r * c) * (part - F.try_divide(r * r, n))
    first = (first_ref + first_cur).cast("double")
    deviation = F.abs(first_ref - F.try_divide(r * first, n))
    moved = deviation - F.least(F.lit(0.5), deviation)
    corrected = F.try_divide(moved * moved * n * n * n, r * c * first * (n - first))
    statistic = F.when(degenerate, 0.0).when(k == 2, corrected).otherwise(F.greatest(plain, F.lit(0.0)))
    return statistic, F.when(degenerate, 0).otherwise(k - 1).cast("long")


def chi2_statistics(counts: DataFrame, group: list[str]) -> DataFrame:
    """(group, statistic, dof, p_value) from aligned counts (group..., value, ref, cur)."""
    totals = counts.groupBy(*group).agg(
        F.sum("ref").alias("_r"),
        F.sum("cur").alias("_c"),
        F.count(F.lit(1)).alias("_k"),
        F.sum(F.col("ref") * (F.col("ref") / (F.col("ref") + F.col("cur")))).alias("_part"),
        F.min(F.struct("value", "ref", "cur")).alias("_first"),
    )
    statistic, dof = _chi2_columns(
        F.col("_r"), F.col("_c"), F.col("_k"), F.col("_part"), F.col("_first.ref"), F.col("_first.cur")
    )
    out = totals.select(*group, statistic.alias("statistic"), dof.alias("dof"))
    return out.withColumn("p_value", chi2_p_value(F.col("statistic"), F.col("dof")))


def chi2_drift(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """(feature, statistic, dof, p_value), all categorical features in one shuffle."""
    return chi2_statistics(category_counts(reference, current, features), ["feature"])


# --- many groups against one reference --------------------------------------------------


def ks_against_reference(
    reference: DataFrame, current: DataFrame, group: list[str], *, n_features: int | None = None
) -> DataFrame:
    """(group, feature, statistic, p_value) of histograms (group..., feature, value, n).

    ``reference`` is (feature, value, n).  The largest gap lies at a current value or just
    before one, so the reference counts are looked up at current values only; the
    reference is not repeated per group.
    """
    both = reference.select("feature", "value", F.col("n").alias("ref"), F.lit(0).alias("cur")).unionByName(
        current.select("feature", "value", F.lit(0).cast("long").alias("ref"), F.lit(1).alias("cur"))
    )
    looked_up = prefix_counts(both, ["feature"], "value", {"ref": F.col("ref"), "cur": F.col("cur")}, n_groups=n_features)
    looked_up = looked_up.select("feature", "value", "ref", "ref_before", "ref_total")
    own = prefix_counts(current, [*group, "feature"], "value", {"cur": F.col("n")})
    joined = own.join(looked_up, ["feature", "value"])
    share_cur_before = F.try_divide("cur_before", "cur_total")
    share_cur = F.try_divide(F.col("cur_before") + F.col("cur"), F.col("cur_total"))
    share_ref_before = F.try_divide("ref_before", "ref_total")
    share_ref = F.try_divide(F.col("ref_before") + F.col("ref"), F.col("ref_total"))
    gap = F.greatest(F.abs(share_cur - share_ref), F.abs(share_cur_before - share_ref_before))
    out = joined.groupBy(*group, "feature").agg(
        F.max(gap).alias("statistic"), F.max("ref_total").alias("n_ref"), F.max("cur_total").alias("n_cur")
    )
    return _with_ks_p_value(out, EXACT_ROWS).select(*group, "feature", "statistic", "p_value")


def chi2_against_reference(reference: DataFrame, current: DataFrame, group: list[str]) -> DataFrame:
    """(group, feature, statistic, dof, p_value) of category counts (group..., feature, value, n).

    Categories only the reference has enter through its total, so they need no row per
    group.
    """
    ref = reference.select("feature", "value", F.col("n").alias("ref"))
    ref_totals = ref.groupBy("feature").agg(F.sum("ref").alias("_r"), F.count(F.lit(1)).alias("_k_ref"))
    matched = current.join(ref, ["feature", "value"], "left").withColumn("ref", F.coalesce("ref", F.lit(0)))
    sums = matched.groupBy(*group, "feature").agg(
        F.sum("n").alias("_c"),
        F.sum("ref").alias("_seen"),
        F.count(F.when(F.col("ref") == 0, 1)).alias("_new"),
        F.sum(F.col("ref") * (F.col("ref") / (F.col("ref") + F.col("n")))).alias("_part"),
        F.min(F.struct("value", "ref", "n")).alias("_first"),
    )
    joined = sums.join(ref_totals, "feature")
    statistic, dof = _chi2_columns(
        F.col("_r"),
        F.col("_c"),
        F.col("_k_ref") + F.col("_new"),
        F.col("_part") + (F.col("_r") - F.col("_seen")),
        F.col("_first.ref"),
        F.col("_first.n"),
    )
    out = joined.select(*group, "feature", statistic.alias("statistic"), dof.alias("dof"))
    return out.withColumn("p_value", chi2_p_value(F.col("statistic"), F.col("dof")))


def histogram_drift(
    reference: DataFrame, current: DataFrame, group: list[str], continuous: list[str], categorical: list[str],
    alpha: float = 0.05,
) -> DataFrame:
    """(group, feature, test, statistic, p_value, drift_detected) from stored histograms.

    Values are text in both histograms; continuous ones are read as doubles.
    """

    def numeric(df: DataFrame) -> DataFrame:
        return df.where(F.col("feature").isin(continuous)).withColumn("value", F.col("value").cast("double"))

    def nominal(df: DataFrame) -> DataFrame:
        return df.where(F.col("feature").isin(categorical))

    parts = []
    if continuous:
        ks = ks_against_reference(numeric(reference), numeric(current), group, n_features=len(continuous))
        parts.append(ks.select(*group, "feature", F.lit("ks").alias("test"), "statistic", "p_value"))
    if categorical:
        chi2 = chi2_against_reference(nominal(reference), nominal(current), group)
        parts.append(chi2.select(*group, "feature", F.lit("chi2").alias("test"), "statistic", "p_value"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.withColumn("drift_detected", is_significant(F.col("p_value"), alpha))


def feature_histogram(df: DataFrame, features: list[str], group: list[str] | None = None) -> DataFrame:
    """(group..., feature, value, n) with values as text; works on a stream as well."""
    group = group or []
    wide = df.select(*group, *[F.col(f"`{c}`").cast("string").alias(c) for c in features])
    long = wide.unpivot(group, features, "feature", "value").where(F.col("value").isNotNull())
    return long.groupBy(*group, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def count_windows(df: DataFrame, key: str, size: int = 10_000, start: int = 0) -> DataFrame:
    """(key, window_id): consecutive windows of ``size`` rows by ascending numeric key.

    ``start`` rows came before this table.
    """
    keyed = df.select(F.lit("all").alias("_all"), key)
    ranked = prefix_counts(keyed, ["_all"], key, {"n": F.lit(1)}, n_groups=1)
    return ranked.select(key, F.floor((F.col("n_before") + start) / size).cast("long").alias("window_id"))


def data_drift(reference: DataFrame, current: DataFrame, roles: Roles, alpha: float = 0.05) -> DataFrame:
    """(feature, test, statistic, p_value, drift_detected); absent columns are skipped."""
    found = roles.for_drift().present_in(reference, current)
    parts = []
    if found.continuous:
        ks = ks_drift(reference, current, found.continuous)
        parts.append(ks.select("feature", F.lit("ks").alias("test"), "statistic", "p_value"))
    if found.categorical:
        chi2 = chi2_drift(reference, current, found.categorical)
        parts.append(chi2.select("feature", F.lit("chi2").alias("test"), "statistic", "p_value"))
    if not parts:
        raise ValueError("none of the features is in both tables")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.withColumn("drift_detected", is_significant(F.col("p_value"), alpha))


def drift_summary(report: DataFrame) -> DataFrame:
    """(n_tested, n_drifted, drifted): names joined in order, one row per report feature."""
    return report.agg(
        F.count(F.lit(1)).alias("n_tested"),
        F.count(F.when(F.col("drift_detected"), 1)).alias("n_drifted"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))), ",").alias(
            "drifted"
        ),
    )


def drift_metric_rows(report: DataFrame) -> DataFrame:
    """(key, value): one p-value metric per feature, for the run log."""
    return report.select(
        F.concat(F.lit("pval_"), "feature").alias("key"), F.col("p_value").alias("value")
    )


def model_drift(baseline: DataFrame, current: DataFrame, threshold: float = 0.05) -> DataFrame:
    """(model, reference_roc_auc, current_roc_auc, delta_roc_auc, threshold, drift_detected).

    Both inputs are (model, roc_auc).  A model without current metrics is compared with
    itself.  The flag uses the unrounded difference and a strict comparison.
    """
    both = baseline.select("model", F.col("roc_auc").alias("reference_roc_auc")).join(
        current.select("model", F.col("roc_auc").alias("_cur")), "model", "left"
    )
    both = both.withColumn("current_roc_auc", F.coalesce("_cur", "reference_roc_auc"))
    delta = F.col("current_roc_auc") - F.col("reference_roc_auc")
    return both.select(
        "model",
        "reference_roc_auc",
        "current_roc_auc",
        F.round(delta, 6).alias("delta_roc_auc"),
        F.lit(float(threshold)).alias("threshold"),
        is_degraded(delta, threshold).alias("drift_detected"),
    )


def retraining_triggers(
    report: DataFrame,
    model_report: DataFrame,
    latencies: DataFrame,
    *,
    critical: list[str],
    latency: str = "latency_ms",
) -> DataFrame:
    """(rule, observed, fired, action): the documented rules over three finished tables."""
    features = report.agg(
        F.count(F.when(F.col("drift_detected"), 1)).cast("double").alias("n"),
        F.count(F.when(F.col("drift_detected") & F.col("feature").isin(critical), 1)).cast("double").alias("crit"),
    )
    drop = model_report.agg(F.max(F.col("reference_roc_auc") - F.col("current_roc_auc")).alias("drop"))
    timed = latencies.select(F.lit("all").alias("_all"), F.col(latency).cast("double").alias("_ms"))
    slow = exact_quantiles(timed, ["_all"], "_ms", {"p95": 0.95}, n_groups=1).select("p95")
    n = F.col("n")
    tier = F.when(n == 0, "none").when(n < 5, "watch").otherwise("retrain")
    # Three one-row tables.
    facts = features.crossJoin(F.broadcast(drop)).crossJoin(F.broadcast(slow))

    def rule(name: str, observed: Column, fired: Column, action: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"), observed.alias("observed"), fired.alias("fired"), action.alias("action")
        )

    rows = [
        rule("critical_feature_drift", F.col("crit"), F.col("crit") > 0, F.lit("retrain")),
        rule("many_features_drift", n, n >= 5, F.lit("retrain")),
        rule("auc_drop_mandatory", F.round("drop", 6), F.col("drop") > 0.05, F.lit("retrain")),
        rule("auc_drop_alert", F.round("drop", 6), F.col("drop") > 0.03, F.lit("alert")),
        rule("latency_p95", F.col("p95"), F.col("p95") > 500, F.lit("alert")),
        rule("feature_tier", n, n > 0, tier),
    ]
    return facts.select(F.inline(F.array(*rows)))
