"""Table profiling: class balance, quartiles, outliers, correlation, rates, histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators import contracts
from riskframe.operators.prefix import exact_quantiles, number, prefix_counts, to_long, value_histogram
from riskframe.roles import numeric_columns

# --- counts -------------------------------------------------------------------------


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing cells, their count and the two totals, one row per column."""
    counts = contracts.missing_counts(df)
    return counts.where(F.col("n_missing") > 0)


def missing_summary(df: DataFrame) -> DataFrame:
    """(n_missing_total, n_cols_with_missing)."""
    return contracts.missing_counts(df).agg(
        F.sum("n_missing").alias("n_missing_total"),
        F.count(F.when(F.col("n_missing") > 0, 1)).alias("n_cols_with_missing"),
    )


def class_balance(df: DataFrame, target: str, threshold: float = 0.20) -> DataFrame:
    """(label, n, ratio, is_minority, imbalance_warning), ratio to 4 digits.

    The minority class is the rarest; on a tie the smallest label.  Rows without a label are no class;
    ``missing_report`` counts them.
    """
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    shares = counts.withColumn(
        "ratio", F.round(F.col("n") / F.sum("n").over(everything), 4)
    ).withColumn("_rarest", F.min(F.struct("n", "label", "ratio")).over(everything))
    return shares.select(
        "label",
        "n",
        "ratio",
        (F.col("label") == F.col("_rarest.label")).alias("is_minority"),
        (F.col("_rarest.ratio") < F.lit(float(threshold))).alias("imbalance_warning"),
    )


def basic_stats(df: DataFrame, target: str) -> DataFrame:
    """(n_samples, n_features, n_missing, n_negative, n_positive, imbalance_ratio)."""
    missing = reduce(
        lambda a, b: a + b, [F.when(contracts._is_missing(df, c), 1).otherwise(0) for c in df.columns]
    )
    out = df.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.lit(len(df.columns) - 1).cast("long").alias("n_features"),
        F.sum(missing).alias("n_missing"),
        F.count(F.when(F.col(target) == 0, 1)).alias("n_negative"),
        F.count(F.when(F.col(target) == 1, 1)).alias("n_positive"),
    )
    ratio = F.try_divide(F.col("n_negative"), F.col("n_positive"))
    return out.withColumn("imbalance_ratio", F.round(ratio, 4))


def class_share_by_split(df: DataFrame, split: str, target: str) -> DataFrame:
    """(split, label, n, share): class proportions within each split."""
    counts = df.groupBy(split, F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(split)), 6))


def frequency_tables(df: DataFrame, columns: list[str], allowed: dict[str, list[int]] | None = None) -> DataFrame:
    """(column, code, n, in_domain); ``in_domain`` is null for columns without a domain."""
    counts = contracts.code_counts(df, columns)
    verdict = F.lit(None).cast("boolean")
    for c, codes in (allowed or {}).items():
        verdict = F.when(F.col("column") == c, F.col("code").isin(codes)).otherwise(verdict)
    return counts.withColumn("in_domain", verdict)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) pairs, each once, ordered; rows rather than one array per column."""
    return to_long(df, columns).where(F.col("value").isNotNull()).distinct().withColumnRenamed(
        "feature", "column"
    ).orderBy("column", "value")


def rate_by_group(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """(feature, value, n, positive_rate) for each value of each column, one shuffle."""
    wide = df.select(
        F.col(target).cast("long").alias("_y"), *[F.col(f"`{c}`").cast("string").alias(c) for c in columns]
    )
    long = wide.unpivot(["_y"], columns, "feature", "value").where(F.col("value").isNotNull())
    sums = long.groupBy("feature", "value").agg(F.count("_y").alias("n"), F.sum("_y").alias("_pos"))
    return sums.select("feature", "value", "n", F.round(F.try_divide("_pos", "n"), 4).alias("positive_rate"))


# --- distribution -------------------------------------------------------------------

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def quartiles(df: DataFrame, columns: list[str], *, approximate: bool = False, accuracy: int = 10000) -> DataFrame:
    """(feature, q1, median, q3, iqr), linear interpolation.

    Exact by default.  ``approximate=True`` trades that for a single sketch pass.
    """
    long = to_long(df, columns)
    if approximate:
        out = long.groupBy("feature").agg(
            F.percentile_approx("value", list(QUARTILES.values()), accuracy).alias("_q")
        )
        out = out.select("feature", *[F.col("_q")[i].alias(n) for i, n in enumerate(QUARTILES)])
    else:
        out = exact_quantiles(long, ["feature"], "value", QUARTILES, n_groups=len(columns))
    return out.withColumn("iqr", F.col("q3") - F.col("q1"))


def _per_column(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """(feature, measure...) from one wide aggregate; the table is not multiplied by its columns."""
    sums = [
        f(number(F.col(f"`{c}`"))).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()
    ]
    rows = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, c in enumerate(columns)
    ]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, count, mean, std, min, q1, median, q3, max); std with n - 1."""
    moments = _per_column(
        df,
        columns,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": F.min,
            "max": F.max,
        },
    )
    long = to_long(df, columns)
    quants = exact_quantiles(long, ["feature"], "value", QUARTILES, n_groups=len(columns))
    # Both sides hold one row per feature.
    return moments.join(F.broadcast(quants), "feature").select(
        "feature", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def five_numbers_by_class(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """(feature, label, min, q1, median, q3, max) per class."""
    long = to_long(df.withColumn("label", F.col(target)), columns, keep=["label"])
    probs = {"min": 0.0, **QUARTILES, "max": 1.0}
    return exact_quantiles(long, ["feature", "label"], "value", probs)


def iqr_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, low, high): quartiles moved out by 1.5 interquartile ranges."""
    q = quartiles(df, columns)
    return q.select(
        "feature",
        (F.col("q1") - 1.5 * F.col("iqr")).alias("low"),
        (F.col("q3") + 1.5 * F.col("iqr")).alias("high"),
    )


def _outside() -> Column:
    return (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))


def outlier_rows(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, feature, value) of every cell strictly outside its feature's bounds."""
    # The bounds table has one row per listed column.
    bounds = F.broadcast(iqr_bounds(df, columns))
    return to_long(df, columns, keep=[key]).join(bounds, "feature").where(_outside()).select(key, "feature", "value")


def outlier_counts(df: DataFrame, columns: list[str], top: int | None = None) -> DataFrame:
    """(feature, n_outliers, share_pct) for features that have any, most first.

    Counts come from the histogram that also gives the quartiles, so the table is read once.  The share
    is of all rows, those without a value included.
    """
    bounds = F.broadcast(iqr_bounds(df, columns))
    per_value = value_histogram(to_long(df, columns), ["feature"], "value", {"n": F.lit(1)})
    n_rows = F.broadcast(df.agg(F.count(F.lit(1)).alias("_n")))
    counted = (
        per_value.join(bounds, "feature")
        .groupBy("feature")
        .agg(F.coalesce(F.sum(F.when(_outside(), F.col("n"))), F.lit(0)).alias("n_outliers"))
        .crossJoin(n_rows)  # one row
    )
    share = F.round(100.0 * F.col("n_outliers") / F.col("_n"), 2).alias("share_pct")
    found = counted.where(F.col("n_outliers") > 0).select("feature", "n_outliers", share)
    found = found.orderBy(F.desc("n_outliers"), "feature")
    return found.limit(top) if top else found


def equal_width_histogram(df: DataFrame, columns: list[str], bins: int = 50) -> DataFrame:
    """(feature, bin, n): bins of equal width from minimum to maximum, the last one closed."""
    long = to_long(df, columns).where(F.col("value").isNotNull())
    # One row per listed column.
    span = F.broadcast(_per_column(df, columns, {"lo": F.min, "hi": F.max}))
    width = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    position = F.floor((F.col("value") - F.col("lo")) * bins / width)
    placed = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)) + 1
    return (
        long.join(span, "feature")
        .withColumn("bin", placed.cast("long"))
        .groupBy("feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def panel_means(df: DataFrame, measures: dict[str, list[str]]) -> DataFrame:
    """(measure, period, mean) of wide panel columns; periods follow the list order."""
    names = {c: (m, i) for m, cols in measures.items() for i, c in enumerate(cols, 1)}
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names])
    rows = [
        F.struct(F.lit(m).alias("measure"), F.lit(i).alias("period"), F.col(c).alias("mean"))
        for c, (m, i) in names.items()
    ]
    return means.select(F.inline(F.array(*rows)))


# --- correlation --------------------------------------------------------------------


def target_correlation(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """(feature, corr): signed Pearson with the target, null for a constant feature.

    One aggregate over the table; ``F.corr`` is guarded because a constant column
    raises under ANSI.
    """
    y = number(F.col(f"`{target}`"))
    sums = []
    for i, c in enumerate(columns):
        x = number(F.col(f"`{c}`"))
        both = x.isNotNull() & y.isNotNull()
        sums += [
            F.covar_pop(x, y).alias(f"_c{i}"),
            F.stddev_pop(F.when(both, x)).alias(f"_x{i}"),
            F.stddev_pop(F.when(both, y)).alias(f"_y{i}"),
        ]
    flat = df.agg(*sums)
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.when(
                (F.col(f"_x{i}") > 0) & (F.col(f"_y{i}") > 0),
                F.col(f"_c{i}") / (F.col(f"_x{i}") * F.col(f"_y{i}")),
            ).alias("corr"),
        )
        for i, c in enumerate(columns)
    ]
    return flat.select(F.inline(F.array(*rows)))


def top_pearson(df: DataFrame, target: str, columns: list[str] | None = None, top: int = 10) -> DataFrame:
    """(feature, corr): absolute Pearson with the target to 4 digits, strongest first."""
    columns = columns or numeric_columns(df, exclude=[target])
    out = target_correlation(df, target, columns).withColumn("corr", F.abs("corr"))
    out = out.orderBy(F.desc_nulls_last("corr"), "feature").limit(top)
    return out.withColumn("corr", F.round("corr", 4))


def signed_ranking(df: DataFrame, target: str, columns: list[str], first: int | None = None) -> DataFrame:
    """(feature, corr) by descending signed Pearson, the first ``first`` of them."""
    out = target_correlation(df, target, columns).orderBy(F.desc_nulls_last("corr"), "feature")
    return out.limit(first) if first else out


def target_spearman(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """(feature, corr): Spearman with a numeric target, ties sharing their mean rank."""
    y = number(F.col(f"`{target}`"))
    others = df.where(y.isNotNull() & ~y.isin(0.0, 1.0))
    return _ranked_spearman(df, target, columns) if others.limit(1).count() else _folded_spearman(df, target, columns)


def _ranked_spearman(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """Any target: both sides are ranked among the rows where both have a value."""
    labelled = df.withColumn("_y", number(F.col(f"`{target}`"))).where(F.col("_y").isNotNull())
    cells = to_long(labelled, columns, keep=["_y"]).where(F.col("value").isNotNull())
    cells = cells.groupBy("feature", "value", "_y").agg(F.count(F.lit(1)).alias("_n"))
    weight = {"n": F.col("_n")}

    def ranks(column: str) -> DataFrame:
        counts = prefix_counts(cells, ["feature"], column, weight, n_groups=len(columns))
        rank = F.col("n_before") + (F.col("n") + 1) / 2.0 - (F.col("n_total") + 1) / 2.0
        return counts.select("feature", column, rank.alias(f"_rank_{column}"))

    both = cells.join(ranks("value"), ["feature", "value"]).join(ranks("_y"), ["feature", "_y"])
    rx, ry, n = F.col("_rank_value"), F.col("_rank__y"), F.col("_n")
    sums = both.groupBy("feature").agg(F.sum(n * rx * rx).alias("xx"), F.sum(n * ry * ry).alias("yy"), F.sum(n * rx * ry).alias("xy"))
    corr = F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy")))
    return sums.select("feature", corr.alias("corr"))


def _folded_spearman(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """A 0/1 target.

    The rank of a binary target takes two values, so the whole coefficient follows from
    the positives and negatives per distinct value; rows never meet their ranks.
    """
    labelled = df.withColumn("_y", number(F.col(f"`{target}`")).cast("int")).where(F.col("_y").isNotNull())
    long = to_long(labelled, columns, keep=["_y"]).where(F.col("value").isNotNull())
    weights = {"neg": F.when(F.col("_y") == 0, 1).otherwise(0), "pos": F.when(F.col("_y") == 1, 1).otherwise(0)}
    table = prefix_counts(long, ["feature"], "value", weights, n_groups=len(columns))
    n = F.col("neg") + F.col("pos")
    rank = (F.col("neg_before") + F.col("pos_before")) + (n + 1) / 2.0
    total = F.col("neg_total") + F.col("pos_total")
    # Centre the ranks: their mean is (total + 1) / 2 on both sides.
    centre = (total + 1) / 2.0
    rank_neg = (F.col("neg_total") + 1) / 2.0 - centre
    rank_pos = F.col("neg_total") + (F.col("pos_total") + 1) / 2.0 - centre
    parts = table.select(
        "feature",
        (n * (rank - centre) * (rank - centre)).alias("xx"),
        (F.col("neg") * rank_neg * rank_neg + F.col("pos") * rank_pos * rank_pos).alias("yy"),
        ((rank - centre) * (F.col("neg") * rank_neg + F.col("pos") * rank_pos)).alias("xy"),
    )
    sums = parts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("xx", "yy", "xy")])
    corr = F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy")))
    return sums.select("feature", corr.alias("corr"))


def top_spearman(df: DataFrame, target: str, columns: list[str] | None = None, top: int = 10) -> DataFrame:
    """(feature, corr): absolute Spearman with the target to 4 digits, strongest first."""
    columns = columns or numeric_columns(df, exclude=[target])
    out = target_spearman(df, target, columns).withColumn("corr", F.abs("corr"))
    out = out.orderBy(F.desc_nulls_last("corr"), "feature").limit(top)
    return out.withColumn("corr", F.round("corr", 4))


def pearson_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_a, feature_b, corr) for every ordered pair, from one aggregate.

    Each unordered pair is one moment; the mirror image and the diagonal are added to
    the single result row.
    """
    cols = {c: number(F.col(f"`{c}`")) for c in columns}
    sums, rows = [], []

    def entry(a: str, b: str, corr: Column) -> Column:
        return F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), corr.alias("corr"))

    for i, a in enumerate(columns):
        sums.append(F.stddev_pop(cols[a]).alias(f"_s{i}"))
        rows.append(entry(a, a, F.when(F.col(f"_s{i}") > 0, F.lit(1.0))))
        for j in range(i):
            b = columns[j]
            both = cols[a].isNotNull() & cols[b].isNotNull()
            sums.append(F.covar_pop(cols[a], cols[b]).alias(f"_c{i}_{j}"))
            sums.append(F.stddev_pop(F.when(both, cols[a])).alias(f"_a{i}_{j}"))
            sums.append(F.stddev_pop(F.when(both, cols[b])).alias(f"_b{i}_{j}"))
            sa, sb = F.col(f"_a{i}_{j}"), F.col(f"_b{i}_{j}")
            corr = F.when((sa > 0) & (sb > 0), F.col(f"_c{i}_{j}") / (sa * sb))
            rows += [entry(a, b, corr), entry(b, a, corr)]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


# --- everything at once -------------------------------------------------------------


def diagnostics(
    df: DataFrame,
    target: str,
    *,
    sensitive: list[str],
    columns: list[str] | None = None,
    top: int = 10,
) -> DataFrame:
    """All quality checks in long form: (check, item, measure, value)."""
    columns = columns or numeric_columns(df, exclude=[target])

    def rows(frame: DataFrame, check: str, item: Column, measures: dict[str, Column]) -> DataFrame:
        entries = [
            F.struct(F.lit(m).alias("measure"), v.cast("double").alias("value")) for m, v in measures.items()
        ]
        return frame.select(
            F.lit(check).alias("check"), item.cast("string").alias("item"), F.inline(F.array(*entries))
        )

    parts = [
        rows(missing_summary(df), "missing", F.lit("table"), {
            "n_missing_total": F.col("n_missing_total"),
            "n_cols_with_missing": F.col("n_cols_with_missing"),
        }),
        rows(contracts.duplicate_count(df), "duplicates", F.lit("table"), {
            "n_duplicate_rows": F.col("n_duplicate_rows"),
            "duplicate_ratio": F.col("duplicate_ratio"),
        }),
        rows(class_balance(df, target), "target", F.col("label"), {
            "n": F.col("n"),
            "ratio": F.col("ratio"),
            "is_minority": F.col("is_minority").cast("int"),
            "imbalance_warning": F.col("imbalance_warning").cast("int"),
        }),
        rows(outlier_counts(df, columns), "outliers", F.col("feature"), {
            "n_outliers": F.col("n_outliers")
        }),
        rows(top_pearson(df, target, columns, top), "pearson", F.col("feature"), {"abs_corr": F.col("corr")}),
        rows(top_spearman(df, target, columns, top), "spearman", F.col("feature"), {"abs_corr": F.col("corr")}),
    ]
    if sensitive:
        parts.append(
            rows(
                rate_by_group(df, target, sensitive),
                "positive_rate",
                F.concat_ws("=", "feature", "value"),
                {"rate": F.col("positive_rate")},
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)
