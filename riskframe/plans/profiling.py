"""Profiling queries: counts, distributions, correlation, rates, order statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import contracts, correlation, profile, splits
from riskframe.operators.prefix import average_ranks, exact_quantiles, prefix_counts, to_long
from riskframe.plans.bindings import BILLS, LINE_FEATURES, PAYMENTS, accounts, lines, panel, table, with_
from riskframe.plans.io_contracts import derived
from riskframe.plans.registry import query

# Every fifth value of one measure and every third label are blanked, by rule.
HOLES_SQL = """holes AS (SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value,
                CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind, user_id FROM events)"""


def holes(spark, sf):
    i = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", F.when(i % 5 != 0, F.col("value")).alias("value"),
        F.when(i % 3 != 0, F.col("event_type")).alias("kind"), "user_id",
    )


@query(
    "ag01_missing_by_column",
    f"""WITH {HOLES_SQL} SELECT 'value' AS "column", count(*) - count(value) AS n_missing FROM holes
        UNION ALL SELECT 'kind', count(*) - count(kind) FROM holes""",
)
def ag01(spark, sf):
    return profile.missing_report(holes(spark, sf))


@query(
    "ag01_missing_total",
    f"""WITH {HOLES_SQL} SELECT CAST(2 * count(*) - count(value) - count(kind) AS BIGINT) AS n_missing_total,
        CAST(2 AS BIGINT) AS n_cols_with_missing FROM holes""",
)
def ag01b(spark, sf):
    return profile.missing_summary(holes(spark, sf))


@query(
    "ag02_duplicate_rows",
    with_("lines")
    + """SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicate_rows,
         round(CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 6) AS duplicate_ratio
         FROM (SELECT count(*) AS n FROM lines GROUP BY quantity, line, flag, status, discount)""",
)
def ag02(spark, sf):
    return contracts.duplicate_count(lines(spark, sf), ["quantity", "line", "flag", "status", "discount"])


@query(
    "ag03_deduplicate",
    f"WITH {HOLES_SQL} SELECT DISTINCT kind, user_id FROM holes",
)
def ag03(spark, sf):
    return contracts.drop_duplicates(holes(spark, sf).select("kind", "user_id"))


@query(
    "ag04_class_balance",
    with_("accounts")
    + """, c AS (SELECT target AS label, count(*) AS n FROM accounts GROUP BY target),
         s AS (SELECT label, n, round(n / (SELECT sum(n) FROM c)::DOUBLE, 4) AS ratio FROM c)
         SELECT label, n, ratio, label = (SELECT arg_min(label, (n, label)) FROM s) AS is_minority,
                (SELECT arg_min(ratio, (n, label)) FROM s) < 0.20 AS imbalance_warning FROM s""",
)
def ag04(spark, sf):
    return profile.class_balance(accounts(spark, sf), "target")


@query(
    "ag05_basic_stats",
    with_("accounts")
    + """SELECT count(*) AS n_samples, CAST(7 AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_missing,
         count(*) FILTER (target = 0) AS n_negative, count(*) FILTER (target = 1) AS n_positive,
         round(count(*) FILTER (target = 0) / (count(*) FILTER (target = 1))::DOUBLE, 4) AS imbalance_ratio
         FROM accounts""",
)
def ag05(spark, sf):
    return profile.basic_stats(accounts(spark, sf), "target")


SPLIT_SQL = """ranked AS (SELECT row_id, target, row_number() OVER (PARTITION BY target ORDER BY md5('42:' || row_id)) AS rn,
   count(*) OVER (PARTITION BY target) AS n FROM accounts),
 split AS (SELECT row_id, target, CASE WHEN rn <= floor(n * 0.15::DOUBLE + 0.5) THEN 'test'
   WHEN rn <= floor(n * 0.15::DOUBLE + 0.5) + floor(n * 0.15::DOUBLE + 0.5) THEN 'val' ELSE 'train' END AS split FROM ranked)"""


@query(
    "ag06_class_share_by_split",
    with_("accounts")
    + f""", {SPLIT_SQL} SELECT split, label, n, round(n / (sum(n) OVER (PARTITION BY split))::DOUBLE, 6) AS share
         FROM (SELECT split, target AS label, count(*) AS n FROM split GROUP BY split, target)""",
)
def ag06(spark, sf):
    base = accounts(spark, sf)
    cuts = splits.fit_split(base, "row_id", "target")
    return profile.class_share_by_split(cuts.assign(base), "split", "target")


def _describe_sql(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS feature, count({column}) AS "count", round(avg({column}), 5) AS mean,
      round(stddev_samp({column}), 5) AS std, CAST(min({column}) AS DOUBLE) AS "min",
      round(quantile_cont({column}, 0.25), 6) AS q1, round(quantile_cont({column}, 0.5), 6) AS median,
      round(quantile_cont({column}, 0.75), 6) AS q3, CAST(max({column}) AS DOUBLE) AS "max" FROM {source}"""


@query("ag07_describe", with_("lines") + " UNION ALL ".join(_describe_sql(c, "lines") for c in LINE_FEATURES))
def ag07(spark, sf):
    out = profile.describe(lines(spark, sf), LINE_FEATURES)
    digits = {"mean": 5, "std": 5, "q1": 6, "median": 6, "q3": 6}
    return out.select("feature", "count", "min", "max", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "ag08_quartiles",
    f"""WITH {HOLES_SQL} SELECT 'value' AS feature, round(quantile_cont(value, 0.25), 6) AS q1,
        round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3,
        round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr FROM holes
        UNION ALL SELECT 'user_id', quantile_cont(user_id, 0.25), quantile_cont(user_id, 0.5),
        quantile_cont(user_id, 0.75), quantile_cont(user_id, 0.75) - quantile_cont(user_id, 0.25) FROM holes""",
)
def ag08(spark, sf):
    out = profile.quartiles(holes(spark, sf), ["value", "user_id"])
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "iqr")])


@query("ag08_quartiles_sketch")
def ag08b(spark, sf):
    return profile.quartiles(lines(spark, sf), LINE_FEATURES, approximate=True)


@query(
    "ag09_outlier_counts",
    """WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
       o AS (SELECT count(*) AS n, count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS k
             FROM events, b)
       SELECT 'value' AS feature, k AS n_outliers, round(100.0::DOUBLE * k / n, 2) AS share_pct FROM o WHERE k > 0""",
)
def ag09(spark, sf):
    return profile.outlier_counts(table(spark, sf, "events"), ["value", "user_id"])


@query(
    "ag10_top_pearson",
    with_("lines")
    + """, c AS (SELECT 'quantity' AS feature, abs(corr(quantity, target)) AS c FROM lines
         UNION ALL SELECT 'price', abs(corr(price, target)) FROM lines
         UNION ALL SELECT 'discount', abs(corr(discount, target)) FROM lines
         UNION ALL SELECT 'tax', abs(corr(tax, target)) FROM lines)
         SELECT feature, round(c, 4) AS corr FROM c ORDER BY c DESC, feature LIMIT 3""",
)
def ag10(spark, sf):
    return profile.top_pearson(lines(spark, sf), "target", LINE_FEATURES, top=3)


_SPEARMAN = """SELECT '{0}' AS feature, corr(rx, ry) AS c FROM (SELECT
   rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0 AS rx,
   rank() OVER (ORDER BY target) + (count(*) OVER (PARTITION BY target) - 1) / 2.0 AS ry FROM lines)"""


@query(
    "ag11_top_spearman",
    with_("lines")
    + ", c AS ("
    + " UNION ALL ".join(_SPEARMAN.format(c) for c in LINE_FEATURES)
    + ") SELECT feature, round(abs(c), 4) AS corr FROM c ORDER BY abs(c) DESC, feature LIMIT 3",
)
def ag11(spark, sf):
    return profile.top_spearman(lines(spark, sf), "target", LINE_FEATURES, top=3)


@query(
    "ag12_pearson_matrix",
    with_("lines")
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
        + ("1.0::DOUBLE AS corr" if a == b else f"round(corr({a}, {b}), 6) AS corr FROM lines")
        for a in [*LINE_FEATURES, "target"]
        for b in [*LINE_FEATURES, "target"]
    ),
)
def ag12(spark, sf):
    out = profile.pearson_matrix(lines(spark, sf), [*LINE_FEATURES, "target"])
    return out.withColumn("corr", F.round("corr", 6))


#: Lagged and mixed measures of the panel: 48 columns, with holes of their own.
WIDE = {
    **{f"b{i}": f"bill{i}" for i in range(1, 7)},
    **{f"p{i}": f"paid{i}" for i in range(1, 7)},
    **{f"d{i}": f"CAST(delay{i} AS DOUBLE)" for i in range(1, 7)},
    **{f"r{i}": f"CASE WHEN bill{i} > 0 THEN paid{i} / bill{i} END" for i in range(1, 7)},
    **{f"s{i}{j}": f"bill{i} - bill{j}" for i in range(1, 6) for j in range(i + 1, 7)},
    **{f"u{i}": f"CASE WHEN delay{i} > 0 THEN bill{i} / credit END" for i in range(1, 7)},
    "credit": "credit",
    "constant": "CASE WHEN credit > 0 THEN 7.0 END",
    "empty": "CASE WHEN credit IS NULL THEN 1.0 END",
}


@query(
    "ag12_pearson_matrix_wide",
    with_("panel")
    + ", wide AS (SELECT "
    + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in WIDE.items())
    + " FROM panel), pairs AS (SELECT "
    + ", ".join(
        f"CASE WHEN stddev_pop({a}) FILTER ({b} IS NOT NULL) > 0 AND stddev_pop({b}) FILTER ({a} IS NOT NULL) > 0 "
        f"THEN corr({a}, {b}) END AS {a}__{b}"
        for i, a in enumerate(WIDE)
        for b in list(WIDE)[:i]
    )
    + ", "
    + ", ".join(f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0::DOUBLE END AS {a}__{a}" for a in WIDE)
    + " FROM wide), long AS (SELECT unnest(["
    + ", ".join(f"{{'pair': '{a}__{b}', 'corr': {a}__{b}}}" for i, a in enumerate(WIDE) for b in list(WIDE)[: i + 1])
    + "], recursive := true) FROM pairs)"
    + " SELECT split_part(pair, '__', 1) AS feature_a, split_part(pair, '__', 2) AS feature_b, round(corr, 6) AS corr FROM long"
    + " UNION ALL SELECT split_part(pair, '__', 2), split_part(pair, '__', 1), round(corr, 6) FROM long"
    + " WHERE split_part(pair, '__', 1) <> split_part(pair, '__', 2)",
)
def ag12b(spark, sf):
    """In blocks of 16 columns; a bill over a credit of 0 is infinite, as in the SQL."""
    exprs = {c: F.expr(e) for c, e in WIDE.items()}
    bill, credit = (lambda i: F.col(f"bill{i}")), F.col("credit")
    for i in range(1, 7):
        over_zero = F.when(bill(i) > 0, float("inf")).when(bill(i) < 0, float("-inf"))
        share = F.when(credit == 0, over_zero).otherwise(F.try_divide(bill(i), credit))
        exprs[f"u{i}"] = F.when(F.col(f"delay{i}") > 0, share)
    wide = panel(spark, sf).select(*[e.cast("double").alias(c) for c, e in exprs.items()])
    return correlation.pearson(wide, list(WIDE), block=16).withColumn("corr", F.round("corr", 6))


PANEL_TARGET = "CASE WHEN bill6 > 500000 THEN 1 ELSE 0 END"


@query(
    "ag13_derived_correlation",
    with_("panel")
    + f""", d AS (SELECT *, ({' + '.join(BILLS)}) / 6 AS avg_bill, ({' + '.join(PAYMENTS)}) / 6 AS avg_paid,
          {PANEL_TARGET} AS y FROM panel)
        SELECT 'avg_bill' AS feature, round(corr(avg_bill, y), 6) AS corr FROM d
        UNION ALL SELECT 'avg_paid', round(corr(avg_paid, y), 6) FROM d
        UNION ALL SELECT 'paid_ratio', round(corr(avg_paid / (avg_bill + 1), y), 6) FROM d""",
)
def ag13(spark, sf):
    base = derived(spark, sf).withColumn("y", F.expr(PANEL_TARGET))
    out = profile.target_correlation(base, "y", ["avg_bill", "avg_paid", "paid_ratio"])
    return out.withColumn("corr", F.round("corr", 6))


@query(
    "ag14_signed_ranking",
    with_("lines")
    + """, c AS (SELECT 'quantity' AS feature, corr(quantity, target) AS c FROM lines
         UNION ALL SELECT 'price', corr(price, target) FROM lines UNION ALL SELECT 'discount', corr(discount, target)
         FROM lines UNION ALL SELECT 'tax', corr(tax, target) FROM lines)
         SELECT feature, round(c, 6) AS corr FROM c ORDER BY c DESC, feature LIMIT 2""",
)
def ag14(spark, sf):
    out = profile.signed_ranking(lines(spark, sf), "target", LINE_FEATURES, first=2)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    "ag15_rate_by_group",
    with_("accounts")
    + """SELECT 'segment' AS feature, CAST(segment AS VARCHAR) AS value, count(*) AS n,
                round(avg(target), 4) AS positive_rate FROM accounts GROUP BY segment
         UNION ALL SELECT 'priority', CAST(priority AS VARCHAR), count(*), round(avg(target), 4)
         FROM accounts GROUP BY priority""",
)
def ag15(spark, sf):
    return profile.rate_by_group(accounts(spark, sf), "target", ["segment", "priority"])


@query(
    "ag15_error_rate_by_hour",
    """SELECT 'hour' AS feature, CAST(hour(ts) AS VARCHAR) AS value, count(*) AS n,
              round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 4) AS positive_rate FROM events GROUP BY hour(ts)
       UNION ALL SELECT 'weekday', CAST(dayofweek(ts) + 1 AS VARCHAR), count(*),
              round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 4) FROM events GROUP BY dayofweek(ts)""",
)
def ag15b(spark, sf):
    events = table(spark, sf, "events").select(
        F.hour("ts").alias("hour"), F.dayofweek("ts").alias("weekday"),
        (F.col("event_type") == "error").cast("int").alias("error"),
    )
    return profile.rate_by_group(events, "error", ["hour", "weekday"])


@query(
    "ag16_frequency_tables",
    with_("accounts")
    + """SELECT 'priority' AS "column", priority AS code, count(*) AS n, priority IN (1, 2, 3) AS in_domain
         FROM accounts GROUP BY priority
         UNION ALL SELECT 'month', month, count(*), NULL FROM accounts GROUP BY month""",
)
def ag16(spark, sf):
    return profile.frequency_tables(accounts(spark, sf), ["priority", "month"], {"priority": [1, 2, 3]})


@query(
    "ag17_distinct_values",
    with_("lines")
    + """SELECT DISTINCT 'discount' AS "column", discount AS value FROM lines
         UNION ALL SELECT DISTINCT 'line', CAST(line AS DOUBLE) FROM lines""",
)
def ag17(spark, sf):
    return profile.distinct_values(lines(spark, sf), ["discount", "line"])


def _histogram_sql(column: str, source: str, bins: int) -> str:
    return f"""SELECT '{column}' AS feature, CAST(least(floor(({column} - lo) * {bins} / (hi - lo)), {bins - 1}) + 1 AS BIGINT)
       AS bin, count(*) AS n FROM {source}, (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source})
       GROUP BY 1, 2"""


@query(
    "ag18_histograms",
    _histogram_sql("value", "events", 50) + " UNION ALL " + _histogram_sql("user_id", "events", 50),
)
def ag18(spark, sf):
    return profile.equal_width_histogram(table(spark, sf, "events"), ["value", "user_id"], bins=50)


@query(
    "ag19_five_numbers_by_class",
    with_("accounts")
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, target AS label, CAST(min({c}) AS DOUBLE) AS "min",
        round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
        round(quantile_cont({c}, 0.75), 6) AS q3, CAST(max({c}) AS DOUBLE) AS "max" FROM accounts GROUP BY target"""
        for c in ("amount", "age")
    ),
)
def ag19(spark, sf):
    out = profile.five_numbers_by_class(accounts(spark, sf), "target", ["amount", "age"])
    return out.select("feature", "label", "min", "max", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")])


@query(
    "ag20_panel_trend",
    with_("panel")
    + " UNION ALL ".join(
        f"SELECT '{m}' AS measure, {i} AS period, round(avg({c}), 3) AS mean FROM panel"
        for m, cols in (("bill", BILLS), ("paid", PAYMENTS))
        for i, c in enumerate(cols, 1)
    ),
)
def ag20(spark, sf):
    out = profile.panel_means(panel(spark, sf), {"bill": BILLS, "paid": PAYMENTS})
    return out.withColumn("mean", F.round("mean", 3))


@query(
    "ag21_leakage_check",
    with_("accounts")
    + f""", {SPLIT_SQL}, s AS (SELECT a.amount, split.split FROM accounts a JOIN split USING (row_id)),
         m AS (SELECT round(avg(amount) FILTER (split = 'train'), 4) AS mean_train, round(avg(amount), 4) AS mean_all FROM s)
         SELECT CAST(0 AS BIGINT) AS n_shared_keys, mean_train, mean_all, mean_train <> mean_all AS scaler_leaks FROM m""",
)
def ag21(spark, sf):
    """Leakage, measured: keys in two splits, and a scaler that would shift if test rows joined the fit."""
    base = accounts(spark, sf)
    split = splits.fit_split(base, "row_id", "target").assign(base)
    shared = splits.split_overlap(split, "row_id").agg(F.count(F.lit(1)).alias("n_shared_keys"))
    means = split.agg(
        F.round(F.avg(F.when(F.col("split") == "train", F.col("amount"))), 4).alias("mean_train"),
        F.round(F.avg("amount"), 4).alias("mean_all"),
    )
    # Two one-row tables.
    both = shared.crossJoin(F.broadcast(means))
    return both.withColumn("scaler_leaks", F.col("mean_train") != F.col("mean_all"))


@query(
    "ag22_diagnostics",
    with_("accounts")
    + """, t AS (SELECT target, count(*) AS n, round(count(*) / (SELECT count(*) FROM accounts)::DOUBLE, 4) AS ratio
                 FROM accounts GROUP BY target),
         m AS (SELECT arg_min(target, (n, target)) AS label, arg_min(ratio, (n, target)) AS ratio FROM t),
         p AS (SELECT 'amount' AS item, abs(corr(amount, target)) AS c FROM accounts
               UNION ALL SELECT 'age', abs(corr(age, target)) FROM accounts),
         ra AS (SELECT target, rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0 AS a,
                rank() OVER (ORDER BY age) + (count(*) OVER (PARTITION BY age) - 1) / 2.0 AS g,
                rank() OVER (ORDER BY target) + (count(*) OVER (PARTITION BY target) - 1) / 2.0 AS y FROM accounts)
         SELECT 'missing' AS "check", 'table' AS item, 'n_missing_total' AS measure, 0.0::DOUBLE AS value
         UNION ALL SELECT 'missing', 'table', 'n_cols_with_missing', 0.0
         UNION ALL SELECT 'duplicates', 'table', 'n_duplicate_rows', 0.0
         UNION ALL SELECT 'duplicates', 'table', 'duplicate_ratio', 0.0
         UNION ALL SELECT 'target', CAST(target AS VARCHAR), 'n', n FROM t
         UNION ALL SELECT 'target', CAST(target AS VARCHAR), 'ratio', ratio FROM t
         UNION ALL SELECT 'target', CAST(target AS VARCHAR), 'is_minority', CAST(target = label AS INTEGER) FROM t, m
         UNION ALL SELECT 'target', CAST(target AS VARCHAR), 'imbalance_warning', CAST(m.ratio < 0.20 AS INTEGER) FROM t, m
         UNION ALL SELECT 'pearson', item, 'abs_corr', round(c, 4) FROM p
         UNION ALL SELECT 'spearman', 'amount', 'abs_corr', round(abs(corr(a, y)), 4) FROM ra
         UNION ALL SELECT 'spearman', 'age', 'abs_corr', round(abs(corr(g, y)), 4) FROM ra
         UNION ALL SELECT 'positive_rate', 'segment=' || segment, 'rate', round(avg(target), 4) FROM accounts GROUP BY segment
      """,
)
def ag22(spark, sf):
    return profile.diagnostics(
        accounts(spark, sf), "target", sensitive=["segment"], columns=["amount", "age"], top=5
    )


# --- order statistics -------------------------------------------------------------------


@query(
    "wn02_average_ranks",
    """SELECT 'value' AS feature, value, count(*) AS n, max(rk) AS avg_rank FROM (SELECT value,
         rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0::DOUBLE AS rk FROM events)
       GROUP BY value""",
)
def wn02(spark, sf):
    long = to_long(table(spark, sf, "events"), ["value"])
    return average_ranks(long, ["feature"], "value", n_groups=1)


@query(
    "wn03_cumulative_counts",
    """SELECT event_type, value, n, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY value) AS BIGINT) AS running,
              round(sum(n) OVER (PARTITION BY event_type ORDER BY value) / (sum(n) OVER (PARTITION BY event_type))::DOUBLE, 6)
              AS ecdf FROM (SELECT event_type, value, count(*) AS n FROM events GROUP BY event_type, value)""",
)
def wn03(spark, sf):
    counts = prefix_counts(table(spark, sf, "events"), ["event_type"], "value", {"n": F.lit(1)})
    running = F.col("n_before") + F.col("n")
    return counts.select(
        "event_type", "value", "n", running.alias("running"), F.round(running / F.col("n_total"), 6).alias("ecdf")
    )


@query(
    "wn05_latest_per_key",
    "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value "
    "FROM events GROUP BY user_id",
)
def wn05(spark, sf):
    # One number in the order of (ts, event_id), so that the latest row is a hash aggregate.
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(20,0)")
    order = micros * F.lit(2**40).cast("decimal(13,0)") + F.col("event_id").cast("decimal(20,0)")
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.max_by("event_id", order).alias("event_id"), F.max_by("value", order).alias("value")
    )


@query(
    "wn06_shuffle_order",
    with_("accounts")
    + """SELECT target, CASE WHEN rn <= n // 4 THEN 0 WHEN rn <= 2 * n // 4 THEN 1 WHEN rn <= 3 * n // 4 THEN 2 ELSE 3 END
         AS quarter, row_id FROM (SELECT target, row_id, row_number() OVER (PARTITION BY target ORDER BY
         md5('3:' || row_id)) AS rn, count(*) OVER (PARTITION BY target) AS n FROM accounts)""",
)
def wn06(spark, sf):
    """Rows by quarter of a seeded shuffle inside each class."""
    base = accounts(spark, sf)
    cuts = splits.fit_folds(base, "row_id", "target", k=4, seed=3)
    return splits.assign_folds(base, cuts, "quarter").select("target", "quarter", "row_id")


@query(
    "wn03_quantile_groups",
    """SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.05), 6) AS p05,
              round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def wn03b(spark, sf):
    groups = ["l_returnflag", "l_linestatus"]
    out = exact_quantiles(table(spark, sf, "lineitem"), groups, "l_extendedprice", {"p05": 0.05, "p95": 0.95})
    return out.select(*groups, F.round("p05", 6).alias("p05"), F.round("p95", 6).alias("p95"))


# --- damaged columns ----------------------------------------------------------------------

# NaN in every fourth value, no label in every third row, a label of many values in the rest.
DAMAGED_SQL = """damaged AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN value END AS value, user_id::DOUBLE AS user_id,
   CASE WHEN event_id % 3 <> 0 THEN event_id % 7 END AS grade, CASE WHEN event_id % 3 <> 0 THEN (value > 50)::INT END AS flag
   FROM events)"""


def damaged(spark, sf):
    i = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", F.when(i % 4 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.col("user_id").cast("double").alias("user_id"), F.when(i % 3 != 0, i % 7).alias("grade"),
        F.when(i % 3 != 0, (F.col("value") > 50).cast("int")).alias("flag"),
    )


@query(
    "ag04_missing_labels",
    f"""WITH {DAMAGED_SQL}, c AS (SELECT grade AS label, count(*) AS n FROM damaged WHERE grade IS NOT NULL GROUP BY grade),
         s AS (SELECT label, n, round(n / (SELECT sum(n) FROM c)::DOUBLE, 4) AS ratio FROM c)
         SELECT label, n, ratio, label = (SELECT arg_min(label, (n, label)) FROM s) AS is_minority,
                (SELECT arg_min(ratio, (n, label)) FROM s) < 0.20 AS imbalance_warning FROM s""",
)
def ag04b(spark, sf):
    return profile.class_balance(damaged(spark, sf), "grade")


@query("ag07_describe_nan", f"WITH {DAMAGED_SQL} " + " UNION ALL ".join(_describe_sql(c, "damaged") for c in ("value", "user_id")))
def ag07b(spark, sf):
    out = profile.describe(damaged(spark, sf), ["value", "user_id"])
    digits = {"mean": 5, "std": 5, "q1": 6, "median": 6, "q3": 6}
    return out.select("feature", "count", "min", "max", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query(
    "ag10_pearson_nan",
    f"""WITH {DAMAGED_SQL} SELECT 'value' AS feature, round(abs(corr(value, grade)), 4) AS corr FROM damaged
        UNION ALL SELECT 'user_id', round(abs(corr(user_id, grade)), 4) FROM damaged""",
)
def ag10b(spark, sf):
    return profile.top_pearson(damaged(spark, sf), "grade", ["value", "user_id"])


_RANKED = """SELECT '{0}' AS feature, round(abs(corr(rx, ry)), 4) AS corr FROM (SELECT
   rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0 AS rx,
   rank() OVER (ORDER BY {1}) + (count(*) OVER (PARTITION BY {1}) - 1) / 2.0 AS ry
   FROM damaged WHERE {0} IS NOT NULL AND {1} IS NOT NULL)"""


@query("ag11_spearman_any_target", f"WITH {DAMAGED_SQL} {_RANKED.format('value', 'grade')} UNION ALL {_RANKED.format('user_id', 'grade')}")
def ag11b(spark, sf):
    return profile.top_spearman(damaged(spark, sf), "grade", ["value", "user_id"])


@query("ag11_spearman_missing_labels", f"WITH {DAMAGED_SQL} {_RANKED.format('value', 'flag')} UNION ALL {_RANKED.format('user_id', 'flag')}")
def ag11c(spark, sf):
    return profile.top_spearman(damaged(spark, sf), "flag", ["value", "user_id"])


@query(
    "pr07_outlier_rows_nan",
    f"""WITH {DAMAGED_SQL}, b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM damaged)
        SELECT event_id, 'value' AS feature, value FROM damaged, b WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def pr07b(spark, sf):
    return profile.outlier_rows(damaged(spark, sf), "event_id", ["value"])


@query(
    "wn03_quantiles_null_group",
    f"""WITH {DAMAGED_SQL} SELECT grade, round(quantile_cont(value, 0.5), 6) AS median FROM damaged GROUP BY grade""",
)
def wn03c(spark, sf):
    out = exact_quantiles(damaged(spark, sf).where(~F.isnan("value")), ["grade"], "value", {"median": 0.5})
    return out.select("grade", F.round("median", 6).alias("median"))
