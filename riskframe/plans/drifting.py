"""Drift queries: two samples, many windows, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import drift
from riskframe.operators import evaluation as E
from riskframe.plans.bindings import MODELS, accounts, scores, table, with_
from riskframe.plans.evaluating import split_table
from riskframe.plans.profiling import SPLIT_SQL
from riskframe.plans.registry import query
from riskframe.roles import Roles
from riskframe.session import fresh_path
from riskframe.streaming import drift as stream_drift

DRIFT_ROLES = Roles(
    key="event_id",
    target="error",
    continuous=["value", "user_id", "absent"],
    ordinal=["hour6"],
    categorical=["event_type", "weekend"],
)

# Late events are scaled up, so that one feature drifts.
EVENTS_SQL = """ev AS (SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value * 1.1 ELSE value END AS value,
   user_id, event_type, CAST(hour(ts) // 6 AS BIGINT) AS hour6, dayofweek(ts) IN (0, 6) AS weekend,
   CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS side FROM events)"""


def sides(spark, sf):
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    events = table(spark, sf, "events").select(
        "event_id", "ts", F.when(late, F.col("value") * 1.1).otherwise(F.col("value")).alias("value"), "user_id",
        "event_type", F.floor(F.hour("ts") / 6).alias("hour6"), F.dayofweek("ts").isin(1, 7).alias("weekend"),
    )
    return events.where(~late), events.where(late)


def ks_sql(value: str, source: str, name: str) -> str:
    """Statistic and p-value of one feature from cumulative counts."""
    return f"""SELECT '{name}' AS feature, d AS statistic, least(greatest(2 * list_sum(list_transform(range(1, 101),
        lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * lam * lam))), 0), 1) AS p_value FROM (
        SELECT d, sqrt(en) * d + 1 / (6 * sqrt(en)) + (sqrt(en) * d - 1) / (4 * en) AS lam FROM (
        SELECT max(abs(r / nr::DOUBLE - c / nc::DOUBLE)) AS d, round(max(nr)::DOUBLE * max(nc) / (max(nr) + max(nc))) AS en FROM (
        SELECT sum(r) OVER (ORDER BY v) AS r, sum(c) OVER (ORDER BY v) AS c, sum(r) OVER () AS nr, sum(c) OVER () AS nc FROM (
        SELECT {value} AS v, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c FROM {source} GROUP BY {value}))))"""


@query(
    "dr01_ks_drift",
    f"WITH {EVENTS_SQL} SELECT feature, round(statistic, 8) AS statistic, round(p_value, 6) AS p_value FROM ("
    + ks_sql("value", "ev", "value") + " UNION ALL " + ks_sql("user_id", "ev", "user_id") + ")",
)
def dr01(spark, sf):
    out = drift.ks_drift(*sides(spark, sf), ["value", "user_id"], exact_rows=0)
    return out.select("feature", F.round("statistic", 8).alias("statistic"), F.round("p_value", 6).alias("p_value"))


@query("dr01_ks_exact")
def dr01c(spark, sf):
    """Exact p-values where both sides are small enough."""
    return drift.ks_drift(*sides(spark, sf), ["value", "user_id"])


@query(
    "dr01_ks_nan",
    f"""WITH {EVENTS_SQL}, holed AS (SELECT side, CASE WHEN event_id % 4 <> 0 THEN value END AS value FROM ev),
        whole AS (SELECT * FROM holed WHERE value IS NOT NULL)
        SELECT feature, round(statistic, 8) AS statistic, round(p_value, 6) AS p_value FROM ({ks_sql("value", "whole", "value")})""",
)
def dr01b(spark, sf):
    holed = [s.withColumn("value", F.when(F.col("event_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("value"))) for s in sides(spark, sf)]
    out = drift.ks_drift(*holed, ["value"], exact_rows=0)
    return out.select("feature", F.round("statistic", 8).alias("statistic"), F.round("p_value", 6).alias("p_value"))


@query(
    "dr06_p_value_metrics",
    f"""WITH {EVENTS_SQL} SELECT 'pval_' || feature AS key, round(p_value, 6) AS value FROM ({ks_sql("value", "ev", "value")}
        UNION ALL {ks_sql("user_id", "ev", "user_id")})""",
)
def dr06b(spark, sf):
    report = drift.ks_drift(*sides(spark, sf), ["value", "user_id"], exact_rows=0)
    return drift.drift_metric_rows(report).withColumn("value", F.round("value", 6))


def chi2_sql(value: str, name: str) -> str:
    """Statistic from expected counts, Yates-corrected in a 2 x 2 table."""
    return f"""SELECT '{name}' AS feature, sum(greatest(abs(o - x) - y, 0) ** 2 / x) AS statistic, max(k) - 1 AS dof FROM (
        SELECT o, row_total * col_total / total::DOUBLE AS x, k, CASE WHEN k = 2 THEN 0.5 ELSE 0 END AS y FROM (
        SELECT o, sum(o) OVER (PARTITION BY s) AS row_total, sum(o) OVER (PARTITION BY v) AS col_total, sum(o) OVER () AS total,
        (SELECT count(DISTINCT {value}) FROM ev) AS k FROM (
        SELECT s, v, (SELECT count(*) FROM ev WHERE side = s AND {value} = v) AS o FROM (VALUES (0), (1)) t(s),
        (SELECT DISTINCT {value} AS v FROM ev))))"""


CHI2_SQL = " UNION ALL ".join([chi2_sql("event_type", "event_type"), chi2_sql("hour6", "hour6"), chi2_sql("weekend", "weekend")])


@query("dr02_chi2_drift", f"WITH {EVENTS_SQL} SELECT feature, round(statistic, 6) AS statistic, dof FROM ({CHI2_SQL})")
def dr02(spark, sf):
    out = drift.chi2_drift(*sides(spark, sf), ["event_type", "hour6", "weekend"])
    return out.select("feature", F.round("statistic", 6).alias("statistic"), "dof")


# Closed form of the tail for an even number of degrees of freedom.
@query(
    "dr02_chi2_p_value",
    f"""WITH {EVENTS_SQL} SELECT feature, round(exp(-statistic / 2) * (1 + statistic / 2), 6) AS p_value
        FROM ({chi2_sql("event_type", "event_type")})""",
)
def dr02b(spark, sf):
    out = drift.chi2_drift(*sides(spark, sf), ["event_type"])
    return out.select("feature", F.round("p_value", 6).alias("p_value"))


@query(
    "jn05_aligned_counts",
    f"""WITH {EVENTS_SQL} SELECT 'user_id' AS feature, CAST(user_id AS VARCHAR) AS value, count(*) FILTER (side = 0) AS ref,
        count(*) FILTER (side = 1) AS cur FROM ev GROUP BY user_id""",
)
def jn05(spark, sf):
    return drift.category_counts(*sides(spark, sf), ["user_id"])


@query(
    "dr03_data_drift",
    f"""WITH {EVENTS_SQL} SELECT feature, 'ks' AS test, round(statistic, 6) AS statistic, p_value < 0.05 AS drift_detected FROM (
        {ks_sql("value", "ev", "value")} UNION ALL {ks_sql("user_id", "ev", "user_id")})
        UNION ALL SELECT feature, 'chi2', round(statistic, 6), statistic > (CASE dof WHEN 4 THEN 9.487729036781154
        WHEN 3 THEN 7.814727903251179 ELSE 3.841458820694124 END) FROM ({CHI2_SQL})""",
)
def dr03(spark, sf):
    out = drift.data_drift(*sides(spark, sf), DRIFT_ROLES)
    return out.select("feature", "test", F.round("statistic", 6).alias("statistic"), "drift_detected")


CRITICAL_VALUES = "(CASE dof WHEN 4 THEN 9.487729036781154 WHEN 3 THEN 7.814727903251179 ELSE 3.841458820694124 END)"
FLAGS_SQL = f"""flags AS (SELECT feature, p_value < 0.05 AS f FROM ({ks_sql("value", "ev", "value")} UNION ALL
   {ks_sql("user_id", "ev", "user_id")}) UNION ALL SELECT feature, statistic > {CRITICAL_VALUES} FROM ({CHI2_SQL}))"""


@query(
    "dr06_drift_summary",
    f"""WITH {EVENTS_SQL}, {FLAGS_SQL} SELECT count(*) AS n_tested, count(*) FILTER (f) AS n_drifted,
        coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (f), '') AS drifted FROM flags""",
)
def dr06(spark, sf):
    return drift.drift_summary(drift.data_drift(*sides(spark, sf), DRIFT_ROLES))


def areas_by_split(spark, sf):
    split = split_table(spark, sf).withColumnRenamed("row_id", "key")
    joined = scores(spark, sf).join(split, "key")
    wide = E.roc_auc(joined, ["model", "split"], n_groups=3 * len(MODELS))
    val = wide.where(F.col("split") == "val").select("model", "roc_auc")
    test = wide.where((F.col("split") == "test") & (F.col("model") != "age_rule")).select("model", "roc_auc")
    return val, test


AREAS_SQL = """j AS (SELECT model, split, y, score FROM scores JOIN split ON key = row_id),
  a AS (SELECT model, split, (sum(CASE WHEN y = 1 THEN rk END) - max(np) * (max(np) + 1) / 2.0) / (max(np) * max(nn))::DOUBLE
        AS auc FROM (SELECT model, split, y, rank() OVER (PARTITION BY model, split ORDER BY score)
          + (count(*) OVER (PARTITION BY model, split, score) - 1) / 2.0 AS rk, sum(y) OVER (PARTITION BY model, split) AS np,
          sum(1 - y) OVER (PARTITION BY model, split) AS nn FROM j) GROUP BY model, split),
  d AS (SELECT v.model, v.auc AS ref, CASE WHEN v.model = 'age_rule' THEN v.auc ELSE t.auc END AS cur
        FROM a v JOIN a t ON v.model = t.model AND v.split = 'val' AND t.split = 'test')"""


@query(
    "dr04_model_drift",
    with_("accounts", "scores")
    + f""", {SPLIT_SQL}, {AREAS_SQL} SELECT model, round(ref, 6) AS reference_roc_auc, round(cur, 6) AS current_roc_auc,
         round(cur - ref, 6) AS delta_roc_auc, 0.005::DOUBLE AS threshold, cur - ref < -0.005::DOUBLE AS drift_detected FROM d""",
)
def dr04(spark, sf):
    out = drift.model_drift(*areas_by_split(spark, sf), threshold=0.005)
    rounded = [F.round(c, 6).alias(c) for c in ("reference_roc_auc", "current_roc_auc")]
    return out.select("model", *rounded, "delta_roc_auc", "threshold", "drift_detected")


def reference_and_current(spark, sf):
    """Train and validation rows together, and the test rows."""
    joined = accounts(spark, sf).join(split_table(spark, sf), "row_id")
    parts = {s: joined.where(F.col("split") == s) for s in ("train", "val", "test")}
    return parts["train"].unionByName(parts["val"]), parts["test"]


@query(
    "dr05_reference_current",
    with_("accounts")
    + f""", {SPLIT_SQL} SELECT CASE WHEN split = 'test' THEN 'current' ELSE 'reference' END AS side, count(*) AS n,
         round(avg(amount), 4) AS mean_amount FROM accounts JOIN split USING (row_id) GROUP BY 1""",
)
def dr05(spark, sf):
    ref, cur = reference_and_current(spark, sf)
    sized = [F.count(F.lit(1)).alias("n"), F.round(F.avg("amount"), 4).alias("mean_amount")]
    return ref.agg(F.lit("reference").alias("side"), *sized).unionByName(cur.agg(F.lit("current").alias("side"), *sized))


@query(
    "dr07_retraining_triggers",
    with_("accounts", "scores")
    + f""", {SPLIT_SQL}, {AREAS_SQL}, drops AS (SELECT max(ref - cur) AS x FROM d),
        {EVENTS_SQL}, {FLAGS_SQL}, n AS (SELECT count(*) FILTER (f)::DOUBLE AS n, count(*) FILTER (f AND feature = 'value')
          ::DOUBLE AS crit FROM flags)
        SELECT 'critical_feature_drift' AS rule, crit AS observed, crit > 0 AS fired, 'retrain' AS action FROM n
        UNION ALL SELECT 'many_features_drift', n, n >= 5, 'retrain' FROM n
        UNION ALL SELECT 'auc_drop_mandatory', round(x, 6), x > 0.05, 'retrain' FROM drops
        UNION ALL SELECT 'auc_drop_alert', round(x, 6), x > 0.03, 'alert' FROM drops
        UNION ALL SELECT 'latency_p95', round(quantile_cont(value * 2, 0.95), 6), quantile_cont(value * 2, 0.95) > 500, 'alert'
        FROM events
        UNION ALL SELECT 'feature_tier', n, n > 0, CASE WHEN n = 0 THEN 'none' WHEN n < 5 THEN 'watch' ELSE 'retrain' END FROM n""",
)
def dr07(spark, sf):
    report = drift.data_drift(*sides(spark, sf), DRIFT_ROLES)
    latencies = table(spark, sf, "events").select((F.col("value") * 2).alias("latency_ms"))
    rules = drift.retraining_triggers(report, drift.model_drift(*areas_by_split(spark, sf)), latencies, critical=["value"])
    return rules.withColumn("observed", F.round("observed", 6))


# --- windows and streams ------------------------------------------------------------------


WEEK_SQL = """wk AS (SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS w, event_type, value, user_id FROM events),
  closed AS (SELECT DISTINCT w FROM wk, (SELECT max(ts) AS last FROM events) WHERE w + INTERVAL '7 days' <= last - INTERVAL '1 day')"""


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def week_histograms(spark, sf, features):
    out, checkpoint = fresh_path(spark, "weeks"), fresh_path(spark, "weeks-checkpoint")
    histograms = stream_drift.window_histograms(event_stream(spark, sf), features)
    stream_drift.start_window_histograms(histograms, out=out, checkpoint=checkpoint).awaitTermination()
    return spark.read.schema(histograms.schema).parquet(out)


@query(
    "ss02_weekly_histograms",
    f"""WITH {WEEK_SQL} SELECT strftime(w, '%Y-%m-%d') AS week, 'event_type' AS feature, event_type AS value, count(*) AS n
        FROM wk WHERE w IN (SELECT w FROM closed) GROUP BY w, event_type
        UNION ALL SELECT strftime(w, '%Y-%m-%d'), 'user_id', CAST(user_id AS VARCHAR), count(*)
        FROM wk WHERE w IN (SELECT w FROM closed) GROUP BY w, user_id""",
)
def ss02(spark, sf):
    found = week_histograms(spark, sf, ["event_type", "user_id"])
    return found.select(F.date_format("window_start", "yyyy-MM-dd").alias("week"), "feature", "value", "n")


@query(
    "ss02_weekly_drift",
    f"""WITH {WEEK_SQL}, r AS (SELECT event_type, count(*) AS r FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY event_type),
        c AS (SELECT w, event_type, count(*) AS c FROM wk WHERE w IN (SELECT w FROM closed) GROUP BY w, event_type),
        t AS (SELECT w, event_type, r, c, sum(r) OVER (PARTITION BY w) AS nr, sum(c) OVER (PARTITION BY w) AS nc
              FROM c JOIN r USING (event_type)),
        chi AS (SELECT w, sum((r - nr * (r + c) / (nr + nc)::DOUBLE) ** 2 / (nr * (r + c) / (nr + nc)::DOUBLE)
              + (c - nc * (r + c) / (nr + nc)::DOUBLE) ** 2 / (nc * (r + c) / (nr + nc)::DOUBLE)) AS s FROM t GROUP BY w),
        v AS (SELECT w, value, 0 AS r, 1 AS c FROM wk WHERE w IN (SELECT w FROM closed)
              UNION ALL SELECT w, value, 1, 0 FROM closed, (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-10')),
        g AS (SELECT w, value, sum(r) AS r, sum(c) AS c FROM v GROUP BY w, value),
        k AS (SELECT w, max(abs(cr / nr::DOUBLE - cc / nc::DOUBLE)) AS d FROM (SELECT w,
              sum(r) OVER (PARTITION BY w ORDER BY value) AS cr, sum(c) OVER (PARTITION BY w ORDER BY value) AS cc,
              sum(r) OVER (PARTITION BY w) AS nr, sum(c) OVER (PARTITION BY w) AS nc FROM g) GROUP BY w)
        SELECT strftime(w, '%Y-%m-%d') AS week, 'event_type' AS feature, 'chi2' AS test, round(s, 6) AS statistic FROM chi
        UNION ALL SELECT strftime(w, '%Y-%m-%d'), 'value', 'ks', round(d, 6) FROM k""",
)
def ss02b(spark, sf):
    early = table(spark, sf, "events").where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    found = stream_drift.window_drift(
        early, week_histograms(spark, sf, ["value", "event_type"]), ["value"], ["event_type"]
    )
    return found.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("week"), "feature", "test",
        F.round("statistic", 6).alias("statistic"),
    )


def week_sketches(spark, sf, features):
    out, checkpoint = fresh_path(spark, "sketches"), fresh_path(spark, "sketches-checkpoint")
    sketches = stream_drift.window_sketches(event_stream(spark, sf), features)
    stream_drift.start_window_histograms(sketches, out=out, checkpoint=checkpoint).awaitTermination()
    return spark.read.schema(sketches.schema).parquet(out)


def _exact_weeks(value: str) -> str:
    """Exact statistic of every closed week against the events before 10 January."""
    return f"""SELECT w, '{value}' AS feature, max(nc) AS n, max(nr) AS n_ref, max(abs(cr / nr::DOUBLE - cc / nc::DOUBLE)) AS d FROM (
        SELECT w, sum(r) OVER o AS cr, sum(c) OVER o AS cc, sum(r) OVER (PARTITION BY w) AS nr, sum(c) OVER (PARTITION BY w) AS nc
        FROM (SELECT w, v, sum(r) AS r, sum(c) AS c FROM (
          SELECT w, {value}::DOUBLE AS v, 0 AS r, 1 AS c FROM wk WHERE w IN (SELECT w FROM closed)
          UNION ALL SELECT w, {value}::DOUBLE, 1, 0 FROM closed, (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-10')) GROUP BY w, v)
        WINDOW o AS (PARTITION BY w ORDER BY v)) GROUP BY w"""


@query(
    "ss02_sketched_drift",
    f"""WITH {WEEK_SQL}, k AS ({_exact_weeks("value")} UNION ALL {_exact_weeks("user_id")}),
        e AS (SELECT *, round(n_ref::DOUBLE * n / (n_ref + n)) AS en FROM k),
        l AS (SELECT *, sqrt(en) * d + 1 / (6 * sqrt(en)) + (sqrt(en) * d - 1) / (4 * en) AS lam FROM e)
        SELECT strftime(w, '%Y-%m-%d') AS week, feature, CAST(n AS BIGINT) AS n, TRUE AS within, CASE WHEN lam < 0.2 THEN FALSE ELSE
          2 * list_sum(list_transform(range(1, 101), lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * lam * lam))) < 0.05
          END AS drift_detected FROM l""",
)
def ss02c(spark, sf):
    """From quantile sketches; ``within``: the statistic is no further from the exact one than the stated error."""
    early = table(spark, sf, "events").where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    features = ["value", "user_id"]
    found = stream_drift.sketch_drift(early, week_sketches(spark, sf, features), features, ["window_start"])
    exact = stream_drift.window_drift(early, week_histograms(spark, sf, features), features, [])
    exact = exact.select("window_start", "feature", F.col("statistic").alias("exact"))
    both = found.join(exact, ["window_start", "feature"])
    return both.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("week"), "feature", "n",
        (F.abs(F.col("statistic") - F.col("exact")) <= F.col("error")).alias("within"), "drift_detected",
    )


@query(
    "ss03_count_windows",
    """SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // 1000 AS BIGINT) AS window_id FROM events""",
)
def ss03(spark, sf):
    return drift.count_windows(table(spark, sf, "events"), "event_id", 1000)


@query(
    "ss03_count_window_histograms",
    """WITH w AS (SELECT event_type, CAST((row_number() OVER (ORDER BY event_id) - 1) // 3000 AS BIGINT) AS window_id FROM events)
       SELECT window_id, 'event_type' AS feature, event_type AS value, count(*) AS n FROM w
       WHERE (window_id + 1) * 3000 <= (SELECT count(*) FROM events) GROUP BY window_id, event_type""",
)
def ss03b(spark, sf):
    out, checkpoint = fresh_path(spark, "counts"), fresh_path(spark, "counts-checkpoint")
    stream_drift.start_count_windows(
        event_stream(spark, sf), key="event_id", features=["event_type"], size=3000, out=out, checkpoint=checkpoint
    ).awaitTermination()
    return stream_drift.read_count_windows(spark, out, 3000)


@query(
    "ss03_count_window_drift",
    """WITH w AS (SELECT event_type, CAST((row_number() OVER (ORDER BY event_id) - 1) // 3000 AS BIGINT) AS window_id FROM events),
       r AS (SELECT event_type, count(*) AS r FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY event_type),
       c AS (SELECT window_id, event_type, count(*) AS c FROM w WHERE (window_id + 1) * 3000 <= (SELECT count(*) FROM events)
             GROUP BY window_id, event_type),
       t AS (SELECT window_id, r, c, sum(r) OVER (PARTITION BY window_id) AS nr, sum(c) OVER (PARTITION BY window_id) AS nc
             FROM c JOIN r USING (event_type)),
       chi AS (SELECT window_id, sum((r - nr * (r + c) / (nr + nc)::DOUBLE) ** 2 / (nr * (r + c) / (nr + nc)::DOUBLE)
             + (c - nc * (r + c) / (nr + nc)::DOUBLE) ** 2 / (nc * (r + c) / (nr + nc)::DOUBLE)) AS s FROM t GROUP BY window_id)
       SELECT window_id, 'event_type' AS feature, 'chi2' AS test, round(s, 6) AS statistic, s > 9.487729036781154
       AS drift_detected FROM chi""",
)
def ss03c(spark, sf):
    early = table(spark, sf, "events").where(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    found = stream_drift.count_window_drift(early, ss03b(spark, sf), [], ["event_type"])
    return found.select("window_id", "feature", "test", F.round("statistic", 6).alias("statistic"), "drift_detected")
