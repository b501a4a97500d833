"""The labelled tables, score tables and run tables that the queries work on.

Each binding exists twice: as a DataFrame over the given tables and as a SQL common
table expression with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.roles import Roles


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


CTE: dict[str, str] = {}


def with_(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({CTE[n]})" for n in names) + " "


# --- labelled rows of orders ----------------------------------------------------------

ACCOUNT_ROLES = Roles(
    key="row_id",
    target="target",
    continuous=["amount", "age"],
    ordinal=["priority"],
    categorical=["segment", "month"],
    sensitive=["segment", "priority"],
)


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order with a unique key, mixed feature kinds and a 0/1 target."""
    age = 21 + F.col("o_custkey") % 58
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_totalprice").alias("amount"),
        age.alias("age"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("priority"),
        (F.col("o_custkey") % 4).alias("segment"),
        F.month("o_orderdate").cast("long").alias("month"),
        F.year("o_orderdate").cast("long").alias("year"),
        F.when(F.col("o_totalprice") + 4000.0 * age > 550000.0, 1).otherwise(0).alias("target"),
    )


CTE["accounts"] = """
SELECT o_orderkey AS row_id, o_totalprice AS amount, 21 + o_custkey % 58 AS age,
       CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority, o_custkey % 4 AS segment,
       CAST(month(o_orderdate) AS BIGINT) AS month, CAST(year(o_orderdate) AS BIGINT) AS year,
       CASE WHEN o_totalprice + 4000.0::DOUBLE * (21 + o_custkey % 58) > 550000.0 THEN 1 ELSE 0 END AS target
FROM orders"""


# --- labelled rows of lineitem --------------------------------------------------------

LINE_FEATURES = ["quantity", "price", "discount", "tax"]


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line item; no key, numeric measures, coded categories, a 0/1 target."""
    return table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_linenumber").cast("long").alias("line"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("flag"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("status"),
        F.when(F.col("l_quantity") * F.col("l_extendedprice") > 1300000.0, 1).otherwise(0).alias("target"),
    )


CTE["lines"] = """
SELECT l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
       CAST(l_linenumber AS BIGINT) AS line,
       CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS flag,
       CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS status,
       CASE WHEN l_quantity * l_extendedprice > 1300000.0 THEN 1 ELSE 0 END AS target
FROM lineitem"""


# --- a wide panel per customer --------------------------------------------------------

BILLS = [f"bill{i}" for i in range(1, 7)]
PAYMENTS = [f"paid{i}" for i in range(1, 7)]
DELAYS = [f"delay{i}" for i in range(1, 7)]


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer and period 1..6: billed amount, urgent amount, late orders; plus a limit."""
    cents = F.col("o_totalprice").cast("decimal(18,2)")
    period = F.year("o_orderdate") - 1994
    urgent = F.col("o_orderpriority") == "1-URGENT"
    sums = []
    for i in range(1, 7):
        here = period == i
        sums += [
            F.coalesce(F.sum(F.when(here, cents)), F.lit(0)).cast("double").alias(f"bill{i}"),
            F.coalesce(F.sum(F.when(here & urgent, cents)), F.lit(0)).cast("double").alias(f"paid{i}"),
            F.count(F.when(here & (F.col("o_orderstatus") == "P"), 1)).alias(f"delay{i}"),
        ]
    per = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("cust")).agg(*sums)
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("cust"), F.col("c_acctbal").alias("credit"))
    return customer.join(per, "cust")


CTE["panel"] = (
    "SELECT c_custkey AS cust, any_value(c_acctbal) AS credit, "
    + ", ".join(
        f"CAST(coalesce(sum(CASE WHEN year(o_orderdate) = {1994 + i} THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) "
        f"AS DOUBLE) AS bill{i}, "
        f"CAST(coalesce(sum(CASE WHEN year(o_orderdate) = {1994 + i} AND o_orderpriority = '1-URGENT' "
        f"THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS paid{i}, "
        f"count(CASE WHEN year(o_orderdate) = {1994 + i} AND o_orderstatus = 'P' THEN 1 END) AS delay{i}"
        for i in range(1, 7)
    )
    + " FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"
)


# --- scores of three fixed rules ------------------------------------------------------

MODELS = ["age_rule", "amount_rule", "month_rule"]


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """(key, model, y, score, prediction) of a strong, a weak and a heavily tied scorer."""
    base = accounts(spark, sf)
    rules = {
        "amount_rule": F.col("amount") / 600000.0,
        "age_rule": F.col("age") / 100.0,
        "month_rule": F.col("month") / 12.0,
    }
    rows = F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in rules.items()])
    long = base.select(F.col("row_id").alias("key"), F.col("target").alias("y"), F.inline(rows))
    return long.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


CTE["scores"] = """
SELECT key, model, y, score, CAST(score > 0.5 AS INTEGER) AS prediction FROM (
  SELECT row_id AS key, 'amount_rule' AS model, target AS y, amount / 600000.0::DOUBLE AS score FROM accounts
  UNION ALL SELECT row_id, 'age_rule', target, age / 100.0::DOUBLE FROM accounts
  UNION ALL SELECT row_id, 'month_rule', target, month / 12.0::DOUBLE FROM accounts)"""

# Confusion cells, per-class table and rank-sum area in SQL.
CTE["cells"] = """
SELECT model, count(*) FILTER (y = 0 AND prediction = 0) AS tn, count(*) FILTER (y = 0 AND prediction = 1) AS fp,
       count(*) FILTER (y = 1 AND prediction = 0) AS fn, count(*) FILTER (y = 1 AND prediction = 1) AS tp
FROM scores GROUP BY model"""

CTE["classes"] = """
SELECT model, label, hit, claimed, support, total,
       CASE WHEN claimed = 0 THEN 0 ELSE hit / claimed::DOUBLE END AS p,
       CASE WHEN support = 0 THEN 0 ELSE hit / support::DOUBLE END AS r,
       CASE WHEN hit = 0 THEN 0 ELSE 2.0 * (hit / claimed::DOUBLE) * (hit / support::DOUBLE)
            / (hit / claimed::DOUBLE + hit / support::DOUBLE) END AS f
FROM (SELECT model, 0 AS label, tn AS hit, tn + fn AS claimed, tn + fp AS support, tn + fp + fn + tp AS total FROM cells
      UNION ALL SELECT model, 1, tp, tp + fp, tp + fn, tn + fp + fn + tp FROM cells)
WHERE claimed > 0 OR support > 0"""

CTE["macro"] = """
SELECT model, sum(hit) / max(total)::DOUBLE AS accuracy, avg(p) AS precision_macro, avg(r) AS recall_macro,
       avg(f) AS f1_macro FROM classes GROUP BY model"""

CTE["areas"] = """
SELECT model, (sum(CASE WHEN y = 1 THEN rk END) - max(np) * (max(np) + 1) / 2.0) / (max(np) * max(nn))::DOUBLE AS roc_auc
FROM (SELECT model, y,
             rank() OVER (PARTITION BY model ORDER BY score)
               + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS rk,
             sum(y) OVER (PARTITION BY model) AS np, sum(1 - y) OVER (PARTITION BY model) AS nn FROM scores)
GROUP BY model"""


# --- experiment runs ------------------------------------------------------------------

MODEL_NAMES = ["perceptron", "logreg", "dtree", "rf", "gb"]
CONFIGS = ["pca_k10", "pca_k15", "lda_k1"]


def _pick(index, values: list[str]):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def run_heads(spark: SparkSession, sf: str) -> DataFrame:
    """One run per supplier: identity, stage, model, reduction, name, start time."""
    key = F.col("s_suppkey")
    base = table(spark, sf, "supplier").select(
        F.md5(key.cast("string")).alias("run_id"),
        F.concat(F.lit("exp"), (F.col("s_nationkey") % 3).cast("string")).alias("experiment"),
        key.alias("suppkey"),
        _pick(key % 5, MODEL_NAMES).alias("model_name"),
        _pick(key % 5, ["linear", "linear", "tree", "ensemble", "ensemble"]).alias("model_family"),
        _pick(F.floor(key / 5) % 3, ["baseline", "tune", "dimred"]).alias("stage"),
        _pick(F.floor(key / 15) % 3, CONFIGS).alias("_config"),
        F.floor(F.col("s_acctbal") * 100 + 0.5).cast("long").alias("start_time"),
    )
    reduced = F.col("stage") == "dimred"
    config = F.when(reduced, F.col("_config")).otherwise("none")
    search = F.when(F.col("stage") == "tune", "grid").otherwise("none")
    name = F.concat_ws(
        "__", "stage", "model_name", F.lit("numstd_catoh"), config, search, F.lit("seed42"),
        F.concat(F.lit("data"), F.substring("run_id", 1, 8)), F.concat(F.lit("code"), F.substring("run_id", 9, 7)),
    )
    return base.select(
        "run_id", "experiment", "suppkey", "model_name", "model_family", "stage",
        search.alias("search_type"),
        F.when(reduced, F.split("_config", "_k")[0]).otherwise("none").alias("dimred_method"),
        F.when(reduced, F.split("_config", "_k")[1]).otherwise("0").alias("dimred_n_components"),
        name.alias("run_name"),
        "start_time",
    )


CTE["run_heads"] = """
SELECT run_id, experiment, suppkey, model_name, model_family, stage, search_type,
       CASE WHEN stage = 'dimred' THEN split_part(config, '_k', 1) ELSE 'none' END AS dimred_method,
       CASE WHEN stage = 'dimred' THEN split_part(config, '_k', 2) ELSE '0' END AS dimred_n_components,
       concat_ws('__', stage, model_name, 'numstd_catoh', CASE WHEN stage = 'dimred' THEN config ELSE 'none' END,
                 search_type, 'seed42', 'data' || substr(run_id, 1, 8), 'code' || substr(run_id, 9, 7)) AS run_name,
       start_time
FROM (SELECT md5(CAST(s_suppkey AS VARCHAR)) AS run_id, 'exp' || (s_nationkey % 3) AS experiment,
             s_suppkey AS suppkey,
             ['perceptron','logreg','dtree','rf','gb'][s_suppkey % 5 + 1] AS model_name,
             ['linear','linear','tree','ensemble','ensemble'][s_suppkey % 5 + 1] AS model_family,
             ['baseline','tune','dimred'][(s_suppkey // 5) % 3 + 1] AS stage,
             CASE WHEN (s_suppkey // 5) % 3 = 1 THEN 'grid' ELSE 'none' END AS search_type,
             ['pca_k10','pca_k15','lda_k1'][(s_suppkey // 15) % 3 + 1] AS config,
             CAST(floor(s_acctbal * 100 + 0.5) AS BIGINT) AS start_time
      FROM supplier)"""

# Metric key to (formula in Spark SQL and DuckDB alike); q, d, t are mean quantity,
# discount and tax, n the row count.
METRIC_FORMULAS = {
    "roc_auc": "floor((q / 50) * 1000 + 0.5) / 1000",
    "f1_macro": "floor((q / 60) * 1000 + 0.5) / 1000",
    "precision_macro": "floor((1 - d) * 1000 + 0.5) / 1000",
    "recall_macro": "floor((1 - t) * 1000 + 0.5) / 1000",
    "accuracy": "floor((q / 55) * 1000 + 0.5) / 1000",
    "cv_roc_auc_mean": "floor((q / 51) * 1000 + 0.5) / 1000",
    "cv_roc_auc_std": "floor((d / 10) * 10000 + 0.5) / 10000",
    "cv_f1_mean": "floor((q / 61) * 1000 + 0.5) / 1000",
    "cv_f1_std": "floor((t / 10) * 10000 + 0.5) / 10000",
    "training_time_s": "n * 1.0",
    "inference_latency_ms": "floor((t) * 10000 + 0.5) / 10000",
}


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """(run_id, key, value, ts, step): one logged value per supplier, year and metric.

    Runs whose number divides by 11 never logged a training time.
    """
    def mean(column: str):
        return (F.sum(F.col(column).cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)))

    per = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").cast("long").alias("ts")).agg(
        mean("l_quantity").alias("q"),
        mean("l_discount").alias("d"),
        mean("l_tax").alias("t"),
        F.count(F.lit(1)).cast("double").alias("n"),
    )
    entries = ", ".join(f"struct('{k}' AS key, CAST({e} AS DOUBLE) AS value)" for k, e in METRIC_FORMULAS.items())
    long = per.select("l_suppkey", "ts", F.expr(f"inline(array({entries}))"))
    long = long.where((F.col("key") != "training_time_s") | (F.col("l_suppkey") % 11 != 0))
    return long.select(
        F.md5(F.col("l_suppkey").cast("string")).alias("run_id"), "key", "value", "ts", (F.col("ts") - 1990).alias("step")
    )


CTE["run_metrics"] = (
    "SELECT md5(CAST(l_suppkey AS VARCHAR)) AS run_id, key, value, ts, ts - 1990 AS step FROM ("
    + " UNION ALL ".join(
        f"SELECT l_suppkey, ts, '{k}' AS key, CAST({e} AS DOUBLE) AS value FROM per_supplier_year"
        for k, e in METRIC_FORMULAS.items()
    )
    + ") WHERE key <> 'training_time_s' OR l_suppkey % 11 <> 0"
)
CTE["per_supplier_year"] = """
SELECT l_suppkey, CAST(year(l_shipdate) AS BIGINT) AS ts,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS q,
       CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS d,
       CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS t, CAST(count(*) AS DOUBLE) AS n
FROM lineitem GROUP BY l_suppkey, ts"""

CTE["wide_metrics"] = (
    "SELECT run_id, "
    + ", ".join(f"arg_max(value, ts) FILTER (key = '{k}') AS {k}" for k in METRIC_FORMULAS)
    + " FROM run_metrics GROUP BY run_id"
)
CTE["runs"] = (
    "SELECT h.*, "
    + ", ".join(METRIC_FORMULAS)
    + " FROM run_heads h LEFT JOIN wide_metrics m USING (run_id)"
)
RUN_CTES = ("per_supplier_year", "run_metrics", "wide_metrics", "run_heads", "runs")


def run_tags(spark: SparkSession, sf: str) -> DataFrame:
    """(run_id, key, value); runs whose number divides by 13 have no family tag."""
    heads = run_heads(spark, sf)
    rows = F.array(
        *[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in ("model_family", "stage", "search_type")]
    )
    long = heads.select("run_id", "suppkey", F.inline(rows))
    return long.where((F.col("key") != "model_family") | (F.col("suppkey") % 13 != 0)).drop("suppkey")


def wide_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Run heads with one column per metric, the value logged last."""
    from riskframe.sources.runstore import pivot_metrics

    return run_heads(spark, sf).join(pivot_metrics(run_metrics(spark, sf)), "run_id", "left")
