"""Experiment runs as ordinary tables.

Long tables: runs (run_id, experiment, run_name, start_time), metrics (run_id, key,
value, ts, step), params and tags (run_id, key, value).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.expressions import run_search, run_stage

# The metrics, parameters and tags every run logs.
METRICS = [
    "roc_auc", "f1_macro", "precision_macro", "recall_macro", "accuracy",
    "cv_roc_auc_mean", "cv_roc_auc_std", "cv_f1_mean", "cv_f1_std",
    "training_time_s", "inference_latency_ms",
]
PARAMS = [
    "model_name", "seed", "cv_folds", "scoring_primary", "split_strategy",
    "search_type", "n_train", "n_val", "dimred_method", "dimred_n_components",
]
TAGS = [
    "model_family", "git_commit", "dataset_fingerprint", "compute_profile_s", "project_part",
    "framework", "python_version", "os_platform", "stage", "search_type",
    "dimred_method", "dimred_n_components", "dimred_explained_variance", "baseline_run_id",
]


def read_metric_logs(spark: SparkSession, path: str) -> DataFrame:
    """(key, value, ts, step, run_id) from text files of ``timestamp value step run_id`` lines.

    The metric name is the name of the file or, when the writer was partitioned by
    ``key``, of its folder.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).withColumn("_file", F.col("_metadata.file_path"))
    parts = F.split(F.trim("value"), r"\s+")
    folder = F.regexp_extract("_file", r"/key=([^/]+)/[^/]*$", 1)
    file_name = F.regexp_extract("_file", r"/([^/]+)$", 1)
    return lines.where(F.trim("value") != "").select(
        F.when(folder != "", folder).otherwise(file_name).alias("key"),
        F.get(parts, F.lit(1)).try_cast("double").alias("value"),
        F.get(parts, F.lit(0)).try_cast("long").alias("ts"),
        F.get(parts, F.lit(2)).try_cast("long").alias("step"),
        F.get(parts, F.lit(3)).alias("run_id"),
    )


def write_metric_logs(metrics: DataFrame, path: str) -> None:
    """Metric lines in one folder per metric name."""
    line = F.concat_ws(" ", F.col("ts").cast("string"), F.col("value").cast("string"), F.col("step").cast("string"), "run_id")
    metrics.select("key", line.alias("value")).write.mode("append").partitionBy("key").text(path)


def last_values(metrics: DataFrame) -> DataFrame:
    """(run_id, key, value): the value logged last."""
    return metrics.groupBy("run_id", "key").agg(F.max_by("value", logged_order()).alias("value"))


def logged_order() -> Column:
    """(ts, step) as one number, so that the latest value is a hash aggregate; steps are below 2^32."""
    return F.col("ts").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(11,0)") + F.col("step").cast("decimal(20,0)")


def pivot_metrics(metrics: DataFrame, keys: list[str] = METRICS) -> DataFrame:
    """One row per run, one column per metric, null where it was not logged."""
    chosen = metrics.where(F.col("key").isin(keys))
    return chosen.groupBy("run_id").agg(
        *[
            F.max_by(F.when(F.col("key") == k, F.col("value")), F.when(F.col("key") == k, logged_order())).alias(k)
            for k in keys
        ]
    )


def pivot_text(table: DataFrame, keys: list[str]) -> DataFrame:
    """One row per run, one column per parameter or tag."""
    chosen = table.where(F.col("key").isin(keys))
    return chosen.groupBy("run_id").agg(
        *[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys]
    )


def consolidated(
    runs: DataFrame,
    metrics: DataFrame,
    tags: DataFrame,
    *,
    stage: str | None = None,
    max_runs: int | None = None,
) -> DataFrame:
    """Best runs first: run_name, three tags ("" when absent), eleven metrics (null when absent).

    Every run, unless the caller asks for the first ``max_runs``.
    """
    labels = pivot_text(tags, ["model_family", "stage", "search_type"])
    wide = runs.select("run_id", "run_name").join(labels, "run_id", "left").join(pivot_metrics(metrics), "run_id", "left")
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("model_family", "stage", "search_type")]
    out = wide.select("run_id", "run_name", *text, *METRICS)
    if stage:
        out = out.where(F.col("stage") == stage)
    out = out.orderBy(F.desc_nulls_last("roc_auc"), "run_id")
    return out.limit(max_runs) if max_runs else out


def run_record(
    run_name: Column,
    *,
    tags: dict[str, Column],
    metrics: dict[str, Column],
    params: dict[str, Column],
    clf_params: dict[str, Column],
) -> list[Column]:
    """The map columns of a run row; stage and search type come from the run name."""
    tags = {**tags, "stage": run_stage(run_name), "search_type": run_search(run_name)}
    defaults = {"dimred_method": "none", "dimred_n_components": "0", "dimred_explained_variance": "na", "baseline_run_id": ""}
    for k, v in defaults.items():
        tags.setdefault(k, F.lit(v))
    all_params = {**params, **{f"clf__{k}": v for k, v in clf_params.items()}}

    def as_map(entries: dict[str, Column], to: str) -> Column:
        flat = [x for k, v in entries.items() for x in (F.lit(k), v.cast(to))]
        return F.create_map(*flat)

    return [
        as_map(all_params, "string").alias("params"),
        as_map(tags, "string").alias("tags"),
        as_map(metrics, "double").alias("metrics"),
    ]


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run rows (run_id, ..., params, tags, metrics) to a table laid out by batch and stage.

    A batch counts once its commit is written, after all its rows; what a failed write left behind is never read.
    Runs that are committed already are not written again, so an append may be repeated.  One writer at a time.
    A row without a ``run_id`` is an error.
    """
    spark = runs.sparkSession
    committed = _committed(spark, path)
    new = runs.withColumn("run_id", F.coalesce("run_id", F.raise_error(F.lit("a run needs a run_id"))))
    if committed is not None:
        new = new.join(committed.select("run_id"), "run_id", "left_anti").select(*runs.columns)
    if new.isEmpty():
        return
    batch = f"b{uuid.uuid4().hex}"
    new.withColumn("stage", F.col("tags")["stage"]).write.partitionBy("stage").parquet(f"{path}/batch={batch}")
    spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("append").parquet(f"{path}/{_COMMITS}")


#: Spark passes over folders with such a name unless it is asked for one.
_COMMITS = "_commits"


def _committed(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of committed batches; None where nothing was ever committed."""
    try:
        commits = spark.read.schema("batch string").parquet(f"{path}/{_COMMITS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return spark.read.parquet(path).join(commits, "batch", "left_semi").drop("batch")


def read_runs(spark: SparkSession, path: str, stage: str | None = None) -> DataFrame:
    """Runs of committed batches; a stage reads only its own folders."""
    runs = _committed(spark, path)
    if runs is None:
        raise FileNotFoundError(f"no committed runs in {path}")
    return runs.where(F.col("stage") == stage) if stage else runs


def explode_map(runs: DataFrame, column: str) -> DataFrame:
    """(run_id, key, value) of a map column."""
    return runs.select("run_id", F.explode(column).alias("key", "value"))
