"""Drift on a stream: per time window, and per fixed number of records."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.functions.significance import is_significant, ks_p_value
from riskframe.operators.drift import count_windows, feature_histogram, histogram_drift
from riskframe.operators.prefix import prefix_counts, to_long

#: Size parameter of quantile sketches, and marks of a reference distribution.
SKETCH = 2048
MARKS = 1000


def window_histograms(
    stream: DataFrame, features: list[str], *, ts: str = "ts", window: str = "7 days", late: str = "1 day"
) -> DataFrame:
    """(window_start, window_end, feature, value, n) per tumbling window.

    The state holds one counter per distinct value, not the rows; rows later than the
    watermark are dropped.
    """
    timed = stream.withWatermark(ts, late).withColumn("_w", F.window(ts, window))
    counted = feature_histogram(timed, features, ["_w"])
    return counted.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "feature", "value", "n"
    )


def start_window_histograms(histograms: DataFrame, *, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append each finished window's histogram (or sketch) to a table."""
    writer = histograms.writeStream.outputMode("append").format("parquet").option("path", out)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def window_drift(
    reference: DataFrame, histograms: DataFrame, continuous: list[str], categorical: list[str], alpha: float = 0.05
) -> DataFrame:
    """(window_start, feature, test, statistic, p_value, drift_detected) per finished window."""
    return histogram_drift(
        feature_histogram(reference, [*continuous, *categorical]),
        histograms.select("window_start", "feature", "value", "n"),
        ["window_start"],
        continuous,
        categorical,
        alpha,
    )


def rank_error(k: int = SKETCH, marks: int = MARKS) -> float:
    """How far a statistic of :func:`sketch_drift` can be off, at the 99 % confidence that sketches are sized for."""
    # The published error of a KLL sketch for single ranks.
    return 2.296 / k**0.9723 + 1.0 / marks


def window_sketches(
    stream: DataFrame, features: list[str], *, ts: str = "ts", window: str = "7 days", late: str = "1 day", k: int = SKETCH
) -> DataFrame:
    """(window_start, window_end, feature, n, sketch) per tumbling window, for continuous features.

    The state holds one mergeable quantile sketch per window and feature: its size depends on ``k``, not on the rows
    or their distinct values.  Missing values are left out, rows later than the watermark are dropped.
    """
    timed = stream.withWatermark(ts, late).withColumn("_w", F.window(ts, window))
    long = to_long(timed, features, keep=["_w"]).where(F.col("value").isNotNull())
    sketched = long.groupBy("_w", "feature").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch"))
    return sketched.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "feature", "n", "sketch")


def merge_sketches(sketches: DataFrame, group: list[str], k: int = SKETCH) -> DataFrame:
    """(group, feature, n, sketch): windows put together, for instance weeks to months, without their rows."""
    return sketches.groupBy(*group, "feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def reference_marks(reference: DataFrame, features: list[str], marks: int = MARKS) -> DataFrame:
    """(feature, n_ref, marks): exact shares of the reference below and up to about ``marks`` of its values.

    Between neighbouring marks lies less than one part in ``marks`` of the reference; a value that more rows share is
    a mark itself.
    """
    long = to_long(reference, features).where(F.col("value").isNotNull())
    table = prefix_counts(long, ["feature"], "value", {"n": F.lit(1)}, n_groups=len(features))
    upto, total = F.col("n_before") + F.col("n"), F.col("n_total")
    chosen = table.where((F.floor(upto * marks / total) > F.floor(F.col("n_before") * marks / total)) | (upto == total))
    mark = F.struct("value", (F.col("n_before") / total).alias("below"), (upto / total).alias("upto"))
    return chosen.groupBy("feature").agg(F.max("n_total").alias("n_ref"), F.sort_array(F.collect_list(mark)).alias("marks"))


def sketch_drift(
    reference: DataFrame, sketches: DataFrame, features: list[str], group: list[str], *, alpha: float = 0.05, k: int = SKETCH, marks: int = MARKS
) -> DataFrame:
    """(group, feature, n, statistic, error, p_value, drift_detected, certain) of sketched windows.

    The Kolmogorov-Smirnov statistic from sketch ranks at the marks of the reference, off by at most ``error``.
    ``certain`` says that the verdict holds at both ends of that range.
    """
    # Sketches are asked at literals only: at most ``marks`` + 1 of them per feature come to the driver.
    known = reference_marks(reference, features, marks).collect()
    if not known:
        sketches = sketches.limit(0)

    def per_feature(value) -> Column:
        """A column chosen by the feature's name."""
        out = F.lit(None)
        for row in known:
            out = F.when(F.col("feature") == row["feature"], value(row)).otherwise(out)
        return out

    def gap(row) -> Column:
        values = [m["value"] for m in row["marks"]]
        # Next to the value from below: what the current window has of the value itself is not counted there.
        below = [math.nextafter(v, -math.inf) for v in values]
        gaps = [
            F.zip_with(F.kll_sketch_get_rank_double("sketch", F.lit(at)), F.lit([m[share] for m in row["marks"]]), lambda a, b: F.abs(a - b))
            for at, share in ((values, "upto"), (below, "below"))
        ]
        return F.greatest(*[F.array_max(g) for g in gaps])

    named = F.col("feature").isin([row["feature"] for row in known])
    found = sketches.where((F.col("n") > 0) & named).withColumn("n_ref", per_feature(lambda row: F.lit(row["n_ref"])).cast("long"))
    found = found.withColumn("statistic", per_feature(gap).cast("double"))
    error = rank_error(k, marks)
    found = found.withColumn("error", F.lit(error))

    def verdict(statistic: Column) -> Column:
        bounded = F.least(F.greatest(statistic, F.lit(0.0)), F.lit(1.0))
        return is_significant(ks_p_value(bounded, F.col("n_ref"), F.col("n")), alpha)

    found = found.withColumns(
        {
            "p_value": ks_p_value(F.col("statistic"), F.col("n_ref"), F.col("n")),
            "drift_detected": verdict(F.col("statistic")),
            "certain": verdict(F.col("statistic") - error) == verdict(F.col("statistic") + error),
        }
    )
    return found.select(*group, "feature", "n", "statistic", "error", "p_value", "drift_detected", "certain")


def start_count_windows(
    stream: DataFrame, *, key: str, features: list[str], size: int, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Histograms per ``size`` consecutive records, in arrival order of micro-batches.

    A batch stores the position after its last row next to its histograms; the next one
    starts there.  Both are files named after the batch, so a repeated batch reads the
    same position and replaces its own output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        start = 0
        if batch_id > 0:
            start = spark.read.schema("end_row long").parquet(f"{out}/positions/batch={batch_id - 1}").first()[0]
        end = spark.createDataFrame([(start + rows.count(),)], "end_row long")
        end.write.mode("overwrite").parquet(f"{out}/positions/batch={batch_id}")
        placed = rows.join(count_windows(rows, key, size, start), key)
        feature_histogram(placed, features, ["window_id"]).write.mode("overwrite").parquet(
            f"{out}/histograms/batch={batch_id}"
        )
        rows.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_count_windows(spark: SparkSession, out: str, size: int) -> DataFrame:
    """(window_id, feature, value, n) of full windows only; a window may span batches."""
    parts = spark.read.parquet(f"{out}/histograms")
    merged = parts.groupBy("window_id", "feature", "value").agg(F.sum("n").alias("n"))
    total = spark.read.parquet(f"{out}/positions").agg(F.max("end_row").alias("_rows"))
    # ``total`` is one row.
    full = merged.crossJoin(F.broadcast(total)).where((F.col("window_id") + 1) * size <= F.col("_rows"))
    return full.drop("_rows")


def count_window_drift(
    reference: DataFrame, histograms: DataFrame, continuous: list[str], categorical: list[str], alpha: float = 0.05
) -> DataFrame:
    """(window_id, feature, test, statistic, p_value, drift_detected)."""
    return histogram_drift(
        feature_histogram(reference, [*continuous, *categorical]), histograms, ["window_id"],
        continuous, categorical, alpha,
    )
