"""Scoring a stream of JSON records, bad records set aside."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskframe.operators.contracts import accepted_and_quarantined, validate_json_records
from riskframe.operators.models import score_batch


def load_model(path: str) -> PipelineModel:
    """Load before the stream starts, so that a missing model fails at once."""
    return PipelineModel.load(path)


def score_stream(
    records: DataFrame,
    *,
    column: str,
    fields: list[str],
    model: PipelineModel,
    keep: list[str],
    out: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Validate, score and store every micro-batch.

    A batch writes ``scored/batch=<id>`` and ``quarantine/batch=<id>`` with overwrite, so
    a batch repeated after a failure replaces its own folders and nothing is doubled.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        validated = validate_json_records(batch, column, fields).persist()
        good, bad = accepted_and_quarantined(validated)
        score_batch(model, good, keep).write.mode("overwrite").parquet(f"{out}/scored/batch={batch_id}")
        bad.select(*keep, column, "reason").write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")
        validated.unpersist()

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_scored(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/scored")


def read_quarantine(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/quarantine")
