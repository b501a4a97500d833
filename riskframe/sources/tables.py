"""Scans and sinks of ordinary tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expressions import normalise_name


def drop_id(df: DataFrame, id_col: str) -> DataFrame:
    """Drop the id column; unlike ``DataFrame.drop`` an absent column is an error."""
    if id_col not in df.columns:
        raise KeyError(f"id column {id_col!r} is not in the table")
    return df.drop(id_col)


def read_titled_text(
    spark: SparkSession, path: str, schema: T.StructType, *, head_lines: int = 2, sep: str = ",", id_col: str | None = None
) -> DataFrame:
    """Delimited text whose files start with ``head_lines`` lines that are no data: a title and a header.

    They are known by their place: a task that reads a file from its first byte passes over that many lines.
    Their text may be anything, a data line that equals one of them stays, and files stay splittable.
    Empty lines are no rows.
    """
    if head_lines < 0:
        raise ValueError("head_lines must not be negative")
    # Lines of a file's first split carry the file's number, all others null.
    head = F.when(F.col("_metadata.file_block_start") == 0, F.xxhash64("_metadata.file_path"))
    lines = spark.read.text(path).select("value", head.alias("head"))

    def pass_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, left = None, 0
        for batch in batches:
            # Runs of lines of one file; null stands for all lines that are in no first split.
            runs = pc.run_end_encode(batch.column("head"))
            keep, start = np.ones(batch.num_rows, bool), 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if name != file:
                    file, left = name, head_lines
                if name is not None:
                    passed = min(left, end - start)
                    keep[start : start + passed] = False
                    left -= passed
                start = end
            yield pa.RecordBatch.from_arrays([batch.column("value").filter(pa.array(keep))], names=["value"])

    body = lines.mapInArrow(pass_over, "value string") if head_lines else lines
    parsed = body.where(F.trim("value") != "").select(F.from_csv("value", schema.toDDL(), {"sep": sep}).alias("r"))
    table = parsed.select("r.*")
    return drop_id(table, id_col) if id_col else table


def write_titled_text(df: DataFrame, path: str, *, title: str, sep: str = ",") -> None:
    """The inverse: every file starts with a title line and a header line."""
    head = [title, sep.join(df.columns)]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": head})
        yield from batches

    rows = df.select(F.to_csv(F.struct(*df.columns), {"sep": sep}).alias("value"))
    rows.mapInArrow(begin, "value string").write.mode("append").text(path)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case and underscore every column name; a clash is an error."""
    names = [normalise_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names clash after normalisation: {names}")
    return df.toDF(*names)


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Replace all column names, in order."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, *, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line; the schema is always given, never inferred."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_splits(splits: DataFrame, path: str) -> None:
    """Split table laid out by split, so a reader that excludes test never opens its files."""
    write_parquet(splits, path, partition_by=["split"])


def read_splits(spark: SparkSession, path: str, *, include_test: bool = False) -> DataFrame:
    splits = spark.read.parquet(path)
    return splits if include_test else splits.where(F.col("split") != "test")
