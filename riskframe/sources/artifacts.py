"""Small result artifacts: JSON lines, markdown tables, file checksums."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.expressions import fixed_point
from riskframe.operators.prefix import ranked


def write_json_lines(df: DataFrame, path: str) -> None:
    """Each row as one JSON object, nested types included."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def markdown_line(dtypes: list[tuple[str, str]], *, digits: int = 4) -> Column:
    """Pipe-separated cells of a row; fractions with fixed digits, a missing one as ``nan``."""

    def cell(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        if kind in ("double", "float"):
            return F.coalesce(fixed_point(column, digits), F.lit("nan"))
        return F.coalesce(column.cast("string"), F.lit(""))

    cells = [cell(n, t) for n, t in dtypes]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def markdown_table(df: DataFrame, order: list[Column], *, digits: int = 4) -> DataFrame:
    """(position, line): header, ruler, then the rows of a report in order."""
    head = [
        (1, "| " + " | ".join(df.columns) + " |"),
        (2, "|" + "|".join("---" for _ in df.columns) + "|"),
    ]
    line = markdown_line(df.dtypes, digits=digits)
    body = ranked(df, [], order, "_place").select(
        (F.col("_place") + len(head)).cast("int").alias("position"), line.alias("line")
    )
    return df.sparkSession.createDataFrame(head, "position int, line string").unionByName(body)


def write_markdown(table: DataFrame, path: str) -> None:
    """The lines in order; the names of the part files follow that order."""
    table.orderBy("position").select("line").write.mode("overwrite").text(path)


def file_checksums(spark: SparkSession, path: str, *, pattern: str = "*") -> DataFrame:
    """(file_name, n_bytes, sha256) of every file below 2 GB, hashed where it is read.

    A name is the path below ``path``, so files of the same name in different folders stay apart.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(_below(path), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def _below(path: str) -> Column:
    # Spark names file:/x what a caller may name /x or file:///x; a relative path is found where it stands.
    place = re.sub("^[^/:]+:(//[^/]*)?(?=/)", "", path.rstrip("/"))
    start = "^(?:[^/:]+:)?(?://[^/]*)?" if place.startswith("/") else ""
    return F.regexp_extract("path", start + re.escape(place) + "/(.*)$", 1).alias("file_name")


#: Bytes of a block that one digest stands for, bytes that a task reads, and bytes that opening a file counts for.
BLOCK_BYTES = 64 << 20
TASK_BYTES = 64 << 20
OPEN_BYTES = 64 << 10


def block_checksums(spark: SparkSession, path: str, *, pattern: str = "*", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file_name, block, n_bytes, sha256): a digest for every range of ``block_bytes`` of every file.

    Files may have any size: the ranges of one are read by different tasks, a piece at a time; small ranges share
    a task.  Spark lists no empty files, so these have no blocks.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    # Lengths are known from the listing; no content is read here.
    number = F.ceil(F.col("length") / block_bytes)
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)).alias("block"))
    n_blocks, n_bytes = files.agg(F.coalesce(F.sum(number), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    wanted = math.ceil((n_bytes + n_blocks * OPEN_BYTES) / TASK_BYTES)
    tasks = max(1, min(int(n_blocks), max(wanted, spark.sparkContext.defaultParallelism)))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for name, block in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist()):
                if name.startswith("file:"):
                    system, place = fs.LocalFileSystem(), re.sub("^file:(//)?", "", name)
                else:
                    system, place = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", name))
                digest, left = hashlib.sha256(), block_bytes
                with system.open_input_file(place) as file:
                    file.seek(block * block_bytes)
                    while left and (piece := file.read(min(left, 1 << 20))):
                        digest.update(piece)
                        left -= len(piece)
                sizes.append(block_bytes - left)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(found, pa.string())],
                names=["path", "block", "n_bytes", "sha256"],
            )

    spread = blocks.select("path", "block").repartition(tasks, "path", "block")
    hashed = spread.mapInArrow(digests, "path string, block bigint, n_bytes bigint, sha256 string")
    return hashed.select(_below(path), "block", "n_bytes", "sha256")


def file_digests(blocks: DataFrame) -> DataFrame:
    """(file_name, n_bytes, n_blocks, digest): SHA-256 over a file's block digests in order."""
    ordered = F.sort_array(F.collect_list(F.struct("block", "sha256")))
    joined = F.array_join(F.transform(ordered, lambda b: b["sha256"]), "")
    return blocks.groupBy("file_name").agg(
        F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_blocks"), F.sha2(joined, 256).alias("digest")
    )


def changed_blocks(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file_name, block, expected, found) where a block differs, is missing (found null) or not listed (expected null)."""
    old = manifest.select("file_name", "block", F.col("sha256").alias("expected"))
    new = found.select("file_name", "block", F.col("sha256").alias("found"))
    both = old.join(new, ["file_name", "block"], "full")
    return both.where(~F.col("expected").eqNullSafe(F.col("found")))


def checksum_mismatches(checksums: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file_name, expected, found) where a listed file is absent or differs."""
    expected = manifest.select("file_name", F.col("sha256").alias("expected"))
    found = checksums.select("file_name", F.col("sha256").alias("found"))
    return expected.join(found, "file_name", "left").where(~F.col("expected").eqNullSafe(F.col("found")))


def require_checksums(checksums: DataFrame, manifest: DataFrame) -> None:
    """Abort when a file does not have the digest it should have."""
    bad = checksum_mismatches(checksums, manifest).limit(5).collect()
    if bad:
        raise ValueError("checksum mismatch: " + ", ".join(r["file_name"] for r in bad))
