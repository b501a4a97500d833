"""Sources, sinks and streams."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators import drift
from riskframe.session import fresh_path, shared_dir
from riskframe.sources import artifacts, runstore, tables
from riskframe.streaming import drift as stream_drift

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])


def test_titled_text_in_several_files(spark):
    path = fresh_path(spark, "titled")
    os.makedirs(path)
    for i in range(3):
        with open(f"{path}/f{i}.csv", "w") as f:
            f.write(f"a title\nid,x,s\n{i},1.5,\"a,b\"\n{i + 10},,c\n")
    got = tables.read_titled_text(spark, path, SCHEMA, id_col="id")
    assert got.columns == ["x", "s"] and got.count() == 6
    assert got.where("s = 'a,b'").count() == 3 and got.where("x is null").count() == 3


@pytest.mark.parametrize("split_bytes", [64, 1000, 10**8])
def test_head_lines_are_known_by_place(spark, split_bytes):
    path = fresh_path(spark, "titled")
    os.makedirs(path)
    want = []
    for i, n in enumerate([0, 1, 2, 5, 400]):
        # Data lines that equal title or header, at all places; one file is shorter than its head.
        lines_ = [f"title {i}", "id,x,s", *(["id,x,s", f"title {i}"] * n)]
        with open(f"{path}/f{i}.csv", "w") as f:
            f.write("\n".join(lines_[: 1 if n == 0 else None]) + "\n")
        want += lines_[2:]
    schema = T.StructType().add("a", "string").add("b", "string").add("c", "string")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = [r.a for r in tables.read_titled_text(spark, path, schema).collect()]
        three = tables.read_titled_text(spark, path, schema, head_lines=3).count()
        none = tables.read_titled_text(spark, path, schema, head_lines=0).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == sorted(v.split(",")[0] for v in want)
    assert (three, none) == (len(want) - 4, len(want) + 9)
    with pytest.raises(ValueError):
        tables.read_titled_text(spark, path, schema, head_lines=-1)


def test_missing_id_column(customers):
    with pytest.raises(KeyError):
        tables.drop_id(customers, "ID")


def test_name_rules(customers):
    with pytest.raises(ValueError):
        tables.normalise_columns(customers.toDF("A", "a ", "b", "c", "d", "e"))
    with pytest.raises(ValueError):
        tables.rename_by_position(customers, ["x"])


def test_checksums(spark):
    path = fresh_path(spark, "files")
    os.makedirs(path)
    with open(f"{path}/a.bin", "wb") as f:
        f.write(b"hello")
    found = artifacts.file_checksums(spark, path)
    # Fixed value: SHA-256 of the five letters.
    good = "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    assert found.first().sha256 == good
    manifest = spark.createDataFrame([("a.bin", good), ("b.bin", good)], "file_name string, sha256 string")
    with pytest.raises(ValueError, match="b.bin"):
        artifacts.require_checksums(found, manifest)
    artifacts.require_checksums(found, manifest.where("file_name = 'a.bin'"))


def test_block_checksums(spark):
    path = fresh_path(spark, "files")
    os.makedirs(f"{path}/deep")
    contents = {"a.bin": os.urandom(1000), "deep/b.bin": b"x" * 256, "empty.bin": b""}
    for name, data in contents.items():
        with open(f"{path}/{name}", "wb") as f:
            f.write(data)

    def blocks(data):
        return [data[i : i + 128] for i in range(0, max(len(data), 1), 128)]

    def listed(found):
        return {(r.file_name, r.block): (r.n_bytes, r.sha256) for r in found.collect()}

    reader = artifacts.block_checksums(spark, path, block_bytes=128)
    top = {"a.bin": contents["a.bin"]}  # no files of folders below, unless these are partitions; no empty files
    before = listed(reader)
    assert before == {(n, i): (len(b), hashlib.sha256(b).hexdigest()) for n, d in top.items() for i, b in enumerate(blocks(d))}
    whole = {r.file_name: (r.n_bytes, r.n_blocks, r.digest) for r in artifacts.file_digests(reader).collect()}
    joined = "".join(hashlib.sha256(b).hexdigest() for b in blocks(contents["a.bin"]))
    assert whole["a.bin"] == (1000, 8, hashlib.sha256(joined.encode()).hexdigest())
    manifest = spark.createDataFrame([(n, b, h) for (n, b), (_, h) in before.items()], "file_name string, block long, sha256 string")
    with open(f"{path}/a.bin", "r+b") as f:
        f.seek(300)
        f.write(bytes([contents["a.bin"][300] ^ 1]))
    with open(f"{path}/empty.bin", "wb") as f:
        f.write(b"y" * 200)
    changed = artifacts.changed_blocks(artifacts.block_checksums(spark, path, block_bytes=128), manifest).collect()
    assert {(r.file_name, r.block, r.expected is None) for r in changed} == {("a.bin", 2, False), ("empty.bin", 0, True), ("empty.bin", 1, True)}


def test_small_blocks_share_tasks(spark):
    path = fresh_path(spark, "files")
    os.makedirs(path)
    contents = {f"{i}.bin": os.urandom(200 + i) for i in range(150)}
    for name, data in contents.items():
        with open(f"{path}/{name}", "wb") as f:
            f.write(data)
    found = artifacts.block_checksums(spark, path, block_bytes=64)
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    want = {
        (name, at // 64): (len(data[at : at + 64]), hashlib.sha256(data[at : at + 64]).hexdigest())
        for name, data in contents.items()
        for at in range(0, len(data), 64)
    }
    assert {(r.file_name, r.block): (r.n_bytes, r.sha256) for r in found.collect()} == want


def test_names_below_a_folder_given_as_uri(spark):
    path = fresh_path(spark, "files")
    os.makedirs(f"{path}/part=1")
    with open(f"{path}/part=1/a.bin", "wb") as f:
        f.write(b"x" * 100)
    # The last one is the end of an absolute path, as a relative one is.
    for spelled in (path, f"{path}/", f"file:{path}", f"file://{path}", f"file://{path}/", path[1:]):
        below = spark.createDataFrame([(f"file:{path}/part=1/a.bin",)], "path string").select(artifacts._below(spelled))
        assert below.first().file_name == "part=1/a.bin", spelled
    for spelled in (path, f"file:{path}", f"file://{path}"):
        assert [r.file_name for r in artifacts.file_checksums(spark, spelled).collect()] == ["part=1/a.bin"]
        blocks = artifacts.block_checksums(spark, spelled, block_bytes=64)
        assert {(r.file_name, r.block, r.n_bytes) for r in blocks.collect()} == {("part=1/a.bin", 0, 64), ("part=1/a.bin", 1, 36)}
    remote = spark.createDataFrame([("hdfs://x/x/part=1/a.bin",)], "path string")
    for spelled in ("hdfs://x/x", "hdfs:///x", "/x"):
        assert remote.select(artifacts._below(spelled)).first().file_name == "part=1/a.bin"


def test_runs_count_once_and_only_when_committed(spark):
    path = fresh_path(spark, "runs")

    def runs(names, bad=False):
        rows = spark.createDataFrame([(n,) for n in names], "run_id string")
        stage = F.when(F.lit(not bad) | (F.col("run_id") != names[-1]), "tune").otherwise(F.raise_error(F.lit("lost")))
        return rows.repartition(4).select("run_id", F.create_map(F.lit("stage"), stage).alias("tags"))

    def stored():
        return sorted(r.run_id for r in runstore.read_runs(spark, path, "tune").collect())

    with pytest.raises(FileNotFoundError):
        runstore.read_runs(spark, path)
    with pytest.raises(Exception, match="lost"):
        runstore.append_runs(runs(["a", "b", "c", "d"], bad=True), path)
    with pytest.raises(FileNotFoundError):
        runstore.read_runs(spark, path)
    runstore.append_runs(runs(["a", "b"]), path)
    runstore.append_runs(runs(["a", "b"]), path)
    assert stored() == ["a", "b"]
    runstore.append_runs(runs(["b", "c"]), path)
    assert stored() == ["a", "b", "c"]
    # Rows whose commit is missing, as a writer leaves them that stops between the two.
    left = runs(["x", "y"]).withColumn("stage", F.lit("tune"))
    left.write.partitionBy("stage").parquet(f"{path}/batch=bstopped")
    assert stored() == ["a", "b", "c"]
    runstore.append_runs(runs(["x"]), path)
    assert stored() == ["a", "b", "c", "x"]
    with pytest.raises(Exception, match="run_id"):
        runstore.append_runs(runs([None]), path)


def test_split_files_are_pruned(spark, customers):
    path = fresh_path(spark, "splits")
    marked = customers.select("row_id", F.when(F.col("row_id") < 100, "test").otherwise("train").alias("split"))
    tables.write_splits(marked, path)
    guarded = tables.read_splits(spark, path)
    assert guarded.count() == 400
    plan = guarded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_stage_files_are_pruned(spark):
    path = fresh_path(spark, "runs")
    rows = spark.createDataFrame([("a", "tune"), ("b", "baseline")], "run_id string, stage string")
    rows = rows.select("run_id", F.create_map(F.lit("stage"), "stage").alias("tags"))
    runstore.append_runs(rows, path)
    runstore.append_runs(rows.withColumn("run_id", F.upper("run_id")), path)
    assert sorted(r.run_id for r in runstore.read_runs(spark, path, "tune").collect()) == ["A", "a"]


def test_missing_metric_and_tag(spark):
    runs = spark.createDataFrame([("a", "n1"), ("b", "n2")], "run_id string, run_name string")
    metrics = spark.createDataFrame(
        [("a", "roc_auc", 0.5, 1, 0), ("a", "roc_auc", 0.7, 2, 1)], "run_id string, key string, value double, ts long, step long"
    )
    tags = spark.createDataFrame([("a", "stage", "tune")], "run_id string, key string, value string")
    rows = runstore.consolidated(runs, metrics, tags).collect()
    assert [r.run_id for r in rows] == ["a", "b"]
    assert rows[0].roc_auc == 0.7 and rows[1].roc_auc is None and rows[1].stage == ""


def test_markdown(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", None)], "name string, v double")
    lines = [r.line for r in artifacts.markdown_table(df, [F.asc("name")]).orderBy("position").collect()]
    assert lines == ["| name | v |", "|---|---|", "| a | nan |", "| b | 0.5000 |"]


def test_shared_dir_comes_from_the_session(spark):
    before = shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == before
    assert fresh_path(spark, "x").startswith(before) and fresh_path(spark, "x") != fresh_path(spark, "x")


# --- streams --------------------------------------------------------------------------------


def add_file(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")


def test_late_rows_are_dropped(spark):
    source, out, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "cp"))
    schema = "ts timestamp, kind string"

    def run():
        stream = spark.readStream.schema(schema).json(source)
        hist = stream_drift.window_histograms(stream, ["kind"], window="1 day", late="1 hour")
        stream_drift.start_window_histograms(hist, out=out, checkpoint=checkpoint).awaitTermination()
        return hist.schema

    add_file(source, "a", [{"ts": "2024-01-01T10:00:00Z", "kind": "x"}, {"ts": "2024-01-02T10:00:00Z", "kind": "x"}])
    run()
    add_file(source, "b", [{"ts": "2024-01-01T11:00:00Z", "kind": "y"}, {"ts": "2024-01-05T00:00:00Z", "kind": "x"}])
    found = spark.read.schema(run()).parquet(out)
    rows = {(r.window_start.day, r.value): r.n for r in found.collect()}
    assert rows == {(1, "x"): 1, (2, "x"): 1}


def test_count_windows_span_batches_and_survive_a_restart(spark):
    source, out, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "cp"))

    def run():
        stream = spark.readStream.schema("id long, kind string").json(source)
        stream_drift.start_count_windows(
            stream, key="id", features=["kind"], size=10, out=out, checkpoint=checkpoint
        ).awaitTermination()
        return {(r.window_id, r.value): r.n for r in stream_drift.read_count_windows(spark, out, 10).collect()}

    add_file(source, "a", [{"id": i, "kind": "x"} for i in range(14)])
    assert run() == {(0, "x"): 10}
    add_file(source, "b", [{"id": i, "kind": "y"} for i in range(14, 27)])
    assert run() == {(0, "x"): 10, (1, "x"): 4, (1, "y"): 6}
    # The last commit is lost: the batch runs again and replaces its own files.
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (f"{checkpoint}/commits/{last}", f"{checkpoint}/commits/.{last}.crc"):
        if os.path.exists(name):
            os.unlink(name)
    assert run() == {(0, "x"): 10, (1, "x"): 4, (1, "y"): 6}


def test_count_windows_against_positions(spark):
    df = spark.range(0, 3000, 3).repartition(7)
    rows = drift.count_windows(df, "id", 100, start=50).collect()
    assert all(r.window_id == (r.id // 3 + 50) // 100 for r in rows) and len(rows) == 1000
