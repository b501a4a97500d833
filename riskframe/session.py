"""Session defaults and the place where intermediate tables are written."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "riskframe", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RISKFRAME_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    Taken from ``spark.checkpoint.dir``.  Only a local-mode session may go without
    that setting; it gets a temporary folder on the one machine it has.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="riskframe-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: later jobs start from the files."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers; call it before handing Spark a Python function.

    Workers that start in the package's folder or with it in PYTHONPATH have it already; others get it as an
    archive, once per session.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.getcwd() == root or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    context = spark.sparkContext
    if not getattr(context, "_riskframe_shipped", False):
        folder = tempfile.mkdtemp(prefix="riskframe-code-")
        context.addPyFile(shutil.make_archive(os.path.join(folder, "riskframe"), "zip", root, "riskframe"))
        context._riskframe_shipped = True
