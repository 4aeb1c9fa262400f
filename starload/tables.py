"""Intermediate tables in the folder that every executor can reach."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a fresh /tmp folder only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Where this application writes its intermediate tables; remove it after the final write."""
    return f"{shared_folder(spark)}/starload-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but stays columnar: later readers prune
    columns, and Catalyst plans joins from the real file sizes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote and that nothing will read again."""
    for table in tables:
        jvm = table.sparkSession._jvm
        hadoop = table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def side_by_side(spark: SparkSession, *steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run independent steps at the same time, so that small jobs fill gaps left by large ones."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in running]
